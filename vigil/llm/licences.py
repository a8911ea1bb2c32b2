"""Licence names, notice phrases and licence expressions."""

import re
from dataclasses import dataclass

# Fixed values. Phrases of the base count, as words, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Fixed values. Further phrases of licence notices, their labels and weights (how
# surely the phrase alone tells of a licence).
NOTICES = {
    "gnu lesser general public license": ("lgpl", 0.7),
    "gnu library general public license": ("lgpl", 0.7),
    "gnu affero general public license": ("agpl", 0.7),
    "gnu gpl": ("gpl", 0.5),
    "mozilla public license": ("mpl", 0.7),
    "eclipse public license": ("epl", 0.7),
    "european union public licence": ("eupl", 0.7),
    "bsd license": ("bsd", 0.6),
    "isc license": ("isc", 0.6),
    "boost software license": ("boost", 0.7),
    "open database license": ("odbl", 0.7),
    "open font license": ("ofl", 0.6),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "permission is hereby granted free of charge": ("mit", 0.8),
    "permission to use copy modify and or distribute this software": ("isc", 0.8),
    "free and unencumbered software released into the public domain": ("unlicense", 0.9),
    "creative commons attribution": ("cc-by", 0.6),
    "creative commons zero": ("cc0", 0.6),
    "cc0": ("cc0", 0.5),
    "cc by nc": ("cc-by-nc", 0.6),
    "cc by nd": ("cc-by-nd", 0.6),
    "cc by sa": ("cc-by-sa", 0.6),
    "cc by nc nd": ("cc-by-nc-nd", 0.6),
    "cc by nc sa": ("cc-by-nc-sa", 0.6),
    "all rights reserved": ("all-rights-reserved", 0.4),
}
BASE_WEIGHT, EXPRESSION_WEIGHT = 0.6, 0.9

# Fixed values. What stands before a licence expression, in lower case.
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:", '"license":', "@license")

# Fixed values. Beginnings of licence identifiers in lower case: label, and what the
# licence asks of those who pass a work on (0 nothing, 1 a notice, 2 share the files,
# 3 share the whole work, 4 share it with users of a service too, 5 no such use).
IDENTIFIERS = {
    "0bsd": ("bsd", 0), "cc0-": ("cc0", 0), "unlicense": ("unlicense", 0), "wtfpl": ("wtfpl", 0),
    "mit-0": ("mit", 0), "mit": ("mit", 1), "x11": ("mit", 1), "isc": ("isc", 1), "zlib": ("zlib", 1),
    "bsd-": ("bsd", 1), "apache-": ("apache", 1), "bsl-1.0": ("boost", 1), "python-2.0": ("python", 1),
    "artistic-": ("artistic", 1), "cc-by-": ("cc-by", 1), "ofl-": ("ofl", 2),
    "mpl-": ("mpl", 2), "epl-": ("epl", 2), "cddl-": ("cddl", 2), "lgpl-": ("lgpl", 2),
    "gpl-": ("gpl", 3), "eupl-": ("eupl", 3), "odbl-": ("odbl", 3), "cc-by-sa-": ("cc-by-sa", 3),
    "agpl-": ("agpl", 4), "cc-by-nd-": ("cc-by-nd", 5), "cc-by-nc-": ("cc-by-nc", 5),
    "cc-by-nc-nd-": ("cc-by-nc-nd", 5), "cc-by-nc-sa-": ("cc-by-nc-sa", 5), "licenseref-": ("other", 5),
}
#: An exception takes the duty to share the whole work down to sharing the files.
EXCEPTION = re.compile(r".*-exception\b.*|linux-syscall-note")
SHARED_FILES = 2

WITH, AND, OR = "with", "and", "or"
BINDS = {WITH: 3, AND: 2, OR: 1}
TOKEN = re.compile(r"[ \t\"']*([()]|[a-z0-9.+\-]+)")


@dataclass(frozen=True)
class Terms:
    labels: frozenset[str]
    duty: int


def identifier(token: str) -> Terms | None:
    """The licence that a token names, by the longest known beginning."""
    name = token.rstrip("+")
    for length in range(len(name), 0, -1):
        known = IDENTIFIERS.get(name[:length])
        # A name without a trailing dash must be whole.
        if known and (name[:length].endswith("-") and length < len(name) or length == len(name)):
            return Terms(frozenset([known[0]]), known[1])
    return None


def expression(text: str, start: int, end: int) -> Terms | None:
    """Terms of the longest licence expression that begins at start, in lower-case text.

    Operators bind in the order with, and, or. None where no licence stands there.
    """
    tokens, whole, depth, operand = [], 0, 0, True
    at = start
    while found := TOKEN.match(text, at, end):
        token = found[1]
        after_with = bool(tokens) and tokens[-1] == WITH
        if operand:
            if token == "(" and not after_with:
                depth += 1
            elif after_with and EXCEPTION.fullmatch(token) or not after_with and identifier(token):
                operand = False
            else:
                break
        elif token == ")" and depth:
            depth -= 1
        elif token in BINDS and not (token == WITH and tokens[-1] == ")"):
            operand = True
        else:
            break
        tokens.append(token)
        at = found.end()
        if not operand and not depth:
            whole = len(tokens)
    return evaluate(tokens[:whole]) if whole else None


def evaluate(tokens: list[str]) -> Terms:
    """Shunting-yard: operands and operators wait on two stacks until what binds weaker comes."""
    values, waiting = [], []

    def apply() -> None:
        operator, right, left = waiting.pop(), values.pop(), values.pop()
        if operator == WITH:
            duty = min(left.duty, SHARED_FILES)
        else:
            duty = (max if operator == AND else min)(left.duty, right.duty)
        values.append(Terms(left.labels | right.labels, duty))

    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                apply()
            waiting.pop()
        elif token in BINDS:
            while waiting and BINDS.get(waiting[-1], 0) >= BINDS[token]:
                apply()
            waiting.append(token)
        else:
            values.append(identifier(token) or Terms(frozenset(), 0))
    while waiting:
        apply()
    return values[0]
