"""op11 against regular expressions and a recursive reading of expressions."""

import random
import re

import pytest

from vigil.llm.licences import BASE, EXCEPTION, NOTICES, expression, identifier
from vigil.llm.op11_licence_scan import scan

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: The four base phrases as the contract states them.
STATED = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in STATED.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k:k + len(p)] == p]
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def read(tokens):
    """Grammar, top down: the value and what is left, or None."""

    def unit(rest):
        if rest and rest[0] == "(":
            value, rest = level(rest[1:], "or")
            assert rest[0] == ")"
            return value, rest[1:]
        t = identifier(rest[0])
        value, rest = (set(t.labels), t.duty), rest[1:]
        if rest and rest[0] == "with":
            value, rest = (value[0], min(value[1], 2)), rest[2:]
        return value, rest

    def level(rest, operator):
        below = unit if operator == "and" else lambda r: level(r, "and")
        value, rest = below(rest)
        while rest and rest[0] == operator:
            right, rest = below(rest[1:])
            value = (value[0] | right[0], (max if operator == "and" else min)(value[1], right[1]))
        return value, rest

    return level(tokens, "or")


def random_expression(depth):
    roll = random.random()
    if depth and roll < 0.3:
        return ["(", *random_expression(depth - 1), ")"]
    if depth and roll < 0.8:
        return [*random_expression(depth - 1), random.choice(["and", "or"]), *random_expression(depth - 1)]
    name = random.choice(["mit", "apache-2.0", "gpl-2.0-only", "gpl-3.0+", "agpl-3.0-or-later", "cc0-1.0",
                          "lgpl-2.1", "bsd-3-clause", "licenseref-own", "mpl-2.0", "cc-by-nc-sa-4.0"])
    return [name, "with", "classpath-exception-2.0"] if random.random() < 0.2 else [name]


def test_expressions_equal_a_recursive_reading():
    random.seed(11)
    assert EXCEPTION.fullmatch("classpath-exception-2.0")
    for _ in range(2000):
        tokens = random_expression(5)
        text = " ".join(tokens)
        value, rest = read(tokens)
        assert rest == []
        found = expression(text, 0, len(text))
        assert (set(found.labels), found.duty) == value
        tail = random.choice(["", " and", " or (", " */ mit", ")", " nothing", " with mit", " ("])
        found = expression(text + tail, 0, len(text + tail))
        assert (set(found.labels), found.duty) == value


@pytest.mark.parametrize("text, labels, duty", [
    ("mit or gpl-2.0", {"mit", "gpl"}, 1),
    ("mit or apache-2.0 and gpl-2.0", {"mit", "apache", "gpl"}, 1),
    ("(mit or apache-2.0) and gpl-2.0", {"mit", "apache", "gpl"}, 3),
    ("gpl-2.0-or-later with gcc-exception-3.1", {"gpl"}, 2),
    ("'cc-by-4.0'", {"cc-by"}, 1),
    ("(mit and (apache-2.0", None, None), ("", None, None), ("mitx", None, None), ("gpl", None, None),
    ("with mit", None, None), ("(" * 50_000 + "mit" + ")" * 50_000, {"mit"}, 1),
    (" and ".join(["mit"] * 50_000), {"mit"}, 1),
])
def test_expression(text, labels, duty):
    found = expression(text, 0, len(text))
    assert (found and set(found.labels), found and found.duty) == (labels, duty)


def test_phrases_are_words():
    assert BASE == STATED
    for phrase in [*BASE, *NOTICES]:
        assert " ".join(WORD.findall(phrase.translate(LOWER))) == phrase


def test_scan(spark, frame, odd_rows):
    random.seed(5)
    words = ["GNU", "general", "Public", "LICENSE", "apache", "License,", "cc", "BY-NC", "by", "mit", "é", "mité", "\n", "…", "İ"]
    rows = odd_rows + [(100 + i, " ".join(random.choice(words) for _ in range(random.randint(1, 60)))) for i in range(300)]
    rows += [
        (500, "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */\nmit"),
        (501, "Licensed under CC BY-NC 4.0."), (502, "mylicense: MIT"), (503, '{"license": "ISC"}'),
        (504, "License:\nMIT"), (505, "Cc-bY cc\x00by CC\xa0BY"), (506, "Permission is hereby granted, free of charge"),
        (507, "x " * 200_000 + "MIT License. " * 3),
        (508, "license: proprietary"), (500, "MIT license"),
    ]
    found = {(r["doc_id"], r["n_words"], r["labels"]): r for r in scan(frame(rows)).collect()}
    assert sorted(map(repr, scan(frame(rows)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect())) == sorted(
        f"Row(doc_id={i}, n_words={b[0]}, n_base={b[1]}, first_word={b[2]}, last_word={b[3]}, base_labels={b[4]!r})"
        for i, b in ((i, base_of(t)) for i, t in rows))
    for r in found.values():
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"]
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    labels = {r["doc_id"]: (r["labels"], r["n_expressions"], r["duty"]) for r in found.values() if (r["doc_id"], r["n_words"]) != (500, 2)}
    assert labels[500] == ("apache,gpl,mit", 1, 2)
    assert labels[501] == ("cc-by,cc-by-nc", 0, None)
    assert (labels[503][0], labels[506][0], labels[507][0]) == ("isc", "mit", "mit")
    assert labels[508] == ("", 0, None)
    assert scan(frame([])).count() == 0
