"""Byte-pair encoding by dynamic programming over prefixes.

The encoding of a prefix without its last token is the encoding of the shorter
prefix, so one last token per prefix describes all of them. A token can be the
last one of a prefix if it ends there (the suffix links of an automaton of the
vocabulary list all that do, longest first), if it is what its own bytes encode
to, and if the last token of the prefix before it stays apart from it.

Tokens a, b stay apart unless a merge joins a part x on a's right edge with a
part y on b's left edge while both stand there: after x and y were made, before
x is merged inside a, and not after y is merged inside b.
"""

import functools
import json
import re

import ahocorasick
import regex

from vigil.llm.vocabulary import OTHER_SPACE, SEGMENT, byte_letters, pack
from vigil.llm.workers import Memo

NEVER = 1 << 60
#: Fixed value: the pattern at which byte-level vocabularies of this make split text.
SPLITS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class PrefixBpe:
    """Ids of whole texts, and texts of ids, for a byte-level tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        if data["pre_tokenizer"]["type"] != "ByteLevel" or data["normalizer"] is not None:
            raise ValueError("only byte-level vocabularies without normalizer")
        byte_of = {letter: b for b, letter in byte_letters().items()}
        model = data["model"]
        vocab = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items()}
        self.added = {a["content"]: a["id"] for a in data["added_tokens"]}
        self.between = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) \
            if self.added else None
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (bytes(byte_of[c] for c in t)
                           for t in (merge if isinstance(merge, list) else merge.split(" ")))
            a, b = vocab[left], vocab[right]
            self.rank[a, b] = rank
            self.halves[vocab[left + right]] = (a, b, rank)
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = token
        for text, i in self.added.items():
            self.bytes_of[i] = text.encode()
        self.apart = Memo(self._apart)
        self.whole = Memo(self._whole)
        self.splits = Memo(lambda split: pack(self.encode_split(split.encode())))
        self.segments = Memo(lambda segment: self._section(segment.decode()))

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts on an edge of a token, each with the rank of the merge that ends it."""
        parts, until = [], NEVER
        while True:
            parts.append((token, until))
            if token not in self.halves:
                return parts
            *both, until = self.halves[token]
            token = both[side]

    def _apart(self, pair: tuple[int, int], below: int = NEVER) -> bool:
        for x, x_until in self._edge(pair[0], 1):
            for y, y_until in self._edge(pair[1], 0):
                rank = self.rank.get((x, y), NEVER)
                if rank < below and rank < x_until and rank <= y_until:
                    return False
        return True

    def _whole(self, token: int) -> bool:
        """Whether the token's own bytes encode to it: nothing joins its halves early."""
        if token not in self.halves:
            return True
        a, b, rank = self.halves[token]
        return self.whole[a] and self.whole[b] and self._apart((a, b), rank)

    def encode_split(self, data: bytes) -> list[int]:
        """Ids of bytes that are not split further."""
        last: list[int] = [-1] * (len(data) + 1)
        for end, (length, token) in self.automaton.iter(data.decode("latin-1")):
            start = end + 1 - length
            if last[end + 1] < 0 and self.whole[token] and (
                    start == 0 or last[start] >= 0 and self.apart[last[start], token]):
                last[end + 1] = token
        ids, at = [], len(data)
        while at:
            ids.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return ids[::-1]

    def _section(self, text: str) -> bytes:
        return b"".join(map(self.splits.__getitem__, SPLITS.findall(text)))

    def encode(self, data: bytes) -> bytes:
        """Packed ids of a whole text."""
        if self.between is None or not any(a.encode() in data for a in self.added):
            return self._plain(data)
        text, out, at = data.decode(), [], 0
        for found in self.between.finditer(text):
            out += [self._plain(text[at:found.start()].encode()), pack([self.added[found[0]]])]
            at = found.end()
        return b"".join([*out, self._plain(text[at:].encode())])

    def _plain(self, data: bytes) -> bytes:
        if not data.isascii() and OTHER_SPACE.search(data.decode()):
            return self._section(data.decode())
        return b"".join(map(self.segments.__getitem__, SEGMENT.findall(data)))

    def decode(self, ids) -> bytes:
        """UTF-8 of the text; bytes that are no UTF-8 become replacement characters."""
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        return data.decode("utf-8", "replace").encode()


@functools.cache
def prefix_bpe(path: str) -> PrefixBpe:
    return PrefixBpe(path)
