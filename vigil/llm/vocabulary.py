"""Encoding of whole texts by public tokenizer files, remembered by segment.

A segment is a run of ASCII white space with the run of other characters after
it. Both public vocabularies encode a text as its segments one after another:
a split never depends on what stands before a change from text to white space,
except where other Unicode white space stands beside it. Texts with such
characters, and tokenizers of another make, go to the library as a whole.
"""

import functools
import json
import os
import re
import struct
from itertools import islice

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

from vigil.llm.passages import portions  # noqa: E402
from vigil.llm.workers import Memo  # noqa: E402

NONE = np.iinfo(np.int32).max
#: Words, and parts of words, that a worker's encoder keeps: it lives on in workers that
#: go on with other work. Bytes of texts whose words are split and looked up at once.
KEPT_WORDS, LOT_BYTES = 200_000, 2 << 20

SEGMENT = re.compile(rb"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: How the word vocabulary splits lower-case text of these characters.
PLAIN_WORD = re.compile("[!-~À-ÖØ-öø-ÿ]+")
WORD_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 ]+| ")
#: Stands between words of packed ids; ids below 2**16 never hold these bytes in a row.
BETWEEN = b"\xff\xff\xff\xff"


def has_other_space(data: bytes) -> bool:
    """White space beyond ASCII (or a separator that some libraries count as such)."""
    return not data.isascii() and OTHER_SPACE.search(data.decode()) is not None \
        or any(c in data for c in (b"\x1c", b"\x1d", b"\x1e", b"\x1f"))


def pack(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.cache
def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.cache
def description(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    added = data["added_tokens"]
    plain = all(not (a["lstrip"] or a["rstrip"] or a["normalized"] or re.search(r"\s", a["content"]))
                for a in added)
    first = data["pre_tokenizer"]
    byte_level = (first["type"] == "ByteLevel" and first["use_regex"]
                  and not first["add_prefix_space"] and data["normalizer"] is None)
    steps = first.get("pretokenizers", [])
    normal = (data["normalizer"] or {}).get("normalizers", [])
    by_word = (
        [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["invert"]
        and steps[0]["behavior"] == "Removed"
        and steps[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
        and [n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"]
        and data["model"].get("end_of_word_suffix") == "</w>")
    return {"segments": plain and byte_level, "words": plain and by_word,
            "longest_added": max([0, *(len(a["content"]) for a in added)]),
            "model": data["model"]}


class Counter:
    """Token counts by the library; segment counts are remembered."""

    def __init__(self, path: str):
        self.tokenizer, self.about = load(path), description(path)
        self.memo = Memo(lambda s: len(self.ids(s.decode())))

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def whole(self, data: bytes) -> int:
        if self.about["segments"] and not has_other_space(data):
            return sum(map(self.memo.__getitem__, SEGMENT.findall(data)))
        return len(self.ids(data.decode()))

    def boundaries(self, text: str) -> tuple[list[int], list[int], int]:
        """Starts of splits (in characters), the tokens before each, and all tokens."""
        data = text.encode()
        if self.about["segments"] and not has_other_space(data):
            starts, before, at, n = [], [], 0, 0
            for s in SEGMENT.findall(data):
                starts.append(at)
                before.append(n)
                at += len(s) if s.isascii() else len(s.decode())
                n += self.memo[s]
            return starts, before, n
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        starts, before, last = [], [], object()
        for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
            if word is None or word != last:
                starts.append(start)
                before.append(i)
            last = word
        return starts, before, len(encoding)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


class Merges:
    """Byte-pair merges of many short runs at once: one merge of every run per step.

    Each step takes the leftmost pair of the lowest rank in every run, as the
    merges are defined, so the result equals that of one run after another.
    """

    def __init__(self, model: dict):
        vocab, letters = model["vocab"], byte_letters()
        end = model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + end] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def _same_width(self, runs: list[bytes], width: int) -> list[bytes]:
        """Packed ids of runs of at most width bytes."""
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        data = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in runs), np.uint8)
        ids = self.inner[data.reshape(len(runs), width)]
        ids[np.arange(len(runs)), lengths - 1] = self.last[data.reshape(len(runs), width)[
            np.arange(len(runs)), lengths - 1]]
        ids[np.arange(width) >= lengths[:, None]] = -1
        out, sizes = np.full_like(ids, -1), lengths.copy()
        rows = np.arange(len(runs))
        ranks = np.full(ids.shape, NONE, np.int32)
        ranks[:, :-1] = self.rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            best = ranks[each, at]
            go = best < NONE
            if not go.all():
                out[rows[~go], : ids.shape[1]] = ids[~go]
                rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
                each = np.arange(len(rows))
                if not len(rows):
                    break
            sizes[rows] -= 1
            ids[each, at] = self.made[best]
            columns = np.arange(ids.shape[1] - 1)
            take = columns + (columns > at[:, None])
            ids, ranks = np.take_along_axis(ids, take, 1), np.take_along_axis(ranks, take, 1)
            after = np.minimum(at + 1, ids.shape[1] - 1)
            follows = np.where(at + 1 < ids.shape[1], ids[each, after], -1)
            ranks[each, at] = self.rank(ids[each, at], follows)
            some = np.flatnonzero(at > 0)
            ranks[some, at[some] - 1] = self.rank(ids[some, at[some] - 1], ids[some, at[some]])
        flat = out.astype("<u4").tobytes()
        return [flat[4 * i * width: 4 * (i * width + n)] for i, n in enumerate(sizes.tolist())]

    def encode(self, runs: list[bytes]) -> list[bytes]:
        """Packed ids of each run; all runs are short and not empty."""
        found, by_width = [b""] * len(runs), {}
        for i, run in enumerate(runs):
            by_width.setdefault(-(-len(run) // 4) * 4, []).append(i)
        for width, group in by_width.items():
            for at in range(0, len(group), 8192):
                some = group[at:at + 8192]
                for i, ids in zip(some, self._same_width([runs[i] for i in some], width)):
                    found[i] = ids
        return found


class WordEncoder:
    """Packed ids of whole texts by a vocabulary that drops white space.

    Words are remembered in lower case. New words of a batch are cut into the
    runs that the vocabulary splits at, and the runs that are new are merged
    together. Words of unusual characters, very long words and texts that may
    hold added tokens are encoded by the library.
    """

    LONGEST = 64

    def __init__(self, path: str):
        self.tokenizer, self.about = load(path), description(path)
        self.merges = Merges(self.about["model"]) if self.about["words"] else None
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _remember(self, kept: dict, fresh: dict) -> None:
        """Add as many of the fresh entries as KEPT_WORDS leaves room for; no very long ones."""
        short = ((k, v) for k, v in fresh.items() if len(k) <= self.LONGEST)
        kept.update(islice(short, max(0, KEPT_WORDS - len(kept))))

    def _library(self, data: bytes) -> bytes:
        return pack(self.tokenizer.encode(data.decode(), add_special_tokens=False).ids)

    def _split(self, data: bytes) -> list[bytes] | None:
        """Words in lower case; None if only the library can tell (added tokens)."""
        if not self.about["words"] or b"<|" in data:
            return None
        return data.lower().split()

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of different words, none of them remembered."""
        plain = [t for t in b" ".join(words).decode().split(" ")
                 if len(t) <= self.LONGEST and PLAIN_WORD.fullmatch(t)]
        parts = WORD_PARTS.findall(" ".join(plain).lower())
        runs = [r for r in set(parts) if r not in self.parts and r != " "]
        here = dict(zip(runs, self.merges.encode([r.encode() for r in runs])))
        look = here | {r: self.parts[r] for r in set(parts) if r in self.parts}
        self._remember(self.parts, here)
        ids = [BETWEEN if r == " " else look[r] for r in parts]
        found = dict(zip([t.encode() for t in plain], b"".join(ids).split(BETWEEN)))
        found.update((w, self._library(w)) for w in words if w not in found)
        return found

    def encode_batch(self, batch: list[bytes]) -> list[bytes]:
        return [ids for a, b in portions(batch, LOT_BYTES) for ids in self._encode_lot(batch[a:b])]

    def _encode_lot(self, batch: list[bytes]) -> list[bytes]:
        split = [self._split(data) for data in batch]
        ids = [words and list(map(self.words.get, words)) for words in split]
        gaps = [i for i, found in enumerate(ids) if found and None in found]
        new = {w for i in gaps for w, v in zip(split[i], ids[i]) if v is None}
        if new:
            fresh = self._encode_words(list(new))
            for i in gaps:
                ids[i] = [fresh[w] if v is None else v for w, v in zip(split[i], ids[i])]
            self._remember(self.words, fresh)
        return [self._library(data) if words is None else b"".join(found or ())
                for data, words, found in zip(batch, split, ids)]


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
