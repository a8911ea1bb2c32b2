"""op6 against word counts, all segmentations, and on held-out documents."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from vigil.llm import lattice
from vigil.llm.op6_lattice_lm import score, vocabulary_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def words_of(text):
    return (text or "").encode().lower().split()


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_forward_sums_all_segmentations():
    pieces = lattice.Pieces([b" ", b" a", b"a", b"ab", b"b", b" ab", b"ba"])
    rng = np.random.default_rng(2)
    p = rng.random(len(pieces.words) + 1)
    log_p = np.log(p / p.sum())
    of = {}
    for i, w in enumerate(pieces.words):
        of.setdefault(w, []).append(i)

    def ways(text):
        if not text:
            yield []
        for n in range(1, len(text) + 1):
            for i in of.get(text[:n], ()):
                for rest in ways(text[n:]):
                    yield [i, *rest]

    words = [bytes(w) for n in range(5) for w in itertools.product(b"ab", repeat=n)] + [b"xa", b"aby"]
    got = lattice.marginals(pieces, words, log_p)
    weights = np.arange(1.0, len(words) + 1)
    uses = np.zeros(len(pieces.words))
    for w, g, weight in zip(words, got, weights):
        found = [(math.exp(log_p[i].sum()), i) for i in ways(b" " + w)]
        total = sum(q for q, _ in found)
        assert g == pytest.approx(math.log(total), abs=1e-12)
        for q, i in found:
            np.add.at(uses, i, weight * q / total)
    assert lattice.expected(pieces, words, weights, log_p) == pytest.approx(uses, abs=1e-9)


@pytest.mark.parametrize("heavy", [0, 5, 150_000])
def test_base_scores(frame, odd_rows, heavy):
    counts, ends = Counter(), 0
    for i, t in odd_rows:
        if not held_out(i):
            counts.update(words_of(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    expected = []
    for i, t in odd_rows:
        uses = [counts[w] for w in words_of(t)] + [ends]
        expected.append((str(i), held_out(i), len(uses), sum(c > 0 for c in uses), n,
                         sum(math.log10((c + 1) / (n + v + 1)) for c in uses)))
    found = score(frame(odd_rows), MODEL, heavy_words=heavy).collect()
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found]
    for a, b in zip(sorted(got), sorted(expected), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r.score < 0 for r in found)


def test_scores_equal_the_lattice_and_prefer_likely_text(frame):
    random.seed(9)
    common = ["the", "house", "reading", "walked", "river"]
    rows = [(i, " ".join(random.choice(common) for _ in range(40))) for i in range(80)]
    rows += [(1000 + i, "".join(random.choice("qxzjvk") for _ in range(150))) for i in range(5)]
    found = {r.doc_id: r for r in score(frame(rows), MODEL).collect()}
    like = [r.score / r.n_tokens for r in found.values() if r.held_out and r.doc_id < 1000]
    seen = [r.score / r.n_tokens for r in found.values() if not r.held_out and r.doc_id < 1000]
    odd = [r.score / r.n_tokens for r in found.values() if r.doc_id >= 1000]
    assert like and abs(np.mean(like) - np.mean(seen)) < 0.1
    assert min(like) > max(odd)
    # Training makes held-out text of the same kind likelier than the first weights do.
    pieces, first = vocabulary_pieces(MODEL)
    untrained = np.mean(lattice.marginals(pieces, [w.encode() for w in common], first)) / math.log(10)
    assert np.mean(like) > untrained


def test_nothing_to_learn_from(spark, frame):
    assert score(frame([]), MODEL).count() == 0
    out = next(i for i in range(100) if held_out(i))
    row, = score(frame([(out, "only this")]), MODEL).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
