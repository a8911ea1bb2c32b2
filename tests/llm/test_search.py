"""op5 against all inner products."""

import numpy as np
import pytest

from vigil.llm.op5_forest_search import search


@pytest.fixture(scope="module")
def make(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int") \
            .selectExpr("*", "1 AS query", "2 AS score", "3 AS v", "4 AS id").repartition(3)

    return frame


def truth(rows, k=20):
    seen = {}
    for i, v, _ in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8:
            seen[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in seen:
        if q % 20 == 0:
            near = sorted((-(seen[q] * x).sum(), i) for i, x in seen.items() if i != q)[:k]
            out[q] = [i for _, i in near], [-s for s, _ in near]
    return out


def random_rows(n, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, rng.standard_normal(8).astype(np.float32).tolist(), 0) for i in range(n)]


def by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_recall_and_scores(make):
    rows = random_rows(3000)
    found, expected = by_query(search(make(rows))), truth(rows)
    hits = sum(len({i for _, i, _ in found[q]} & set(expected[q][0])) for q in expected)
    assert hits / (20 * len(expected)) >= 0.9
    vectors = {i: np.array(v) for i, v, _ in rows}
    for q, answers in found.items():
        assert [r for r, _, _ in answers] == list(range(1, 21))
        keys = [(-s, i) for _, i, s in answers]
        assert keys == sorted(keys)
        for _, i, s in answers:
            assert s == pytest.approx(float((vectors[q] * vectors[i]).sum()), abs=1e-12)


def test_copies_ties_and_rows_that_take_no_part(make):
    rows = random_rows(30)
    rows += [(i, rows[2][1], 1) for i in range(100, 190)]  # one vector, very often
    rows += [(200, None, 0), (201, [0.0] * 8, 0), (202, [None] + [1.0] * 7, 0), (203, [float("nan")] * 8, 0),
             (204, [float("inf")] * 8, 0), (220, [], 0), (240, [1.0] * 5, 0), (None, [1.0] * 8, 0),
             rows[4], rows[20]]
    found, expected = by_query(search(make(rows))), truth(rows)
    assert {q: [i for _, i, _ in v] for q, v in found.items()} == {q: i for q, (i, _) in expected.items()}


def test_few_or_no_rows(make):
    assert search(make([])).count() == 0
    assert search(make([(0, None, 0), (20, [0.0, 0.0], 0)])).count() == 0
    assert search(make([(0, [1.0, 0.0], 0)])).count() == 0
    rows = [(0, [1.0] * 8, 0), (1, [2.0] * 8, 0), (20, [3.0] * 8, 0)]
    assert {q: [i for _, i, _ in v] for q, v in by_query(search(make(rows))).items()} == {0: [20, 1], 20: [1, 0]}
