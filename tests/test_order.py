"""Positions within keys, dealt over ranges."""

import random
from collections import defaultdict

from vigil.plans.order import positions


def test_positions_of_any_type_and_key_size(spark):
    random.seed(8)
    rows = [(random.choice(["hot"] * 5 + ["a", "b", None]), random.choice([None, *"xyz", "é"]), random.random())
            for _ in range(900)]
    rows += [("hot", "same", 1.0)] * 400  # equal rows are dealt out too
    df = spark.createDataFrame(rows, "`a key` string, t string, v double")
    found = positions(df, ["a key"], ["t", "v"], "pos", parts=7)
    assert found.columns == ["a key", "t", "v", "pos"]
    by_key = defaultdict(list)
    for r in found.collect():
        by_key[r["a key"]].append((r["pos"], (r["t"] is not None, (r["t"] or "").encode(), r["v"])))
    assert sum(map(len, by_key.values())) == len(rows)
    for key, got in by_key.items():
        got.sort()
        assert [p for p, _ in got] == list(range(len(got)))
        assert [v for _, v in got] == sorted(
            (t is not None, (t or "").encode(), v) for k, t, v in rows if k == key)


def test_positions_without_keys_and_without_rows(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "n int")
    assert {(r["n"], r["p"]) for r in positions(df, [], ["n"], "p").collect()} == {(None, 0), (1, 1), (3, 2)}
    assert positions(df.where("n > 5"), ["n"], ["n"], "p").count() == 0
