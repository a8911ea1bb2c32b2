"""Exact quantiles against numpy, also when ranges have to be narrowed often."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.plans import quantiles as Q

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def data(kind, n=3000):
    r = random.Random(kind)
    if kind == "uniform":
        return [r.uniform(-5, 5) for _ in range(n)]
    if kind == "skewed":  # magnitudes over hundreds of decades
        return [r.choice([-1, 1]) * 10 ** r.uniform(-300, 300) for _ in range(n)]
    if kind == "one value":
        return [7.0] * n
    if kind == "mostly one value":
        return [1.0] * (n - 40) + [r.uniform(0, 2) for _ in range(40)]
    if kind == "extremes":
        return [-1.7e308, 1.7e308] * 5 + [r.gauss(0, 1) for _ in range(n)]
    return [float(r.randrange(20)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["uniform", "skewed", "one value", "mostly one value",
                                  "extremes", "few values"])
def test_against_numpy(spark, monkeypatch, kind):
    monkeypatch.setattr(Q, "SMALL_RANGE", 20)
    monkeypatch.setattr(Q, "BUCKETS", 16)
    values = data(kind)
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "x double")
    ordered = np.sort(values)
    discrete = [ordered[max(0, math.ceil(p * len(values)) - 1)] for p in PROBABILITIES]
    assert Q.quantiles(df, {"x": PROBABILITIES})["x"] == discrete
    if kind != "extremes":
        linear = np.quantile(values, PROBABILITIES)
        assert Q.quantiles(df, {"x": PROBABILITIES}, interpolated=True)["x"] == \
            pytest.approx(linear.tolist())


@pytest.mark.parametrize("kind", ["uniform", "skewed", "mostly one value", "few values"])
def test_ranks_outside_their_bracket(spark, monkeypatch, kind):
    """A sketch too small for its margin: exact counts tell, and the whole column is searched."""
    monkeypatch.setattr(Q, "SMALL_RANGE", 20)
    monkeypatch.setattr(Q, "SKETCH_K", 8)
    monkeypatch.setattr(Q, "MARGIN", 0.0)
    searched, search = [], Q._search
    monkeypatch.setattr(Q, "_search", lambda df, targets: searched.append((df.columns, len(targets))) or search(df, targets))
    values = data(kind)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    ordered = np.sort(values)
    discrete = [ordered[max(0, math.ceil(p * len(values)) - 1)] for p in PROBABILITIES]
    assert Q.quantiles(df, {"x": PROBABILITIES})["x"] == discrete
    if kind == "uniform":
        assert searched[-1][0] == ["x"] and searched[-1][1] > 0


def test_only_values_inside_brackets_are_kept(spark, monkeypatch):
    kept = []
    materialize = Q.scratch.materialize
    def watch(df, name):
        copy, path = materialize(df, name)
        kept.append(copy.count())
        return copy, path
    monkeypatch.setattr(Q.scratch, "materialize", watch)
    n = 200_000
    df = spark.range(n).selectExpr("id * 7 % 200003 AS a", "if(id % 10 < 4, 5, id) AS b", "id % 3 AS c", "rand(1) AS d")
    found = Q.quantiles(df, {c: [0.25, 0.5] for c in "abcd"})
    assert len(kept) == 1 and kept[0] < 0.05 * n
    a = sorted(k * 7 % 200003 for k in range(n))
    b = sorted(5 if k % 10 < 4 else k for k in range(n))
    assert (found["a"], found["b"], found["c"]) == ([a[n // 4 - 1], a[n // 2 - 1]], [5, b[n // 2 - 1]], [0, 1])


def test_integers_stay_integers(spark):
    df = spark.createDataFrame([(i, i * 10**9) for i in range(1, 11)], "a int, b long")
    assert Q.quantiles(df, {"a": [0.5], "b": [0.25, 0.75]}) == \
        {"a": [5], "b": [3 * 10**9, 8 * 10**9]}


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    assert Q.quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [None], "b": [1]}
    assert Q.quantiles(df.limit(0), {"b": [0.5]}) == {"b": [None]}
    assert Q.iqr_fences(df, ["a", "b"]) == {"b": (1.0, 1.0)}
    assert Q.quantiles(df, {}) == {}


def test_whole_numbers_beyond_doubles(spark):
    r = random.Random(3)
    values = [2**60 + 1] * 3
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert Q.quantiles(df, {"v": [0.5]}) == {"v": [2**60 + 1]}
    values = [r.choice([2**60 + r.randrange(50), -2**62 + r.randrange(9), r.randrange(10**18), -2**63, 2**63 - 1])
              for _ in range(30_000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(4)
    values.sort()
    wanted = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    expected = [values[max(1, -(-int(p * 1000) * len(values) // 1000)) - 1] for p in wanted]
    assert Q.quantiles(df, {"v": wanted}) == {"v": expected}


def test_look_taken_with_another_action(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_021).alias("a"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("b"),
                                    F.lit(None).cast("int").alias("c"))
    look = Q.Look(df, ["c", "a", "b"])
    look.df.count()
    wanted = {"a": [0.25, 0.5], "b": [0.5], "c": [0.5]}
    assert Q.quantiles(df, wanted, look=look) == Q.quantiles(df, wanted)
