"""Group values with and without hot groups."""

import pytest
from pyspark.sql import Window, functions as F

from vigil.operators import flags
from vigil.plans import skew


@pytest.mark.parametrize("hot_rows, few_groups", [(1, 0), (5, 0), (10**9, 0), (5, 10**6)])
def test_equals_the_window(spark, hot_rows, few_groups):
    rows = [(i, "hot" if i % 3 else f"k{i % 20}", None if i % 5 == 0 else i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, a string, b int").repartition(7)
    got = skew.with_group_value(df, ["a", "b"], "total", F.sum("id"), hot_rows, few_groups)
    expected = df.withColumn("total", F.sum("id").over(Window.partitionBy("a", "b")))
    assert sorted(got.collect(), key=repr) == sorted(expected.collect(), key=repr)
    assert got.columns == df.columns + ["total"]


def test_copies_of_one_row(spark):
    df = spark.createDataFrame([("x", 1)] * 500, "a string, b int").repartition(6)
    got = skew.with_group_value(df, ["a"], "n", F.count(F.lit(1)), hot_rows=10, few_groups=0)
    assert {r.n for r in got.collect()} == {500} and got.count() == 500


@pytest.mark.parametrize("hot_rows", [1, 2, 100])
def test_duplicate_flag(reports, hot_rows):
    flagged = flags.flag_duplicate(reports, hot_rows).where("is_duplicate").collect()
    assert sorted(r.case_count for r in flagged) == [100, 150]


def test_scope_removes_the_copies_made_inside(spark):
    from pathlib import Path

    from vigil.plans import scratch

    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, a int")
    before = set(Path(scratch.scratch_root(spark).removeprefix("file:")).iterdir())
    with scratch.scope(spark):
        got = skew.with_group_value(df, ["a"], "n", F.count(F.lit(1)), few_groups=0)
        assert got.count() == 30
    assert set(Path(scratch.scratch_root(spark).removeprefix("file:")).iterdir()) <= before
