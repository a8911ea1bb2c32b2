"""Windows computed in chunks equal the plain windows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window, functions as F

from vigil.operators import cleaning, windows
from vigil.plans import chunks


def frame(spark, seed, days=40, rows=400, one_day=0.3):
    """Random rows; a share of them falls on one day of one key."""
    r = random.Random(seed)
    data = []
    for i in range(rows):
        if r.random() < one_day:
            key, day = "hot", date(2024, 12, 30)
        else:
            key = r.choice(["hot", "a", "b", None])
            day = r.choice([None, date(2024, 11, 20) + timedelta(days=r.randrange(days))])
        value = r.choice([None, r.randrange(100), r.randrange(100)])
        seen = r.choice([None, None, date(2020, 1, 1) + timedelta(days=r.randrange(900))])
        data.append((i, r.choice([1.0, 2.0, 2.5]) * i, key, day, value, seen))
    return spark.createDataFrame(
        data, "id int, rank double, key string, day date, value int, seen date").repartition(5)


def plain(df, expression, frame_rows):
    order = Window.partitionBy("key").orderBy("day", "rank", "id").rowsBetween(*frame_rows)
    return {r.id: r.x for r in df.select("id", expression.over(order).alias("x")).collect()}


@pytest.mark.parametrize("chunk_rows", [1, 2, 7, 40, 10_000, None])
def test_rolling_average(spark, chunk_rows):
    df = frame(spark, 1)
    rolled = windows.rolling_average(df, ["key"], ["rank", "id"], "day", "value", 7, "x", chunk_rows)
    assert {r.id: r.x for r in rolled.collect()} == plain(df, F.avg("value"), (-6, 0))
    assert rolled.columns == df.columns + ["x"]


@pytest.mark.parametrize("chunk_rows", [1, 5, 60, None])
def test_forward_fill(spark, chunk_rows):
    df = frame(spark, 2)
    filled = cleaning.fill_null_forward(df, "seen", ["key"], "day", ["rank", "id"], chunk_rows)
    expected = plain(df, F.last("seen", ignorenulls=True), (Window.unboundedPreceding, 0))
    assert {r.id: r.seen for r in filled.collect()} == expected
    assert filled.columns == df.columns


def test_forward_fill_over_the_whole_table(spark):
    df = frame(spark, 3)
    filled = cleaning.fill_null_forward(df, "seen", [], "day", ["rank", "id"], 10)
    order = Window.partitionBy(F.lit(1)).orderBy("day", "rank", "id") \
        .rowsBetween(Window.unboundedPreceding, 0)
    expected = df.select("id", F.last("seen", True).over(order).alias("x"))
    assert {r.id: r.seen for r in filled.collect()} == {r.id: r.x for r in expected.collect()}


def test_one_key_on_one_day(spark):
    df = frame(spark, 4, one_day=1.0, rows=1000)
    cut = chunks.cut(df, ["key"], "day", ["rank", "id"], chunk_rows=50)
    sizes = [r["count"] for r in cut.df.groupBy("key", "__day", "__sub").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) >= 10 and max(sizes) <= 150
    rolled = windows.rolling_average(df, ["key"], ["rank", "id"], "day", "value", 7, "x", 50)
    assert {r.id: r.x for r in rolled.collect()} == plain(df, F.avg("value"), (-6, 0))


def test_equal_tie_breaks_stay_together(spark):
    rows = [(i, 1, "k", date(2025, 1, 1), i) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, rank int, key string, day date, value int")
    rolled = windows.rolling_average(df, ["key"], ["rank", "id"], "day", "value", 3, "x", 4)
    assert {r.id: r.x for r in rolled.collect()} == plain(df, F.avg("value"), (-2, 0))


def test_grain_follows_the_largest_period(spark):
    df = frame(spark, 5, one_day=0.0, rows=600, days=365)
    by_limit = {limit: chunks.cut(df, ["key"], "day", ["rank"], limit) for limit in (1000, 10, 300)}
    assert by_limit[1000].single
    assert not by_limit[10].single
    counted = by_limit[300].df.groupBy("key", "__day", "__sub").count()
    assert counted.agg(F.max("count")).first()[0] <= 300


def test_empty_frame(spark):
    df = frame(spark, 6).limit(0)
    assert windows.rolling_average(df, ["key"], ["rank"], "day", "value").count() == 0


@pytest.mark.parametrize("chunk_rows", [3, 50, None])
@pytest.mark.parametrize("along", [
    "timestamp(day) + make_dt_interval(0, 0, 0, rank)", "CAST(day AS TIMESTAMP_NTZ)", "rank - 200", "string(value)"])
def test_orders_of_other_types(spark, along, chunk_rows):
    """Times, numbers and texts with nulls and ties; one hot key over many ranges."""
    df = frame(spark, 7).withColumn("at", F.expr(along))
    order = Window.partitionBy("key").orderBy("at", "rank", "id")
    rolled = windows.rolling_average(df, ["key"], ["rank", "id"], "at", "value", 7, "x", chunk_rows)
    expected = df.select("id", F.avg("value").over(order.rowsBetween(-6, 0)).alias("x"))
    assert rolled.columns == df.columns + ["x"]
    assert {r.id: r.x for r in rolled.collect()} == {r.id: r.x for r in expected.collect()}
    filled = cleaning.fill_null_forward(df, "seen", ["key"], "at", ["rank", "id"], chunk_rows)
    expected = df.select("id", F.last("seen", True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("x"))
    assert {r.id: r.seen for r in filled.collect()} == {r.id: r.x for r in expected.collect()}


def test_ranges_split_a_hot_key(spark):
    df = frame(spark, 7, one_day=1.0, rows=1000)
    cut = chunks.cut(df, ["key"], "rank", ["id"], chunk_rows=100)
    assert cut.df.count() == 1000
    assert cut.df.groupBy("key", "__range").count().agg(F.max("count")).first()[0] <= 300
    assert chunks.rolling(chunks.cut(df.limit(0), ["key"], "rank", ["id"], 10), "value", "x", 3).count() == 0


@pytest.mark.parametrize("chunk_rows", [1, 100, 10**9])
@pytest.mark.parametrize("ties", [["name"], ["two", "name"], ["two", "rank", "id"]])
def test_any_total_order_splits_large_days(spark, ties, chunk_rows):
    df = frame(spark, 8, one_day=1.0, rows=600) \
        .withColumn("name", F.format_string("n%05d", F.col("id"))).withColumn("two", F.col("id") % 2)
    rolled = windows.rolling_average(df, ["key"], ties, "day", "value", 7, "x", chunk_rows)
    order = Window.partitionBy("key").orderBy("day", *ties).rowsBetween(-6, 0)
    expected = df.select("id", F.avg("value").over(order).alias("x"))
    assert {r.id: r.x for r in rolled.collect()} == {r.id: r.x for r in expected.collect()}
    filled = cleaning.fill_null_forward(df, "seen", ["key"], "day", ties, chunk_rows)
    order = Window.partitionBy("key").orderBy("day", *ties).rowsBetween(Window.unboundedPreceding, 0)
    expected = df.select("id", F.last("seen", True).over(order).alias("x"))
    assert {r.id: r.seen for r in filled.collect()} == {r.id: r.x for r in expected.collect()}


def test_two_values_as_first_tie_break_split_evenly(spark):
    df = frame(spark, 8, one_day=1.0, rows=1000).withColumn("two", F.col("id") % 2)
    cut = chunks.cut(df, ["key"], "day", ["two", "id"], chunk_rows=100)
    assert cut.df.groupBy("key", "__day", "__sub").count().agg(F.max("count")).first()[0] <= 200


@pytest.mark.parametrize("rows", [3, 500])
def test_an_order_without_tie_breaks_is_refused_at_any_size(spark, rows):
    df = frame(spark, 8, rows=rows)
    with pytest.raises(ValueError, match="total"):
        windows.rolling_average(df, ["key"], [], "day", "value", chunk_rows=10)
    with pytest.raises(ValueError, match="total"):
        cleaning.handle_missing_values(df, "day", ["key"])


def test_a_column_is_not_filled_along_itself(spark):
    with pytest.raises(ValueError, match="along itself"):
        cleaning.fill_null_forward(frame(spark, 9), "day", ["key"], "day", ["rank"])
