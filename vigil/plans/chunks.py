"""Ordered windows over keys too large for one task.

A running or rolling window per key would send each key to one task. Instead a
key's rows are cut, along the window order, into chunks of bounded size; each
chunk is computed on its own after receiving the few rows ("carry") that the
frame needs from the chunks before it. The result equals the plain window.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vigil.plans import order as ranges
from vigil.plans.scratch import materialize
from vigil.schemas import quoted

# Chunk widths in order of size: how a date is cut, coarsest first.
GRAINS = ["all", "year", "month", "day"]
# A task sorts a chunk in memory. Keys of fewer rows take the plain window.
CHUNK_ROWS = 1_000_000
PARTS = 2  # parts per chunk limit into which crowded days are cut
FEW_CELLS = 200_000


@dataclass
class Chunked:
    """A frame whose rows carry `__chunk`, increasing along the window order."""

    df: DataFrame
    cells: DataFrame | None  # rows per key and day, with the day's period; of a date order
    keys: list[str]
    order: str
    ties: list[str]
    single: bool
    few: bool  # there are at most FEW_CELLS cells
    chunk: list[str] = field(default_factory=lambda: ["__day", "__sub"])

    @property
    def group(self) -> list[Column]:
        return [quoted(k) for k in self.keys] + [F.col(c) for c in self.chunk]

    @property
    def row_order(self) -> list[Column]:
        return [quoted(self.order), *[quoted(t) for t in self.ties]]


def _grain_start(date: Column, grain: str) -> Column:
    if grain == "all":
        return F.lit(None).cast("date")
    return F.trunc(date, grain) if grain != "day" else date


def cut(df: DataFrame, keys: list[str], order: str, ties: list[str],
        chunk_rows: int | None = None) -> Chunked:
    """Cut every key along (order, ties) into chunks of about chunk_rows rows.

    Ties must make the order total. Along a date the chunk is the coarsest calendar
    period that is small enough for every key; days that are still too large are cut
    along all ties. Along any other order (times, numbers, text) rows are dealt by
    range of (key, order, ties), and a chunk is what a key has in a range.
    """
    if not ties:
        raise ValueError("rows of one day need tie-breaks that make their order total")
    if not isinstance(df.schema[order].dataType, T.DateType):
        return _ranged(df, keys, order, ties, chunk_rows)
    # One row per key and day.
    cells = df.groupBy(*[quoted(k) for k in keys], quoted(order).alias("__order")) \
        .agg(F.count(F.lit(1)).alias("__n"))
    sizes = _largest_per_grain(cells, keys)
    limit = chunk_rows or CHUNK_ROWS
    grain = next((g for g in GRAINS if (sizes[g] or 0) <= limit), "day")
    chunked = df.withColumn("__day", _grain_start(quoted(order), grain))
    biggest = sizes[grain] or 0
    if biggest <= limit:
        chunked = chunked.withColumn("__sub", F.lit(0))
    else:
        chunked = _split_days(chunked, cells, keys, order, ties, limit)
    cells = cells.withColumn("__day", _grain_start(F.col("__order"), grain))
    return Chunked(chunked, cells, keys, order, ties, single=grain == "all" and biggest <= limit,
                   few=(sizes["cells"] or 0) <= FEW_CELLS)


def _ranged(df: DataFrame, keys: list[str], order: str, ties: list[str],
            chunk_rows: int | None) -> Chunked:
    """Ranges of about chunk_rows rows, or as many as a shuffle has partitions."""
    parts = -(-df.count() // chunk_rows) or None if chunk_rows else None
    rows = ranges.dealt(df, [quoted(c) for c in [*keys, order, *ties]], "__number", parts)
    rows = rows.withColumn("__range", F.shiftright("__number", ranges.PARTITION_BITS)).drop("__number")
    return Chunked(rows, None, keys, order, ties, single=False, few=False, chunk=["__range"])


def _largest_per_grain(cells: DataFrame, keys: list[str]) -> dict[str, int]:
    """Rows of the largest key x period, for every period length, and the number of cells."""
    by = [quoted(k) for k in keys]
    sizes = cells.withColumns({"day": F.col("__n"), "cells": F.lit(1)})
    for grain in ["month", "year", "all"]:
        period = _grain_start(F.col("__order"), grain)
        kept = [F.max(g).alias(g) for g in GRAINS[::-1] if g in sizes.columns]
        sizes = sizes.groupBy(*by, period.alias("__order")).agg(
            F.sum("__n").alias("__n"), F.sum("cells").alias("cells"), *kept) \
            .withColumn(grain, F.col("__n"))
    return sizes.agg(*[F.max(g).alias(g) for g in GRAINS], F.sum("cells").alias("cells")) \
        .first().asDict()


def _split_days(df: DataFrame, cells: DataFrame, keys: list[str], order: str,
                ties: list[str], limit: int) -> DataFrame:
    """Number the parts of days above the limit along the tie-breaks.

    There are at most rows / limit such days: that bounds the broadcast. Their
    rows are dealt by range of (key, day, ties) to partitions of about limit /
    PARTS rows, whose numbers rise along the window order. The dealt rows are
    written once, for ranges are drawn anew whenever a plan runs.
    """
    cell = [f"__c{i}" for i in range(len(keys) + 1)]
    same = F.lit(True)
    for k, c in zip([*keys, order], cell):
        same = same & quoted(k).eqNullSafe(F.col(c))
    large = cells.where(F.col("__n") > limit).select(
        *[quoted(k).alias(c) for k, c in zip([*keys, "__order"], cell)], F.col("__n"))
    parts = -(-PARTS * large.agg(F.sum("__n")).first()[0] // limit)
    large = F.broadcast(large.drop("__n"))
    dealt = (
        df.join(large, same)
        .repartitionByRange(parts, *[F.col(c) for c in cell], *[quoted(t) for t in ties])
        .withColumn("__sub", F.spark_partition_id()).drop(*cell))
    crowded, _ = materialize(dealt, "crowded-days")
    return df.join(large, same, "left_anti").withColumn("__sub", F.lit(0)).unionByName(crowded)


def _run(chunked: Chunked, carry: DataFrame, name: str, expression, frame) -> DataFrame:
    """Evaluate a window per chunk with carry rows in front, then drop them."""
    rows = chunked.df.withColumn("__pos", F.lit(0))
    both = rows.unionByName(carry, allowMissingColumns=True)
    window = Window.partitionBy(*chunked.group).orderBy("__pos", *chunked.row_order)
    return (
        both.withColumn(name, expression.over(window.rowsBetween(*frame)))
        .where(F.col("__pos") == 0).drop("__pos", *chunked.chunk)
    )


def _last_days(chunked: Chunked, rows: int) -> DataFrame:
    """Rows of the days at the end of each period that hold its last `rows` rows.

    Counting days tells where they start, so that no period is sorted as a whole.
    Chunks of another order are ranges, sorted by one task each anyway.
    """
    if chunked.cells is None:
        return chunked.df
    period = [quoted(k) for k in chunked.keys] + [F.col("__day")]
    later = Window.partitionBy(*period).orderBy(F.col("__order").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    copies = [f"__k{i}" for i in range(len(period))]
    starts = (
        chunked.cells.withColumn("__later", F.coalesce(F.sum("__n").over(later), F.lit(0)))
        .where(F.col("__later") < rows)
        .groupBy(*[c.alias(a) for c, a in zip(period, copies)])
        .agg(F.min("__order").alias("__from"))
    )
    same = F.lit(True)
    for c, a in zip(period, copies):
        same = same & c.eqNullSafe(F.col(a))
    # Without the broadcast, a split day is one key of the join; Spark splits it there.
    starts = F.broadcast(starts) if chunked.few else starts
    # Rows without a date are a period of their own.
    return chunked.df.join(starts, same).drop(*copies) \
        .where(F.col("__from").isNull() | (quoted(chunked.order) >= F.col("__from")))


def rolling(chunked: Chunked, value: str, name: str, rows: int, aggregate=F.avg) -> DataFrame:
    """aggregate(value) over the current and the rows - 1 preceding rows."""
    before = rows - 1
    frame = (-before, 0)
    if chunked.single:
        window = Window.partitionBy(*[quoted(k) for k in chunked.keys]) \
            .orderBy(*chunked.row_order).rowsBetween(*frame)
        return chunked.df.withColumn(name, aggregate(quoted(value)).over(window)) \
            .drop(*chunked.chunk)
    backwards = Window.partitionBy(*chunked.group).orderBy(*[c.desc() for c in chunked.row_order])
    tails = (
        _last_days(chunked, before)
        .select(*chunked.keys, *chunked.chunk, chunked.order, *chunked.ties,
                quoted(value).alias("__v"))
        .withColumn("__back", F.row_number().over(backwards))
        .where(F.col("__back") <= before)
        .groupBy(*chunked.group)
        # At most `before` values per chunk, oldest first.
        .agg(F.sort_array(F.collect_list(F.struct(-F.col("__back"), F.col("__v").alias("v"))))
             .alias("__tail"))
    )
    earlier = Window.partitionBy(*[quoted(k) for k in chunked.keys]) \
        .orderBy(*chunked.chunk).rowsBetween(-before, -1)
    carried = F.flatten(F.collect_list("__tail").over(earlier))
    carry = (
        tails.withColumn("__carried", carried)
        .withColumn("__skip", F.greatest(F.size("__carried") - before, F.lit(0)))
        .select(*chunked.keys, *chunked.chunk, "__skip", F.posexplode("__carried"))
        .where(F.col("pos") >= F.col("__skip"))
        # Negative positions sort before the chunk's own rows, oldest first.
        .select(*chunked.keys, *chunked.chunk, F.col("col.v").alias(value),
                (F.col("pos") - F.col("__skip") - before).alias("__pos"))
    )
    return _run(chunked, carry, name, aggregate(quoted(value)), frame)


def last_known(chunked: Chunked, value: str, name: str) -> DataFrame:
    """The latest non-null value up to and including each row."""
    frame = (Window.unboundedPreceding, 0)
    latest = F.last(quoted(value), ignorenulls=True)
    if chunked.single:
        window = Window.partitionBy(*[quoted(k) for k in chunked.keys]) \
            .orderBy(*chunked.row_order).rowsBetween(*frame)
        return chunked.df.withColumn(name, latest.over(window)).drop(*chunked.chunk)
    position = F.when(quoted(value).isNotNull(), F.struct(*chunked.row_order))
    ends = chunked.df.groupBy(*chunked.group).agg(
        F.max_by(quoted(value), position).alias("__end"))
    earlier = Window.partitionBy(*[quoted(k) for k in chunked.keys]) \
        .orderBy(*chunked.chunk).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ends.withColumn(value, F.last("__end", ignorenulls=True).over(earlier))
        .where(quoted(value).isNotNull())
        .select(*chunked.keys, *chunked.chunk, value, F.lit(-1).alias("__pos"))
    )
    return _run(chunked, carry, name, latest, frame)
