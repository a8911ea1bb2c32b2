"""Positions of rows along any order, within keys of any size.

A window numbers the rows of a key in one task. Here the rows are dealt by range
of (key, order), sorted where they are, and written with numbers that rise along
the ranges; counts per key and range then tell where each range goes on.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.plans.scratch import materialize
from vigil.schemas import quoted

#: monotonically_increasing_id keeps the number of the partition above this many bits.
PARTITION_BITS = 33


def dealt(df: DataFrame, along: list[Column], number: str, parts: int | None = None) -> DataFrame:
    """A written copy of df whose column `number` rises along the given columns.

    Rows that are equal in all of them are dealt out too, in any order, so that no
    value can fill one task. number >> PARTITION_BITS is the range of the row.
    """
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    along = [*along, F.col("__tie")]
    ranges = tied.repartitionByRange(parts, *along) if parts else tied.repartitionByRange(*along)
    copy, _ = materialize(
        ranges.sortWithinPartitions(*along).drop("__tie")
        .withColumn(number, F.monotonically_increasing_id()), "dealt")
    return copy


def positions(df: DataFrame, keys: list[str], order: list[str], name: str,
              parts: int | None = None) -> DataFrame:
    """Add `name`: 0 for the first row of a key (null is a key), 1 for the next, ...

    Nulls come first. Rows of a key that are equal in the whole order are numbered
    in any order among themselves. df is read twice and should be cheap to compute.
    """
    by = [quoted(k) for k in keys]
    rows = dealt(df, [*by, *[quoted(o) for o in order]], "__number", parts)
    rows = rows.withColumn("__range", F.shiftright("__number", PARTITION_BITS))
    copies = [f"__k{i}" for i in range(len(keys))]
    counts = rows.groupBy(*[k.alias(c) for k, c in zip(by, copies)], F.col("__range").alias("__r")) \
        .agg(F.min("__number").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*copies).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*copies, "__r", (
        F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    same = F.col("__range") == F.col("__r")
    for k, c in zip(by, copies):
        same = same & k.eqNullSafe(F.col(c))
    return rows.join(starts, same).withColumn(name, F.col("__number") + F.col("__shift")) \
        .drop("__number", "__range", "__r", "__shift", *copies)
