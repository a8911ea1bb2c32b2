"""Group values on every row of a group, safe for groups of any size."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.plans.scratch import materialize
from vigil.schemas import quoted

FEW_GROUPS = 100_000
HOT_GROUP_ROWS = 10_000_000


def with_group_value(df: DataFrame, keys: list[str], name: str, value: Column,
                     hot_rows: int = HOT_GROUP_ROWS, few_groups: int = FEW_GROUPS,
                     source: DataFrame | None = None) -> DataFrame:
    """Add the aggregate `value` of the row's group (null keys form a group).

    The groups are aggregated first, and counted. Few groups are broadcast: no
    row moves. Otherwise groups of at least hot_rows rows, of which there can be
    no more than rows / hot_rows, are broadcast to their rows, and a window sees
    the rows of the other groups only. source: a frame with the same rows, of the
    columns that matter, from which the groups are aggregated.
    """
    copies = [f"__k{i}" for i in range(len(keys))]
    groups, _ = materialize(
        (df if source is None else source).groupBy(*[quoted(k).alias(c) for k, c in zip(keys, copies)])
        .agg(F.count(F.lit(1)).alias("__rows"), value.alias("__value")), "groups")
    same = F.lit(True)
    for k, c in zip(keys, copies):
        same = same & quoted(k).eqNullSafe(F.col(c))

    def by_broadcast(some: DataFrame) -> DataFrame:
        return df.join(F.broadcast(some.drop("__rows")), same) \
            .withColumn(name, F.col("__value")).drop(*copies, "__value")

    if groups.count() <= few_groups:
        return by_broadcast(groups)
    hot = groups.where(F.col("__rows") >= hot_rows)
    cold = df.join(F.broadcast(hot), same, "left_anti")
    window = Window.partitionBy(*[quoted(k) for k in keys])
    return cold.withColumn(name, value.over(window)).unionByName(by_broadcast(hot))
