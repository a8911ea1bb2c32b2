"""Connected components of a graph given as a table of edges, by alternating stars.

Large star: each node's larger neighbours move to its smallest one. Small star:
its smaller neighbours do. Both keep what is connected connected, and in a number
of rounds logarithmic in the size every node is tied to the least of its
component. All minima are partial aggregates, so a node with very many neighbours
costs no task more than its share; each round is written to scratch.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.plans.scratch import materialize, remove


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """(node, label): label the smallest node of its component, for nodes with edges.

    edges: as in ties(). Also returns the scratch path of the table.
    """
    tied, path = ties(edges)
    labels, label_path = materialize(
        tied.unionByName(tied.select(F.col("label").alias("node"), "label").distinct()), "labels")
    remove(edges.sparkSession, path)
    return labels, label_path


def ties(edges: DataFrame) -> tuple[DataFrame, str]:
    """(node, label): label the smallest node of its component, for all its other nodes.

    edges: a written table with columns x, y of one comparable type; direction,
    repeats and loops do not matter. It is read as it is, several times. Also
    returns the scratch path of the result.
    """
    spark = edges.sparkSession
    now, path = edges.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")), None
    while path is None or not _stars(now):
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(
            "x", F.least("x", "m").alias("m"))
        large = (both.where("y > x").join(least, "x")
                 .select(F.col("y").alias("x"), F.col("m").alias("y")).where("x <> y").distinct())
        large, large_path = materialize(large, "large-star")
        # Now x > y in every edge: y are the smaller neighbours.
        floor = large.groupBy("x").agg(F.min("y").alias("m"))
        small = (large.join(floor, "x").select(F.col("y").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(floor.select(F.col("x").alias("a"), F.col("m").alias("b")))
                 .select(F.col("a").alias("x"), F.col("b").alias("y")).distinct())
        fresh, fresh_path = materialize(small, "small-star")
        remove(spark, large_path)
        if path:
            remove(spark, path)
        now, path = fresh, fresh_path
    return now.select(F.col("x").alias("node"), F.col("y").alias("label")), path


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour at most, and that one none: all is settled."""
    ends = edges.select(F.col("x").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")) \
        .unionByName(edges.select(F.col("y").alias("node"), F.lit(0).alias("above"), F.lit(1).alias("below")))
    met = ends.groupBy("node").agg(F.sum("above").alias("above"), F.max("below").alias("below"))
    return met.where("above > 1 OR above = 1 AND below = 1").isEmpty()
