"""Nearest neighbours by inner product in a forest of random-projection trees.

Equal vectors are searched once: a distinct vector keeps its k + 1 smallest ids,
all that any answer can use. Trees split by random directions at the median of a
bounded sample; every vector is filed under one leaf of each tree. Inner products
become distances by one more component, sqrt(M^2 - |x|^2) with M the longest
vector's length. A query walks all trees through one priority queue, best margin
first, and stops after enough filed vectors. How many are enough is calibrated:
the true neighbours of a bounded sample of queries, found by scanning every
vector, must be met for TARGET of them. Leaves and queries meet in blocks of
bounded size, and what is met is ranked by its exact inner product.
"""

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.registry import register, table
from vigil.llm.workers import map_batches
from vigil.plans.scratch import materialize

K, EVERY = 20, 20
TREES, LEAVES = 8, 64
#: Vectors the trees are fitted on; queries the stopping rule is calibrated on.
FIT_ROWS, FIT_QUERIES = 16_384, 256
TARGET = 0.95
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 4_000


@dataclass
class Forest:
    """Complete binary trees, nodes in breadth-first order; the last level are leaves."""

    directions: np.ndarray  # trees x inner nodes x dimensions + 1
    cuts: np.ndarray
    longest: float

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest ** 2 - (x * x).sum(axis=1), 0.0)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        y, out = self.lifted(x), np.empty((len(x), len(self.cuts)), np.int32)
        inner = self.cuts.shape[1]
        for t in range(len(self.cuts)):
            sides = y @ self.directions[t].T >= self.cuts[t]
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + sides[np.arange(len(x)), node]
            out[:, t] = node - inner
        return out

    def margins(self, q: np.ndarray) -> np.ndarray:
        return np.einsum("tid,qd->qti", self.directions[:, :, :-1], q) - self.cuts

    def walk(self, margins: np.ndarray):
        """(tree, leaf) of one query, best margin of the worst split on the way first."""
        inner = self.cuts.shape[1]
        queue = [(-np.inf, t, 0) for t in range(len(self.cuts))]
        while queue:
            worst, t, node = heapq.heappop(queue)
            if node >= inner:
                yield t, node - inner
                continue
            m = float(margins[t, node])
            heapq.heappush(queue, (max(worst, m), t, 2 * node + 1))
            heapq.heappush(queue, (max(worst, -m), t, 2 * node + 2))


def grow(sample: np.ndarray, longest: float, trees: int = TREES, leaves: int = LEAVES,
         seed: int = 5) -> Forest:
    """Fit the trees on the rows of sample; fewer leaves where the sample is small."""
    levels = 0
    while 2 ** (levels + 1) <= leaves and len(sample) >= 16 * 2 ** (levels + 1):
        levels += 1
    random = np.random.default_rng(seed)
    forest = Forest(np.zeros((trees, 2 ** levels - 1, sample.shape[1] + 1)),
                    np.zeros((trees, 2 ** levels - 1)), longest)
    y = forest.lifted(sample)
    for t in range(trees):
        parts = [np.arange(len(y))]
        for node in range(2 ** levels - 1):
            direction = random.standard_normal(y.shape[1])
            direction /= np.linalg.norm(direction)
            along = y[parts[node]] @ direction
            cut = float(np.median(along)) if len(along) else 0.0
            forest.directions[t, node], forest.cuts[t, node] = direction, cut
            parts += [parts[node][along < cut], parts[node][along >= cut]]
    return forest


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of one length, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1 if n else 1)


def valid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that take part: no null or non-finite component, not
    all zero, of the table's most common length. Ids that are null take no part."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    rows = rows.where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           is_query=None, k: int = K, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query, nearest first.

    is_query: a condition on column "id"; by default ids divisible by 20. Ties go
    to the smaller id; a query is never its own answer; a row that repeats an id
    with an equal vector counts once. With k rows or fewer all are answers. An
    empty table, or one without valid vectors, gives no rows.
    """
    rows = valid(vectors, id_col, vector_col)
    is_query = F.col("id") % EVERY == 0 if is_query is None else is_query
    nearest_ids = Window.partitionBy("v").orderBy("id")
    # Only the k + 1 smallest ids of equal vectors leave a task.
    kept = (rows.withColumn("nth", F.dense_rank().over(nearest_ids)).where(F.col("nth") <= k + 1)
            .groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids")))
    distinct, _ = materialize(
        kept.withColumn("key", F.monotonically_increasing_id()), "vectors")
    asked, _ = materialize(
        rows.where(is_query).dropDuplicates(["id", "v"]).join(distinct.select("v", "key"), "v")
        .select(F.col("id").alias("query_id"), F.col("key").alias("query")), "asked")
    queries, _ = materialize(asked.select("query").distinct().join(
        distinct.select(F.col("key").alias("query"), "v"), "query"), "queries")
    found = _search(distinct, queries, k, target)

    # The k + 1 nearest rows of each distinct query hold the k nearest besides its own.
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    answers = (
        found.select("query", "score", F.explode("ids").alias("id"))
        .withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= k + 1).drop("nth"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        asked.join(answers, "query").where(F.col("id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score"))


def _search(distinct: DataFrame, queries: DataFrame, k: int, target: float) -> DataFrame:
    """(query, score, ids): the k + 1 nearest distinct vectors met by each query."""
    spark = distinct.sparkSession
    schema = "query bigint, score double, key bigint, ids array<bigint>"
    size = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(_norm("v")).alias("longest")).first()
    if not size["n"]:
        return spark.createDataFrame([], schema).select("query", "score", "ids")
    sample = _matrix(distinct.orderBy(F.xxhash64("key")).limit(FIT_ROWS).select("v").toArrow().column("v"))
    forest = grow(sample, float(size["longest"]) * (1 + 1e-9))
    shipped = spark.sparkContext.broadcast(forest)

    def file_rows():
        def work(batch: pa.RecordBatch) -> dict:
            leaves = shipped.value.leaves(_matrix(batch.column("v")))
            return {"key": batch.column("key"), "v": batch.column("v"), "ids": batch.column("ids"),
                    "leaves": list(leaves)}

        return work

    vector = dict(distinct.dtypes)["v"]
    filed = map_batches(distinct.select("key", "v", "ids"), file_rows,
                        f"key bigint, v {vector}, ids array<bigint>, leaves array<int>")
    postings = filed.select("key", "v", "ids", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = {(r["tree"], r["leaf"]): r["n"] for r in
             postings.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    enough = _calibrate(distinct, queries, forest, shipped, sizes, k, target)

    def visit():
        def work(batch: pa.RecordBatch) -> dict:
            q = _matrix(batch.column("v"))
            places = [_visited(shipped.value, m, sizes, enough) for m in shipped.value.margins(q)]
            return {"query": batch.column("query"), "v": batch.column("v"),
                    "places": [[t << 32 | leaf for t, leaf in p] for p in places]}

        return work

    visits = map_batches(queries.select("query", "v"), visit,
                         f"query bigint, v {vector}, places array<bigint>"
                         ).select("query", "v", F.explode("places").alias("place"))
    visits, _ = materialize(visits, "visits")
    asking = {r["place"]: r["n"] for r in
              visits.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = _meet(postings, visits, sizes, asking, k)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    return (found.dropDuplicates(["query", "key"])
            .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
            .select("query", "score", "ids"))


def _norm(column: str):
    return F.sqrt(F.aggregate(column, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _visited(forest: Forest, margins: np.ndarray, sizes: dict, enough: float) -> list[tuple[int, int]]:
    met, places = 0, []
    for place in forest.walk(margins):
        if met >= enough:
            break
        if place in sizes:
            met += sizes[place]
            places.append(place)
    return places


def _calibrate(distinct, queries, forest, shipped, sizes, k, target) -> float:
    """Filed vectors to visit, so that the sampled queries meet target of their neighbours."""
    spark = distinct.sparkSession
    chosen = queries.orderBy(F.xxhash64("query")).limit(FIT_QUERIES).toArrow()
    if not chosen.num_rows:
        return 0.0
    q = _matrix(chosen.column("v"))
    asked = spark.sparkContext.broadcast(q)

    def scan():
        def work(batch: pa.RecordBatch) -> dict:
            x = _matrix(batch.column("v"))
            scores = asked.value @ x.T
            most = min(k, len(x))
            best = np.argpartition(-scores, most - 1, axis=1)[:, :most]
            leaves = shipped.value.leaves(x)
            each = np.repeat(np.arange(len(scores)), most)
            at = best.ravel()
            return {"nth": each, "score": scores[each, at], "leaves": list(leaves[at])}

        return work

    near = map_batches(distinct.select("v"), scan, "nth int, score double, leaves array<int>")
    top = Window.partitionBy("nth").orderBy(F.desc("score"))
    truth = (near.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k)
             .select("nth", "leaves").collect())
    needs = []
    walks = {}
    for i, m in enumerate(forest.margins(q)):
        met, at = 0, {}
        for place in forest.walk(m):
            at[place] = met  # visited while fewer than `met` + 1 vectors were met
            met += sizes.get(place, 0)
        walks[i] = at
    for row in truth:
        needs.append(min(walks[row["nth"]][t, leaf] for t, leaf in enumerate(row["leaves"])))
    needs.sort()
    return needs[min(len(needs) - 1, int(target * len(needs)))] + 1 if needs else 0.0


def _meet(postings, visits, sizes, asking, k) -> DataFrame:
    """Meet filed vectors and queries leaf by leaf, in blocks of bounded size."""
    rows_of = {t << 32 | leaf: -(-n // BLOCK_ROWS) for (t, leaf), n in sizes.items()}
    queries_of = {p: -(-n // BLOCK_QUERIES) for p, n in asking.items()}
    blocks = visits.sparkSession.createDataFrame(
        [(p, rows_of[p], n) for p, n in queries_of.items()],
        "place bigint, row_blocks int, query_blocks int")
    blocks = F.broadcast(blocks)  # one row per leaf: at most TREES x LEAVES
    left = (
        postings.withColumn("place", F.shiftleft(F.col("tree").cast("long"), 32) + F.col("leaf"))
        .join(blocks, "place")
        .withColumn("i", F.pmod(F.xxhash64("key"), F.col("row_blocks")).cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select("place", "i", "j", "key", "v", "ids"))
    right = (
        visits.join(blocks, "place")
        .withColumn("j", F.pmod(F.xxhash64("query"), F.col("query_blocks")).cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
        .select("place", "i", "j", "query", "v"))

    def cell(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return pd.DataFrame({"query": [], "score": [], "key": [], "ids": []})
        x = np.stack(rows["v"].to_numpy()).astype(np.float64)
        q = np.stack(asked["v"].to_numpy()).astype(np.float64)
        own, ids = rows["key"].to_numpy(), rows["ids"].to_numpy()
        smallest = np.array([i[0] for i in ids])
        out = []
        for at in range(0, len(q), 512):
            part = q[at:at + 512]
            rough = part @ x.T
            most = min(len(x), k + 9)
            best = np.argpartition(-rough, most - 1, axis=1)[:, :most]
            exact = (x[best] * part[:, None, :]).sum(axis=2)
            order = np.lexsort((smallest[best], -exact), axis=1)[:, : k + 1]
            best, exact = np.take_along_axis(best, order, 1), np.take_along_axis(exact, order, 1)
            asked_part = asked["query"].to_numpy()[at:at + 512]
            out.append(pd.DataFrame({
                "query": np.repeat(asked_part, best.shape[1]), "score": exact.ravel(),
                "key": own[best.ravel()], "ids": ids[best.ravel()]}))
        return pd.concat(out, ignore_index=True)

    key = ["place", "i", "j"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        cell, "query bigint, score double, key bigint, ids array<bigint>")


@register("op5_forest_search")
def op5_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
