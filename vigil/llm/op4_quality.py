"""Quality rules: base rules, then an isolation forest on rule statistics.

The statistics of all whole texts are computed once and written to scratch. The
forest is grown on labelled documents of good quality: each tree splits a small
subsample by random features at random values, so documents unlike them end on
short paths. The threshold is calibrated on every labelled document: the score
that separates the two classes best while keeping nearly all good ones.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.llm.passages import portions
from vigil.llm.registry import register, table
from vigil.llm.workers import map_batches, texts_of
from vigil.plans.scratch import materialize

SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
SPAN = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Labelled good rows that the trees may draw from, trees, and rows of each tree.
FIT_ROWS, TREES, TREE_ROWS = 20_000, 200, 1024
#: Part of the labelled good documents that the threshold must keep, and how much
#: a lost share of them weighs against a caught share of the bad ones.
KEEP_GOOD, WEIGHT_OF_GOOD = 0.99, 20
BUCKETS = 2000
#: Bytes of texts measured at once.
PORTION_BYTES = 4 << 20

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("symbol_share", "repetition", "upper_share", "mark_share")
#: Characters added below each share, so that a few marks in a short text stay ordinary.
STEADY = 20
#: Different words over words ** 0.85 from which a text counts as varied.
VARIED = 1.25


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, base_failed and features of every whole text, one row per row of docs.

    Words are runs of characters other than ASCII white space. Null and empty
    texts have no words: all counts are 0 and base_failed is true.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    columns = ", ".join([f"{c} bigint" for c in BASE] + [f"{c} double" for c in FEATURES])

    def task():
        def work(batch: pa.RecordBatch) -> dict:
            data = texts_of(batch.column("text"))
            out = {c: [] for c in (*BASE, *FEATURES)}
            for a, b in portions(data, PORTION_BYTES):
                for name, values in _measure(data[a:b]).items():
                    out[name] += values
            return {"id": batch.column("id"), **out}

        return work

    found = map_batches(rows, task, f"id {kind}, {columns}")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumnRenamed("id", id_col)


def _measure(data: list[bytes]) -> dict:
    out = {c: [] for c in (*BASE, *FEATURES)}
    split = [d.split() for d in data]
    repeats = repeat_words(split)
    for d, words, repeated in zip(data, split, repeats):
        n = len(words)
        text_chars = len(d) if d.isascii() else len(d.decode())
        chars = text_chars - sum(map(d.count, SPACES))
        symbols = sum(map(d.count, SYMBOLS))
        lines = [line for line in d.split(b"\n") if line.strip()]
        dup = len(lines) - len(set(lines))
        kinds = np.bincount(np.frombuffer(d, np.uint8), minlength=256)
        upper = int(kinds[65:91].sum())
        letters = upper + int(kinds[97:123].sum())
        marks = int(kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum())
        values = (n, chars, symbols, dup, repeated, symbols / (chars + STEADY),
                  max(0.0, VARIED - len(set(words)) / max(1.0, n ** 0.85)), upper / (letters + STEADY),
                  marks / (chars + STEADY))
        for name, value in zip(out, values):
            out[name].append(value)
    return out


def repeat_words(split: list[list[bytes]]) -> list[int]:
    """Per text: words inside SPAN-word windows that occur twice or more in it.

    Windows are compared by hash first, those that agree word by word.
    """
    sizes = np.array([len(w) for w in split], np.int64)
    ends = np.cumsum(sizes)
    flat = [w for words in split for w in words]
    out = [0] * len(split)
    if len(flat) < SPAN + 1:
        return out
    hashes = np.fromiter(map(hash, flat), np.int64, len(flat)).view(np.uint64)
    n = len(flat) - SPAN + 1
    windows = np.zeros(n, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    for k in range(SPAN):
        windows = windows * factor + hashes[k:k + n]
        windows ^= windows >> np.uint64(29)
    owner = np.repeat(np.arange(len(split)), sizes)[:n]
    inside = np.arange(n) + SPAN <= ends[owner]
    at = np.flatnonzero(inside)
    keys = windows[at] + owner[at].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    same = np.flatnonzero((keys[1:] == keys[:-1]) & (owner[at[1:]] == owner[at[:-1]]))
    if not len(same):
        return out
    for doc in set(owner[at[same]].tolist()):
        mine = same[owner[at[same]] == doc] if len(split) > 1 else same
        begin = int(ends[doc] - sizes[doc])
        places = np.unique(np.concatenate([at[mine], at[mine + 1]])) - begin
        out[doc] = _covered(split[doc], places.tolist())
    return out


def _covered(words: list[bytes], places: list[int]) -> int:
    """Words covered by the windows at places whose words occur at another place too."""
    groups: dict[bytes, list[int]] = {}
    for p in places:
        groups.setdefault(b" ".join(words[p:p + SPAN]), []).append(p)
    covered, until = 0, 0
    for p in sorted(p for g in groups.values() if len(g) > 1 for p in g):
        covered += p + SPAN - max(p, until)
        until = p + SPAN
    return covered


@dataclass
class Forest:
    """Trees as arrays: feature and value of each split, children, path length at leaves."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / usual path length): near 1 is anomalous."""
        total = np.zeros(len(x))
        each = np.arange(len(x))
        for feature, value, left, depth in zip(self.feature, self.value, self.left, self.depth):
            node = np.zeros(len(x), np.int64)
            while True:
                inner = feature[node] >= 0
                if not inner.any():
                    break
                right = x[each, np.maximum(feature[node], 0)] >= value[node]
                node = np.where(inner, left[node] + right, node)
            total += depth[node]
        return 2.0 ** (-total / len(self.feature) / max(usual_path(self.rows), 1e-9))


def usual_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """An isolation forest on the rows of x; equal rows share a leaf."""
    random = np.random.default_rng(seed)
    rows = min(rows, len(x))
    most = max(1, math.ceil(math.log2(max(2, rows))))
    size = 2 ** (most + 1)
    feature, left = np.full((trees, size), -1), np.zeros((trees, size), np.int64)
    value, depth = np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees):
        pending, free = [(0, x[random.choice(len(x), rows, replace=False)], 0)], 1
        while pending:
            node, part, level = pending.pop()
            if len(part) < 2 or level == most:
                depth[t, node] = level + usual_path(len(part))
                continue
            low, high = part.min(axis=0), part.max(axis=0)
            spread = np.flatnonzero(high > low)
            if not len(spread):
                depth[t, node] = level + usual_path(len(part))
                continue
            f = random.choice(spread)
            v = random.uniform(low[f], high[f])
            right = part[:, f] >= v
            feature[t, node], value[t, node], left[t, node] = f, v, free
            pending += [(free, part[~right], level + 1), (free + 1, part[right], level + 1)]
            free += 2
    return Forest(feature, value, left, depth, rows)


def fitted(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", fit_rows: int = FIT_ROWS,
           keep_good: float = KEEP_GOOD):
    """The forest (broadcast) and the anomaly from which on a document goes, or None; from
    a table of statistics that is cheap to read again.

    labels: (id, quality), quality 1 good and 0 bad; other values and null are
    not used, a document with labels of both kinds counts as bad. The trees draw
    from at most fit_rows good documents (by hash of the id). Without good
    labels no forest is grown: kept is what passes the base rules. Without bad
    ones the threshold keeps every labelled good document.
    """
    marks = (labels.where(F.col("quality").isin(0, 1)).groupBy(id_col)
             .agg(F.min("quality").alias("quality")))
    passed = stats.where(~F.col("base_failed"))
    known = passed.join(marks, id_col).select(id_col, "quality", *FEATURES)
    sample = known.where("quality = 1").orderBy(F.xxhash64(id_col), *FEATURES).limit(fit_rows)
    x = np.array([list(r) for r in sample.select(*FEATURES).collect()], float)
    if not len(x):
        return None
    forest = stats.sparkSession.sparkContext.broadcast(grow(x))
    scored = _score(known, forest, "quality int", id_col)
    buckets = (scored.groupBy(F.floor(F.col("anomaly") * BUCKETS).cast("int").alias("b"))
               .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")).collect())
    return forest, threshold({r["b"]: (r["good"], r["bad"]) for r in buckets}, keep_good)


def judge(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", fit_rows: int = FIT_ROWS,
          keep_good: float = KEEP_GOOD) -> DataFrame:
    """Add anomaly (double) and kept to a table of statistics; see fitted()."""
    model = fitted(stats, labels, id_col, fit_rows, keep_good)
    if model is None:
        return stats.withColumn("anomaly", F.lit(0.0)).withColumn("kept", ~F.col("base_failed"))
    forest, limit = model
    others = ", ".join(f"{c} {t}" for c, t in stats.dtypes if c in (*BASE, "base_failed"))
    return (_score(stats, forest, others, id_col)
            .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit)))


def _score(rows: DataFrame, forest, others: str, id_col: str) -> DataFrame:
    """Anomaly of each row, beside the id and the other columns (name and type each)."""
    names = StructType.fromDDL(others).names
    kind = rows.schema[id_col].dataType.simpleString()

    def task():
        def work(batch: pa.RecordBatch) -> dict:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES], axis=1)
            return {"id": batch.column("id"), "anomaly": forest.value.scores(x),
                    **{c: batch.column(c) for c in names}}

        return work

    rows = rows.withColumnRenamed(id_col, "id").select("id", *names, *FEATURES)
    return map_batches(rows, task, f"id {kind}, {others}, anomaly double").withColumnRenamed("id", id_col)


def threshold(buckets: dict[int, tuple[int, int]], keep_good: float) -> float:
    """The score with the best weighed shares that keeps keep_good of the good ones."""
    good, bad = (sum(v[k] for v in buckets.values()) for k in (0, 1))
    best, chosen, lost, held = 0.0, max(buckets) + 1, 0, 0
    for b in sorted(buckets, reverse=True):
        lost += buckets[b][0]
        held += buckets[b][1]
        if lost > (1 - keep_good) * good:
            break
        gain = held / max(1, bad) - WEIGHT_OF_GOOD * lost / max(1, good)
        if gain > best:
            best, chosen = gain, b
    return chosen / BUCKETS


def decisions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base counts, base_failed, anomaly and kept of every document."""
    stats, _ = materialize(statistics(docs, id_col, text_col), "quality")
    return judge(stats, labels, id_col)


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that pass, with all their columns; the same as decisions() keeps.

    The texts are measured twice, for the threshold and for the decision: writing
    them in between would take the disk that the whole table takes.
    """
    stats, _ = materialize(statistics(docs, id_col, text_col), "quality")
    model = fitted(stats, labels, id_col)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    at = docs.columns.index(text_col)

    def task():
        def passes(data: list[bytes]) -> np.ndarray:
            found = _measure(data)
            n, repeated = (np.array(found[c], np.int64) for c in ("n_words", "n_repeat_words"))
            good = (n >= MIN_WORDS) & (100 * repeated <= MAX_REPEAT_PERCENT * n)
            if model is not None:
                forest, limit = model
                good &= forest.value.scores(np.array([found[c] for c in FEATURES], float).T) < limit
            return good

        def work(batch: pa.RecordBatch) -> dict:
            row = batch.column("row")
            data = texts_of(row.field(at))
            good = [passes(data[a:b]) for a, b in portions(data, PORTION_BYTES)]
            return {"row": row.filter(pa.array(np.concatenate([np.zeros(0, bool), *good])))}

        return work

    return map_batches(rows, task, f"row {rows.schema['row'].dataType.simpleString()}").select("row.*")


@register("op4_quality_forest")
def op4_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decisions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *BASE, "base_failed", "kept", "anomaly")
