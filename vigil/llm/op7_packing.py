"""Packing of documents into windows by minimum bin slack.

A document is cut into full windows and one remainder. What is left to solve
depends only on how many remainders there are of each length, at most a window's
length of numbers however large the corpus is. The plan takes the longest
remaining length, finds by subset sums (a bitset over 0..window) the multiset of
remaining lengths that fills its window closest to capacity, and uses that
pattern as often as the counts allow. Pieces then find their place by their rank
among the pieces of their length, counted in parallel blocks.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm import vocabulary
from vigil.llm.passages import portions
from vigil.llm.registry import register, table
from vigil.llm.workers import map_batches, texts
from vigil.plans.scratch import materialize

WINDOW = 2048
END_ID = 1


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document gets the end id, so null and empty texts are pieces of one
    token. Each id lies in one piece, pieces of a sequence follow each other
    without gaps from offset 0, no sequence is longer than window. Repeated rows
    are packed each; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut, _ = materialize(_cut(rows, tokenizer, window, end_id), "pieces")
    pieces = cut.select(
        "id", "doc_tokens", F.posexplode("crcs").alias("part", "ids_crc32")
    ).select(
        "id", (F.col("part") * F.lit(window).cast("long")).alias("start"),
        F.least(F.lit(window).cast("long"), F.col("doc_tokens") - F.col("part") * window).alias("length"),
        "ids_crc32", "doc_tokens")
    return _place(pieces, window).select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _cut(rows: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()

    def task():
        encoder, end, width = vocabulary.word_encoder(path), vocabulary.pack([end_id]), 4 * window

        def work(batch: pa.RecordBatch) -> dict:
            data, tokens, crcs = texts(batch, "text"), [], []
            for begin, stop in portions(data):
                for ids in encoder.encode_batch(data[begin:stop]):
                    ids += end
                    tokens.append(len(ids) // 4)
                    crcs.append([zlib.crc32(ids[at:at + width]) for at in range(0, len(ids), width)])
            return {"id": batch.column("id"), "doc_tokens": tokens, "crcs": crcs}

        return work

    return map_batches(rows, task, f"id {kind}, doc_tokens bigint, crcs array<bigint>")


def _place(pieces: DataFrame, window: int) -> DataFrame:
    spark = pieces.sparkSession
    blocks = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(blocks)))
    counts = pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    counts, _ = materialize(counts, "lengths")  # at most blocks x window rows
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(slots(fill(totals, window)))

    own = Window.partitionBy("length", "block").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        pieces.withColumn("rank", F.row_number().over(own).cast("long") - 1)
        .join(counts.select("length", "block", "before"), ["length", "block"])
        .withColumn("rank", F.col("rank") + F.col("before")).drop("before", "block"))
    kind = pieces.schema["id"].dataType.simpleString()

    def task():
        keys, first, copies, base, offset = plan.value

        def work(batch: pa.RecordBatch) -> dict:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length << 48 | rank, "right") - 1
            nth = rank - first[at]
            out = {c: batch.column(c) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")}
            return out | {"sequence_id": base[at] + nth // copies[at],
                          "offset": offset[at] + nth % copies[at] * length}

        return work

    return map_batches(
        ranked, task, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, "
        "doc_tokens bigint, sequence_id bigint, offset bigint")


def fill(totals: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> copies) and how often each is used; they use up totals."""
    left = {n: c for n, c in sorted(totals.items(), reverse=True) if c}
    plan = []
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        pattern = closest(left, window - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[n] // c for n, c in pattern.items())
        plan.append((pattern, times))
        for n, c in pattern.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return plan


def closest(left: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of the lengths left whose sum comes closest to room from below."""
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for n, count in left.items():
        most = min(count, room // n)
        if not most:
            continue
        steps.append((n, reach))
        part = 1
        while most:
            take = min(part, most)
            reach |= reach << n * take & mask
            most -= take
            part *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for n, before in reversed(steps):
        while not before >> total & 1:
            chosen[n] = chosen.get(n, 0) + 1
            total -= n
    return chosen


def slots(plan: list[tuple[dict[int, int], int]]) -> tuple[np.ndarray, ...]:
    """Per pattern and length: length and first rank as one key, first rank, copies,
    first sequence, offset of the length's first copy; sorted by key."""
    rows, used, base = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for n, copies in pattern.items():
            first = used.get(n, 0)
            rows.append((n << 48 | first, first, copies, base, offset))
            used[n] = first + copies * times
            offset += n * copies
        base += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.empty(0, np.int64),) * 5


@register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
