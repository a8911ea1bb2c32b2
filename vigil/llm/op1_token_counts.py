"""Token counts of whole texts, with huge documents cut into overlapping chunks.

A document of more than chunk_chars characters is cut into chunks that overlap.
Each chunk is encoded on its own, in any task. Two neighbours agree on the rest
of the text from any place p inside their overlap at which both start a new
split: what follows p is split by what stands after p alone. Places closer to
the left chunk's end than the longest added token are not used, for the end may
cut such a token in two. So the count of a document is the sum of its chunks
less, per neighbouring pair, what the left one counts after p and the right one
before p. A pair without such a place sends its document to the next round,
with overlaps (and chunks) four times as wide, at last to a single chunk.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm import vocabulary
from vigil.llm.registry import register, table
from vigil.llm.workers import map_batches, texts
from vigil.plans.scratch import materialize

LIMIT = 1024
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    tokenizer: a tokenizers JSON file that the executors can read. Null texts
    count as empty (0 tokens), repeated rows each keep their row, ids may be
    null or repeat, other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    huge = F.length("text") > chunk_chars
    short = _count_short(rows.where(~huge), tokenizer)
    long = rows.where(huge).withColumn("digest", F.unhex(F.md5("text")))
    counted = _count_long(long, tokenizer, chunk_chars, overlap_chars)
    # Repeated rows are counted once and joined back; only ids and digests move.
    sizes = long.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    same = sizes["id"].eqNullSafe(counted["key"]) & (sizes["digest"] == counted["key_digest"])
    whole = sizes.join(counted, same).select("id", "n_bytes", "n_tokens")
    return short.unionByName(whole).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))


def _count_short(rows: DataFrame, path: str) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()

    def task():
        counter = vocabulary.counter(path)

        def work(batch: pa.RecordBatch) -> dict:
            data = texts(batch, "text")
            return {"id": batch.column("id"), "n_bytes": [len(d) for d in data],
                    "n_tokens": [counter.whole(d) for d in data]}

        return work

    return map_batches(rows, task, f"id {kind}, n_bytes bigint, n_tokens bigint")


def _count_long(long: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(key, key_digest, n_tokens) of each different row."""
    kind = long.schema["id"].dataType.simpleString()
    pending, counted = long, None
    while True:
        spliced, _ = materialize(_spliced(pending, path, kind, chunk, overlap), "tokens")
        done = spliced.where(~F.col("failed")).select(
            F.col("id").alias("key"), F.col("digest").alias("key_digest"), "n_tokens")
        counted = done if counted is None else counted.unionByName(done)
        failed = spliced.where("failed").select(F.col("id").alias("bad"), F.col("digest").alias("bad_digest"))
        if failed.isEmpty():
            return counted
        pending = pending.join(failed, F.col("id").eqNullSafe(F.col("bad"))
                               & (F.col("digest") == F.col("bad_digest")), "left_semi")
        overlap *= 4
        chunk = max(chunk, 4 * overlap)


def _spliced(rows: DataFrame, path: str, kind: str, chunk: int, overlap: int) -> DataFrame:
    """(id, digest, n_tokens, failed) of each different row, from its chunks."""
    chunks = map_batches(
        rows, lambda: lambda batch: _cut(batch, chunk, overlap),
        f"id {kind}, digest binary, chunk bigint, piece string, is_last boolean")
    # Hash of all three columns: the chunks of one document go to many tasks.
    spread = chunks.repartition(F.col("id"), F.col("digest"), F.col("chunk"))
    ends = map_batches(
        spread, lambda: _encoder(path, chunk, overlap),
        f"id {kind}, digest binary, chunk bigint, total bigint, is_last boolean, "
        "head array<bigint>, head_before array<bigint>, tail array<bigint>, tail_before array<bigint>")
    ends = ends.dropDuplicates(["id", "digest", "chunk"])
    following = Window.partitionBy("id", "digest").orderBy("chunk")
    pairs = (
        ends.withColumn("next_head", F.lead("head").over(following))
        .withColumn("next_before", F.lead("head_before").over(following))
        .withColumn("p", F.array_min(F.array_intersect("tail", "next_head")))
        .withColumn("drop", F.when(F.col("is_last"), F.lit(0).cast("long")).otherwise(
            F.col("total") - F.expr("tail_before[array_position(tail, p) - 1]")
            + F.expr("next_before[array_position(next_head, p) - 1]"))))
    return pairs.groupBy("id", "digest").agg(
        F.sum(F.col("total") - F.col("drop")).alias("n_tokens"),
        F.max(F.col("drop").isNull()).alias("failed"))


def _cut(batch: pa.RecordBatch, chunk: int, overlap: int) -> dict:
    out = {"id": [], "digest": [], "chunk": [], "piece": [], "is_last": []}
    ids, digests = batch.column("id").to_pylist(), batch.column("digest").to_pylist()
    for i, text in enumerate(batch.column("text").to_pylist()):
        step = chunk - overlap
        n = max(1, -(-(len(text) - overlap) // step))
        for k in range(n):
            out["id"].append(ids[i])
            out["digest"].append(digests[i])
            out["chunk"].append(k)
            out["piece"].append(text[k * step: k * step + chunk])
            out["is_last"].append(k == n - 1)
    return out


def _encoder(path: str, chunk: int, overlap: int):
    counter = vocabulary.counter(path)
    step = chunk - overlap
    margin = counter.about["longest_added"] + 1

    def work(batch: pa.RecordBatch) -> dict:
        out = {c: batch.column(c) for c in ("id", "digest", "chunk", "is_last")}
        out |= {c: [] for c in ("total", "head", "head_before", "tail", "tail_before")}
        numbers = batch.column("chunk").to_pylist()
        for k, piece in zip(numbers, batch.column("piece").to_pylist()):
            starts, before, total = counter.boundaries(piece)
            out["total"].append(total)
            for name, keep in (("head", lambda s: s < overlap),
                               ("tail", lambda s: step <= s <= len(piece) - margin)):
                kept = [(k * step + s, n) for s, n in zip(starts, before) if keep(s)]
                out[name].append([s for s, _ in kept])
                out[f"{name}_before"].append([n for _, n in kept])
        return out

    return work


@register("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
