"""Byte-pair encoding and decoding of whole texts, by dynamic programming over prefixes."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.prefix_bpe import prefix_bpe
from vigil.llm.registry import register, table
from vigil.llm.workers import map_batches, texts


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (array<int>) of every whole text, one row per row of docs.

    Equal to the tokenizers library without begin and end tokens; added tokens
    that stand in a text become their ids. Null is the empty text (no ids);
    ids and rows may repeat; other columns are ignored.
    """
    return _mapped(docs, tokenizer, id_col, text_col, "ids array<int>", _ids)


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and text of every array of ids; a null array gives the empty text."""
    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def task():
        bpe = prefix_bpe(tokenizer)

        def work(batch: pa.RecordBatch) -> dict:
            return {"id": batch.column("id"),
                    "text": [bpe.decode(ids or ()).decode() for ids in batch.column("ids").to_pylist()]}

        return work

    return map_batches(rows, task, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 (of the ids decoded again) of every whole text."""
    return _mapped(docs, tokenizer, id_col, text_col,
                   "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digests)


def _mapped(docs, tokenizer, id_col, text_col, columns, make) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def task():
        bpe = prefix_bpe(tokenizer)
        return lambda batch: {"id": batch.column("id"), **make(bpe, texts(batch, "text"))}

    return map_batches(rows, task, f"id {kind}, {columns}").withColumnRenamed("id", id_col)


def _ids(bpe, data: list[bytes]) -> dict:
    return {"ids": [np.frombuffer(bpe.encode(d), "<u4").astype(np.int32) for d in data]}


def _digests(bpe, data: list[bytes]) -> dict:
    out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
    for d in data:
        packed = bpe.encode(d)
        back = bpe.decode(np.frombuffer(packed, "<u4").tolist())
        out["n_tokens"].append(len(packed) // 4)
        out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
        out["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
    return out


@register("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
