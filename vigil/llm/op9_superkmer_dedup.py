"""Removal of repeated word windows: super-k-mers sorted in the buckets of their minimisers.

Consecutive windows under one minimiser travel as one packed string of words (see
vigil.llm.passages). In its bucket each window of words gets its rank by sorting:
of single words, then of pairs of halves, up to the window's length. Windows of
equal rank are equal words, and the least document of a rank keeps its words.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import passages
from vigil.llm.passages import Spec
from vigil.llm.registry import register, table
from vigil.llm.workers import map_batches, texts

WINDOW, GRAM = 50, 8


def least_by_sorting(strings: list[bytes], grams: np.ndarray, least: np.ndarray, spec: Spec) -> np.ndarray:
    """Per string and window the smallest of least over the strings with that window."""
    words = b" ".join(strings).split(b" ")
    sizes = np.fromiter((s.count(b" ") + 1 for s in strings), np.int64, len(strings))
    number: dict[bytes, int] = {}
    ranks = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # Ranks of `width` words from each place on, whatever string they run into:
    # windows that leave their string are not asked for.
    width = 1
    while 2 * width <= spec.window:
        ranks = _paired(ranks, width)
        width *= 2
    if width < spec.window:
        ranks = _paired(ranks, spec.window - width)
    first = np.cumsum(sizes) - sizes
    windows = ranks[passages.spread(first, sizes - spec.window + 1)]
    lowest = np.full(len(ranks) + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, windows, np.repeat(least, sizes - spec.window + 1))
    return lowest[windows]


def _paired(ranks: np.ndarray, apart: int) -> np.ndarray:
    """Ranks of the pairs of a place and the one `apart` after it, in sorted order."""
    pairs = ranks[:-apart] * (int(ranks.max()) + 1) + ranks[apart:]
    order = np.argsort(pairs, kind="stable")
    sorted_ = pairs[order]
    out = np.empty(len(pairs), np.int64)
    out[order] = np.cumsum(np.concatenate([[False], sorted_[1:] != sorted_[:-1]]))
    return out


def remove_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text", hot: int = passages.HOT) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, kept (words joined by one space).

    Words are runs of characters other than ASCII white space, unchanged. Each
    word inside a window of words that also starts in a document of smaller id
    is removed; windows are judged on the input. Ids are integers; rows of equal
    id do not remove from each other, a null id neither removes nor loses. Null
    texts have no words; an empty table gives no rows.
    """
    if not 1 <= gram <= window or window < 2:
        raise ValueError("window of at least two words, and gram within it")
    rows = passages.keyed(docs, id_col, text_col)
    spans = passages.repeated_spans(rows, Spec("word", window, gram), least_by_sorting, hot)

    def task():
        def work(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("n_words", "n_removed", "kept")}
            for data, packed in zip(texts(batch, "text"), batch.column("spans").to_pylist()):
                words, cut = data.split(), passages.removed_spans(packed)
                kept, at = [], 0
                for a, b in cut.tolist():
                    kept += words[at:a]
                    at = b
                out["n_words"].append(len(words))
                out["n_removed"].append(int((cut[:, 1] - cut[:, 0]).sum()))
                out["kept"].append(b" ".join(kept + words[at:]))
            return out | {"id": batch.column("id")}

        return work

    return map_batches(rows.join(spans.hint("merge"), "print", "left").select("id", "text", "spans"), task,
                       "id bigint, n_words bigint, n_removed bigint, kept binary"
                       ).withColumnRenamed("id", id_col)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
words AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
windows AS (
  SELECT r, doc_id, p, array_to_string(w[p:p + 49], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - 48)) AS p FROM d)),
repeated AS (
  SELECT r, p FROM (SELECT r, p, doc_id, min(doc_id) OVER (PARTITION BY s) AS first FROM windows)
  WHERE first < doc_id),
marked AS (
  SELECT r, word, w.p, max(x.p) OVER (PARTITION BY r ORDER BY w.p) AS latest
  FROM words AS w LEFT JOIN repeated AS x USING (r, p)),
kept AS (
  SELECT r, count(*) FILTER (WHERE latest > p - 50) AS n_removed,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE latest IS NULL OR latest <= p - 50) AS k
  FROM marked GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


@register("op9_superkmer_dedup", SQL)
def op9_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_windows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
