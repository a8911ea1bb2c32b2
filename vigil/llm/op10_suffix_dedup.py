"""Removal of repeated byte passages, by suffix arrays of the strings under a minimiser.

The exchange of vigil.llm.passages brings together all strings that can share a
window. The different strings of one minimiser form a text whose suffixes are
ordered by linear grouping; windows that are equal stand next to each other, and
the least document of each such run is the one that keeps the passage.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import passages
from vigil.llm.passages import Spec
from vigil.llm.registry import register, table
from vigil.llm.suffix_groups import suffix_orders
from vigil.llm.workers import map_batches, texts

WINDOW, GRAM = 50, 16
#: Bytes of one text beyond which its strings are dealt anew by longer minimisers,
#: and of the texts ordered at once.
TEXT_BYTES, LOT_BYTES = 6_000, 1 << 20


def least_by_suffixes(strings: list[bytes], grams: np.ndarray, least: np.ndarray, spec: Spec) -> np.ndarray:
    """Per string and window the smallest of least over the strings with that window.

    A text beyond TEXT_BYTES is cut under minimisers of twice the length, at last
    whole windows: equal windows then meet again, in smaller texts.
    """
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    offset = np.concatenate([[0], np.cumsum(sizes - spec.window + 1)])
    out = np.repeat(least, sizes - spec.window + 1)
    begin = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    end = np.append(begin[1:], len(grams))
    total = np.add.reduceat(sizes + 1, begin)
    large = (total > TEXT_BYTES) & (end - begin > 1) & (spec.k < spec.window)
    if large.any():
        some = passages.spread(begin[large], (end - begin)[large])
        found = _by_longer([strings[i] for i in some.tolist()], least[some],
                           Spec(spec.unit, spec.window, min(spec.window, 2 * spec.k)))
        out[passages.spread(offset[some], sizes[some] - spec.window + 1)] = found
    small = np.flatnonzero(~large & (end - begin > 1))
    small = small[np.argsort(total[small], kind="stable")]  # texts of like length advance together
    lots = np.cumsum(total[small]) // LOT_BYTES
    for lot in np.split(small, np.flatnonzero(np.diff(lots)) + 1):
        if len(lot):
            own = passages.spread(begin[lot], (end - begin)[lot])
            found = _ordered([strings[i] for i in own.tolist()], least[own], (end - begin)[lot], spec.window)
            out[passages.spread(offset[own], sizes[own] - spec.window + 1)] = found
    return out


def _by_longer(strings: list[bytes], least: np.ndarray, spec: Spec) -> np.ndarray:
    u = passages.units(spec, strings)
    start, length, gram, owner = passages.runs(u, spec.window, spec.k)
    seen: dict[tuple[int, bytes], int] = {}
    part = np.fromiter(
        (seen.setdefault((g, u.data[a:b]), len(seen)) for g, a, b in
         zip(gram.tolist(), start.tolist(), (start + length + spec.window - 1).tolist())),
        np.int64, len(start))
    lowest = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(lowest, part, least[owner])
    keys = list(seen)
    of = np.array([g for g, _ in keys], np.uint64)
    order = np.argsort(of, kind="stable")
    found = least_by_suffixes([keys[i][1] for i in order.tolist()], of[order], lowest[order], spec)
    size = np.array([len(s) - spec.window + 1 for _, s in keys], np.int64)
    ends = np.cumsum(size[order])
    where = np.empty(len(keys), np.int64)
    where[order] = ends - size[order]
    # Runs come by string and window, and cover every window once.
    return found[passages.spread(where[part], length)]


def _ordered(strings: list[bytes], least: np.ndarray, per_text: np.ndarray, window: int) -> np.ndarray:
    """The same for texts of per_text strings each, over their suffix arrays."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    # Bytes become 2..257, 1 ends a string, 0 a text.
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int32) + 2
    ends = np.cumsum(sizes + 1) - 1
    raw[ends] = 1
    last = np.cumsum(per_text) - 1
    raw[ends[last]] = 0
    offsets = np.concatenate([[0], ends[last] + 1])
    order = suffix_orders(raw, offsets)

    begin = np.concatenate([[0], ends[:-1] + 1])
    windows = sizes - window + 1
    place = passages.spread(begin, windows)
    slot_of = np.full(len(raw), -1)
    slot_of[place] = np.arange(len(place))
    listed = order[slot_of[order] >= 0]  # places of windows in suffix order, text by text
    text = np.searchsorted(offsets, listed, "right")
    byte = np.append((raw - 2).astype(np.uint8), np.zeros(8, np.uint8)).astype(np.uint64)
    eight = np.zeros(len(raw), np.uint64)
    for j in range(8):
        eight = eight << np.uint64(8) | byte[j:j + len(raw)]
    same = text[1:] == text[:-1]
    for j in [*range(0, window - 7, 8), max(0, window - 8)]:
        at = np.flatnonzero(same)
        same[at] = eight[listed[at + 1] + j] == eight[listed[at] + j]
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    value = np.repeat(least, windows)[slot_of[listed]]
    smallest = np.minimum.reduceat(value, first)
    out = np.empty(len(place), np.int64)
    out[slot_of[listed]] = np.repeat(smallest, np.diff(np.append(first, len(listed))))
    return out


def remove_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                    text_col: str = "text", hot: int = passages.HOT) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept (binary).

    Each byte inside a string of window bytes that also starts in a document of
    smaller id is removed; strings are judged on the input. Ids are integers;
    rows of equal id do not remove from each other, a null id neither removes
    nor loses. Null texts are empty; shorter texts stay whole; an empty table
    gives no rows.
    """
    if not 8 <= window or not 1 <= gram <= window:
        raise ValueError("window of at least 8 bytes, and gram within it")
    rows = passages.keyed(docs, id_col, text_col)
    spans = passages.repeated_spans(rows, Spec("byte", window, gram), least_by_suffixes, hot)

    def task():
        def work(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept")}
            for data, packed in zip(texts(batch, "text"), batch.column("spans").to_pylist()):
                cut = passages.removed_spans(packed)
                kept, at = [], 0
                for a, b in cut.tolist():
                    kept.append(data[at:a])
                    at = b
                out["n_bytes"].append(len(data))
                out["n_removed"].append(int((cut[:, 1] - cut[:, 0]).sum()))
                out["n_spans"].append(len(cut))
                out["kept"].append(b"".join([*kept, data[at:]]))
            return out | {"id": batch.column("id")}

        return work

    return map_batches(rows.join(spans.hint("merge"), "print", "left").select("id", "text", "spans"), task,
                       "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
                       ).withColumnRenamed("id", id_col)


def shorten(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
            text_col: str = "text", chars_col: str | None = None, hot: int = passages.HOT) -> DataFrame:
    """docs with all columns and rows, the texts without their repeated passages.

    A character goes only if all its bytes do, so texts stay valid. chars_col, if
    given, is set to the new number of characters (0 for null).
    """
    # The text travels once, beside the row.
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"), F.col(f"`{text_col}`").alias("text"))
    keyed = passages.keyed(docs, id_col, text_col)
    spans = passages.repeated_spans(keyed, Spec("byte", window, gram), least_by_suffixes, hot)
    own = F.xxhash64(F.col(f"row.`{id_col}`").cast("long"), F.coalesce("text", F.lit("")))
    joined = rows.withColumn("print", own).join(spans.hint("merge"), "print", "left").select("row", "text", "spans")
    kind = joined.schema["row"].dataType.simpleString()

    def task():
        def work(batch: pa.RecordBatch) -> dict:
            given, kept = batch.column("text"), []
            for null, data, packed in zip(given.is_null().to_pylist(), texts(batch, "text"),
                                          batch.column("spans").to_pylist()):
                kept.append(None if null else _without(data, passages.removed_spans(packed)).decode())
            return {"row": batch.column("row"), "kept": kept}

        return work

    found = map_batches(joined, task, f"row {kind}, kept string")
    new = {text_col: F.col("kept")}
    if chars_col:
        new[chars_col] = F.coalesce(F.length("kept"), F.lit(0)).cast(dict(docs.dtypes)[chars_col])
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def _without(data: bytes, spans: np.ndarray) -> bytes:
    """The data without the characters that lie in spans whole."""
    kept, at = [], 0
    for a, b in spans.tolist():
        while a < b and data[a] & 0xC0 == 0x80:  # begins inside a character
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:  # ends inside one
            b -= 1
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (
  SELECT r, doc_id, unnest(range(0, strlen(h) // 2)) AS p,
         unnest(list_transform(range(0, strlen(h) // 2), lambda p: substr(h, 2 * p + 1, 100))) AS s
  FROM d),
judged AS (
  SELECT r, p, s[1:2] AS byte, CASE WHEN strlen(s) = 100
           AND min(doc_id) OVER (PARTITION BY s) < doc_id THEN p END AS x
  FROM bytes),
marked AS (
  SELECT r, p, byte, coalesce(max(x) OVER (PARTITION BY r ORDER BY p) > p - 50, false) AS gone
  FROM judged),
edges AS (
  SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY r ORDER BY p) AS begins FROM marked),
kept AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
         string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone) AS k
  FROM edges GROUP BY r)
SELECT doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


@register("op10_suffix_dedup", SQL)
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans",
                        F.sha2("kept", 256).alias("kept_sha256"))
