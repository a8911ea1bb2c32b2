"""Passages that documents share, found over minimisers.

A text is a sequence of units: its bytes, or its words. A window is WINDOW
consecutive units of one document, its minimiser the k units in it of least
hash. Equal windows have equal minimisers, so what is asked of windows can be
answered where their minimisers meet:

0. Texts are written once, packed in portions of 8 MB.
1. The minimisers of each portion, 40 bits of them, go to hash buckets, one entry per
   portion; a minimiser of one document only settles all its windows. The answer is one
   bit per entry, which is kept beside the portion.
2. Consecutive windows under one shared minimiser travel as one packed string
   to the bucket of the minimiser. There the windows of the different strings
   are compared exactly (by a function of the caller), which gives each window
   the smallest document it stands in. Strings overlap: those of texts that all
   repeat would be four times the texts. So this is done in as many rounds, each for
   some of the minimisers, as keep the strings of one near the size of the texts.
3. Windows that stand in a smaller document give spans, which return to their portion.

What a portion can tell by itself does not travel: of documents with an equal
string only the smallest sends it, the others' windows are known to repeat. So
a passage in a third of all documents costs its bucket one string per portion.
Minimisers with more than HOT entries are known from step 1, as one set that all
portions of step 2 see; their windows are dealt one by one, by a hash of the whole
window. Two minimisers that agree in 40 bits are sent for nothing: equal windows
are told by their bytes.
"""

import gc
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vigil.llm.workers import record_batch, texts
from vigil.plans.scratch import Appended, materialize, remove

PORTION_BYTES = 8 << 20
#: Texts of a portion whose windows are looked at together: some ten tables of
#: eight bytes per byte stand at once, best in a processor's cache.
BLOCK_BYTES = 128 << 10
WORD_BLOCK = 256 << 10
HOT = 50_000
#: Strings that a round sends, as a multiple of the texts.
ROUND_TEXTS = 1.5
#: Bytes of packed portions that a task takes at once.
BATCH = "8m"
SHORT = np.uint64(24)  # bits of a minimiser's hash that the first step leaves out
MIX = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Spec:
    """What is compared: unit "byte" or "word", window and minimiser length in units."""

    unit: str
    window: int
    k: int

    def text(self, data: bytes) -> bytes:
        """What spans count in: the text, or its words joined by one space."""
        return data if self.unit == "byte" else b" ".join(data.split())


@dataclass
class Units:
    """Units of joined texts: a code, begin and end of each, and where texts begin."""

    data: bytes
    codes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray  # first unit of each text, and the number of units


def byte_codes() -> np.ndarray:
    return np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64)


def units(spec: Spec, data: list[bytes]) -> Units:
    """Units of texts that went through spec.text()."""
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    if spec.unit == "byte":
        joined = b"".join(data)
        at = np.arange(len(joined))
        first = np.concatenate([[0], np.cumsum(sizes)])
        return Units(joined, byte_codes()[np.frombuffer(joined, np.uint8)], at, at + 1, first)
    joined = b" ".join(data) + b" "
    raw = np.frombuffer(joined, np.uint8)
    space = SPACE[raw]
    begin = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    codes = _word_codes(raw, begin, end)
    first = np.searchsorted(begin, np.concatenate([[0], np.cumsum(sizes + 1)]))
    return Units(joined, codes, begin, end, first)


def _word_codes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word from sums over the bytes, scaled back by its place. Whole words of
    WORD_BLOCK bytes at a time: tables of eight bytes and more per byte stay small."""
    out, code_of, powers = np.empty(len(begin), np.uint64), byte_codes(), None
    i = 0
    while i < len(begin):
        a = begin[i]
        j = max(i + 1, int(np.searchsorted(end, a + WORD_BLOCK, "right")))
        n = int(end[j - 1] - a)
        if powers is None or len(powers) < n:
            powers, inverse = _powers(max(n, min(WORD_BLOCK, int(end[-1] - a))))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code_of[raw[a:a + n]] * powers[:n])])
        out[i:j] = _mixed((sums[end[i:j] - a] - sums[begin[i:j] - a]) * inverse[begin[i:j] - a])
        i = j
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of MIX and of its inverse, made anew: kept, they would hold memory for ever."""
    out = []
    for step in (int(MIX), pow(int(MIX), -1, 1 << 64)):
        near = np.full(1 << 12, np.uint64(step))
        far = np.full(n // len(near) + 1, np.uint64(pow(step, len(near), 1 << 64)))
        near[0] = far[0] = 1
        out.append(np.outer(np.cumprod(far), np.cumprod(near)).ravel()[:n])
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def grams(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k units from each place on."""
    out, covered, power, width = None, 0, codes, 1
    while True:
        if k & 1:
            if out is None:
                out = power
            else:
                n = max(0, min(len(out), len(power) - covered))
                out = out[:n] * np.uint64(pow(int(MIX), width, 1 << 64)) + power[covered:covered + n]
            covered += width
        k >>= 1
        if not k:
            return _mixed(out)
        power = power[:-width] * np.uint64(pow(int(MIX), width, 1 << 64)) + power[width:] \
            if len(power) > width else power[:0]
        width *= 2


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of the width values from each place on."""
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:]) if len(x) > n else x[:0]
        n *= 2
    rest = width - n
    return np.minimum(x[:-rest], x[rest:]) if rest and len(x) > rest else x[:0] if rest else x


def runs(u: Units, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows of one text under one minimiser:
    first window (as unit), number of windows, minimiser hash, text."""
    n = len(u.codes) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64), np.empty(0, np.int64))
    least = _least(grams(u.codes, k), window - k + 1)[:n]
    sizes = np.diff(u.first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = owner[:n] == owner[window - 1:]
    change = np.empty(n, bool)
    change[0] = True
    change[1:] = (least[1:] != least[:-1]) | (owner[1:n] != owner[:n - 1])
    change |= ~inside
    begin = np.flatnonzero(change)
    length = np.diff(np.append(begin, n))
    keep = inside[begin]
    begin, length = begin[keep], length[keep]
    # Repetitive text has endless runs; cut anywhere, they stay under one minimiser.
    most = 4 * window
    parts = -(-length // most)
    if (parts > 1).any():
        nth = spread(np.zeros(len(parts), np.int64), parts)
        begin = np.repeat(begin, parts) + nth * most
        length = np.minimum(np.repeat(length, parts) - nth * most, most)
    return begin, length, least[begin], owner[begin]


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[k], begin[k] + 1, ... for size[k] numbers each."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def portions(data: list[bytes], most: int = PORTION_BYTES):
    """Ranges of texts of at most `most` bytes together, or of one longer text."""
    begin, size = 0, 0
    for i, d in enumerate(data):
        if size and size + len(d) > most:
            yield begin, i
            begin, size = i, 0
        size += len(d)
    if begin < len(data):
        yield begin, len(data)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(print, id, text): print tells rows apart that differ in id or text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_col).cast("long"), text).alias("print"),
                       F.col(id_col).cast("long").alias("id"), text.alias("text"))


def repeated_spans(docs: DataFrame, spec: Spec, exact: Callable, hot: int = HOT) -> DataFrame:
    """(print, spans): units of each keyed row covered by windows that also start in
    a row of smaller id. spans: the maximal ones as packed int64 pairs begin, end.

    exact(strings, grams, least, spec): per string and window, in one array, the
    smallest of least over all strings with that window; strings come by gram, and
    equal windows have equal grams. Rows with a null id neither cause
    nor have spans.
    """
    spark = docs.sparkSession
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.where(F.col("id").isNotNull())
    with _small_batches(spark):
        packed, packed_path = materialize(_packed(rows, spec), "portions")
        marks, marks_path = materialize(_marks(packed, spec, buckets, hot), "marks")
        # At most entries / HOT minimisers, the same for every row whatever portion it is in.
        often = [r.hot for r in marks.where(F.col("portion").isNull()).select("hot").collect()]
        seen = marks.agg(F.sum("entries").alias("entries"), F.sum("shared").alias("shared")).first()
        release(spark)
        marked, marked_path = materialize(_marked(packed, marks), "marked")
        for path in (packed_path, marks_path):
            remove(spark, path)
        release(spark)
        often = spark.sparkContext.broadcast(np.unique(np.frombuffer(b"".join(often), np.uint64)))
        rounds = _rounds(spec, seen.entries or 0, seen.shared or 0)
        answers = Appended(spark, "answers")
        for nth in range(rounds):
            answers.add(_answered(marked, often, spec, exact, buckets, nth, rounds))
            release(spark)
        often.destroy()
        spans, _ = materialize(_spans(spark.read.schema(ANSWERS).parquet(answers.path), marked), "spans")
        for path in (marked_path, answers.path):
            remove(spark, path)
        release(spark)
    return spans


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """A portion is a row of megabytes: tasks take a few at once, by size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, BATCH)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _rounds(spec: Spec, entries: int, shared: int) -> int:
    """In how many parts the strings go: each has window - 1 units besides its own ones."""
    own = (spec.window - spec.k + 2) / 2  # units from one minimiser to the next, on average
    return max(1, math.ceil(shared / max(1, entries) * (1 + (spec.window - 1) / own) / ROUND_TEXTS))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are no longer referenced.

    Its listeners hold on to the plan of the last query that ended, so one is run.
    """
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


PORTIONS = "ids binary, prints binary, sizes binary, data binary"
ENTRIES = "bucket int, portion bigint, known binary, grams binary"
MARKS = "portion bigint, bucket int, marks binary, entries bigint, shared bigint, hot binary"
STRINGS = ("bucket int, portion bigint, strings binary, lengths binary, grams binary, "
           "uses binary, ids binary, rows binary, starts binary, "
           "known_rows binary, known_begins binary, known_sizes binary")
ANSWERS = "portion bigint, rows binary, begins binary, sizes binary"


def arrow_of(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def squeezed(values: np.ndarray, steps: bool = True) -> bytes:
    """Whole numbers in little room: (the steps between) them, by place of the byte, compressed."""
    if not len(values):
        return b""
    x = values.astype(np.int64, copy=False)
    if steps:
        x = np.diff(x, prepend=np.int64(0))
    x = ((x << 1) ^ (x >> 63)).view(np.uint64)  # small if near zero
    width = max(1, (int(x.max()).bit_length() + 7) // 8)
    places = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width | steps << 4]) + zstandard.ZstdCompressor(level=1).compress(places.tobytes())


def unsqueezed(packed: bytes) -> np.ndarray:
    if not packed:
        return np.empty(0, np.int64)
    width, steps = packed[0] & 15, packed[0] >> 4
    places = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8).reshape(width, -1)
    x = np.zeros((places.shape[1], 8), np.uint8)
    x[:, :width] = places.T
    x = x.view(np.uint64).ravel()
    x = (x >> np.uint64(1)).view(np.int64) ^ -(x & np.uint64(1)).view(np.int64)
    return np.cumsum(x) if steps else x


def _packed(rows: DataFrame, spec: Spec) -> DataFrame:
    """(portion, ids, prints, sizes, data): the texts that spans count in, in portions, by id."""
    arrow = arrow_of(PORTIONS)

    def pack(batches):
        for batch in batches:
            data = [spec.text(d) for d in texts(batch, "text")]
            ids, prints = batch.column("id").to_numpy(), batch.column("print").to_numpy()
            for begin, end in portions(data):
                order = begin + np.argsort(ids[begin:end], kind="stable")
                own = [data[i] for i in order.tolist()]
                yield record_batch({
                    "ids": [squeezed(ids[order])], "prints": [prints[order].tobytes()],
                    "sizes": [squeezed(np.fromiter(map(len, own), np.int64, len(own)))],
                    "data": [zstandard.ZstdCompressor(level=3).compress(b"".join(own))]}, arrow)

    return rows.select("print", "id", "text").mapInArrow(pack, PORTIONS) \
        .withColumn("portion", F.monotonically_increasing_id())


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Number of the row, and texts, of each portion."""
    for i in range(batch.num_rows):
        data = zstandard.ZstdDecompressor().decompress(batch.column("data")[i].as_buffer())
        ends = np.cumsum(unsqueezed(batch.column("sizes")[i].as_py())).tolist()
        yield i, [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def _marks(packed: DataFrame, spec: Spec, buckets: int, hot: int) -> DataFrame:
    """(portion, bucket, marks, entries, shared, hot): which of a portion's minimisers of a
    bucket other rows have too, in the order of _entries, and how many. Rows of a null
    portion hold the minimisers of more than `hot` entries."""
    arrow, met_arrow = arrow_of(ENTRIES), arrow_of(MARKS)

    def send(batches):
        for batch in batches:
            for i, data in _unpacked(batch):
                prints = np.frombuffer(batch.column("prints")[i].as_py(), np.int64)
                found = _entries(spec, data, prints, buckets)
                yield record_batch(found | {"portion": [batch.column("portion")[i].as_py()] * len(found["bucket"])},
                                   arrow)

    def meet(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([record_batch(_met(group, hot), met_arrow)])

    sent = packed.select("portion", "prints", "sizes", "data").mapInArrow(send, ENTRIES)
    return sent.groupBy("bucket").applyInArrow(meet, MARKS)


def _entries(spec: Spec, data: list[bytes], prints: np.ndarray, buckets: int) -> dict:
    """Per bucket the different minimisers of a portion, and which different rows of it share."""
    grams_, mine = [], []
    for a, b in portions(data, BLOCK_BYTES):
        _, _, gram, owner = runs(units(spec, data[a:b]), spec.window, spec.k)
        grams_.append(gram >> SHORT)
        mine.append(prints[a:b][owner])
    gram, mine = np.concatenate(grams_), np.concatenate(mine)
    order = np.argsort(gram, kind="stable")
    gram, mine = gram[order], mine[order]
    first = np.flatnonzero(np.diff(gram, prepend=~gram[:1]) != 0)
    if len(first):
        # Some row of a minimiser differs from its first one.
        known = np.logical_or.reduceat(mine != np.repeat(mine[first], np.diff(np.append(first, len(gram)))), first)
    else:
        known = np.empty(0, bool)
    gram = gram[first]
    out = {c: [] for c in ("bucket", "known", "grams")}
    key, order = _by_bucket(gram, buckets)
    for a, b in stretches(key[order]):
        out["bucket"].append(int(key[order[a]]))
        out["known"].append(np.packbits(known[order[a:b]]).tobytes())
        out["grams"].append(squeezed(gram[order[a:b]]))
    return out


def _by_bucket(gram: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of sorted short minimisers, and their order by bucket."""
    key = (gram % np.uint64(buckets)).astype(np.int64)
    return key, np.argsort(key, kind="stable")


def _met(group: pa.Table, hot: int) -> dict:
    columns = {c: group.column(c).to_pylist() for c in group.column_names}
    grams_ = [unsqueezed(g) for g in columns["grams"]]
    sizes = [len(g) for g in grams_]
    gram = np.concatenate([np.empty(0, np.int64), *grams_])
    known = np.concatenate([np.empty(0, bool), *(
        np.unpackbits(np.frombuffer(k, np.uint8), count=n).view(bool) for k, n in zip(columns["known"], sizes))])
    # A portion has a minimiser once.
    order = np.argsort(gram, kind="stable")
    first = np.flatnonzero(np.diff(gram[order], prepend=-1) != 0)
    size = np.diff(np.append(first, len(gram)))
    shared = known
    shared[order] |= np.repeat(size > 1, size)
    often = gram[order[first[size > hot]]]
    ends = np.cumsum(sizes).tolist()
    parts = [shared[a:b] for a, b in zip([0, *ends[:-1]], ends)]
    out = {"portion": columns["portion"], "bucket": columns["bucket"], "entries": sizes,
           "marks": [np.packbits(p).tobytes() for p in parts], "shared": [int(p.sum()) for p in parts],
           "hot": [None] * len(parts)}
    if len(often):
        for c, value in (("portion", None), ("bucket", columns["bucket"][0]), ("entries", 0), ("marks", b""),
                         ("shared", 0), ("hot", often.astype(np.uint64).tobytes())):
            out[c].append(value)
    return out


def _marked(packed: DataFrame, marks: DataFrame) -> DataFrame:
    """The portions with the marks of all their buckets."""
    own = marks.where(F.col("portion").isNotNull()).groupBy("portion").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "marks"))).alias("marks"))
    # The plan is the same at any size: few marks would else be broadcast.
    return packed.join(own.hint("merge"), "portion")


def _shared(spec: Spec, data: list[bytes], marks: list[dict], buckets: int) -> np.ndarray:
    """The minimisers of a portion that other rows have too, sorted."""
    gram = np.unique(np.concatenate([
        runs(units(spec, data[a:b]), spec.window, spec.k)[2] for a, b in portions(data, BLOCK_BYTES)]))
    short = gram >> SHORT
    first = np.flatnonzero(np.diff(short, prepend=~short[:1]) != 0)
    key, order = _by_bucket(short[first], buckets)
    each = np.bincount(key, minlength=buckets)[[m["bucket"] for m in marks]]
    shared = np.zeros(len(first), bool)
    shared[order] = np.concatenate([np.empty(0, bool), *(
        np.unpackbits(np.frombuffer(m["marks"], np.uint8), count=n).view(bool) for m, n in zip(marks, each.tolist()))])
    return gram[np.repeat(shared, np.diff(np.append(first, len(gram))))]


def stretches(sorted_: np.ndarray):
    """(begin, end) of each run of equal values."""
    if not len(sorted_):
        return []
    begin = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    return zip(begin.tolist(), [*begin[1:].tolist(), len(sorted_)])


def _answered(marked: DataFrame, often: Broadcast, spec: Spec, exact: Callable, buckets: int,
              nth: int, rounds: int) -> DataFrame:
    """ANSWERS of the nth part of the minimisers."""
    arrow, found_arrow = arrow_of(STRINGS), arrow_of(ANSWERS)

    def send(batches):
        for batch in batches:
            for i, data in _unpacked(batch):
                shared = _shared(spec, data, batch.column("marks")[i].as_py(), buckets)
                shared = shared[(shared >> SHORT) // np.uint64(buckets) % np.uint64(rounds) == nth]
                ids = unsqueezed(batch.column("ids")[i].as_py())
                if len(shared):
                    hot = shared[_among(shared >> SHORT, often.value)]
                    found = _squeezed(_strings(spec, data, ids, np.arange(len(ids)), shared, hot, buckets))
                    found["portion"] = [batch.column("portion")[i].as_py()] * len(found["bucket"])
                    yield record_batch(found, arrow)

    def answer(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([record_batch(_answers(group, spec, exact), found_arrow)])

    sent = marked.select("portion", "ids", "sizes", "data", "marks").mapInArrow(send, STRINGS)
    return sent.groupBy("bucket").applyInArrow(answer, ANSWERS)


def _squeezed(strings: dict) -> dict:
    """What _strings found, as it travels."""
    spans = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in strings["known_spans"]]

    def each(column: str, kind: type, steps: bool = True, less: np.uint64 = np.uint64(0)) -> list[bytes]:
        found = (np.frombuffer(x, kind) for x in strings[column])
        return [squeezed(x >> less if less else x, steps) for x in found]

    return {"bucket": strings["bucket"], "strings": strings["strings"],
            "lengths": each("lengths", np.uint32, False), "grams": each("grams", np.uint64, False, SHORT),
            "uses": each("uses", np.uint32), "ids": each("ids", np.int64), "rows": each("prints", np.int64),
            "starts": each("starts", np.int64), "known_rows": each("known_prints", np.int64),
            "known_begins": [squeezed(x[:, 0]) for x in spans],
            "known_sizes": [squeezed(x[:, 1] - x[:, 0], False) for x in spans]}


def _spans(answers: DataFrame, marked: DataFrame) -> DataFrame:
    """(print, spans) of the rows that have any."""
    out = "print bigint, spans binary"
    out_arrow = arrow_of(out)

    def gather(found: pa.Table, portion: pa.Table) -> pa.Table:
        return pa.Table.from_batches([record_batch(_spans_of_rows(found, portion), out_arrow)])

    # Rows that are equal have equal spans, in whatever portions they are.
    return answers.groupBy("portion").cogroup(marked.select("portion", "prints").groupBy("portion")) \
        .applyInArrow(gather, out).dropDuplicates(["print"])


def _among(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Which of the values stand in a sorted list."""
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _strings(spec: Spec, data: list[bytes], ids: np.ndarray, prints: np.ndarray,
             shared: np.ndarray, hot: np.ndarray, buckets: int) -> dict:
    seen: dict[bytes, int] = {}
    found = []
    for at, to in portions(data, BLOCK_BYTES):
        u = units(spec, data[at:to])
        start, length, gram, owner = runs(u, spec.window, spec.k)
        keep = _among(gram, shared)
        start, length, gram, owner = start[keep], length[keep], gram[keep], owner[keep]
        often = _among(gram, hot)
        if often.any():
            n = length[often]
            single = spread(start[often], n)
            gram = np.concatenate([gram[~often], grams(u.codes, spec.window)[single]])
            owner = np.concatenate([owner[~often], np.repeat(owner[often], n)])
            start = np.concatenate([start[~often], single])
            length = np.concatenate([length[~often], np.ones(len(single), np.int64)])
        begin, end = u.begin[start], u.end[start + length + spec.window - 2]
        text = u.data
        string = np.fromiter((seen.setdefault(text[a:b], len(seen)) for a, b in zip(begin.tolist(), end.tolist())),
                             np.int64, len(begin))
        found.append((start - u.first[owner], length, gram, owner + at, string))
    place, length, gram, owner, string = (np.concatenate(x) for x in zip(*found))
    own_id = ids[owner]
    least = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(least, string, own_id)
    asks = own_id == least[string]
    strings = list(seen)
    key = np.empty(len(seen), np.uint64)
    key[string] = gram
    sizes = np.fromiter(map(len, strings), np.uint32, len(strings))

    out = {c: [] for c in ("bucket", "strings", "lengths", "grams", "uses", "ids", "prints", "starts",
                           "known_prints", "known_spans")}
    packer = zstandard.ZstdCompressor(level=3)
    to = (key % np.uint64(buckets)).astype(np.int64)
    asking = np.flatnonzero(asks)
    asked = string[asking]
    use_to = to[asked]
    known_print, known = merged(prints[owner[~asks]], np.stack(
        [place[~asks], place[~asks] + length[~asks] + spec.window - 1], axis=1))
    number = np.empty(len(strings), np.int64)
    by_string, by_use = (np.argsort(x, kind="stable") for x in (to, use_to))
    sorted_uses = use_to[by_use]
    for a, b in stretches(to[by_string]):
        mine, bucket = by_string[a:b], int(to[by_string[a]])
        number[mine] = np.arange(len(mine))
        uses = by_use[np.searchsorted(sorted_uses, bucket):np.searchsorted(sorted_uses, bucket, "right")]
        out["bucket"].append(bucket)
        out["strings"].append(packer.compress(b"".join([strings[i] for i in mine.tolist()])))
        out["lengths"].append(sizes[mine].tobytes())
        out["grams"].append(key[mine].tobytes())
        out["uses"].append(number[asked[uses]].astype(np.uint32).tobytes())
        uses = asking[uses]
        out["ids"].append(own_id[uses].tobytes())
        out["prints"].append(prints[owner[uses]].tobytes())
        out["starts"].append(place[uses].tobytes())
        own = slice(None) if bucket == to[0] else slice(0)  # any bucket brings them home
        out["known_prints"].append(known_print[own].tobytes())
        out["known_spans"].append(known[own].tobytes())
    return out


def _answers(group: pa.Table, spec: Spec, exact: Callable) -> dict:
    columns = {c: group.column(c).to_pylist() for c in group.column_names}
    seen: dict[bytes, int] = {}
    gram_of: list[np.ndarray] = []
    uses = []
    for packed, lengths, g, use in zip(*(columns[c] for c in ("strings", "lengths", "grams", "uses"))):
        data = zstandard.ZstdDecompressor().decompress(packed)
        ends = np.cumsum(unsqueezed(lengths)).tolist()
        before = len(seen)
        own = np.fromiter((seen.setdefault(data[a:b], len(seen)) for a, b in zip([0, *ends[:-1]], ends)),
                          np.int64, len(ends))
        fresh = np.zeros(len(seen) - before, np.uint64)
        new = own >= before
        fresh[own[new] - before] = unsqueezed(g)[new].astype(np.uint64)
        gram_of.append(fresh)
        uses.append(own[unsqueezed(use)])
    names = {p: n for n, p in enumerate(sorted(set(columns["portion"])))}

    def all_of(column: str) -> np.ndarray:
        return np.concatenate([np.empty(0, np.int64), *map(unsqueezed, columns[column])])

    def whose(column: str) -> np.ndarray:
        """Portion, as its number here, and row."""
        return np.concatenate([np.empty(0, np.int64), *(
            unsqueezed(x) | names[p] << 32 for p, x in zip(columns["portion"], columns[column]))])

    strings = list(seen)
    gram = np.concatenate([np.empty(0, np.uint64), *gram_of])
    string = np.concatenate([np.empty(0, np.int64), *uses])
    ids, rows, starts = all_of("ids"), whose("rows"), all_of("starts")
    least = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(least, string, ids)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) if spec.unit == "byte" else \
        np.fromiter((s.count(b" ") + 1 for s in strings), np.int64, len(strings))
    windows = sizes - spec.window + 1

    # A string alone under its minimiser has its windows to itself.
    order = np.argsort(gram, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], gram[order][1:] != gram[order][:-1]])) if len(order) else order
    count = np.diff(np.append(first, len(order)))
    alone = np.empty(len(strings), bool)
    alone[order] = np.repeat(count == 1, count)
    offset = np.concatenate([[0], np.cumsum(windows)])
    smallest = np.repeat(least, windows)
    several = order[~alone[order]]
    if len(several):
        found = exact([strings[i] for i in several.tolist()], gram[several], least[several], spec)
        smallest[spread(offset[several], windows[several])] = found

    n = windows[string]
    covered = smallest[spread(offset[string], n)] < np.repeat(ids, n)
    at = spread(starts, n)[covered]
    begins = all_of("known_begins")
    spans = np.concatenate([np.stack([at, at + spec.window], axis=1),
                            np.stack([begins, begins + all_of("known_sizes")], axis=1)])
    rows, spans = merged(np.concatenate([np.repeat(rows, n)[covered], whose("known_rows")]), spans)
    out = {c: [] for c in ("portion", "rows", "begins", "sizes")}
    portion_of = list(names)
    for a, b in stretches(rows >> 32):
        out["portion"].append(portion_of[rows[a] >> 32])
        out["rows"].append(squeezed(rows[a:b] & 0xFFFFFFFF))
        out["begins"].append(squeezed(spans[a:b, 0]))
        out["sizes"].append(squeezed(spans[a:b, 1] - spans[a:b, 0], False))
    return out


def _spans_of_rows(found: pa.Table, portion: pa.Table) -> dict:
    rows, begins, sizes = (np.concatenate([np.empty(0, np.int64), *map(unsqueezed, found.column(c).to_pylist())])
                           for c in ("rows", "begins", "sizes"))
    rows, spans = merged(rows, np.stack([begins, begins + sizes], axis=1))
    prints = np.concatenate([np.empty(0, np.int64), *(
        np.frombuffer(p, np.int64) for p in portion.column("prints").to_pylist())])
    cuts = list(stretches(rows))
    return {"print": [int(prints[rows[a]]) for a, _ in cuts], "spans": [spans[a:b].tobytes() for a, b in cuts]}


def merged(whose: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of each owner joined where they touch or overlap."""
    if not len(whose):
        return whose, spans
    order = np.lexsort((spans[:, 0], whose))
    whose, spans = whose[order], spans[order]
    fresh = np.concatenate([[True], whose[1:] != whose[:-1]])
    # Running maximum of ends within an owner, over a shift that keeps owners apart.
    number = np.cumsum(fresh) - 1
    shift = number * (int(spans.max()) + 1)
    reach = np.maximum.accumulate(spans[:, 1] + shift)
    new = fresh.copy()
    new[1:] |= spans[1:, 0] + shift[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(whose)) - 1
    return whose[at], np.stack([spans[at, 0], reach[last] - shift[last]], axis=1)


def removed_spans(packed: bytes | None) -> np.ndarray:
    """The maximal spans of one row."""
    return np.frombuffer(packed or b"", np.int64).reshape(-1, 2)
