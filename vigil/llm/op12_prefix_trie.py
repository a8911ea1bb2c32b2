"""Trie of conversations by their first turns, with totals of subtrees.

Conversations are cut into windows of turns at places that are halves of halves of
the longest possible one. Cutting a range of turns in the middle leaves an upper
sequence and a lower one; the prefix up to the cut is named by a digest of the name
above and of what the upper half holds, so equal prefixes have one name in whatever
conversation they stand. Upper tries and lower forests of a level are cut together,
until a range is one window; then the nodes of all windows are named and counted in
one step. On the way back the totals of a lower forest are grafted onto the upper
range it hangs under, again for all ranges of a level together. Rounds grow with
the logarithm of the longest conversation, and only conversations that fill a
window take part in them.

A node belongs to its smallest conversation, and so does all of that conversation
below it. The total of a node is therefore the sum, over its conversations, of what
each owns from there on: sums by name, which are partial aggregates, so neither a
root above all conversations nor copies of one are a group for one task.
"""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vigil.llm.registry import register, table
from vigil.plans.order import dealt, positions
from vigil.plans.scratch import materialize

SHARED, HEADS = 20, 4  # conversations of one base; heads have fewer than HEADS turns
WINDOW = 128  # turns
ROWS = 256  # windows, or conversation ids, that Python handles at once
HOT_CHILDREN = 10_000
WORD = "[^\\x20\\x09-\\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "struct<name:binary,parent:binary,depth:bigint,words:bigint>"


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, digest, words) of all rebuilt conversations, and (conv, turns).

    digest tells role and text, words counts the text's words. Turns go by number
    (null first), then role, then digest; null roles and texts are empty. Rows
    without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    read, _ = materialize(turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", role.alias("role"), F.unhex(digest).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words")), "turns")
    placed, _ = materialize(positions(read, ["conv"], ["turn", "role", "digest"], "at").select(
        "conv", "at", "digest", "words"), "placed-turns")
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    entry = F.when((F.col("at") < HEADS - 1) & (F.col("conv") % SHARED == 0), F.struct("at", "digest", "words"))
    convs = placed.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(entry)).alias("first"))
    bases = convs.where(F.col("conv") % SHARED == 0).select(F.col("conv").alias("base"), F.col("first").alias("given"))
    convs = convs.select("conv", "n", head.alias("head"), (F.col("conv") - F.col("conv") % SHARED).alias("base"),
                         F.slice("first", 1, 0).alias("none"))
    shape, _ = materialize(
        convs.join(bases, "base", "left")
        .withColumn("given", F.slice(F.coalesce("given", "none"), F.lit(1), F.col("head")))
        .select("conv", "given", (F.size("given") - F.col("head")).alias("shift"),
                (F.size("given") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("turns")), "shapes")
    own = placed.where(F.col("at") >= head).join(shape.where("shift <> 0").select("conv", "shift"), "conv", "left") \
        .select("conv", (F.col("at") + F.coalesce("shift", F.lit(0)) + 1).alias("depth"), "digest", "words")
    taken = shape.select("conv", F.posexplode("given").alias("at", "g")).select(
        "conv", (F.col("at") + 1).cast("bigint").alias("depth"), "g.digest", "g.words")
    rows, _ = materialize(own.unionByName(taken), "rebuilt-turns")
    return rows, shape.select("conv", "turns")


def trie(turns: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per node: conv_id (its smallest conversation), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns has conv_id, turn, role and text; see rebuilt() for order, nulls and ties.
    Repeated rows are turns of their own; other columns are ignored. An empty table
    has no conversations and no nodes, not even a root.
    """
    rows, lengths = rebuilt(turns)
    windows, _ = materialize(
        rows.groupBy("conv", F.floor((F.col("depth") - 1) / window).alias("w")).agg(
            F.sort_array(F.collect_list(F.struct("depth", "digest", "words"))).alias("turns"))
        .select("conv", "w", F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words")), "windows")
    height = (windows.agg(F.max("w")).first()[0] or 0).bit_length()
    full = F.size("digests") == window
    filled = windows.where(full).select("conv").distinct()
    sequences, _ = materialize(windows.join(filled, "conv", "left_semi").select("conv", "w", F.when(
        full, F.sha2(F.array_join(F.transform("digests", F.hex), "").cast("binary"), 256)).alias("whole")), "sequences")
    follow = sequences.select("conv", (F.col("w") - 1).alias("w"), F.lit(True).alias("more"))
    named = _cut(sequences, height).join(follow, ["conv", "w"], "left")
    none = lengths.where("turns = 0").select("conv", F.lit(0).cast("bigint").alias("w"))
    every, _ = materialize(_chain(
        windows.join(named, ["conv", "w"], "left").unionByName(none, allowMissingColumns=True), window), "named-windows")

    met, _ = materialize(every.select("conv", F.explode("nodes").alias("n")).select("conv", "n.*").groupBy("name").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("parent").alias("parent"),
        F.min("depth").alias("depth"), F.min("words").alias("words")), "nodes")
    children = met.where("parent IS NOT NULL").groupBy(F.col("parent").alias("name")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    met, _ = materialize(met.join(children, "name", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "counted-nodes")
    ends = _ends(every.select("conv", F.col("end").alias("name")).where("name IS NOT NULL"))
    return (
        _with_parent(met).join(_totals(every, met, window, height), "name").join(ends, "name", "left")
        .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")))


def _cut(sequences: DataFrame, height: int) -> DataFrame:
    """(conv, w, root, leaf): names of the prefixes that end before a window and with it.

    sequences: (conv, w, whole); whole tells what a full window holds. First the
    halves are put together bottom up, so that each range knows what its upper half
    holds; then ranges of 2**height windows are cut.
    """
    held = [sequences]
    for _ in range(height):
        half = F.col("w") % 2
        pairs = held[-1].groupBy("conv", F.floor(F.col("w") / 2).alias("w")).agg(
            F.max(F.when(half == 0, F.col("whole"))).alias("upper"),
            F.max(F.when(half == 1, F.col("whole"))).alias("lower"))
        paired, _ = materialize(pairs.select("conv", "w", "upper", F.sha2(
            F.concat("upper", "lower").cast("binary"), 256).alias("whole")), "halves")
        held.append(paired)
    binary = F.lit(None).cast("binary")
    return _ranges(held, held[-1].select("conv", "w", F.lit(b"").alias("root"), binary.alias("leaf")), height)


def _ranges(held: list[DataFrame], ranges: DataFrame, height: int) -> DataFrame:
    """Cut all ranges of a level in the middle; upper and lower halves go on together."""
    if height == 0:
        return ranges
    cut = ranges.join(held[height].select("conv", "w", "upper"), ["conv", "w"])
    middle = F.unhex(F.sha2(F.concat("root", F.unhex("upper")), 256))
    first = F.col("w") * 2
    halves = cut.withColumn("middle", middle).select("conv", F.explode(F.array(
        F.struct(first.alias("w"), "root", F.col("middle").alias("leaf")),
        F.struct((first + 1).alias("w"), F.col("middle").alias("root"), "leaf"))).alias("half"))
    halves = halves.select("conv", "half.*").join(held[height - 1].select("conv", "w"), ["conv", "w"])
    halves, _ = materialize(halves, "ranges")
    return _ranges(held, halves, height - 1)


def _map(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """work on few rows at a time: windows are long."""
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                out = work(batch.slice(start, ROWS))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def _chain(windows: DataFrame, window: int) -> DataFrame:
    """Nodes of each window, named one after another from its root; the root of all is
    among those of the first. The last node of a full window has the name that the cut
    below it gave. end: the name of the whole conversation, where it ends."""

    def work(batch: pa.RecordBatch) -> dict:
        rows = [batch.column(c).to_pylist() for c in ("conv", "w", "digests", "words", "root", "leaf", "more")]
        nodes, ends = [], []
        for _, w, digests, words, root, leaf, more in zip(*rows):
            name = root or b""
            found = [] if w else [(name, None, 0, 0)]
            last = window - 1 if leaf is not None else -1
            for k, (digest, n) in enumerate(zip(digests or (), words or ())):
                above, name = name, leaf if k == last else hashlib.sha256(name + digest).digest()
                found.append((name, above, w * window + k + 1, n))
            nodes.append([dict(zip(("name", "parent", "depth", "words"), f)) for f in found])
            ends.append(None if more else name)
        return {"conv": rows[0], "w": rows[1], "nodes": nodes, "end": ends}

    return _map(windows, f"conv bigint, w bigint, nodes array<{NODE}>, end binary", work)


def _with_parent(nodes: DataFrame) -> DataFrame:
    """parent_conv_id by the parent's name. Parents of very many children, of which there
    are at most HOT_CHILDREN, are broadcast; others meet theirs in a join."""
    least = max(HOT_CHILDREN, nodes.count() // HOT_CHILDREN)
    parents = nodes.where("n_children > 0").select(
        F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("of"))
    hot = F.broadcast(parents.where(F.col("of") > least))
    rest = nodes.join(hot, "parent", "left_anti").join(parents.where(F.col("of") <= least), "parent", "left")
    return rest.unionByName(nodes.join(hot, "parent")).drop("of")


def _totals(every: DataFrame, nodes: DataFrame, window: int, height: int) -> DataFrame:
    """(name, n_leaves, saved_tokens) of whole subtrees.

    What a conversation owns in a window stands at the window's end: from some depth
    on it is the smallest of all that go that way, and it stays so.
    """
    entry = F.struct("depth", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("leaf"),
                     ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    w = F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.floor((F.col("depth") - 1) / window)).cast("bigint")
    own = nodes.groupBy("conv", w.alias("w")).agg(F.sort_array(F.collect_list(entry)).alias("own"))
    own, _ = materialize(own.select("conv", "w", F.col("own.leaf").alias("leaves"), F.col("own.saved").alias("saved")), "owned")
    part = own.join(_grafts(own, height), ["conv", "w"], "full")
    rows = every.select("conv", "w", F.col("nodes.name").alias("names")).join(part, ["conv", "w"])

    def work(batch: pa.RecordBatch) -> dict:
        names = batch.column("names").to_pylist()
        out = {"names": names}
        for column, below in (("leaves", "leaves_below"), ("saved", "saved_below")):
            out[column] = []
            for held, own, under in zip(names, batch.column(column).to_pylist(), batch.column(below).to_pylist()):
                value = np.zeros(len(held), np.int64)
                if own:
                    value[-len(own):] = own
                out[column].append(value[::-1].cumsum()[::-1] + (under or 0))
        return out

    sums = _map(rows, "names array<binary>, leaves array<bigint>, saved array<bigint>", work)
    return sums.select(F.explode(F.arrays_zip("names", "leaves", "saved")).alias("s")).groupBy(
        F.col("s.names").alias("name")).agg(
        F.sum("s.leaves").alias("n_leaves"), F.sum("s.saved").alias("saved_tokens"))


def _grafts(own: DataFrame, height: int) -> DataFrame:
    """(conv, w, leaves_below, saved_below): what a conversation owns in later windows.

    At each level the total of a range's lower half goes to all windows of its upper
    half; the halves of all levels are totalled at once.
    """
    total = [F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x).alias(c) for c in ("leaves", "saved")]
    lower = own.where("w > 0").select("conv", "w", *total)
    level = F.explode(F.sequence(F.lit(0), F.lit(max(height - 1, 0)))).alias("level")
    halves = lower.select("conv", level, "w", "leaves", "saved") \
        .withColumn("half", F.expr("shiftright(w, level)")).where("half % 2 = 1") \
        .groupBy("conv", "level", "half").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    first = F.expr("shiftleft(half - 1, level)")
    return halves.select("conv", F.explode(F.sequence(first, first + F.expr("shiftleft(1L, level) - 1"))).alias("w"),
                         "leaves", "saved") \
        .groupBy("conv", "w").agg(F.sum("leaves").alias("leaves_below"), F.sum("saved").alias("saved_below"))


def _ends(ended: DataFrame) -> DataFrame:
    """(name, ends_sha256): digest of the ids of the conversations that end at a node.

    Ids are dealt by range of (name, id) and joined to short texts where they are. A
    digest runs over its texts one after another: its task streams them, and holds
    one batch.
    """
    rows = dealt(ended, [F.col("name"), F.col("conv")], "number")
    texts = StructType.fromDDL("name binary, number bigint, ids string")
    texts_schema = to_arrow_schema(texts)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, key = [], None
            for name, conv, number in zip(*[batch.column(c).to_pylist() for c in ("name", "conv", "number")]):
                # A copy is read again in files of any order; rows of one file keep theirs.
                if (name, number - 1) != key or len(out[-1][2]) >= ROWS:
                    out.append((name, number, []))
                out[-1][2].append(str(conv))
                key = (name, number)
            columns = [[o[0] for o in out], [o[1] for o in out], [",".join(o[2]) for o in out]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, texts_schema)], schema=texts_schema)

    digests = StructType.fromDDL("name binary, ends_sha256 string")
    digests_schema = to_arrow_schema(digests)

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if name == now and state is not None:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = name, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[k] for d in done], f.type) for k, f in enumerate(digests_schema)], schema=digests_schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([now], pa.binary()), pa.array([state.hexdigest()])], schema=digests_schema)

    return rows.mapInArrow(join, texts).repartition("name").sortWithinPartitions("name", "number") \
        .mapInArrow(hash_all, digests)


#: The same rows in DuckDB: prefixes as texts of digests, subtrees by the prefixes of their nodes.
SQL = """
WITH bytes AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
said AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, digest, words,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, digest) - 1 AS pos FROM said),
convs AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(
    string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM own), bytes),
taken AS (SELECT v.c, pos, digest, words FROM convs v JOIN own o ON o.c = v.c - v.c % 20 AND pos < h),
given AS (SELECT c, count(*) AS m FROM taken GROUP BY c),
turned AS (
  SELECT c, pos + 1 AS d, digest, words FROM taken
  UNION ALL
  SELECT o.c, pos - h + coalesce(m, 0) + 1, digest, words
  FROM own o JOIN convs v ON v.c = o.c LEFT JOIN given g ON g.c = o.c WHERE pos >= h),
entries AS (
  SELECT c, d, string_agg(digest, '') OVER (PARTITION BY c ORDER BY d) AS name, words FROM turned
  UNION ALL SELECT c, 0, '', 0 FROM convs),
lasts AS (SELECT c, max(d) AS d FROM entries GROUP BY c),
linked AS (SELECT *, lag(name) OVER (PARTITION BY c ORDER BY d) AS parent FROM entries),
nodes AS (
  SELECT name, d, min(parent) AS parent, min(c) AS c, count(*) AS n, min(words) AS words
  FROM linked GROUP BY name, d),
children AS (SELECT parent AS name, count(*) AS n FROM nodes WHERE d > 0 GROUP BY parent),
valued AS (
  SELECT u.*, coalesce(k.n, 0) AS n_children, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf,
    (u.n - 1) * words AS saved
  FROM nodes u LEFT JOIN children k ON k.name = u.name),
totals AS (
  SELECT e.name, sum(leaf)::BIGINT AS leaves, sum(saved)::BIGINT AS saved
  FROM valued u JOIN entries e ON e.c = u.c AND e.d <= u.d GROUP BY e.name),
ends AS (
  SELECT name, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
  FROM entries JOIN lasts USING (c, d) GROUP BY name)
SELECT u.c AS conv_id, u.d AS depth, p.c AS parent_conv_id, u.n AS n_convs, u.n_children,
  t.leaves AS n_leaves, t.saved AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM valued u JOIN totals t ON t.name = u.name
LEFT JOIN nodes p ON p.name = u.parent AND u.d > 0
LEFT JOIN ends x ON x.name = u.name
"""


@register("op12_prefix_trie", SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
