"""Similarity join of documents on word shingles, as connected components.

Equal sets are one class. Classes meet under keys that no link can miss (see
vigil.llm.shingle_sets): small sets under their subsets of the overlap's size,
large ones in the inverted lists of their blocks; the boundary between the two
is chosen by cost from the sizes of all sets. What meets is a candidate: links
are checked on whole texts.

Copies of one text in many versions share many lists. Each list is named by its
leader, the member of least hash; lists of one leader are looked at as one. There,
members are compared on sketches: sums of the elements in many small blocks. Blocks
that differ are fewer than the elements in one set alone, so a pair with too many of
them cannot link. Of the pairs that may, a member's first and nearest partners are
checked on whole texts: where all link, the first ones tie them together. Lists in
which a member had more partners come again, without what is connected by then and
with sixteen times as many partners, until none had more. In lists of many members all
are checked against the leader first. Those that this does not make one component are
dealt anew, each member under its elements that are rarest in the list: linked sets
share one of the first (size - least overlap + 1) in any order that all have in common.
"""

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vigil.llm.components import ties
from vigil.llm.passages import Spec, keyed, portions, release, spread, units
from vigil.llm.registry import register, table
from vigil.llm.shingle_sets import Keys, Sets, boundary_by_cost, first_of_order, mix
from vigil.llm.workers import map_batches, record_batch, texts
from vigil.plans.scratch import materialize, remove

WORDS, PERCENT = 3, 90
#: Sizes of sets for which subsets are weighed against blocks.
SMALL = 64
#: Bytes of texts whose sets a task holds at once, and pairs it checks at once.
SET_BYTES, PAIR_ROWS = 2 << 20, 1_000
#: Members of a list that meet at once; keys that a list is dealt to where it is joined.
CHUNK, SPLIT = 1_000, 8
#: Bytes of sketches and of keys that meet in one task; cells of a comparison.
MET_BYTES, MATRIX = 16 << 20, 1 << 19
#: Partners of a member that are checked in the first round, sixteenfold in each further one.
PICKED = 4
#: Columns of sets and their keys on the way to where equal keys meet.
DEALT = "bucket int, sets binary, counts binary, keys binary"
#: Members, about, by whose elements a large list is ordered, and elements that are ordered at once.
SAMPLE, ELEMENTS = 32, 1 << 19


def shingle_sets(data: list[bytes], words: int) -> Sets:
    """Sets of texts: lower-case A-Z, words between ASCII white space."""
    spec = Spec("word", words, words)
    return Sets(units(spec, [spec.text(d.lower()) for d in data]), words)


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id.

    Two documents link when 100 * |A and B| >= percent * |A or B| for their sets
    of distinct shingles of `words` words; with fewer words the whole sequence is
    one shingle. component_id is the smallest id reachable over links, its own
    included. Without words (null or empty text) there is no link and
    component_id is the own id. Ids may repeat; null ids take part and are
    never smallest. An empty table gives no rows.
    """
    sets, classes, labels = _linked_classes(docs, words, percent, id_col, text_col)
    same = classes.join(labels, F.col("set") == F.col("node"), "left").select(
        "set", "least_id", F.coalesce("label", "set").alias("label"))
    least = same.groupBy("label").agg(F.min("least_id").alias("component_id"))
    # Many classes may share a label, many documents a class; neither joins by it twice.
    of_class = same.join(least, "label").select(F.col("set").alias("of"), "component_id")
    found = sets.join(of_class, (F.col("set") == F.col("of")) & (F.col("n") > 0), "left")
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def representatives(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns: the one of smallest id.

    Null ids come after all others; of rows with equal id and text one stays.
    Rows without words link with nothing and all stay.
    """
    _, classes, labels = _linked_classes(docs, words, percent, id_col, text_col)
    best = F.struct(F.col("least_id").isNull().alias("last"), "least_id", "print")
    chosen = (
        classes.join(labels, F.col("set") == F.col("node"), "left")
        .groupBy(F.coalesce("label", "set").alias("label")).agg(F.min(best).alias("best"))
        .select(F.col("best.print").alias("of")))
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    own = Window.partitionBy("print").orderBy(F.xxhash64("row"))
    kept = (
        rows.where(worded).withColumn("print", F.xxhash64(F.col(f"row.`{id_col}`").cast("long"), text))
        .join(chosen, F.col("print") == F.col("of"), "left_semi")
        .withColumn("nth", F.row_number().over(own)).where("nth = 1").select("row"))
    return kept.unionByName(rows.where(~worded)).select("row.*")


def _linked_classes(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str):
    """Sets of the rows, classes of equal sets, and the labels of classes with links."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    sets, classes, renamed = _classes(rows, words)
    sizes = {r["n"]: r["count"] for r in classes.where(F.col("n") <= SMALL).groupBy("n").count().collect()}
    keys = Keys(percent, boundary_by_cost(sizes, percent, SMALL))
    entries = _entries(rows, classes, keys, words, renamed)
    labels = _settle(rows, classes, entries, words, percent)
    release(spark)
    return sets, classes, labels


def _classes(rows: DataFrame, words: int) -> tuple[DataFrame, DataFrame, dict]:
    """Sets of all rows, their classes, and sets that had to be named anew."""
    schema = "id bigint, print bigint, n bigint, set bigint, whole binary"

    def measure(renamed: dict):
        def task():
            def work(batch: pa.RecordBatch) -> dict:
                data, n, names, whole = texts(batch, "text"), [], [], []
                for a, b in portions(data, SET_BYTES):
                    sets = shingle_sets(data[a:b], words)
                    own = sets.keys()
                    n.append(sets.sizes)
                    names += [_name(k, renamed) for k in own]
                    whole += own
                return {"id": batch.column("id"), "print": batch.column("print"),
                        "n": np.concatenate(n) if n else [], "set": names, "whole": whole}

            return work

        return map_batches(rows, task, schema)

    renamed: dict[bytes, int] = {}
    while True:
        sets, path = materialize(measure(renamed), "sets")
        classes, class_path = materialize(
            sets.where("n > 0").groupBy("set").agg(
                F.min("id").alias("least_id"), F.max("n").alias("n"),
                F.min(F.struct(F.col("id").isNull().alias("last"), "id", "print"))["print"].alias("print"),
                F.min("whole").alias("low"), F.max("whole").alias("high")), "classes")
        twice = classes.where("low <> high").select("set")
        # Different sets under one 64-bit name: a handful even among 10**10 sets.
        found = sets.join(twice, "set").select("whole").distinct().collect()
        if not found:
            return sets.drop("whole", "print"), classes.drop("low", "high"), renamed
        renamed.update({bytes(r["whole"]): len(renamed) + i for i, r in enumerate(found)})
        remove(rows.sparkSession, path)
        remove(rows.sparkSession, class_path)


def _name(whole: bytes, renamed: dict) -> int:
    known = renamed.get(whole)
    return int.from_bytes(whole[:8], "little", signed=True) if known is None \
        else xxhash.xxh3_64_intdigest(whole, seed=known + 1) - (1 << 63)


def _entries(rows: DataFrame, classes: DataFrame, keys: Keys, words: int, renamed: dict) -> DataFrame:
    """(list, set, n): classes that share a key with others, under the leaders of their lists."""
    spark = rows.sparkSession
    shingles = classes.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * shingles // MET_BYTES)
    schema = StructType.fromDDL(DEALT)
    arrow = to_arrow_schema(schema)

    def send(batches):
        for batch in batches:
            data = texts(batch, "text")
            for a, b in portions(data):
                yield record_batch(_dealt(shingle_sets(data[a:b], words), keys, renamed, buckets), arrow)

    lists = _met(rows.select("text").mapInArrow(send, schema))
    entries, _ = materialize(lists.join(classes.select("set", "n"), "set"), "entries")
    release(spark)
    return entries


def _met(dealt: DataFrame) -> DataFrame:
    """(list, set) of the sets that share a key with others; dealt as in DEALT."""
    schema = StructType.fromDDL("list bigint, set bigint")
    arrow = to_arrow_schema(schema)

    def meet(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([record_batch(_lists(group), arrow)])

    return dealt.groupBy("bucket").applyInArrow(meet, schema).distinct()


def _dealt(sets: Sets, keys: Keys, renamed: dict, buckets: int) -> dict:
    """Keys of the different sets of a portion, by bucket."""
    owner, key = keys.of(sets)
    names = np.array([_name(k, renamed) for k in sets.keys()], np.int64)
    # Copies within the portion send their keys once.
    first = np.zeros(len(names), bool)
    first[np.unique(names, return_index=True)[1]] = True
    keep = first[owner]
    key = key[keep]
    return _by_bucket(names[owner[keep]], key, (key % np.uint64(buckets)).astype(np.int64))


def _by_bucket(name: np.ndarray, key: np.ndarray, to: np.ndarray) -> dict:
    order = np.lexsort((name, to))
    key, name, to = key[order], name[order], to[order]
    cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else []
    out = {c: [] for c in ("bucket", "sets", "counts", "keys")}
    for a, b in zip(cut, np.append(cut[1:], len(to)) if len(to) else []):
        each = np.flatnonzero(np.concatenate([[True], name[a + 1:b] != name[a:b - 1]]))
        out["bucket"].append(int(to[a]))
        out["sets"].append(name[a:b][each].tobytes())
        out["counts"].append(np.diff(np.append(each, b - a)).astype(np.uint32).tobytes())
        out["keys"].append(key[a:b].tobytes())
    return out


def _lists(group: pa.Table) -> dict:
    keys, names = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for s, c, k in zip(*(group.column(c).to_pylist() for c in ("sets", "counts", "keys"))):
        keys.append(np.frombuffer(k, np.uint64))
        names.append(np.repeat(np.frombuffer(s, np.int64), np.frombuffer(c, np.uint32)))
    key, name = np.concatenate(keys), np.concatenate(names)
    order = np.lexsort((mix(name.view(np.uint64)), key))
    key, name = key[order], name[order]
    once = np.ones(len(key), bool)
    once[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
    key, name = key[once], name[once]
    if not len(key):
        return {"list": [], "set": []}
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(begin, len(key)))
    some = size > 1
    if not some.any():
        return {"list": [], "set": []}
    # Lists of one leader, the member of least hash, are one.
    at = spread(begin[some], size[some])
    met = np.stack([np.repeat(name[begin[some]], size[some]), name[at]], axis=1)
    met = met[np.lexsort((met[:, 1], met[:, 0]))]
    met = met[np.concatenate([[True], (met[1:] != met[:-1]).any(axis=1)])]
    return {"list": met[:, 0], "set": met[:, 1]}


def _settle(rows: DataFrame, classes: DataFrame, entries: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, label) of the components of linked classes; the least of each has no row."""
    spark = rows.sparkSession
    wanted = entries.select("set").distinct()
    prints = classes.join(wanted, "set").select("set", F.col("print").alias("of"))
    found = rows.join(prints, F.col("print") == F.col("of")).select("set", "text")
    whole, _ = materialize(_packed(found, words, percent), "candidates")
    release(spark)
    labels = spark.createDataFrame([], "node bigint, label bigint")
    tested = spark.createDataFrame([], "x bigint, y bigint")
    pairs, picked = _to_leaders(entries, classes, percent), PICKED
    entries = entries.withColumn("label", F.col("set"))
    while True:
        more = None
        if pairs is None:
            met, _ = materialize(_possible(_open(entries), whole, percent, picked), "pairs")
            found = met.where("x is not null").select("x", "y")
            pairs = found.distinct().join(tested, ["x", "y"], "left_anti")
            more, picked = met.where("x is null").select("list").distinct(), 16 * picked
        else:
            found, _ = materialize(pairs, "pairs")
            pairs = found
        fresh, _ = materialize(_linked(pairs, whole, words, percent), "links")
        release(spark)
        tested, pairs = tested.unionByName(found), None
        if not fresh.isEmpty():
            # Labels stand for the links they came from.
            labels, _ = ties(fresh.unionByName(labels.select(F.col("node").alias("x"), F.col("label").alias("y"))))
        if more is None:
            named, _ = materialize(_named(entries, labels), "entries")
            entries, _ = materialize(_finer(named, whole, words, percent), "entries")
            release(spark)
            continue
        if more.isEmpty():
            return labels
        # Only lists in which some member had more partners than were picked.
        entries, _ = materialize(_named(entries.join(more, "list", "left_semi"), labels), "entries")


def _named(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries with the labels of their sets, to be written: all that follows reads them several times."""
    return entries.drop("label").join(labels, F.col("set") == F.col("node"), "left").select(
        "list", "set", "n", F.coalesce("label", "set").alias("label"))


def _near(a, b, percent: int):
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def _to_leaders(entries: DataFrame, classes: DataFrame, percent: int) -> DataFrame | None:
    """Pairs of each member and the leader of its list, in lists of more than CHUNK; None without such."""
    large = entries.groupBy("list").count().where(F.col("count") > CHUNK).select("list")
    if large.isEmpty():
        return None
    led = large.join(classes.select(F.col("set").alias("list"), F.col("n").alias("m")), "list")
    return (_beside(entries.where("list <> set"), led).where(_near(F.col("n"), F.col("m"), percent))
            .select(F.least("list", "set").alias("x"), F.greatest("list", "set").alias("y")).distinct())


def _beside(entries: DataFrame, of_list: DataFrame) -> DataFrame:
    """Entries joined by list, each list's members dealt to SPLIT keys."""
    return (entries.withColumn("part", F.pmod(F.xxhash64("set"), F.lit(SPLIT)).cast("int"))
            .join(of_list.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPLIT - 1)))), ["list", "part"])
            .drop("part"))


def _finer(named: DataFrame, whole: DataFrame, words: int, percent: int) -> DataFrame:
    """Entries with lists of up to CHUNK members as they are, the members of larger ones
    in lists of their rarest elements, and no larger ones that are within one component.

    The order of elements, by their number in a sample of the list's members, only
    decides how many meet: linked sets meet in any order.
    """
    spark = named.sparkSession
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    large = named.groupBy("list").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members"),
        F.sum("n").alias("elements")).where(F.col("members") > CHUNK)
    parts = F.greatest(F.ceil(F.col("members") / CHUNK), F.ceil(F.col("elements") / ELEMENTS)).cast("int")
    wide = _beside(named, large.where("low < high").select("list", "members", parts.alias("parts")))
    own = F.pmod(F.xxhash64(F.lit(5), "set"), "parts").cast("int")
    sent = (
        wide.join(whole.select("set", "packed"), "set")
        .withColumn("own", own)
        .withColumn("sampled", F.pmod(F.xxhash64(F.lit(3), "set"), "members") < SAMPLE)
        .withColumn("part", F.explode(F.when(F.col("sampled"), F.sequence(F.lit(0), F.col("parts") - 1))
                                      .otherwise(F.array("own"))))
        .select("list", "part", "parts", "set", (F.col("own") == F.col("part")).alias("inside"), "sampled", "packed"))
    schema = StructType.fromDDL(DEALT)
    arrow = to_arrow_schema(schema)

    def deal(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([record_batch(_rarest(group, words, percent, buckets), arrow)])

    lists = _met(sent.groupBy("list", "part").applyInArrow(deal, schema))
    sets = wide.select("set", "n", "label").distinct()
    return (named.join(large.select("list"), "list", "left_anti")
            .unionByName(lists.join(sets, "set").select("list", "set", "n", "label")))


def _rarest(group: pa.Table, words: int, percent: int, buckets: int) -> dict:
    """Keys of a part of a list: the elements of each set that are rarest in the sample."""
    unpack = zstandard.ZstdDecompressor().decompress
    names, inside, sampled = (group.column(c).to_numpy() for c in ("set", "inside", "sampled"))
    packed = group.column("packed").to_pylist()
    order = np.argsort(names)
    known = np.concatenate([np.empty(0, np.uint64), *(
        shingle_sets([unpack(packed[m])], words).values for m in order[sampled[order]].tolist())])
    known, times = np.unique(known, return_counts=True)
    list_salt = mix(group.column("list").to_numpy()[:1].view(np.uint64))
    own, found = np.flatnonzero(inside), []
    data = [unpack(packed[m]) for m in own.tolist()]
    for a, b in portions(data, SET_BYTES):
        sets = shingle_sets(data[a:b], words)
        often = np.zeros(len(sets.values), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, sets.values), len(known) - 1)
            often = np.where(known[at] == sets.values, times[at], 0)
        ranked = np.lexsort((mix(sets.values + list_salt), often, sets.owner))
        nth = spread(np.zeros(len(sets.sizes), np.int64), sets.sizes)
        keep = nth < first_of_order(sets.sizes, percent)[sets.owner]
        found.append((names[own[a:b]][sets.owner[keep]], mix(sets.values[ranked[keep]] + list_salt)))
    name, key = (np.concatenate(x) for x in zip(*found)) if found else (
        np.empty(0, np.int64), np.empty(0, np.uint64))
    # To as many buckets as the list has parts: in each, two sets meet once however many keys they share.
    parts = np.uint64(group.column("parts")[0].as_py())
    return _by_bucket(name, key, (mix(list_salt + key % parts) % np.uint64(buckets)).astype(np.int64))


def _open(named: DataFrame) -> DataFrame:
    """Entries of lists that are not within one component, with the chunks they meet in.

    A list of up to CHUNK members is one chunk. In a larger one, the leader's
    component and the other members are chunks apart; the component's chunks meet
    those of the others only, so a member of it is sent once per chunk of others.
    """
    labelled = named.groupBy("list", "label").agg(
        F.count(F.lit(1)).alias("members"), F.max(F.col("list") == F.col("set")).alias("leads"))
    lists = labelled.groupBy("list").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.sum("members").alias("members"),
        F.max(F.when(F.col("leads"), F.col("label"))).alias("main"),
        F.sum(F.when(F.col("leads"), F.col("members")).otherwise(0)).alias("led")).where("low < high")
    # How many chunks members are in inside the leader's component and outside of it.
    lists = lists.select(
        "list", "main", "members", F.ceil(F.col("led") / CHUNK).cast("int").alias("mains"),
        F.ceil((F.col("members") - F.col("led")) / CHUNK).cast("int").alias("others"))
    own = _beside(named, lists)
    inside, one = F.col("label") == F.col("main"), F.col("members") <= CHUNK
    place = F.xxhash64(F.lit(7), "set")
    own = own.withColumn("own", F.when(one, 0).when(inside, -1 - F.pmod(place, "mains"))
                         .otherwise(F.pmod(place, "others")).cast("int"))
    to_others = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda o: F.struct(
        F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))
    to_mains = F.transform(F.sequence(F.lit(1), F.col("mains")), lambda m: F.struct(
        (-m).alias("i"), F.col("own").alias("j")))
    alone = F.array(F.struct(F.col("own").alias("i"), F.col("own").alias("j")))
    at = F.when(one, alone).when(inside, to_others).otherwise(F.concat(to_others, to_mains))
    return own.withColumn("at", F.explode(at)).select("list", "set", "n", "label", "own", "at.i", "at.j")


def _possible(open_: DataFrame, whole: DataFrame, percent: int, picked: int) -> DataFrame:
    """(list, x, y): pairs between components of one list whose sketches leave a link possible.

    Of a member's partners before it in the list's order the first ones and the
    nearest ones, `picked` of each. Null x and y tell that a member had more.
    """
    spark = open_.sparkSession
    open_, _ = materialize(open_, "open")
    size = whole.agg(F.avg(F.length("sketch")).alias("mean")).first()["mean"] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")),
                  64, int(open_.count() * (size + 48)) // MET_BYTES)
    sent = (
        open_.join(whole.select("set", "sketch"), "set")
        .withColumn("bucket", F.pmod(F.xxhash64("list", "i", "j"), F.lit(buckets)).cast("int"))
        .select("bucket", "list", "i", "j", "own", "set", "n", "label", "sketch"))
    schema = StructType.fromDDL("list bigint, x bigint, y bigint")
    arrow = to_arrow_schema(schema)

    def meet(group: pa.Table) -> pa.Table:
        lists, i, j, side, sets, n, labels = (
            group.column(c).to_numpy() for c in ("list", "i", "j", "own", "set", "n", "label"))
        sketches = group.column("sketch").to_pylist()
        order = np.lexsort((mix(sets.view(np.uint64)), j, i, lists))
        change = np.ones(len(order), bool)
        keys = np.stack([lists[order], i[order], j[order]], axis=1)
        change[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        begin = np.flatnonzero(change)
        found, more = [np.empty((0, 3), np.int64)], []
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(order)]):
            own = order[a:b]
            within = i[own[0]] == j[own[0]]
            left = right = own
            if not within:
                left, right = own[side[own] == j[own[0]]], own[side[own] == i[own[0]]]
            pairs, rest = _pairs_of(left, right, within, n, labels, sketches, percent, picked)
            u, v = sets[pairs[:, 0]], sets[pairs[:, 1]]
            found.append(np.stack([np.full(len(u), lists[own[0]]), np.minimum(u, v), np.maximum(u, v)], axis=1))
            if rest:
                more.append(int(lists[own[0]]))
        out = np.concatenate(found)
        return pa.Table.from_batches([record_batch({
            "list": pa.array([*out[:, 0].tolist(), *more], pa.int64()),
            "x": pa.array([*out[:, 1].tolist(), *[None] * len(more)], pa.int64()),
            "y": pa.array([*out[:, 2].tolist(), *[None] * len(more)], pa.int64())}, arrow)])

    return sent.groupBy("bucket").applyInArrow(meet, schema)


def _pairs_of(left, right, within: bool, n, labels, sketches, percent: int, picked: int):
    """Pairs of rows that may link, some per row of left, and whether there are more."""
    found, more = [np.empty((0, 2), np.int64)], False
    for few, rows in _by_blocks(left, sketches):
        for many, columns in _by_blocks(right, sketches):
            if within and many < few:
                continue
            # Sums of small blocks add up to those of larger ones.
            blocks = min(few, many)
            x, y = (_sums(own, sketches, blocks) for own in (rows, columns))
            step = max(1, MATRIX // len(columns))
            for at in range(0, len(rows), step):
                some = rows[at:at + step]
                small, large = (f(n[some][:, None], n[columns][None, :]) for f in (np.minimum, np.maximum))
                ok = (labels[some][:, None] != labels[columns][None, :]) & (100 * small >= percent * large)
                if within and few == many:
                    ok &= np.arange(len(columns))[None, :] < np.arange(at, at + len(some))[:, None]
                single = (small + large) * (100 - percent) // (100 + percent)
                differ = np.full(ok.shape, np.iinfo(np.int32).max, np.int32)
                r, c = np.nonzero(ok)
                most = max(1, (1 << 22) // blocks)
                for cut in range(0, len(r), most):
                    p, q = r[cut:cut + most], c[cut:cut + most]
                    differ[p, q] = (x[at + p] != y[q]).sum(axis=1)
                may = ok & (differ <= single)
                if not may.any():
                    continue
                take = may & (np.cumsum(may, axis=1) <= picked)
                if len(columns) > picked:
                    nearest = np.argpartition(np.where(may, differ, np.iinfo(np.int32).max), picked - 1, axis=1)
                    put = np.zeros_like(may)
                    np.put_along_axis(put, nearest[:, :picked], True, axis=1)
                    take |= may & put
                more |= bool((may & ~take).any())
                r, c = np.nonzero(take)
                found.append(np.stack([some[r], columns[c]], axis=1))
    return np.concatenate(found), more


def _by_blocks(own, sketches) -> list:
    """Rows by the length of their sketches."""
    length = np.array([len(sketches[m]) // 2 for m in own.tolist()])
    return [(int(k), own[length == k]) for k in np.unique(length)]


def _sums(own, sketches, blocks: int):
    x = np.stack([np.frombuffer(sketches[m], np.uint16) for m in own.tolist()])
    return x.reshape(len(x), -1, blocks).sum(axis=1, dtype=np.uint16)


def sketch(values: np.ndarray, percent: int) -> bytes:
    """Sums of a set's elements in blocks, modulo 2**16; about four blocks for each
    element that may be in one set alone, a power of two of them."""
    single = 2 * len(values) * (100 - percent) // (100 + percent) + 1
    blocks = 1 << max(4, (4 * single - 1).bit_length())
    mixed = mix(values)
    sums = np.bincount((mixed >> np.uint64(40)).astype(np.int64) & (blocks - 1),
                       (mixed & np.uint64(0xFFFF)).astype(float), blocks)
    return (sums.astype(np.int64) & 0xFFFF).astype(np.uint16).tobytes()


def _packed(found: DataFrame, words: int, percent: int) -> DataFrame:
    """(set, packed, sketch) of one text of each class."""

    def task():
        packer = zstandard.ZstdCompressor(level=3)

        def work(batch: pa.RecordBatch) -> dict:
            data, sketches = texts(batch, "text"), []
            for a, b in portions(data, SET_BYTES):
                part = shingle_sets(data[a:b], words)
                sketches += [sketch(v, percent) for v in np.split(part.values, part.first[1:-1])]
            return {"set": batch.column("set"), "packed": [packer.compress(d) for d in data],
                    "sketch": sketches}

        return work

    return map_batches(found, task, "set bigint, packed binary, sketch binary").dropDuplicates(["set"])


def _linked(pairs: DataFrame, whole: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that are linked, from their whole texts."""
    x = whole.select(F.col("set").alias("x"), F.col("packed").alias("text_x"))
    y = whole.select(F.col("set").alias("y"), F.col("packed").alias("text_y"))

    def task():
        unpack = zstandard.ZstdDecompressor().decompress

        def linked(batch: pa.RecordBatch) -> list[bool]:
            left, right = (batch.column(c).to_pylist() for c in ("text_x", "text_y"))
            both = list(dict.fromkeys(left + right))
            number = {d: i for i, d in enumerate(both)}
            data = [unpack(d) for d in both]
            sets = []
            for a, b in portions(data, SET_BYTES):
                part = shingle_sets(data[a:b], words)
                sets += np.split(part.values, part.first[1:-1])
            keep = []
            for a, b in zip(left, right):
                p, q = sets[number[a]], sets[number[b]]
                merged = np.sort(np.concatenate([p, q]), kind="stable")
                shared = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            return keep

        def work(batch: pa.RecordBatch) -> dict:
            keep = [k for at in range(0, batch.num_rows, PAIR_ROWS) for k in linked(batch.slice(at, PAIR_ROWS))]
            kept = pa.array(np.flatnonzero(keep))
            return {"x": batch.column("x").take(kept), "y": batch.column("y").take(kept)}

        return work

    return map_batches(pairs.join(x, "x").join(y, "y"), task, "x bigint, y bigint")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM d),
shingles AS (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.r AS a, b.r AS b FROM shingles AS a JOIN shingles AS b ON a.x = b.x AND a.r < b.r
    AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT r AS a, r AS b FROM sets
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, CAST(any_value(len(s.s)) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id
FROM reach JOIN sets AS s ON reach.a = s.r JOIN sets AS t ON reach.b = t.r GROUP BY s.r, s.doc_id"""


@register("op8_jaccard_join", SQL)
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
