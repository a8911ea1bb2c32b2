"""Merkle manifest of a dataset: a root over all rows, and a proof for each.

A row's leaf is a digest of its fields. The leaves of a group, in order, are cut
into aligned blocks. A block keeps each level of its tree as one string of hex
digests: fixed-width substrings of it are hashed to the level above, and what
stands left and right of a node in its run are its siblings, cut out as two
substrings. The roots of the blocks are the leaves of the next, 256 times smaller
problem; the roots of the groups are the leaves of the last one. Paths come back
down by a join of blocks with the paths of their roots.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.registry import register, table
from vigil.plans.order import positions
from vigil.plans.scratch import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 16  # nodes that become one
LEVELS = 2  # levels that a block climbs
BLOCK = RUN ** LEVELS
HEX = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_EVERY = 5


def digest(*parts: Column) -> Column:
    """Lowercase hex of the SHA-256 of the parts' bytes, one after another."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field with its byte count before it, `-` where it is null."""
    framed = []
    for field in fields:
        text = field.cast("string")
        framed.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(*framed)


def manifest(rows: DataFrame, group: str, order: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Per row: the columns kept, leaf, subroot, root and path.

    rows has the columns group, order, leaf and those kept. Groups (null is one)
    are ordered by their value, null first; the rows of a group by `order`, null
    first, then by leaf, so that repeated rows and repeated ids have defined places:
    each row is a leaf. path is an array of (left, right), the siblings as hex text
    before and after the node, from the leaf's run up to the root's; fold() and
    proof() take it. An empty table gives no rows.
    """
    named = rows.select(F.col(group).alias("group"), F.col(order).alias("order"), F.col("leaf").alias("node"),
                        *[F.col(k).alias(f"kept_{k}") for k in kept])
    placed = positions(named, ["group"], ["order", "node"], "at")
    kept_as = [f"kept_{k}" for k in kept]
    found = _climb(placed.select("group", "at", "node", *kept_as), kept_as, last=False)
    return found.select(*[F.col(f"kept_{k}").alias(k) for k in kept], F.col("node").alias("leaf"),
                        "subroot", "root", "path")


def fold(node: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, node, lambda below, beside: digest(beside["left"], below, beside["right"]))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.aggregate(path, F.lit("").cast("binary"), lambda before, beside: F.concat(
        before, beside["left"], beside["right"])), 256)


def _climb(nodes: DataFrame, kept: list[str], last: bool) -> DataFrame:
    """nodes (group, at, node, *kept) with path, subroot and root; last: there is one group."""
    blocks, _ = materialize(_blocks(nodes, kept), "merkle-blocks")
    highest = blocks.agg(F.max("block")).first()[0]
    nowhere = F.array().cast("array<struct<left:binary,right:binary>>")
    if highest:
        above = _climb(blocks.select("group", F.col("block").alias("at"), F.col("top").alias("node")), [], last)
        above = above.select(F.col("group").alias("g"), F.col("at").alias("b"), F.col("path").alias("above"),
                             "subroot", "root")
        blocks = blocks.join(above, F.col("group").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b")))
    elif last or highest is None:
        blocks = blocks.withColumns({"above": nowhere, "subroot": F.col("top"), "root": F.col("top")})
    else:
        groups = positions(blocks.select("group", F.col("top").alias("node")), [], ["group"], "at")
        above = _climb(groups.select(F.lit(None).cast("string").alias("group"), "at", "node",
                                     F.col("group").alias("name")), ["name"], last=True)
        above = above.select(F.col("name").alias("g"), F.col("path").alias("above"), "root")
        blocks = blocks.join(above, F.col("group").eqNullSafe(F.col("g"))).withColumn("subroot", F.col("top"))
    levels = [f"level{k}" for k in range(LEVELS)]
    each = blocks.select("group", "block", "height", "above", "subroot", "root", *levels,
                         F.posexplode("nodes").alias("i", "n"))
    own = F.slice(F.array(*[_beside(F.col(c), F.floor(F.col("i") / RUN ** k)) for k, c in enumerate(levels)]),
                  1, F.col("height"))
    return each.select("group", F.col("n.at").alias("at"), F.col("n.node").alias("node"),
                       *[F.col("n")[k].alias(k) for k in kept], F.concat(own, "above").alias("path"),
                       "subroot", "root")


def _blocks(nodes: DataFrame, kept: list[str]) -> DataFrame:
    """A row per aligned block: its nodes in order, its levels as strings, its own root (top).

    The first block of a group may be its only one and then stops where one node is
    left. Any other block, and a full one, climbs all levels.
    """
    cut = nodes.groupBy("group", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("at", "node", *kept))).alias("nodes"))
    n = F.size("nodes")
    needed = reduce(lambda rest, k: F.when(n <= RUN ** k, F.lit(k)).otherwise(rest),
                    range(LEVELS - 1, -1, -1), F.lit(LEVELS))
    cut = cut.withColumn("height", F.when(F.col("block") == 0, needed).otherwise(F.lit(LEVELS)))
    cut = cut.withColumn("level0", F.array_join(F.transform("nodes", lambda x: x["node"]), "").cast("binary"))
    for k in range(LEVELS):
        cut = cut.withColumn(f"level{k + 1}", _parents(F.col(f"level{k}")))
    top = F.col(f"level{LEVELS}")
    for k in range(LEVELS - 1, -1, -1):
        top = F.when(F.col("height") == k, F.col(f"level{k}")).otherwise(top)
    return cut.withColumn("top", top.cast("string")).drop(f"level{LEVELS}")


def _parents(level: Column) -> Column:
    """The level above as one string: each run of digests is a substring of fixed width."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / (RUN * HEX)).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(
        F.substr(level, i * (RUN * HEX) + 1, F.lit(RUN * HEX)), 256)), "").cast("binary")


def _beside(level: Column, i: Column) -> Column:
    """What stands before and after node i in its run."""
    start = (F.floor(i / RUN) * (RUN * HEX)).cast("int")
    offset = (F.pmod(i, F.lit(RUN)) * HEX).cast("int")
    return F.struct(
        F.substr(level, start + 1, offset).alias("left"),
        F.substr(level, start + offset + HEX + 1, F.lit((RUN - 1) * HEX) - offset).alias("right"))


def verify(docs: DataFrame, tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Groups are sources, ordered within by doc_id (null first), then leaf. Where
    tamper_every divides the unsigned crc32 of the decimal doc_id, the root is folded
    from the leaf of the text with A-Z in lower case; a null id is not tampered with.
    Null fields are hashed as `-`, empty texts as `0:`; other columns are ignored.
    """
    rows = docs.select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tamper_every == 0
    columns = {c: F.col(c) for c in FIELDS}
    lowered = columns | {"text": F.translate("text", UPPER, LOWER)}
    hashed, _ = materialize(rows.select(
        "doc_id", "source", leaf(*columns.values()).alias("leaf"),
        F.when(tampered, leaf(*lowered.values())).alias("other")), "leaves")
    found = manifest(hashed, "source", "doc_id", ("doc_id", "other"))
    path = F.col("path")
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof(path).alias("proof_sha256"),
        fold(F.coalesce("other", "leaf"), path).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(source_levels: int = 7, top_levels: int = 5) -> str:
    """DuckDB's way to the same rows: one table per level, siblings cut from a run's string."""

    def framed(c: str, value: str) -> str:
        return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"

    def row(text: str) -> str:
        return "sha256(" + " || ".join(framed(c, text if c == "text" else f"{c}::VARCHAR") for c in FIELDS) + ")"

    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    ctes = [
        # The bytewise table of the checksum, then the checksum of the decimal id.
        "bytes AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
        "lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)",
        f"""leaves AS (
            SELECT doc_id, source, {row('text')} AS leaf,
              CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(
                string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % {TAMPER_EVERY} = 0
              THEN {row(lower)} END AS other
            FROM documents, bytes)""",
        """p0 AS (SELECT *, leaf AS node, coalesce(other, leaf) AS folded, '' AS beside,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY source) AS n FROM leaves)"""]

    def level(k: int, group: str) -> list[str]:
        return [
            f"""r{k} AS (SELECT {group} AS g, pos // 16 AS run, string_agg(node, '' ORDER BY pos) AS run_text
                FROM (SELECT DISTINCT {group}, pos, node FROM p{k}) GROUP BY ALL)""",
            f"""q{k} AS (SELECT p.*, run_text, substr(run_text, 1, (pos % 16) * 64) AS l,
                substr(run_text, (pos % 16) * 64 + 65) AS r
                FROM p{k} p JOIN r{k} ON p.{group} IS NOT DISTINCT FROM g AND pos // 16 = run)"""]

    for k in range(source_levels):
        ctes += level(k, "source")
        ctes.append(f"""p{k + 1} AS (SELECT doc_id, source, leaf, other,
            CASE WHEN n > 1 THEN sha256(run_text) ELSE node END AS node,
            CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded,
            CASE WHEN n > 1 THEN beside || l || r ELSE beside END AS beside,
            pos // 16 AS pos, (n + 15) // 16 AS n FROM q{k})""")
    k = source_levels + 1
    ctes.append(f"""p{k} AS (SELECT * EXCLUDE (pos, n), node AS subroot, 0 AS one,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
        (SELECT count(*) FROM (SELECT DISTINCT source FROM leaves)) AS n FROM p{source_levels})""")
    for k in range(source_levels + 1, source_levels + 1 + top_levels):
        ctes += level(k, "one")
        ctes.append(f"""p{k + 1} AS (SELECT doc_id, source, leaf, other, subroot, one,
            CASE WHEN n > 1 THEN sha256(run_text) ELSE node END AS node,
            CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded,
            CASE WHEN n > 1 THEN beside || l || r ELSE beside END AS beside,
            pos // 16 AS pos, (n + 15) // 16 AS n FROM q{k})""")
    return "WITH " + ",\n".join(ctes) + f"""
        SELECT doc_id, leaf, subroot, node AS root, sha256(beside) AS proof_sha256,
          folded AS folded_root, folded = node AS verified FROM p{source_levels + 1 + top_levels}"""


@register("op13_merkle_manifest", _sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(table(spark, sf_dir, "documents"))
