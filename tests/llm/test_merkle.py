"""op13 against a plain tree."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from vigil.llm.op13_merkle_manifest import FIELDS, verify

CLASH = ("group", "order", "node", "leaf", "at", "block", "path", "root", "g", "b", "kept_other", "__tie")
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """Root, and per node its siblings as (left, right) from the bottom up."""
    places, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, p in enumerate(places):
            a = p - p % 16
            paths[k].append(("".join(nodes[a:p]), "".join(nodes[p + 1:a + 16])))
        nodes = [sha(*nodes[a:a + 16]) for a in range(0, len(nodes), 16)]
        places = [p // 16 for p in places]
    return nodes[0], paths


def brute(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, orders = {}, {}
    for s in names:
        orders[s] = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in orders[s]])
    root, above = tree([trees[s][0] for s in names])
    for k, s in enumerate(names):
        for r, path in zip(orders[s], trees[s][1]):
            path = path + above[k]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf((*r[:4], r[4] and r[4].translate(lower))) if tampered else leaf(r)
            for left, right in path:
                node = sha(left, node, right)
            yield (r[0], leaf(r), trees[s][0], root, sha(*[a + b for a, b in path]), node, node == root)


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr(*FIELDS, *[f"'x' AS `{c}`" for c in CLASH]).repartition(5)


def rows_of(sizes):
    random.seed(13)
    rows = []
    for source, n in sizes:
        rows += [(random.randint(-9, 9 * n), source, random.choice(["de", None]), random.choice([None, i]),
                  random.choice([None, "", "Été ÀB", "plain", "One Two " * 50])) for i in range(n)]
    return rows


@pytest.mark.parametrize("sizes", [
    [("hot", 4500), ("b", 256), ("c", 257), ("É", 17), ("", 16), ("z", 1), (None, 33)],  # a tree of five levels
    [(f"s{i}", 1 + i % 3) for i in range(290)],  # more groups than a block has nodes
    [(None, 1)], [("one", 16)],
])
def test_whole_result(spark, sizes):
    rows = rows_of(sizes)
    rows += [(None, rows[0][1], None, None, None)] * 2 + [rows[0]] * 20 + [(rows[0][0], rows[0][1], "xx", 1, "a" * 300_000)]
    found = Counter(tuple(r) for r in verify(frame(spark, rows)).collect())
    assert found == Counter(brute(rows))
    if len(rows) > 4000:
        assert {k[-1] for k in found} == {True, False}


def test_empty_table(spark):
    assert verify(frame(spark, [])).count() == 0
