"""op12 against a plain trie."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from vigil.llm.op12_prefix_trie import trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
CLASH = ("conv", "w", "at", "name", "node", "n", "words", "depth", "digest", "more", "parent")


def brute(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append(((t is not None, t or 0, role.encode(), digest), (role, text)))
    turns = {c: [x for _, x in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    sequences = {}
    for c in turns:
        # The remainder has the sign of the id, as in SQL.
        h = zlib.crc32(str(c).encode()) % 4
        sequences[c] = tuple(turns.get(int(c / 20) * 20, [])[:h] + turns[c][h:])
        for d in range(len(sequences[c]) + 1):
            members[sequences[c][:d]].append(c)
    children = defaultdict(list)
    for s in members:
        if s:
            children[s[:-1]].append(s)
    blank = dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        words = len([w for w in s[-1][1].translate(blank).split(" ") if w]) if s else 0
        leaves[s] = sum(leaves[c] for c in children[s]) or 1
        saved[s] = (len(members[s]) - 1) * words + sum(saved[c] for c in children[s])
    for s, convs in members.items():
        ended = ",".join(map(str, sorted(c for c in convs if len(sequences[c]) == len(s))))
        yield (min(convs), len(s), min(members[s[:-1]]) if s else None, len(convs), len(children[s]),
               leaves[s], saved[s], hashlib.sha256(ended.encode()).hexdigest())


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    return df.selectExpr("conv_id", "turn", "role", "text", *[f"'x' AS `{c}`" for c in CLASH]).repartition(5)


def conversations():
    random.seed(12)
    rows = []
    shared = [("user", f"opening words {k} " * (k % 5)) for k in range(70)]
    for c in random.sample(range(-30, 400), 160):
        own = random.choice([0, 1, 2, 3, 5, 8, 9, 16, 17, 24, 33, 65])
        same = random.randint(0, own)
        said = shared[:same] + [(random.choice(["user", "bot", None]), random.choice(["", None, "a b", "x\ty\n z"]))
                                for _ in range(own - same)]
        rows += [(c, k, *s) for k, s in enumerate(said)]
    rows += [(900 + k, 0, "user", "one third of all") for k in range(80)]
    rows += [(7000, None, "user", None), (7000, None, "a", "tie"), (7000, None, "a", "tie"), (None, 1, "user", "lost"),
             (7000, 3, "user", "late " * 20_000), (7020, 1, None, None), (7021, 1, "", "")]
    rows += [(8000, k, "user", f"t{k}") for k in range(500)] + [(8001, k, "user", f"t{k}") for k in range(500)]
    return rows


@pytest.mark.parametrize("window", [8, 4, 128])
def test_whole_result(spark, window):
    rows = conversations()
    found = trie(frame(spark, rows), window)
    assert tuple(found.columns) == COLUMNS
    assert Counter(tuple(r) for r in found.collect()) == Counter(brute(rows))


def test_turnless_and_empty(spark):
    # 1 and 21 start with turns of absent conversations and have none of their own left.
    rows = [(c, 0, "user", "only") for c in range(1, 60) if zlib.crc32(str(c).encode()) % 4 and c % 20]
    found = [tuple(r) for r in trie(frame(spark, rows)).collect()]
    assert found == list(brute(rows)) and len(found) == 1
    assert trie(frame(spark, [])).count() == 0
