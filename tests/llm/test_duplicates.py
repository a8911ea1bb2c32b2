"""op8, op9 and op10 against brute force."""

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import op8_jaccard_join, op10_suffix_dedup, passages
from vigil.llm.components import components
from vigil.llm.op8_jaccard_join import join, representatives
from vigil.llm.op9_superkmer_dedup import remove_windows
from vigil.llm.op10_suffix_dedup import least_by_suffixes, remove_passages, shorten
from vigil.llm.passages import Spec
from vigil.llm.shingle_sets import Keys, boundary_by_cost, first_of_order, least_overlap
from vigil.llm.suffix_groups import suffix_orders
from vigil.llm.workers import map_batches
from vigil.plans.scratch import materialize


def sha(data):
    return hashlib.sha256(data).hexdigest()


def texts_with_passages(seed):
    random.seed(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "日本"]
    passages = [" ".join(random.choice(words) for _ in range(random.randint(20, 120))) for _ in range(6)]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(random.randint(0, 5)):
            parts.append(random.choice(passages) if random.random() < 0.6 else
                         " ".join(random.choice(words) for _ in range(random.randint(1, 80))))
            if random.random() < 0.3:
                own = parts[-1].split()
                own[random.randrange(len(own))] = f"edit{i}"
                parts[-1] = random.choice([" ", "\n", "  "]).join(own)
        rows.append((i, " \n".join(parts)))
    return rows


@pytest.fixture(scope="module")
def rows(odd_rows):
    return texts_with_passages(1) + [(100 + i if i is not None else i, t) for i, t in odd_rows] + \
        [(200, "ab" * 2000), (201, "ba" * 1800), (3, texts_with_passages(1)[9][1])]


def first_windows(rows, split, window):
    first = {}
    for i, t in rows:
        units = split(t)
        for p in range(len(units) - window + 1 if i is not None else 0):
            w = units[p:p + window]
            first[w] = min(first.get(w, i), i)
    return first


def flags(units, i, first, window):
    out = np.zeros(len(units), bool)
    for p in range(len(units) - window + 1 if i is not None else 0):
        if first[units[p:p + window]] < i:
            out[p:p + window] = True
    return out


@pytest.mark.parametrize("window, gram, hot", [(50, 16, 50_000), (50, 16, 1), (12, 3, 50_000)])
def test_byte_passages(frame, rows, window, gram, hot):
    def split(t):
        return (t or "").encode()

    first, expected = first_windows(rows, split, window), []
    for i, t in rows:
        data = split(t)
        gone = flags(data, i, first, window)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        expected.append((i, len(data), int(gone.sum()), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    found = remove_passages(frame(rows), window, gram, hot=hot).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert sum(e[2] for e in expected) > 10_000


@pytest.mark.parametrize("window, gram, hot", [(50, 8, 50_000), (50, 8, 1), (5, 2, 50_000)])
def test_word_windows(frame, rows, window, gram, hot):
    def split(t):
        return tuple((t or "").encode().split())

    first, expected = first_windows(rows, split, window), []
    for i, t in rows:
        words = split(t)
        gone = flags(words, i, first, window)
        expected.append((i, len(words), int(gone.sum()), sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    found = remove_windows(frame(rows), window, gram, hot=hot).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, sha(bytes(r.kept))) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert sum(e[2] for e in expected) > 1000


@pytest.mark.parametrize("remove, split, join, window", [
    (remove_passages, lambda t: t.encode(), bytes, 50), (remove_windows, lambda t: tuple(t.encode().split()), b" ".join, 50)])
def test_hot_minimisers_are_hot_in_every_portion(spark, remove, split, join, window):
    """Portions of a few rows, dealt anew between the two steps; each sees passages twice."""
    rows = texts_with_passages(6)
    first, expected = first_windows(rows, split, window), []
    for i, t in rows:
        own = split(t)
        gone = flags(own, i, first, window)
        expected.append((i, int(gone.sum()), sha(join(u for u, g in zip(own, gone) if not g))))
    given = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
             "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {k: spark.conf.get(k) for k in given}
    for k, v in given.items():
        spark.conf.set(k, v)
    try:
        found = remove(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), hot=1).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.doc_id, r.n_removed, sha(bytes(r.kept))) for r in found) == sorted(expected)


def test_shortened_texts_travel_once(frame, monkeypatch):
    sent = []
    monkeypatch.setattr(op10_suffix_dedup, "map_batches", lambda df, task, schema: sent.append(df) or map_batches(
        df, task, schema))
    docs = frame([(1, "a" * 60), (2, "b" + "a" * 60), (3, None)])
    found = shorten(docs)
    assert "text" not in sent[-1].schema["row"].dataType.names
    assert found.columns == docs.columns
    assert {r.doc_id: r.text for r in found.collect()} == {1: "a" * 60, 2: "b", 3: None}


def test_shortened_texts_lose_whole_characters_only(frame, rows):
    docs = frame(rows).withColumn("n_chars", F.length("text").cast("long"))
    found = shorten(docs, chars_col="n_chars")
    assert found.dtypes == docs.dtypes
    got = defaultdict(list)
    for r in found.collect():
        got[r.doc_id].append(r)
        assert r.n_chars == len(r.text or "")
    assert Counter(i for i, _ in rows) == {i: len(v) for i, v in got.items()}
    first = first_windows(rows, lambda t: (t or "").encode(), 50)
    for i, t in rows:
        gone = iter(flags((t or "").encode(), i, first, 50))
        kept = None if t is None else "".join(
            c for c in t if not all([next(gone) for _ in range(len(c.encode()))]))
        assert kept in [r.text for r in got[i]]


def test_suffix_orders_equal_sorting():
    random.seed(3)
    for _ in range(150):
        texts = [[random.randint(0, random.choice([1, 2, 5, 20])) for _ in range(random.randint(0, 30))]
                 for _ in range(random.randint(1, 8))]
        flat = np.concatenate([np.append(np.array(t, int) + 1, 0) for t in texts])
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        orders = suffix_orders(flat, offsets)
        for a, b in zip(offsets[:-1], offsets[1:]):
            own = flat[a:b].tolist()
            assert (orders[a:b] - a).tolist() == sorted(range(len(own)), key=lambda i: own[i:])


def test_large_texts_are_cut_by_longer_minimisers():
    random.seed(5)
    core = bytes(random.choice(b"abc") for _ in range(60))
    strings = sorted({bytes(random.choice(b"xyz") for _ in range(random.randint(0, 12))) + core
                      + bytes(random.choice(b"xyz") for _ in range(random.randint(0, 12))) for _ in range(300)})
    least = np.array([random.randint(0, 10**6) for _ in strings])
    got = least_by_suffixes(strings, np.zeros(len(strings), np.uint64), least, Spec("byte", 50, 16))
    best = {}
    for s, n in zip(strings, least):
        for p in range(len(s) - 49):
            best[s[p:p + 50]] = min(best.get(s[p:p + 50], n), n)
    assert got.tolist() == [best[s[p:p + 50]] for s in strings for p in range(len(s) - 49)]


def test_portions_are_looked_at_in_blocks(monkeypatch):
    spec, rng = Spec("byte", 50, 16), np.random.default_rng(5)
    data = [rng.integers(97, 123, 8192, dtype=np.uint8).tobytes() for _ in range(500)]
    data += [d[100:4000] for d in data[:100]] + [b"", b"short"]
    ids = np.arange(len(data))
    tracemalloc.start()
    passages._entries(spec, data, ids, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * sum(map(len, data))

    shared = passages.runs(passages.units(spec, data[-102:]), 50, 16)[2]
    shared = np.unique(shared)

    def sent():
        entries = passages._entries(spec, data, ids, 16)
        return entries, passages._strings(spec, data, ids, ids, shared, shared[::7], 1)

    (entries, strings), _ = sent(), monkeypatch.setattr(passages, "BLOCK_BYTES", 1 << 30)
    whole, whole_strings = sent()
    assert entries == whole
    for column in ("ids", "prints", "starts", "lengths", "grams"):
        a, b = (np.frombuffer(s[column][0], np.uint32 if column == "lengths" else np.int64)
                for s in (strings, whole_strings))
        assert sorted(a.tolist()) == sorted(b.tolist())


def test_entries_take_few_bytes_of_disk():
    """Texts without anything in common, dealt to many buckets: what travels per minimiser."""
    spec, rng = Spec("byte", 50, 16), np.random.default_rng(6)
    data = [rng.integers(97, 123, 3000, dtype=np.uint8).tobytes() for _ in range(300)]
    entries = passages._entries(spec, data, rng.integers(-1 << 62, 1 << 62, len(data)), 200)
    sent = sum(len(x) for column in entries.values() for x in column if isinstance(x, bytes))
    minimisers = len(np.unique(passages.runs(passages.units(spec, data), 50, 16)[2]))
    assert sent < 8 * minimisers


def test_whole_numbers_squeezed():
    rng = np.random.default_rng(7)
    for x in ([], [0], [-1], [5, 5, 5], [-1 << 63, (1 << 63) - 1, 0], rng.integers(-1 << 62, 1 << 62, 1000), np.arange(300)):
        x = np.array(x, np.int64)
        for steps in (True, False):
            assert passages.unsqueezed(passages.squeezed(x, steps)).tolist() == x.tolist()
    assert len(passages.squeezed(np.arange(10_000))) < 100


def test_texts_that_repeat_are_sent_in_rounds(frame, monkeypatch):
    """The strings of texts that all repeat are a multiple of the texts: no round sends them all."""
    rows = texts_with_passages(8)
    rows += [(1000 + i, t) for i, t in rows]
    sent = []
    answered = passages._answered
    monkeypatch.setattr(passages, "_answered", lambda *a: sent.append(a[-2:]) or answered(*a))
    found = {r.doc_id: r for r in remove_passages(frame(rows)).collect()}
    assert sent == [(0, len(sent)), (1, len(sent))] + [(n, len(sent)) for n in range(2, len(sent))]
    first = first_windows(rows, lambda t: t.encode(), 50)
    for i, t in rows:
        gone = flags(t.encode(), i, first, 50)
        assert bytes(found[i].kept) == bytes(b for b, g in zip(t.encode(), gone) if not g)
    assert passages._rounds(Spec("byte", 50, 16), 100, 100) == 3 and passages._rounds(Spec("word", 50, 8), 0, 0) == 1


def similar_texts(seed):
    random.seed(seed)
    words = [f"w{i}" for i in range(400)] + ["Ab", "aB"]
    rows, n = [], 0
    for _ in range(45):
        base = [random.choice(words) for _ in range(random.choice(
            [1, 2, 3, 5, 8, 10, 11, 12, 15, 18, 20, 22, 25, 30, 40, 60, 100, 200, 400]))]
        for _ in range(random.randint(1, 12)):
            rate = random.choice([0, 0, 0.005, 0.01, 0.02, 0.03, 0.05])
            own = [random.choice(words) if random.random() < rate else w for w in base]
            if random.random() < 0.3:
                own = own[: max(1, int(len(own) * random.uniform(0.9, 1)))]
            rows.append((n, random.choice([" ", "\n", " \t"]).join(own)))
            n += 1
    return rows


def linked(rows, words, percent):
    sets, lists, parent = [], defaultdict(list), list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for n, (_, t) in enumerate(rows):
        own = (t or "").encode().lower().split()
        own = {tuple(own[j:j + words]) for j in range(len(own) - words + 1)} or ({tuple(own)} if own else set())
        shared = Counter(m for x in own for m in lists[x])
        for x in own:
            lists[x].append(n)
        for m, both in shared.items():
            if 100 * both >= percent * (len(own) + len(sets[m]) - both):
                parent[root(n)] = root(m)
        sets.append(own)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[root(n)] = min(least.get(root(n), i), i)
    return [(i, len(sets[n]), least.get(root(n)), root(n)) for n, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_jaccard_components(frame, odd_rows, words, percent):
    rows = similar_texts(2) + [(1000 + i if i is not None else i, t) for i, t in odd_rows]
    found = [tuple(r) for r in join(frame(rows), words, percent).collect()]
    expected = [e[:3] for e in linked(rows, words, percent)]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert sum(i != c for i, _, c in expected) > 100


def test_groups_of_many_chunks_and_rounds(frame, monkeypatch):
    """Copies of two texts with so many edits that some pairs link and others just do not."""
    random.seed(9)
    rows = []
    for b in range(2):
        base = [f"b{b}w{i}" for i in range(60 + 40 * b)]
        for i in range(150):
            own = list(base)
            for at in random.sample(range(len(own)), random.randint(1, 4)):
                own[at] = f"edit{random.randrange(12)}"
            rows.append((1000 * b + i, " ".join(own)))
    monkeypatch.setattr(op8_jaccard_join, "CHUNK", 20)
    monkeypatch.setattr(op8_jaccard_join, "PICKED", 1)
    found = [tuple(r) for r in join(frame(rows), 3, 90).collect()]
    expected = [e[:3] for e in linked(rows, 3, 90)]
    assert sorted(found) == sorted(expected)
    assert 20 < len({c for _, _, c in expected}) < 280


def edited_copies(n, edits, length=60, vocabulary=None):
    """Copies of one text, each with edits of its own or from a small vocabulary."""
    rows = []
    for i in range(n):
        own = [f"base{j}" for j in range(length)]
        for at in random.sample(range(length), random.choice(edits)):
            own[at] = f"edit{i}x{at}" if vocabulary is None else f"edit{random.randrange(vocabulary)}"
        rows.append((i, " ".join(own)))
    return rows


def test_rows_sent_grow_with_a_group_of_copies_that_do_not_link(frame, monkeypatch):
    """Copies too far apart for links meet in few lists; what is looked at is not their square."""
    random.seed(11)
    made = Counter()

    def counted(df, name):
        found, path = materialize(df, name)
        made[name] += found.count()
        return found, path

    monkeypatch.setattr(op8_jaccard_join, "CHUNK", 20)
    monkeypatch.setattr(op8_jaccard_join, "materialize", counted)
    sent = []
    for n in (300, 600):
        rows = edited_copies(n, [6, 7, 8])
        made.clear()
        found = [tuple(r) for r in join(frame(rows), 3, 90).collect()]
        assert sorted(found) == sorted(e[:3] for e in linked(rows, 3, 90))
        sent.append(made["open"])
    assert made["candidates"] > 500
    assert sent[1] <= 2.5 * max(sent[0], 100)


def test_labels_join_entries_once_a_round(frame, monkeypatch):
    random.seed(12)
    plans = []

    def seen(df, name):
        if name == "open":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, name)

    monkeypatch.setattr(op8_jaccard_join, "CHUNK", 20)
    monkeypatch.setattr(op8_jaccard_join, "materialize", seen)
    rows = edited_copies(120, [1, 2, 3], vocabulary=12)
    found = [tuple(r) for r in join(frame(rows), 3, 90).collect()]
    assert sorted(found) == sorted(e[:3] for e in linked(rows, 3, 90))
    assert plans and not any("LeftOuter" in p for p in plans)


@pytest.mark.parametrize("words, percent, vocabulary", [(3, 90, 12), (5, 80, None), (1, 60, 30)])
def test_large_lists_dealt_anew_lose_no_link(frame, monkeypatch, words, percent, vocabulary):
    random.seed(13)
    rows = edited_copies(250, range(8), 70, vocabulary)
    rows += [(1000 + i, t) for i, t in edited_copies(60, [0, 1, 2], 30, vocabulary)]
    monkeypatch.setattr(op8_jaccard_join, "CHUNK", 10)
    monkeypatch.setattr(op8_jaccard_join, "SAMPLE", 3)
    monkeypatch.setattr(op8_jaccard_join, "ELEMENTS", 2000)
    dealt = []
    finer = op8_jaccard_join._finer
    monkeypatch.setattr(op8_jaccard_join, "_finer", lambda *a: dealt.append(1) or finer(*a))
    found = [tuple(r) for r in join(frame(rows), words, percent).collect()]
    assert sorted(found) == sorted(e[:3] for e in linked(rows, words, percent))
    assert dealt


def test_linked_sets_share_a_first_element():
    rng = np.random.default_rng(14)
    for percent in (60, 80, 90):
        for _ in range(300):
            b = int(rng.integers(1, 200))
            a = int(rng.integers(-(-percent * b // 100), b + 1))
            both = least_overlap(a, b, percent)
            if both > a:
                continue
            pool = rng.permutation(a + b - both)
            x, y = np.sort(pool[:a]), np.sort(pool[a - both:])
            first = first_of_order(np.array([a, b]), percent)
            assert set(x[:first[0]]) & set(y[:first[1]]), (percent, a, b)


def test_one_row_of_each_component_stays(frame, odd_rows):
    rows = similar_texts(3) + [(1000 + i if i is not None else i, t) for i, t in odd_rows]
    docs = frame(rows)
    kept = representatives(docs)
    assert kept.dtypes == docs.dtypes
    got = Counter(r.doc_id for r in kept.collect())
    expected = linked(rows, 5, 80)
    worded = {component: least for _, n, least, component in expected if n}
    empty = Counter(i for i, n, _, _ in expected if not n)
    assert got == Counter(worded.values()) + empty


def test_no_link_misses_its_keys():
    """Linked sets of every pair of sizes share a key, wherever the boundary is."""
    from vigil.llm.shingle_sets import Sets

    rng = np.random.default_rng(8)

    def as_sets(values):
        out = Sets.__new__(Sets)
        out.values = np.concatenate(values)
        out.sizes = np.array([len(v) for v in values])
        out.first = np.concatenate([[0], np.cumsum(out.sizes)])
        return out

    for percent, boundary in ((90, 0), (90, 18), (90, 25), (80, 0), (80, 9), (60, 5)):
        keys = Keys(percent, boundary)
        for _ in range(250):
            b = int(rng.integers(1, 60)) if rng.random() < 0.7 else int(rng.integers(60, 500))
            a = int(rng.integers(-(-percent * b // 100), b + 1))
            both = least_overlap(a, b, percent)
            if both > a or (both == a == b):
                continue
            pool = rng.integers(1, 1 << 63, a + b - both, dtype=np.uint64)
            of, key = keys.of(as_sets([np.sort(pool[:a]), np.sort(pool[a - both:])]))
            assert set(key[of == 0].tolist()) & set(key[of == 1].tolist()), (percent, boundary, a, b)


def test_boundary_follows_cost():
    assert boundary_by_cost({}, 90) == 0
    assert boundary_by_cost({12: 1000}, 90) >= 12
    assert boundary_by_cost({40: 1000}, 90) < 40


def test_components_of_stars_chains_and_cycles(spark):
    chain = [(i, i + 1) for i in range(300, 380)]
    star = [(1000, i) for i in range(1001, 1200)]
    cycle = [(5, 6), (6, 7), (7, 5), (7, 7)]
    edges = spark.createDataFrame(chain + star + cycle + [(50, 40), (40, 50)], "x long, y long")
    labels, _ = components(edges)
    got = {r.node: r.label for r in labels.collect()}
    assert got == {**{i: 300 for i in range(300, 381)}, **{i: 1000 for i in range(1000, 1200)},
                   5: 5, 6: 5, 7: 5, 40: 40, 50: 40}
    assert components(edges.where("false"))[0].count() == 0


def test_empty_tables(frame):
    none = frame([])
    assert remove_passages(none).count() == 0
    assert remove_windows(none).count() == 0
    assert join(none).count() == 0
    assert representatives(none).count() == 0


def test_word_codes_do_not_depend_on_blocks(monkeypatch):
    """Texts of many blocks, and words longer than one: equal words have equal codes anywhere."""
    from vigil.llm import passages

    random.seed(2)
    words = [bytes(random.choices(range(97, 123), k=random.choice([1, 3, 9, 200, 5000]))) for _ in range(60)]
    text = [random.choice(words) for _ in range(4000)]
    spec = passages.Spec("word", 5, 5)
    whole = passages.units(spec, [b" ".join(text)]).codes
    monkeypatch.setattr(passages, "WORD_BLOCK", 1000)
    parts = passages.units(spec, [b" ".join(text[:7]), b"", b" ".join(text[7:])])
    assert whole.tolist() == parts.codes.tolist() and parts.first.tolist() == [0, 7, 7, 4000]
    assert len(set(zip(text, whole.tolist()))) == len(set(text)) == len(set(whole.tolist()))
    assert passages.units(spec, [b""]).codes.tolist() == []
