"""op4 against the definitions, and its forest on labelled rows."""

import re
from collections import Counter

import numpy as np
import pytest

from vigil.llm import op4_quality as quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(30)] + [(31, None, None), (None, 1, 0)],
                                 "doc_id long, quality int, toxic int")


def test_base_counts(frame, odd_rows, labels):
    rows = odd_rows + [(60, "p q r s t u v w x " * 9 + "\nend\nend\n$%"), (61, "a b c d e f g h i " * 2)]
    found = quality.decisions(frame(rows), labels).collect()
    got = [(r.doc_id, *(r[c] for c in quality.BASE), r.base_failed) for r in found]
    assert sorted(got, key=repr) == sorted(((i, *base(t)) for i, t in rows), key=repr)
    assert not any(r.kept and r.base_failed for r in found)


def test_rows_that_are_kept_keep_their_columns(frame, odd_rows, labels):
    docs = frame(odd_rows)
    kept = quality.keep(docs, labels)
    assert kept.dtypes == docs.dtypes
    wanted = Counter((r.doc_id, r.kept) for r in quality.decisions(docs, labels).collect())
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        {i: n for (i, keep), n in wanted.items() if keep})


def test_without_labels_or_documents(spark, frame, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept != r.base_failed for r in quality.decisions(frame(odd_rows), none).collect())
    assert quality.decisions(frame([]), none).count() == 0


def test_forest_tells_strange_documents(spark, frame):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(500):
        own = rng.choice(words, 80).tolist()
        if i % 5 == 0:
            own = [w + "$$%%" for w in own]
        rows.append((i, " ".join(own) + "."))
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(0, 250)], "doc_id long, quality int")
    found = quality.decisions(frame(rows), labels).collect()
    unseen = [(r.doc_id % 5 > 0, r.kept) for r in found if r.doc_id >= 250]
    assert sum(good == kept for good, kept in unseen) / len(unseen) > 0.95


def test_threshold_keeps_good_documents():
    buckets = {10: (1000, 0), 15: (3, 90), 19: (60, 10)}
    assert quality.threshold(buckets, 0.99) > 19 / quality.BUCKETS
    assert quality.threshold({10: (1000, 0), 15: (3, 90)}, 0.99) == 15 / quality.BUCKETS


def test_keep_is_what_decisions_keep(spark, frame, odd_rows):
    """Whole rows, repeated ones too, with and without labels."""
    from collections import Counter

    from vigil.llm.op4_quality import decisions, keep

    rows = odd_rows + [(100 + k, " ".join(f"word{(k * 7 + j) % 83}" for j in range(60 + k))) for k in range(60)]
    docs = frame(rows)
    marks = spark.createDataFrame([(100 + k, int(k % 9 > 0)) for k in range(60)], "doc_id long, quality int")
    for labels in (marks, marks.limit(0)):
        kept = keep(docs, labels)
        assert kept.columns == docs.columns
        expected = Counter(r["doc_id"] for r in decisions(docs, labels).where("kept").collect())
        assert Counter(r["doc_id"] for r in kept.collect()) == expected and len(expected) > 40
    assert keep(frame([]), marks).count() == 0
