import random

import pytest

from vigil.llm.workers import ship

#: Columns that operators use inside; callers may have them too.
CLASHING = ("id", "print", "row", "set", "bucket", "label", "n", "spans", "word", "key", "rank")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """(doc_id, text) rows as a frame with columns of clashing names."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.selectExpr("doc_id", "text", *(f"'x' AS `{c}`" for c in CLASHING)).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, other scripts, long texts."""
    random.seed(4)
    words = [f"w{i}" for i in range(90)] + ["don't", "naïve", "ÉTÉ", "日本語", "x<y", "42nd", "…"]
    rows = [(i, " ".join(random.choice(words) for _ in range(random.randint(1, 90)))) for i in range(40)]
    rows += [(40, None), (41, ""), (42, " \n\t "), (43, "one"), (None, rows[3][1]), (None, None),
             (5, rows[5][1]), (5, rows[6][1]), (44, rows[7][1].upper()), (45, "a" * 5000),
             (46, "a b " * 2500), (47, "line\n" * 900), (48, "<|endoftext|> and <|startoftext|>x"),
             (49, "tab\there \r\n x  \x0b y  z"), (50, "é" * 3000), (51, "\x00 \x1c zero")]
    return rows
