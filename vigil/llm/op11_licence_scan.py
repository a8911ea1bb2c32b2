"""Licence scan: identifier tags, notice phrases and licence expressions.

One automaton looks for tags in the text in lower case, one for phrases in its
words, each joined by one space, so that a phrase is found where its words stand
one after another. Behind a tag a licence expression is read to its longest whole
beginning and evaluated. Every text is scanned once, where it is; no rows move.
"""

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.licences import BASE, BASE_WEIGHT, EXPRESSION_WEIGHT, NOTICES, TAGS, expression
from vigil.llm.registry import register, table
from vigil.llm.workers import map_batches, texts

SCHEMA = ("id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
          "labels string, score double, n_expressions bigint, duty int")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Word characters are ASCII letters and digits and all bytes of other characters.
WORDS = bytes(LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _automaton(patterns: dict) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        found.add_word(pattern, value)
    found.make_automaton()
    return found


class Scanner:
    def __init__(self):
        phrases = {f" {p} ": (p, label, BASE_WEIGHT, True) for p, label in BASE.items()}
        phrases |= {f" {p} ": (p, label, weight, False) for p, (label, weight) in NOTICES.items()}
        self.phrases, self.tags = _automaton(phrases), _automaton({t: t for t in TAGS})

    def scan(self, data: bytes) -> tuple:
        words = data.translate(WORDS).split()
        # Each byte is one character here: only ASCII is looked for.
        joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
        starts, base, labels, weights = [], set(), set(), {}
        for end, (phrase, label, weight, is_base) in self.phrases.iter(joined):
            labels.add(label)
            weights[phrase] = weight
            if is_base:
                starts.append(end - len(phrase) - 1)
                base.add(label)
        first = last = None
        if starts:
            spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
            first, last = np.searchsorted(spaces, [min(starts), max(starts)]).tolist()
        terms = self.expressions(data)
        for t in terms:
            labels |= t.labels
            weights[t] = EXPRESSION_WEIGHT
        doubt = 1.0
        for weight in sorted(weights.values()):
            doubt *= 1 - weight
        return (len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)),
                1 - doubt, len(terms), max((t.duty for t in terms), default=None))

    def expressions(self, data: bytes) -> list:
        """Terms behind each tag, to the end of its line."""
        text, found = data.translate(LOWER).decode("latin-1"), []
        for end, tag in self.tags.iter(text):
            before = text[end - len(tag):end - len(tag) + 1] if end >= len(tag) else ""
            if before.isalnum() or before == "-":
                continue  # the end of a longer word
            stop = text.find("\n", end)
            terms = expression(text, end + 1, stop if stop >= 0 else len(text))
            if terms:
                found.append(terms)
        return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs.

    n_words; n_base, first_word and last_word: places of the base phrases, the smallest
    and the largest start; base_labels; labels: also those of other notices and of
    licence expressions, all distinct, sorted and joined by commas; score: 1 less the
    product of the doubts (1 - weight) of the distinct notices and expression terms;
    n_expressions; duty: the largest that an expression evaluates to, else null (see
    licences.py). A null text is empty: no words, no labels, score 0. Null ids and
    repeated rows are kept; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = SCHEMA.format(kind=rows.schema["id"].dataType.simpleString())
    names = [field.strip().split(" ")[0] for field in schema.split(",")]

    def task():
        scanner = Scanner()

        def work(batch: pa.RecordBatch) -> dict:
            found = [scanner.scan(data) for data in texts(batch, "text")]
            columns = zip(*found) if found else [[]] * (len(names) - 1)
            return {"id": batch.column("id")} | dict(zip(names[1:], map(list, columns)))

        return work

    return map_batches(rows, task, schema).withColumnRenamed("id", id_col)


@register("op11_licence_scan")
def op11_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
