"""Scores of whole texts by a subword lattice model, beside add-one word scores.

Words of all documents are counted once, by hash partition. The model is a
unigram distribution over the pieces of a public vocabulary: its scores, which
rank the pieces, give the first weights 1 / (1 - score); re-estimation on the
counted training words (expected uses over all segmentations) gives the rest.
The probability of a word sums over all its segmentations, that of a text is the
product over its words and one end.

Only words counted often enough are sent to every task, at most HEAVY_WORDS of
them; the others meet their counts in a join.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vigil.llm.lattice import Pieces, expected, marginals
from vigil.llm.registry import register, table
from vigil.llm.workers import map_batches, record_batch, texts
from vigil.plans.scratch import materialize

HELD_OUT, FOLDS = 2, 7
HEAVY_WORDS = 150_000
#: Different words a task counts before it hands on what it has.
TASK_WORDS = 250_000
ROUNDS, SMOOTH = 2, 0.1


def words_of(data: bytes) -> list[bytes]:
    """Runs of characters other than ASCII white space, A-Z in lower case."""
    return data.lower().split()


def vocabulary_pieces(path: str) -> tuple[Pieces, np.ndarray]:
    """Pieces and first log weights from a sentencepiece model; the last weight is the end's."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text = model.id_to_piece(i)
            word = text.replace("▁", " ")
            if word and " " not in word[1:]:  # a piece across words never matches
                scores[word.encode()] = model.get_score(i)
    first = np.array([1.0 / (1.0 + max(0.0, -s)) for s in scores.values()] + [1e-6] * 257)
    return Pieces(list(scores)), np.log(first / first.sum())


def count_words(rows: DataFrame) -> DataFrame:
    """(word, c): uses in training documents; words of held-out ones alone have 0."""
    schema = StructType.fromDDL("word binary, c bigint")
    arrow = to_arrow_schema(schema)

    def count(batches):
        counts: dict[bytes, int] = {}

        def out():
            return record_batch({"word": list(counts), "c": list(counts.values())}, arrow)

        for batch in batches:
            for data, held in zip(texts(batch, "text"), batch.column("held_out").to_pylist()):
                step = 0 if held else 1
                for w in words_of(data):
                    counts[w] = counts.get(w, 0) + step
                if len(counts) > TASK_WORDS:
                    yield out()
                    counts.clear()
        yield out()

    return (rows.select("text", "held_out").mapInArrow(count, schema)
            .groupBy("word").agg(F.sum("c").alias("c")))


def train(words: DataFrame, pieces, first: np.ndarray, ends: int, rounds: int = ROUNDS) -> np.ndarray:
    """Log probability of each piece, last the end's; pieces: a broadcast Pieces.

    Each task sums expected uses over its words; what reaches the driver is one
    number per piece, whatever the size of the corpus.
    """
    schema = StructType.fromDDL("piece int, uses double")
    arrow = to_arrow_schema(schema)
    log_p = first
    for _ in range(rounds):
        now = words.sparkSession.sparkContext.broadcast(log_p)

        def uses(batches, now=now):
            total = 0.0
            for batch in batches:
                total = total + expected(pieces.value, batch.column("word").to_pylist(),
                                         batch.column("c").to_numpy().astype(float), now.value)
            if not np.isscalar(total):
                used = np.flatnonzero(total)
                yield record_batch({"piece": used, "uses": total[used]}, arrow)

        found = (words.where("c > 0").mapInArrow(uses, schema)
                 .groupBy("piece").agg(F.sum("uses").alias("uses")).collect())
        counts = np.full(len(first), SMOOTH)
        for row in found:
            counts[row["piece"]] += row["uses"]
        counts[-1] += ends
        log_p = np.log(counts / counts.sum())
        now.unpersist()
    return log_p


def score(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
          heavy_words: int = HEAVY_WORDS) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Held out are the rows whose crc32 of the id, as text, is 2 modulo 7; a null
    id is not. Null and empty texts have one token, the end. If no row is left
    for training, counts are zero and the first weights score. Rows and ids may
    repeat; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held.alias("held_out"))
    table_, first = vocabulary_pieces(vocabulary)
    pieces = spark.sparkContext.broadcast(table_)

    words, _ = materialize(count_words(rows), "words")
    levels = [F.sum((F.col("c") >= 2 ** k).cast("long")).alias(f"n{k}") for k in range(62)]
    sums = words.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v"), *levels).first()
    ends = rows.where(~F.col("held_out")).count()
    n_train, distinct = (sums["n"] or 0) + ends, (sums["v"] or 0) + (ends > 0)
    least = next((2 ** k for k in range(62) if (sums[f"n{k}"] or 0) <= heavy_words), 2 ** 62)

    log_p = train(words, pieces, first, ends) if ends else first
    shipped = spark.sparkContext.broadcast(log_p)

    def judge():
        def work(batch: pa.RecordBatch) -> dict:
            own = batch.column("word").to_pylist()
            return {"word": batch.column("word"), "c": batch.column("c"),
                    "lp": marginals(pieces.value, own, shipped.value) / np.log(10)}

        return work

    base = F.log10((F.col("c") + 1) / F.lit(float(n_train + distinct + 1)))
    judged, _ = materialize(map_batches(words, judge, "word binary, c bigint, lp double")
                            .withColumn("base", base), "judged")
    heavy = spark.sparkContext.broadcast(_columns(judged.where(F.col("c") >= least)))
    end = (float(np.log10((ends + 1) / (n_train + distinct + 1))), float(log_p[-1] / np.log(10)), int(ends > 0))
    parts, _ = materialize(_by_heavy(rows, heavy, end), "parts")
    return _with_rare(parts, judged.where(F.col("c") < least), n_train).withColumnRenamed("id", id_col)


def _columns(heavy: DataFrame) -> tuple:
    """At most heavy_words rows."""
    found = heavy.select("word", "base", "lp").toArrow()
    return ({w: i for i, w in enumerate(found.column("word").to_pylist())},
            found.column("base").to_numpy(), found.column("lp").to_numpy())


def _by_heavy(rows: DataFrame, heavy, end: tuple) -> DataFrame:
    """Per document what its heavy words and its end give, and its other words."""
    kind = rows.schema["id"].dataType.simpleString()
    counter = {"n": 0}

    def task():
        where, base, lp = heavy.value
        first = TaskContext.get().partitionId() << 40
        counter["n"] = 0

        def work(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("row", "n_tokens", "n_known", "base_score", "score", "rare", "times")}
            for data in texts(batch, "text"):
                own = words_of(data)
                found = list(map(where.get, own))
                rare: dict[bytes, int] = {}
                if None in found:
                    for w, i in zip(own, found):
                        if i is None:
                            rare[w] = rare.get(w, 0) + 1
                    found = [i for i in found if i is not None]
                at = np.array(found, np.int64)
                out["row"].append(first + counter["n"])
                counter["n"] += 1
                out["n_tokens"].append(len(own) + 1)
                out["n_known"].append(len(found) + end[2])
                out["base_score"].append(float(base[at].sum()) + end[0])
                out["score"].append(float(lp[at].sum()) + end[1])
                out["rare"].append(list(rare))
                out["times"].append(list(rare.values()))
            return out | {"id": batch.column("id"), "held_out": batch.column("held_out")}

        return work

    return map_batches(
        rows, task, f"row bigint, id {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
        "base_score double, score double, rare array<binary>, times array<bigint>")


def _with_rare(parts: DataFrame, rare: DataFrame, n_train: int) -> DataFrame:
    """Add what the other words give, which meet their counts in a join."""
    used = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("u")).select(
        "row", F.col("u.rare").alias("word"), F.col("u.times").alias("times"))
    added = (
        used.join(rare, "word").groupBy("row").agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.col("base")).alias("more_base"),
            F.sum(F.col("times") * F.col("lp")).alias("more_score")))
    none = F.lit(0)
    return parts.drop("rare", "times").join(added, "row", "left").select(
        "id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", none)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", none)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", none)).alias("score"))


@register("op6_lattice_lm")
def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
