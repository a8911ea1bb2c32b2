"""From raw documents to packed training sequences, in four stages.

Each stage takes what its predecessor kept as a table with the columns of
documents; the last returns the pieces of the packed sequences.
"""

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import op4_quality, op7_packing, op8_jaccard_join, op10_suffix_dedup
from vigil.llm.registry import register, table
from vigil.llm.workers import ship
from vigil.plans.scratch import materialize

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80

#: Not expressible in SQL: the forest, byte passages and the packing are no queries.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the forest calibrated on the labels."""
    ship(spark)
    return op4_quality.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of smallest id."""
    ship(spark)
    return op8_jaccard_join.representatives(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a document of smaller id has too."""
    ship(spark)
    return op10_suffix_dedup.shorten(docs, chars_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    ship(spark)
    return op7_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]


@register("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
