"""Queries of this subpackage and, where SQL can express them, their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.llm.workers import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a (spark, sf_dir) -> DataFrame function under name."""

    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
