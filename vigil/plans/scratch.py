"""Where intermediate tables go, and how lineage is cut."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[str, str]] = []  # application and path of copies that still stand


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local-mode session without that setting gets a folder of its own;
    on a cluster a machine-local folder would be invisible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vigil-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df once to the shared scratch folder; return the copy and its path.

    Unlike an RDD checkpoint the copy is Parquet, so later passes still prune
    columns and push filters; a lost executor re-reads it from shared storage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _written.append((spark.sparkContext.applicationId, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table once nothing reads it any more."""
    entry = (spark.sparkContext.applicationId, path)
    if entry in _written:
        _written.remove(entry)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


class Appended:
    """A scratch table that grows frame by frame; columns may differ."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, scratch_path(spark, name)
        _written.append((spark.sparkContext.applicationId, self.path))

    def add(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(self.path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove every copy that is made inside, when the work inside is done.

    For jobs that write their results. Copies behind a frame that is returned to
    the caller are read later; clear() removes them.
    """
    before = len(_written)
    try:
        yield
    finally:
        for _, path in _written[before:]:
            remove(spark, path)


def clear(spark: SparkSession) -> None:
    """Remove all copies this application made and did not remove."""
    for application, path in list(_written):
        if application == spark.sparkContext.applicationId:
            remove(spark, path)
