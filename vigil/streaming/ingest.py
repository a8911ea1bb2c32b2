"""Incremental reading of new files, and validation of them as they arrive."""

import threading
from collections import Counter
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from vigil.plans import jobs, scratch

#: How long the count of rows waits for the listener's events once a query has ended.
EVENT_SECONDS = 60


def new_files(spark: SparkSession, source: str, schema: T.StructType,
              file_format: str = "parquet", **options) -> DataFrame:
    """A stream of the rows of files that were not read before."""
    return spark.readStream.schema(schema).format(file_format).options(**options).load(source)


def incremental_ingest(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                       checkpoint: str, file_format: str = "parquet", **options) -> int:
    """Append the rows of all new files to the sink once; return how many there were.

    The checkpoint remembers the files, so a second run reads none of them.
    """
    with counted_rows(spark) as rows:
        query = (
            new_files(spark, source, schema, file_format, **options).writeStream
            .format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return rows(query)


@contextmanager
def counted_rows(spark: SparkSession):
    """Count the input rows of queries started inside, over all their batches.

    (A query itself remembers its last hundred batches only.) Raises if the events
    do not come in time, as the count would be too small.
    """
    rows, ended = Counter(), {}

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            ended.setdefault(str(event.id), threading.Event())

        def onQueryProgress(self, event):
            rows[str(event.progress.id)] += event.progress.numInputRows

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            ended.setdefault(str(event.id), threading.Event()).set()

    listener = Listener()
    spark.streams.addListener(listener)

    def total(query) -> int:
        return rows[str(query.id)]

    try:
        yield total
        # Events arrive in order, a moment after the query itself has ended.
        if not all([event.wait(EVENT_SECONDS) for event in list(ended.values())]):
            raise TimeoutError(f"no end event of a query in {EVENT_SECONDS} s: its rows are written, "
                               "but their count is not known")
    finally:
        spark.streams.removeListener(listener)


FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def validate_and_route(spark: SparkSession, source: str, target: str, checkpoint: str,
                       rules: dict[str, list[dict]], run_time: datetime, **options):
    """Validate every new file once, by the same readers, rules and log as the batch job.

    The stream carries names and sizes of files only; a batch is read by
    column names, judged and routed like the files of jobs.validation_job, and
    its outputs bear its number, so a repeated batch replaces them. (Spark's file
    stream does not report empty files and names that begin with _ or a dot.)
    """
    new = spark.readStream.schema(FILE_SCHEMA).format("binaryFile") \
        .options(recursiveFileLookup="true", **options).load(source) \
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("event_time"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with scratch.scope(session):
            manifest, _ = scratch.materialize(batch, "arrived")
            jobs.validate_manifest(session, manifest, source, target, run_time, rules, f"b{batch_id}")

    query = (
        new.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
