"""Writers for processed data, aggregates, reports and logs.

No writer fixes the number of files of raw-size data: Spark sizes the tasks and
`records_per_file` bounds the files.
"""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vigil.plans import skew
from vigil.schemas import quoted
from vigil.sources import handles

RECORDS_PER_FILE = 20_000_000


def _overwrite(df: DataFrame, *partitions: str):
    """Replace only the partitions the frame holds, so that a re-run is idempotent."""
    return (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").option("maxRecordsPerFile", RECORDS_PER_FILE)
        .partitionBy(*partitions)
    )


def write_processed(df: DataFrame, root: str, dataset_type: str, run_day: date) -> str:
    """processed/<type>/year=/month=, by etl_date."""
    path = f"{root}/processed/{dataset_type}/year={run_day.year}/month={run_day:%m}"
    _overwrite(df, "etl_date").parquet(path)
    return path


def write_aggregate(df: DataFrame, root: str, name: str, single_file: bool = False) -> str:
    """One folder per aggregate; single_file only for results of bounded size."""
    path = f"{root}/aggregations/{name}"
    (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(path)
    return path


def write_clustered(df: DataFrame, root: str, name: str, by: list[str], sort: str) -> str:
    """One folder per period with sorted rows inside; for aggregates, whose periods are small."""
    path = f"{root}/aggregations/{name}"
    clustered = df.repartition(*[quoted(c) for c in by]).sortWithinPartitions(sort)
    _overwrite(clustered, *by).parquet(path)
    return path


def write_table(df: DataFrame, table: str, path: str | None = None, append: bool = False,
                day: str | None = None) -> None:
    """Create, replace or extend a catalog table.

    With `day`, a date column, the table is partitioned by it and extending
    replaces the days the frame holds, so that a repeated run adds nothing.
    """
    spark = df.sparkSession
    if append and spark.catalog.tableExists(table):
        rows = df.select(*spark.table(table).columns)
        if day is None:
            rows.write.insertInto(table)
        else:
            # insertInto takes the mode from the session only.
            mode = "spark.sql.sources.partitionOverwriteMode"
            before = spark.conf.get(mode)
            spark.conf.set(mode, "dynamic")
            try:
                rows.write.insertInto(table, overwrite=True)
            finally:
                spark.conf.set(mode, before)
        return
    writer = df.write.format("parquet").mode("overwrite")
    writer = writer.partitionBy(day) if day else writer
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_line_files(df: DataFrame, root: str, by: str, line: str, order: str) -> None:
    """One text file per value of `by`, under root/by=value, its lines in order.

    For many small files: tasks write them where they belong, where they can open the
    storage; Spark's writer makes each in a folder of its own that the driver moves.
    """
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    sorted_ = df.repartition(quoted(by)).sortWithinPartitions(quoted(by), quoted(order))
    place = system.makeQualified(path).toString()
    if place.split(":", 1)[0] not in handles.SCHEMES:
        sorted_.select(line, by).write.partitionBy(by).text(root)
        return
    system.mkdirs(path)
    schema = T.StructType.fromDDL(handles.WRITTEN)
    folder = F.concat(F.lit(f"{by}="), F.coalesce(quoted(by), F.lit("__HIVE_DEFAULT_PARTITION__")))
    sorted_.select(folder.alias("folder"), quoted(line).alias("line")) \
        .mapInArrow(handles.line_filer(place, to_arrow_schema(schema)), schema) \
        .agg(F.sum("size")).collect()


def write_metrics(metrics: DataFrame, root: str, dataset_type: str, run_time: datetime) -> str:
    """Metrics of a run as JSON lines under the run's own folder."""
    path = f"{root}/metrics/{dataset_type}/{run_time:%Y%m%d_%H%M%S}"
    metrics.write.mode("overwrite").json(path)
    return path


def write_error(spark: SparkSession, root: str, dataset_type: str, run_time: datetime,
                error: str, trace: str) -> str:
    """The error record of a failed run."""
    path = f"{root}/errors/{dataset_type}/{run_time:%Y%m%d_%H%M%S}_error"
    spark.createDataFrame(
        [(error, trace, run_time)], "error string, traceback string, timestamp timestamp"
    ).write.mode("overwrite").json(path)
    return path


def write_quality_report(results: DataFrame, root: str, table: str, day: date) -> str:
    """Check results by day and table."""
    path = f"{root}/reports"
    results.withColumns({"report_day": F.lit(day), "table_name": F.lit(table)}) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("report_day", "table_name").json(path)
    return path


def validated_rows(df: DataFrame, validated_at: datetime,
                   file_column: str = "original_file") -> DataFrame:
    """Add when the rows were validated and, unless known, how many their file holds."""
    if "record_count" not in df.columns:
        df = skew.with_group_value(df, [file_column], "record_count", F.count(F.lit(1)))
    return df.withColumn("validation_timestamp", F.lit(validated_at).cast("timestamp"))


def run_name(run_time: datetime, batch: str = "") -> str:
    return f"{run_time:%Y%m%d_%H%M%S}" + (f"-{batch}" if batch else "")


def write_validated(df: DataFrame, root: str, dataset_type: str, validated_at: datetime,
                    batch: str = "", file_column: str = "original_file") -> str:
    """Passed rows under validated/<type>, by run; a repeated run replaces its rows."""
    path = f"{root}/validated/{dataset_type.lower()}"
    rows = validated_rows(df, validated_at, file_column) \
        .withColumn("run", F.lit(run_name(validated_at, batch)))
    _overwrite(rows, "run").parquet(path)
    return path


def write_held(df: DataFrame, root: str, dataset_type: str, run_time: datetime,
               batch: str = "") -> str:
    """Rows that did not pass, by dataset type, route (a column) and run."""
    path = f"{root}/held"
    rows = df.withColumns({
        "dataset_type": F.lit(dataset_type), "run": F.lit(run_name(run_time, batch))})
    _overwrite(rows, "dataset_type", "route", "run").parquet(path)
    return path


def write_quarantine(rejected: DataFrame, root: str, run_time: datetime, batch: str = "") -> str:
    """Rejected files by the day they were set aside, and run."""
    path = f"{root}/quarantine"
    _overwrite(rejected.withColumn("run", F.lit(run_name(run_time, batch))),
               "quarantine_date", "run").parquet(path)
    return path


def write_validation_log(entries: DataFrame, root: str, run_time: datetime,
                         batch: str = "") -> DataFrame:
    """One JSON line per validated file, by day and run; returns the run's entries."""
    path, run = f"{root}/logs", run_name(run_time, batch)
    entries.withColumns({"log_date": F.lit(run_time.date()), "run": F.lit(run)}) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("log_date", "run").json(path)
    return entries.sparkSession.read.schema(_log_schema(entries)).json(path) \
        .where((F.col("log_date") == F.lit(run_time.date())) & (F.col("run") == run))


def _log_schema(entries: DataFrame) -> T.StructType:
    """The schema of log entries together with their partition columns."""
    return T.StructType([*entries.schema.fields, T.StructField("log_date", T.DateType()),
                         T.StructField("run", T.StringType())])
