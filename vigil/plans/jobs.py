"""The batch jobs: ETL, quality report, aggregations and file validation."""

import traceback
from datetime import date, datetime
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from vigil.operators import admission, aggregates as A, cleaning as P, governance
from vigil.operators import quality as Q, windows as W
from vigil.plans import quantiles, scratch, validation
from vigil.schemas import numeric_columns
from vigil.sources import files, sinks


def typed(raw: DataFrame, dataset_type: str) -> DataFrame:
    """Names and types."""
    return P.apply_data_types(P.clean_column_names(raw), dataset_type)


def clean(typed: DataFrame, order_by: str | None = None, partition_by: list[str] | None = None,
          tie_break: list[str] | None = None, look: quantiles.Look | None = None) -> DataFrame:
    """Missing values and repeated rows."""
    return P.remove_duplicates(P.handle_missing_values(typed, order_by, partition_by, tie_break, look))


def _capped(df: DataFrame, identifiers: list[str]) -> list[str]:
    """Numbers that identify are not capped."""
    return [c for c in numeric_columns(df) if c not in identifiers]


def transform(cleaned: DataFrame, dataset_type: str, tie_break: list[str],
              identifiers: list[str], look: quantiles.Look | None = None) -> DataFrame:
    """Outliers and business rules."""
    capped = P.cap_outliers_iqr(cleaned, _capped(cleaned, identifiers), look=look)
    return P.apply_business_rules(capped, dataset_type, tie_break)


def _counted(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("record_count")), seen


def _stage(spark: SparkSession, stage: str, df: DataFrame, seen: Observation) -> DataFrame:
    return spark.createDataFrame(
        [(stage, seen.get["record_count"], len(df.columns), df.schema.simpleString())],
        "stage string, record_count long, column_count int, schema string")


def etl_job(raw: DataFrame, dataset_type: str, target: str, run_time: datetime, job_name: str,
            source_system: str, tie_break: list[str], identifiers: list[str] | None = None,
            order_by: str | None = None, partition_by: list[str] | None = None,
            table: str | None = None) -> dict[str, str]:
    """Clean, transform, profile, check, aggregate and write one dataset.

    tie_break orders the reports of a day; identifiers, by default the same
    columns, are numbers that are not measurements.

    The typed rows, and then the cleaned ones, are written once to shared scratch
    space, because medians, outlier fences and business rules read them several
    times, and the source may be costly to read; profile, checks and aggregates
    read the processed table itself. Row counts of the stages and the first look
    of the quantiles are observed during those writes. Failed checks do not stop the job.
    """
    with scratch.scope(raw.sparkSession):
        return _etl(raw, dataset_type, target, run_time, job_name, source_system, tie_break,
                    identifiers, order_by, partition_by, table)


def _etl(raw, dataset_type, target, run_time, job_name, source_system, tie_break, identifiers,
         order_by, partition_by, table) -> dict[str, str]:
    spark = raw.sparkSession
    try:
        identifiers = tie_break if identifiers is None else identifiers
        as_typed = typed(raw, dataset_type)
        look = quantiles.Look(as_typed, numeric_columns(as_typed))
        observed, seen = _counted(look.df, "typed")
        as_typed, copy = scratch.materialize(observed, "typed")
        stages = [_stage(spark, "RAW_DATA", raw, seen)]
        whole = clean(as_typed, order_by, partition_by, tie_break, look)
        look = quantiles.Look(whole, _capped(whole, identifiers))
        observed, seen = _counted(look.df, "cleaned")
        cleaned, _ = scratch.materialize(observed, "cleaned")
        scratch.remove(spark, copy)
        stages.append(_stage(spark, "CLEANED_DATA", cleaned, seen))
        shaped = P.add_metadata(transform(cleaned, dataset_type, tie_break, identifiers, look),
                                job_name, source_system, run_time)
        observed, seen = _counted(shaped, "transformed")
        paths = {"processed": sinks.write_processed(
            observed, target, dataset_type, run_time.date())}
        stages.append(_stage(spark, "TRANSFORMED_DATA", shaped, seen))
        processed = spark.read.parquet(paths["processed"]) \
            .where(F.col("etl_date") == F.lit(run_time.date()))
        measures = [c for c in processed.columns
                    if c not in ("etl_timestamp", "etl_date", "etl_job_name", "source_system",
                                 "data_version")]
        for name, report in A.etl_aggregates(processed, dataset_type).items():
            paths[name] = sinks.write_aggregate(report, target, f"{dataset_type}/{name}")
        if table:
            sinks.write_table(processed, table, append=True, day="etl_date")
        run = f"{target}/run"
        metrics = {
            "stages": stages[0].unionByName(stages[1]).unionByName(stages[2]),
            "profile": Q.profile(processed.select(*measures)),
            "quality": Q.etl_quality_checks(processed.select(*measures)),
        }
        for name, frame in metrics.items():
            paths[name] = sinks.write_metrics(frame, f"{run}/{name}", dataset_type, run_time)
        return paths
    except Exception as e:
        sinks.write_error(spark, target, dataset_type, run_time, str(e), traceback.format_exc())
        raise


def quality_report_job(df: DataFrame, table: str, target: str, day: date) -> str:
    """All quality checks of a table, written as a report."""
    return sinks.write_quality_report(Q.quality_job(df), target, table, day)


def aggregation_job(df: DataFrame, target: str) -> dict[str, str]:
    """Daily, weekly, monthly and ranking reports; the source is read once.

    All four follow from the totals per day, region and disease.
    """
    days, copy = scratch.materialize(A.day_totals(df), "days")
    try:
        reports = {
            "daily": A.daily_of(days),
            "weekly": W.weekly_change_pct(A.weekly_of(days)),
            "monthly": A.monthly_of(days),
            "rankings": W.rank_regions_per_day(A.region_days_of(days)),
        }
        return {name: sinks.write_aggregate(r, target, name) for name, r in reports.items()}
    finally:
        scratch.remove(df.sparkSession, copy)


def region_aggregation_job(df: DataFrame, target: str) -> dict[str, str]:
    """Weekly, monthly and overall figures per region; the source is read once."""
    days, copy = scratch.materialize(A.day_totals(df), "days")
    try:
        weeks = W.week_over_week(A.region_weeks_of(days))
        months = W.year_over_year(W.month_over_month(A.region_months_of(days)))
        return {
            "weekly": sinks.write_clustered(weeks, target, "weekly", ["year", "week"], "region"),
            "monthly": sinks.write_clustered(
                months, target, "monthly", ["year", "month"], "region"),
            "rankings": sinks.write_aggregate(
                W.rank_regions(A.region_stats_of(days)), target, "rankings", single_file=True),
        }
    finally:
        scratch.remove(df.sparkSession, copy)


# All formats bring text, so that rows of one dataset share a schema; admitted
# files are small enough to be read by one task each.
READERS = {
    ".csv": partial(files.scan_csv, multi_line=True),
    ".json": partial(files.scan_json, as_text=True),
    ".xml": files.scan_xml,
}
BROKEN = {".json": files.broken_json, ".xml": files.broken_xml}

LOG_COLUMNS = ["original_file", "dataset_type", "source_organization", "size", "status", "message",
               "errors", "warnings", "details", "record_count", "pii_findings", "completeness",
               "route"]
#: Columns the outputs add; uploaded columns of these names are kept as source_<name>.
RESERVED = ["route", "record_count", "run", "dataset_type", "validation_timestamp"]


def route_rows(rows: DataFrame, outcomes: DataFrame, target: str, dataset_type: str,
               run_time: datetime, batch: str) -> None:
    """Write each file's rows to the place its outcome names."""
    rows = rows.drop("file_columns").withColumnsRenamed({c: f"source_{c}" for c in RESERVED})
    routed = rows.join(outcomes.select("original_file", "route", "record_count"), "original_file")
    passed = routed.where(F.col("route") == "validated").drop("route")
    sinks.write_validated(passed, target, dataset_type, run_time, batch)
    held = routed.where(F.col("route") != "validated").drop("record_count")
    sinks.write_held(held, target, dataset_type, run_time, batch)


def _unread(entries: DataFrame, status: str, message: Column,
            route: str = "quarantine") -> DataFrame:
    """Log entries of files without rows."""
    texts = "array<string>"
    return entries.select(
        F.col("path").alias("original_file"), "dataset_type", "source_organization",
        F.col("size").cast("bigint").alias("size"), F.lit(status).alias("status"),
        message.alias("message"),
        (F.array(message) if status in ("ERROR", "FAILED") else F.array()).cast(texts).alias("errors"),
        (F.array(message) if status == "WARNING" else F.array()).cast(texts).alias("warnings"),
        F.lit(None).cast("map<string,double>").alias("details"),
        F.lit(0).cast("bigint").alias("record_count"),
        F.lit(0).cast("bigint").alias("pii_findings"),
        F.lit(None).cast("double").alias("completeness"), F.lit(route).alias("route"))


def validation_job(spark: SparkSession, source: str, target: str, run_time: datetime,
                   rules: dict[str, list[dict]]) -> DataFrame:
    """Admit, read, validate and route all files under source; return the log.

    `rules` maps a dataset type to its rules. The log has one row per file, with
    errors, warnings and measured details. A file that cannot be read or judged
    is logged as ERROR, the others go on.
    """
    with scratch.scope(spark):
        return validate_manifest(spark, files.file_manifest(spark, source), source, target,
                                 run_time, rules)


def validate_manifest(spark: SparkSession, manifest: DataFrame, source: str, target: str,
                      run_time: datetime, rules: dict[str, list[dict]], batch: str = "") -> DataFrame:
    """validation_job for the files of a manifest (path, size, event_time).

    Files are handled in pages of one format and dataset type, never one by one;
    the driver holds the paths of a page. `batch` names the outputs of one of
    several calls with the same run time.
    """
    tagged = admission.with_dataset_type(manifest)
    admitted, _ = scratch.materialize(
        admission.admit_files(admission.default_tags(tagged)), "admitted")
    hidden = files.hidden_name(F.col("path"))
    readable = F.col("valid") & F.col("extension").isin(*READERS) & ~hidden
    reason = F.coalesce("reason", F.when(hidden, "No reader for names that begin with _ or ."),
                        F.concat(F.lit("No reader for "), "extension"))
    rejected = admitted.where(~readable).withColumn("reason", reason)
    sinks.write_quarantine(admission.quarantine(rejected, run_time.date(), source), target,
                           run_time, batch)
    log = scratch.Appended(spark, "log")
    log.add(_unread(rejected, "FAILED", F.col("reason")).select(*LOG_COLUMNS))
    listed = admitted.where(readable).select("extension", "dataset_type", "path") \
        .orderBy("extension", "dataset_type", "path").toLocalIterator()
    pages = files.pages_of(listed, lambda f: (f.extension, f.dataset_type))
    for number, ((extension, dataset_type), page) in enumerate(pages):
        own = f"{batch}-" * bool(batch) + f"{extension[1:]}{number}"
        _validate_page(spark, admitted, extension, dataset_type, [f.path for f in page], target,
                       run_time, rules.get(dataset_type, []), own, log)
    return sinks.write_validation_log(log.read(), target, run_time, batch)


def _validate_page(spark: SparkSession, admitted: DataFrame, extension: str, dataset_type: str,
                   paths: list[str], target: str, run_time: datetime, rules: list[dict],
                   batch: str, log: "scratch.Appended") -> None:
    """Read, judge and route some files; when that fails, each half on its own."""
    wanted = F.broadcast(spark.createDataFrame([(p,) for p in paths], "path string"))  # a page
    entries = admitted.join(wanted, "path", "left_semi")
    with scratch.scope(spark):
        try:
            broken = []
            if extension in BROKEN:
                broken = BROKEN[extension](spark, [files.literal_path(p) for p in paths]).collect()
            if broken:
                why = F.broadcast(spark.createDataFrame(broken, "path string, why string"))
                bad = _unread(entries.join(why, "path"), "ERROR",
                              F.concat(F.lit("Validation failed with error: "), "why"))
                entries = entries.join(why, "path", "left_anti")
                known = {b.path for b in broken}
                paths = [p for p in paths if p not in known]
            if paths:
                # Text is parsed once; the checks and writes below read columns of the copy.
                rows, _ = scratch.materialize(READERS[extension](
                    spark, [files.literal_path(p) for p in paths], source=True), "rows")
                outcomes, _ = scratch.materialize(
                    validation.validate_files(rows, rules, run_time.date()), "outcomes")
                route_rows(rows, outcomes, target, dataset_type, run_time, batch)
                tags = entries.select("path", "dataset_type", "source_organization",
                                      F.col("size").cast("bigint").alias("size"))
                judged = outcomes.join(tags, F.col("path") == F.col("original_file"))
                silent = entries.join(outcomes, F.col("path") == F.col("original_file"), "left_anti")
                log.add(judged.select(*LOG_COLUMNS).unionByName(
                    _unread(silent, "WARNING", F.lit("File has no records"), "review")))
            if broken:
                log.add(bad.select(*LOG_COLUMNS))
            return
        except (PySparkException, Py4JJavaError) as e:
            if len(paths) <= 1:
                failed = F.lit(f"Validation failed with error: {e}")
                log.add(_unread(entries, "ERROR", failed).select(*LOG_COLUMNS))
                return
    for side, half in enumerate((paths[:len(paths) // 2], paths[len(paths) // 2:])):
        _validate_page(spark, admitted, extension, dataset_type, half, target, run_time, rules,
                       f"{batch}.{side}", log)


def validation_rates(log: DataFrame) -> DataFrame:
    """Daily success, personal-data and completeness rates of validation logs."""
    return governance.rate_metrics(log.select(
        F.col("log_date").alias("day"), "status", (F.col("pii_findings") > 0).alias("pii_found"),
        "completeness"))
