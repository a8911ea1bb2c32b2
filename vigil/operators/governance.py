"""Quality dimensions, retention, alarms, run rates and the audit trail."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from vigil import constants as C
from vigil.functions.measures import count_if, outside, share
from vigil.operators.pii import anonymize
from vigil.schemas import quoted


def quality_dimensions(df: DataFrame, key: list[str], ranges: dict[str, dict],
                       time_column: str, as_of: datetime) -> DataFrame:
    """Scorecard of completeness, validity, uniqueness and timeliness.

    One pass groups rows by key, a second merges the groups: completeness is
    the share of filled cells, validity the share of rows inside all ranges,
    uniqueness the share of distinct keys, timeliness the age of the newest row.
    """
    filled = F.lit(0)
    for c in df.columns:
        filled = filled + quoted(c).isNotNull().cast("int")
    invalid = F.lit(False)
    for c, r in ranges.items():
        invalid = invalid | F.coalesce(outside(quoted(c), r.get("min"), r.get("max")), F.lit(False))
    groups = df.groupBy(*[quoted(k) for k in key]).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(filled).alias("__filled"),
        count_if(~invalid).alias("__valid"), F.max(quoted(time_column)).alias("__newest"))
    total = F.sum("__n")
    newest = F.max("__newest").cast("timestamp")
    age_hours = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(newest)) / 3600
    measured = groups.agg(
        share(F.sum("__filled"), total * len(df.columns)).alias("completeness"),
        share(F.sum("__valid"), total).alias("validity"),
        share(F.count(F.lit(1)), total).alias("uniqueness"),
        age_hours.alias("timeliness"))
    limits = {"completeness": C.COMPLETENESS_LIMIT, "validity": C.VALIDITY_LIMIT,
              "uniqueness": C.UNIQUENESS_LIMIT, "timeliness": float(C.TIMELINESS_HOURS)}
    rows = [F.struct(
        F.lit(name).alias("dimension"), F.col(name).cast("double").alias("value"),
        F.lit(limit).alias("threshold"),
        F.coalesce(F.col(name) <= limit if name == "timeliness" else F.col(name) >= limit,
                   F.lit(False)).alias("passed")) for name, limit in limits.items()]
    return measured.select(F.inline(F.array(*rows)))


def with_retention(df: DataFrame, date_column: str, data_type: str, as_of: date) -> DataFrame:
    """Add retention_action: keep, or the policy's action once the period is over."""
    days, action = C.RETENTION[data_type]
    age = F.datediff(F.lit(as_of), quoted(date_column))
    return df.withColumn("retention_action",
                         F.when(age > days, F.lit(action)).otherwise(F.lit("keep")))


def apply_retention(df: DataFrame, date_column: str, data_type: str,
                    as_of: date) -> tuple[DataFrame, DataFrame]:
    """The rows to keep and the rows to archive (none when the policy deletes)."""
    marked = with_retention(df, date_column, data_type, as_of)
    action = C.RETENTION[data_type][1]
    kept = marked.where(F.col("retention_action") == "keep").drop("retention_action")
    old = marked.where(F.col("retention_action") != "keep").drop("retention_action")
    if action == "delete":
        old = old.limit(0)
    elif action == "anonymize_then_archive":
        old = anonymize(old)
    return kept, old


def metric_windows(events: DataFrame, time_column: str, group_by: list[str], value: Column,
                   statistic: str = "sum", period: str = "5 minutes") -> DataFrame:
    """A metric per tumbling window; works on a stream with a watermark, too."""
    aggregate = {"sum": F.sum, "average": F.avg}[statistic]
    return events.groupBy(F.window(time_column, period).alias("w"), *group_by) \
        .agg(aggregate(value).cast("double").alias("metric")) \
        .select(F.col("w.start").alias("window_start"), *group_by, "metric")


def alarms(windows: DataFrame, group_by: list[str], threshold: float, periods: int = 2,
           period_seconds: int = 300) -> DataFrame:
    """Windows that end a run of `periods` windows above the threshold.

    A window above the threshold counts for itself and the periods - 1 windows
    after it; a window that collects the full count is in alarm. Missing windows
    are below the threshold. No ordering of a group is needed.
    """
    above = windows.where(F.col("metric") > threshold)
    later = F.sequence(F.lit(0), F.lit(periods - 1))
    reached = above.select(
        *group_by, "window_start", "metric", F.explode(later).alias("__k")
    ).withColumn("alarm_start", F.col("window_start")
                 + F.make_dt_interval(secs=F.col("__k") * period_seconds))
    return reached.groupBy(*group_by, "alarm_start").agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.when(F.col("__k") == 0, F.col("metric"))).alias("metric")
    ).where(F.col("__n") == periods).drop("__n")


def rate_metrics(log: DataFrame) -> DataFrame:
    """Daily rates of a validation log.

    The log has one row per validated file: day, status, pii_found,
    completeness and, if it was measured, processing_seconds.
    """
    files = F.count(F.lit(1))
    rates = [
        files.alias("files"),
        (share(count_if(F.col("status") == "PASSED"), files) * 100).alias("validation_success_rate"),
        (share(count_if(F.col("pii_found")), files) * 100).alias("pii_detection_rate"),
        F.avg("completeness").alias("data_completeness")]
    if "processing_seconds" in log.columns:
        rates.append(F.avg("processing_seconds").alias("processing_time"))
    return log.groupBy("day").agg(*rates)


def audit_trail(log: DataFrame, user_id, as_of: datetime) -> DataFrame:
    """Unexpired events of a user, oldest first."""
    return log.where(F.col("user_id") == user_id) \
        .where(F.col("ttl") > F.unix_timestamp(F.lit(as_of).cast("timestamp"))) \
        .orderBy("timestamp", "event_id")


def audit_entries(events: DataFrame, time_column: str, keep_days: int) -> DataFrame:
    """Audit rows (event_id, timestamp, user_id, action, ttl) with their day."""
    time = F.col(time_column).cast("timestamp")
    return events.select(
        "event_id", time.alias("timestamp"), "user_id", F.col("event_type").alias("action"),
        (F.unix_timestamp(time) + keep_days * 86400).alias("ttl"), F.to_date(time).alias("day"))
