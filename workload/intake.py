"""Admission of files, governance and operations."""

from datetime import date, datetime

from vigil.functions.dates import is_date
from vigil.operators import admission as R, governance as G
from workload.registry import query
from workload.views import communicable, files, people, reports, table, uploads, TIES

from pyspark.sql import functions as F

EXTENSION = "lower(regexp_extract(path, '(\\.[^./]*)$', 1))"
REASON = f"""CASE WHEN {EXTENSION} NOT IN ('.csv', '.xls', '.xlsx', '.xml', '.json')
       THEN 'Unsupported file format: ' || {EXTENSION}
     WHEN size > 104857600
       THEN 'File size ' || size || ' exceeds maximum 104857600' END"""


@query("R01_admit_files", f"""
SELECT path, size, {EXTENSION} AS extension, {REASON} AS reason, {REASON} IS NULL AS valid
FROM files""", ("files",))
def admit(spark, sf):
    return R.admit_files(files(spark, sf).select("path", "size"))


def _sql_type(lab):
    return f"""CASE WHEN lower(path) LIKE '%immunisation%' THEN 'immunisation'
  WHEN lower(path) LIKE '%surveillance%' THEN 'surveillance' WHEN {lab} THEN 'laboratory'
  WHEN lower(path) LIKE '%outbreak%' THEN 'outbreak' ELSE 'communicable_disease' END"""


@query("R02_dataset_type_from_path", f"""
SELECT path, {_sql_type("regexp_matches(lower(path), '(^|[^a-z])(lab|laboratory)([^a-z]|$)')")}
  AS dataset_type FROM files""", ("files",))
def dataset_type(spark, sf):
    return R.with_dataset_type(files(spark, sf).select("path"))


@query("R02_dataset_type_substring", f"""
SELECT path, {_sql_type("lower(path) LIKE '%lab%'")} AS dataset_type FROM files""", ("files",))
def dataset_type_substring(spark, sf):
    return R.with_dataset_type(files(spark, sf).select("path"), match="substring")


@query("R03_default_tags", """
SELECT path, COALESCE(dataset_type, 'communicable_disease') AS dataset_type,
       COALESCE(source_organization, 'unknown') AS source_organization FROM files""", ("files",))
def tags(spark, sf):
    return R.default_tags(files(spark, sf).select("path", "dataset_type", "source_organization"))


@query("R04_processing_summary", f"""
SELECT CASE WHEN {REASON} IS NULL THEN 'success' ELSE 'failed' END AS status,
       COUNT(*) AS processed FROM files GROUP BY 1""", ("files",))
def summary(spark, sf):
    admitted = R.admit_files(files(spark, sf).select("path", "size"))
    return R.processing_summary(R.processing_results(admitted))


@query("R04_processing_results", f"""
SELECT path, CASE WHEN {REASON} IS NULL THEN 'success' ELSE 'failed' END AS status,
       {REASON} AS reason FROM files""", ("files",))
def results(spark, sf):
    return R.processing_results(R.admit_files(files(spark, sf).select("path", "size")))


@query("R05_quarantine", f"""
SELECT path, {REASON} AS reason, '2025-01-31' AS quarantine_date,
       'quarantine/2025/01/31/' || path AS quarantine_key
FROM files WHERE {REASON} IS NOT NULL""", ("files",))
def quarantine(spark, sf):
    admitted = R.admit_files(files(spark, sf).select("path", "size"))
    return R.quarantine(admitted.where(~F.col("valid")), date(2025, 1, 31)) \
        .select("path", "reason", "quarantine_date", "quarantine_key")


@query("R06_sanitize_key", """
SELECT path, regexp_replace(regexp_replace(regexp_replace(path, '^.*/', ''),
         '[^a-zA-Z0-9\\-_.]', '_', 'g'), '_+', '_', 'g') AS file_name FROM files""", ("files",))
def sanitize(spark, sf):
    return R.sanitized_names(files(spark, sf).select("path"))


@query("R07_valid_date_format", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, report_date,
       report_date IS NOT NULL AND regexp_full_match(report_date, '\\d{4}-\\d{1,2}-\\d{1,2}')
         AND try_strptime(report_date, '%Y-%m-%d') IS NOT NULL AS valid
FROM uploads""", ("uploads",))
def valid_date(spark, sf):
    return uploads(spark, sf).select(*TIES, "report_date", is_date(F.col("report_date")).alias("valid"))


AS_OF = datetime(2001, 11, 5, 0, 0, 0)


@query("C12_quality_dimensions", """
WITH chosen AS (SELECT report_date, region, disease_name, case_count, population FROM reports),
m AS (SELECT (COUNT(report_date) + COUNT(region) + COUNT(disease_name) + COUNT(case_count)
              + COUNT(population))::DOUBLE / (COUNT(*) * 5) AS completeness,
             (COUNT(*) FILTER (NOT COALESCE(case_count < 0 OR case_count > 45, false)))::DOUBLE
               / COUNT(*) AS validity,
             (SELECT COUNT(*) FROM (SELECT DISTINCT report_date, region, disease_name FROM chosen))
               ::DOUBLE / COUNT(*) AS uniqueness,
             (epoch(TIMESTAMP '2001-11-05') - epoch(MAX(report_date)::TIMESTAMP)) / 3600
               AS timeliness FROM chosen)
SELECT 'completeness' AS dimension, ROUND(completeness, 6) AS value, 0.95::DOUBLE AS threshold,
       completeness >= 0.95 AS passed FROM m
UNION ALL SELECT 'validity', ROUND(validity, 6), 0.99::DOUBLE, validity >= 0.99 FROM m
UNION ALL SELECT 'uniqueness', ROUND(uniqueness, 6), 0.95::DOUBLE, uniqueness >= 0.95 FROM m
UNION ALL SELECT 'timeliness', timeliness, 24.0::DOUBLE, timeliness <= 24 FROM m""", ("reports",))
def dimensions(spark, sf):
    chosen = reports(spark, sf).select(
        "report_date", "region", "disease_name", "case_count", "population")
    return G.quality_dimensions(chosen, ["report_date", "region", "disease_name"],
                                {"case_count": {"min": 0, "max": 45}}, "report_date", AS_OF)


@query("C13_retention", " UNION ALL ".join(f"""
SELECT '{kind}' AS data_type, CASE WHEN datediff('day', report_date, DATE '2001-11-05') > {days}
       THEN '{action}' ELSE 'keep' END AS retention_action, COUNT(*) AS records
FROM cd GROUP BY 2""" for kind, (days, action) in {
    "raw": (90, "delete"), "processed": (365, "archive"), "aggregated": (2555, "archive"),
    "pii": (90, "anonymize_then_archive")}.items()), ("cd",))
def retention(spark, sf):
    from vigil.constants import RETENTION

    cd = communicable(spark, sf).select("report_date")
    marked = [G.with_retention(cd, "report_date", kind, AS_OF.date())
              .groupBy("retention_action").agg(F.count(F.lit(1)).alias("records"))
              .withColumn("data_type", F.lit(kind)) for kind in RETENTION]
    first, *rest = marked
    for m in rest:
        first = first.unionByName(m)
    return first


@query("C13_retention_anonymized", """
SELECT sha256(CAST(patient_id AS VARCHAR)) AS patient_id, '***REDACTED***' AS patient_name,
       regexp_extract(postcode, '^([A-Z]{1,2}\\d{1,2})', 1) AS postcode
FROM people WHERE remark <> 'none'""", ("people",))
def retention_anonymized(spark, sf):
    seen = F.when(F.col("remark") != "none", F.lit(date(2001, 1, 1))).otherwise(F.lit(date(2001, 11, 1)))
    dated = people(spark, sf).withColumn("seen", seen) \
        .select("patient_id", "patient_name", "postcode", "seen")
    _, archived = G.apply_retention(dated, "seen", "pii", AS_OF.date())
    return archived.drop("seen")


WINDOWS = """
SELECT time_bucket(INTERVAL '{period}', ts) AS window_start, event_type,
       {measure}::DOUBLE AS metric FROM events GROUP BY 1, 2"""


def sql_alarm(measure, threshold, period, seconds):
    return f"""
WITH w AS ({WINDOWS.format(period=period, measure=measure)}),
breaches AS (SELECT *, LAG(window_start) OVER (PARTITION BY event_type ORDER BY window_start) AS p
             FROM w WHERE metric > {threshold})
SELECT event_type, CAST(window_start AS VARCHAR) AS alarm_start, ROUND(metric, 6) AS metric
FROM breaches WHERE p = window_start - INTERVAL '{seconds} seconds'"""


@query("C14_windowed_alarm", sql_alarm("SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)",
                                       1, "5 minutes", 300))
def alarm(spark, sf):
    errors = F.when(F.col("event_type") == "error", 1).otherwise(0)
    w = G.metric_windows(table(spark, sf, "events"), "ts", ["event_type"], errors)
    return G.alarms(w, ["event_type"], 1)


@query("C14_windowed_alarm_average", sql_alarm("AVG(value)", 60, "1 hour", 3600))
def alarm_average(spark, sf):
    w = G.metric_windows(table(spark, sf, "events"), "ts", ["event_type"], F.col("value"),
                         "average", "1 hour")
    return G.alarms(w, ["event_type"], 60, period_seconds=3600)


@query("C15_rate_metrics", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS files,
       ROUND(COUNT(*) FILTER (event_type = 'view') * 100.0::DOUBLE / COUNT(*), 6)
         AS validation_success_rate,
       ROUND(COUNT(*) FILTER (event_type = 'error') * 100.0::DOUBLE / COUNT(*), 6)
         AS pii_detection_rate,
       ROUND(AVG(CAST(json_extract_string(props, '$.k') AS INT) / 100.0::DOUBLE), 6)
         AS data_completeness, ROUND(AVG(value), 6) AS processing_time
FROM events GROUP BY 1""")
def rates(spark, sf):
    log = table(spark, sf, "events").select(
        F.to_date("ts").alias("day"),
        F.when(F.col("event_type") == "view", "PASSED").otherwise("FAILED").alias("status"),
        (F.col("event_type") == "error").alias("pii_found"),
        (F.get_json_object("props", "$.k").cast("int") / 100).alias("completeness"),
        F.col("value").alias("processing_seconds"))
    return G.rate_metrics(log)


@query("C20_audit_log", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, user_id, event_type AS action,
       CAST(floor(epoch(ts)) AS BIGINT) + 864000 AS ttl, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
FROM events WHERE user_id = 8 AND floor(epoch(ts)) + 864000 > epoch(TIMESTAMP '2024-01-20')
ORDER BY ts, event_id""")
def audit(spark, sf):
    log = G.audit_entries(table(spark, sf, "events"), "ts", 10)
    return G.audit_trail(log, 8, datetime(2024, 1, 20)) \
        .withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
