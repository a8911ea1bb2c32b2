"""Files, tables, streams and jobs.

The files these queries read are written from the test tables first, into the
shared scratch folder.
"""

import json
from datetime import date, datetime

from vigil.operators import admission as R, aggregates as A, governance as G
from vigil.operators import quality as Q, rules as V
from vigil.plans import jobs, validation
from vigil.plans.scratch import scratch_path
from vigil.sources import files as S, sinks as K
from vigil.streaming import alarms, ingest
from workload import aggregates as AQ, checks as CQ
from workload.cleaning import ROW, sql_fences, sql_rolling
from workload.registry import query
from workload.views import (
    ALL_TIES, TIES, communicable, doses, files, people, reports, samples, table, uploads,
)

from pyspark.sql import functions as F

RUN = datetime(2025, 1, 31, 12, 0, 0)

# --- sources ------------------------------------------------------------------------


@query("S01_scan_parquet_merge", f"""
SELECT {ROW}, case_count, CASE WHEN death_count > 4 THEN age END AS age FROM cd""", ("cd",))
def scan_merged(spark, sf):
    root = scratch_path(spark, "merge")
    cd = communicable(spark, sf).select(*TIES, "case_count", "age", "death_count")
    old = cd.where(F.col("death_count") <= 4).drop("age", "death_count")
    new = cd.where(F.col("death_count") > 4).drop("death_count")
    old.write.parquet(f"{root}/communicable_disease")
    new.write.mode("append").parquet(f"{root}/communicable_disease")
    return S.scan_dataset(spark, root, "COMMUNICABLE_DISEASE")


DOSES = """SELECT * REPLACE (CAST(vaccination_date AS VARCHAR) AS vaccination_date) FROM doses"""


def _table_name(path: str) -> str:
    return "vigil_" + path.rsplit("-", 1)[1]


@query("S02_scan_table", DOSES, ("doses",))
def scan_table(spark, sf):
    path = scratch_path(spark, "table")
    K.write_table(doses(spark, sf), _table_name(path), path)
    return S.scan_table(spark, _table_name(path), "default")


@query("K04_sink_table", DOSES + " UNION ALL " + DOSES, ("doses",))
def sink_table(spark, sf):
    path = scratch_path(spark, "table")
    K.write_table(doses(spark, sf), _table_name(path), path)
    K.write_table(doses(spark, sf), _table_name(path), append=True)
    return S.scan_table(spark, _table_name(path))


LABELLED = f"""SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
  CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_partkey AS VARCHAR) AS l_partkey,
  CAST(l_suppkey AS VARCHAR) AS l_suppkey, region || ' é' AS region, disease_name, case_count
FROM uploads"""


@query("S03_scan_csv", LABELLED, ("uploads",))
def scan_csv(spark, sf):
    root = scratch_path(spark, "csv")
    rows = uploads(spark, sf).select(
        *TIES, F.concat("region", F.lit(" é")).alias("region"), "disease_name", "case_count")
    # Two spellings of a header, two encodings.
    latin = F.col("l_linenumber") > 3
    rows.where(latin).write.option("header", "true").option("encoding", "ISO-8859-1") \
        .csv(f"{root}/latin")
    rows.where(~latin).select("case_count", "region", "disease_name", *TIES) \
        .write.option("header", "true").csv(f"{root}/unicode")
    return S.scan_csv(spark, root)


RECORD = ["report_date", "region", "disease_name", "case_count", "death_count"]
RECORD_SQL = f"""SELECT {ROW}, CAST(report_date AS VARCHAR) AS report_date, region, disease_name,
  case_count, death_count FROM cd"""


@query("S04_scan_xml", RECORD_SQL, ("cd",))
def scan_xml(spark, sf):
    path = scratch_path(spark, "xml")
    rows = communicable(spark, sf).select(*TIES, *RECORD)
    # Files of some 180 MB, a twentieth of it on disk: their tags are many times the values.
    rows.write.format("xml").option("rootTag", "records").option("rowTag", "record") \
        .option("maxRecordsPerFile", 500_000).option("compression", "gzip").save(path)
    return S.scan_xml(spark, path, schema=rows.schema, gzipped=True)


@query("S05_scan_json_envelope", RECORD_SQL, ("cd",))
def scan_json(spark, sf):
    path = scratch_path(spark, "json")
    rows = communicable(spark, sf).select(*TIES, *RECORD)
    envelope = F.to_json(F.struct(
        F.struct(F.lit("1.0.0").alias("version")).alias("metadata"),
        F.array(F.struct(*rows.columns)).alias("records")))
    rows.select(envelope).write.text(path)
    return S.scan_json(spark, path, rows.schema, one_per_line=True)


@query("S06_load_rules", CQ.SQL_NAMED, ("reports",))
def load_rules(spark, sf):
    path = scratch_path(spark, "rules")
    spark.createDataFrame([(json.dumps(CQ.NAMED),)], "value string").write.text(path)
    rules = S.load_rules(spark, path, "communicable_disease")
    return CQ._flat(V.evaluate(reports(spark, sf), rules, CQ.AS_OF))


@query("S07_file_manifest", """
SELECT lang, CAST(SUM(strlen(source) + 1) AS BIGINT) AS bytes, true AS has_time
FROM documents GROUP BY lang""")
def manifest(spark, sf):
    """Files with a line of one source per document; the listing knows their sizes."""
    path = scratch_path(spark, "manifest")
    table(spark, sf, "documents").select("lang", "source").write.partitionBy("lang").text(path)
    listed = S.file_manifest(spark, path).where(F.col("path").endswith(".txt"))
    return listed.groupBy(F.regexp_extract("path", "lang=([a-z]+)", 1).alias("lang")).agg(
        F.sum("size").alias("bytes"), F.bool_and(F.col("event_time").isNotNull()).alias("has_time"))


@query("S08_file_digest", """
WITH uploads AS (
  SELECT o_custkey // 100 AS part, string_agg(o_orderkey || ' ' || o_orderpriority || chr(10), '' ORDER BY o_orderkey) AS content
  FROM orders GROUP BY 1),
named AS (SELECT content FROM uploads UNION ALL SELECT content FROM uploads WHERE part % 2 = 0)
SELECT sha256(content) AS digest, COUNT(*) AS copies FROM named GROUP BY 1 HAVING COUNT(*) > 1""")
def digest(spark, sf):
    """Real files, each with the orders of some customers; every second one is uploaded twice."""
    root = scratch_path(spark, "digests")
    parts = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "concat(o_orderkey, ' ', o_orderpriority) AS line", "o_custkey div 100 AS part")
    uploads = parts.withColumn("folder", F.expr("concat('a', part)")).unionByName(
        parts.where("part % 2 = 0").withColumn("folder", F.expr("concat('b', part)")))
    K.write_line_files(uploads, root, "folder", "line", "o_orderkey")
    return S.duplicate_uploads(S.file_digests(spark, root).where(F.col("size") > 0)).drop("first_path")


GROUP_OF_FILE = 10  # documents a file holds


@query("S08_upload_digest", f"""
WITH uploads AS (
  SELECT doc_id // {GROUP_OF_FILE} AS part, string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id) AS content
  FROM documents GROUP BY 1),
named AS (SELECT 'a' || part AS folder, content FROM uploads UNION ALL
          SELECT 'b' || part, content FROM uploads WHERE part % 3 = 0)
SELECT sha256(content) AS digest, COUNT(*) AS copies, MIN(folder) AS first_path
FROM named GROUP BY 1 HAVING COUNT(*) > 1""")
def upload_digest(spark, sf):
    """Real files, each with the texts of some documents; every third is uploaded twice."""
    root = scratch_path(spark, "uploads")
    parts = table(spark, sf, "documents").selectExpr(
        "doc_id", "text", f"doc_id div {GROUP_OF_FILE} AS part")
    uploads = parts.withColumn("folder", F.expr("concat('a', part)")).unionByName(
        parts.where("part % 3 = 0").withColumn("folder", F.expr("concat('b', part)")))
    K.write_line_files(uploads, root, "folder", "text", "doc_id")
    found = S.duplicate_uploads(S.file_digests(spark, root).where(F.col("size") > 0))
    return found.withColumn("first_path", F.regexp_extract("first_path", "folder=([^/]+)", 1))


@query("S08_document_digest", """
SELECT sha256(text) AS digest, COUNT(*) AS copies, MIN(path) AS first_path
FROM files GROUP BY 1 HAVING COUNT(*) > 1""", ("files",))
def document_digest(spark, sf):
    return S.duplicate_uploads(S.with_digest(files(spark, sf).select("path", "text"), "text"))


# --- sinks --------------------------------------------------------------------------

@query("K01_sink_processed", f"""
SELECT {ROW}, case_count, '2025-01-31' AS etl_date FROM cd""", ("cd",))
def sink_processed(spark, sf):
    rows = communicable(spark, sf).select(*TIES, "case_count") \
        .withColumn("etl_date", F.lit(RUN.date()))
    root = scratch_path(spark, "processed")
    path = K.write_processed(rows, root, "communicable_disease", RUN.date())
    K.write_processed(rows, root, "communicable_disease", RUN.date())
    return spark.read.parquet(path)


@query("K02_sink_aggregate", f"""
SELECT * REPLACE (CAST(report_date AS VARCHAR) AS report_date) FROM (
  SELECT report_date, region, CAST(SUM(case_count) AS BIGINT) AS total_cases FROM cd GROUP BY 1, 2)
""", ("cd",))
def sink_aggregate(spark, sf):
    totals = A.region_days(communicable(spark, sf))
    return spark.read.parquet(K.write_aggregate(totals, scratch_path(spark, "agg"), "days"))


@query("K03_sink_clustered", AQ.REGION_WEEKS, ("cd",))
def sink_clustered(spark, sf):
    weeks = A.region_weeks(communicable(spark, sf))
    path = K.write_clustered(weeks, scratch_path(spark, "weeks"), "weekly",
                             ["year", "week"], "region")
    return spark.read.schema(weeks.schema).parquet(path)


@query("K05_sink_metrics", "SELECT 'RAW_DATA' AS stage, COUNT(*) AS record_count FROM cd", ("cd",))
def sink_metrics(spark, sf):
    metrics = Q.stage_metrics(communicable(spark, sf), "RAW_DATA")
    path = K.write_metrics(metrics, scratch_path(spark, "metrics"), "communicable_disease", RUN)
    return spark.read.schema(metrics.schema).json(path).select("stage", "record_count")


REPORT_SQL = f"""SELECT *, '2025-01-31' AS report_day, 'reports' AS table_name FROM ({CQ.JOB})"""


def _report(spark, path, schema):
    return spark.read.schema(schema.add("report_day", "date").add("table_name", "string")).json(path)


@query("K06_sink_quality_report", REPORT_SQL, ("reports",))
def sink_report(spark, sf):
    results = Q.quality_job(reports(spark, sf).select(*CQ.JOB_COLUMNS))
    path = K.write_quality_report(results, scratch_path(spark, "report"), "reports", RUN.date())
    return _report(spark, path, results.schema)


@query("K07_sink_validated", f"""
SELECT {ROW}, case_count, 'uploads/' || region || '.csv' AS original_file,
       COUNT(*) OVER (PARTITION BY region) AS record_count,
       '2025-01-31 12:00:00' AS validation_timestamp, '20250131_120000' AS run FROM cd""", ("cd",))
def sink_validated(spark, sf):
    rows = communicable(spark, sf).select(
        *TIES, "case_count",
        F.concat(F.lit("uploads/"), "region", F.lit(".csv")).alias("original_file"))
    path = K.write_validated(rows, scratch_path(spark, "valid"), "COMMUNICABLE_DISEASE", RUN)
    return spark.read.parquet(path)


@query("K08_sink_validation_log", """
SELECT path AS original_file,
       CASE WHEN path NOT LIKE '%.csv' AND path NOT LIKE '%.json' AND path NOT LIKE '%.XML'
              OR size > 104857600 THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN path NOT LIKE '%.csv' AND path NOT LIKE '%.json' AND path NOT LIKE '%.XML'
              THEN 'Unsupported file format: .txt'
            WHEN size > 104857600
              THEN 'File size ' || size || ' exceeds maximum 104857600' END AS reason,
       '2025-01-31' AS log_date, '20250131_120000' AS run
FROM files""", ("files",))
def sink_log(spark, sf):
    admitted = R.admit_files(files(spark, sf).select("path", "size"))
    entries = R.processing_results(admitted).withColumnRenamed("path", "original_file")
    return K.write_validation_log(entries, scratch_path(spark, "log"), RUN)


# --- validation of datasets and files -----------------------------------------------

KNOWN = [f"NATION_{i}" for i in range(12)]
FILE_RULES = [
    {"rule_id": "schema", "rule_type": "schema", "required_columns": ["report_date", "region"]},
    {"rule_id": "regions", "rule_type": "allowed_values", "column": "region",
     "allowed_values": KNOWN},
    {"rule_id": "required", "rule_type": "data_quality", "required_nonnull": ["case_count"]},
]


@query("V10_validate_dataset", """
SELECT 'WARNING' AS status, 'Validation passed with warnings' AS message, '' AS errors,
       'Column ''region'' has ' || COUNT(*) || ' values outside the allowed list' AS warnings,
       'review' AS route
FROM cd WHERE CAST(substr(region, 8) AS INT) >= 12""", ("cd",))
def validate(spark, sf):
    outcome = validation.validate_dataset(communicable(spark, sf), FILE_RULES)
    return outcome.select("status", "message", F.array_join("errors", "; ").alias("errors"),
                          F.array_join("warnings", "; ").alias("warnings"), "route")


@query("V10_validate_dataset_pii", """
SELECT 'FAILED' AS status, 'PII detected in file' AS message, 'quarantine' AS route,
       COUNT(patient_name) > 0 AS personal FROM people""", ("people",))
def validate_people(spark, sf):
    outcome = validation.validate_dataset(people(spark, sf), FILE_RULES)
    return outcome.select("status", "message", "route", (F.size("errors") > 0).alias("personal"))


ROUTED = """
SELECT region, CASE WHEN CAST(substr(region, 8) AS INT) < 12 THEN 'validated' ELSE 'review' END
         AS route, COUNT(*) AS records, CAST(SUM(case_count) AS BIGINT) AS cases
FROM cd GROUP BY 1, 2"""


def _routed(rows):
    return rows.groupBy("region", "route").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col("case_count").cast("bigint")).alias("cases"))


def _routed_rows(spark, target):
    valid = S.scan_dataset(spark, f"{target}/validated", "communicable_disease") \
        .withColumn("route", F.lit("validated"))
    held = spark.read.parquet(f"{target}/held")
    kept = ["region", "route", "case_count"]
    return _routed(valid.select(*kept).unionByName(held.select(*kept)))


@query("L05_validation_run", ROUTED, ("cd",))
def validation_run(spark, sf):
    source, target = scratch_path(spark, "uploads"), scratch_path(spark, "target")
    rows = communicable(spark, sf).select(*TIES, *RECORD)
    by_region = rows.withColumn("area", F.col("region"))
    csv = F.col("l_linenumber") > 2
    by_region.where(csv).write.partitionBy("area").option("header", "true").csv(f"{source}/reports")
    by_region.where(~csv).write.partitionBy("area").format("xml") \
        .option("rootTag", "records").option("rowTag", "record").save(f"{source}/more")
    jobs.validation_job(spark, source, target, RUN, {"communicable_disease": FILE_RULES})
    return _routed_rows(spark, target)


# --- streams ------------------------------------------------------------------------

@query("T01_incremental_ingest", """
SELECT event_id, CAST(surveillance_date AS VARCHAR) AS surveillance_date, sample_count,
       positive_count FROM samples""", ("samples",))
def incremental(spark, sf):
    root = scratch_path(spark, "stream")
    rows = samples(spark, sf)
    early = F.col("surveillance_date") < F.lit(date(2024, 1, 15))
    for part in (early, ~early, None):  # the third run finds nothing new
        if part is not None:
            rows.where(part).write.mode("append").parquet(f"{root}/in")
        ingest.incremental_ingest(spark, f"{root}/in", rows.schema, f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out")


@query("T02_validate_and_route_stream", ROUTED, ("cd",))
def routed_stream(spark, sf):
    root = scratch_path(spark, "route")
    rows = communicable(spark, sf).select(*TIES, *RECORD)
    # One half has its columns in another order.
    turned = F.col("l_linenumber") % 2 == 0
    for name, part in (("a", rows.where(~turned)), ("b", rows.where(turned).select(*rows.columns[::-1]))):
        part.withColumn("area", F.col("region")).write.partitionBy("area") \
            .option("header", "true").csv(f"{root}/in/{name}")
    ingest.validate_and_route(spark, f"{root}/in", f"{root}/out", f"{root}/state",
                              {"communicable_disease": FILE_RULES}, RUN)
    return _routed_rows(spark, f"{root}/out")


@query("T03_windowed_alarm_stream", """
WITH w AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type,
                  SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::DOUBLE AS metric
           FROM events GROUP BY 1, 2),
closed AS (SELECT * FROM w WHERE window_start + INTERVAL '1 hour' <=
             (SELECT date_trunc('milliseconds', MAX(ts)) - INTERVAL '1 hour' FROM events)),
breaches AS (SELECT *, LAG(window_start) OVER (PARTITION BY event_type ORDER BY window_start) AS p
             FROM closed WHERE metric > 3)
SELECT event_type, CAST(window_start AS VARCHAR) AS alarm_start, metric
FROM breaches WHERE p = window_start - INTERVAL '1 hour'""")
def alarm_stream(spark, sf):
    root = scratch_path(spark, "alarm")
    events = table(spark, sf, "events")
    events.write.parquet(f"{root}/in")
    stream = ingest.new_files(spark, f"{root}/in", events.schema)
    errors = F.when(F.col("event_type") == "error", 1).otherwise(0)
    return alarms.windowed_alarms(stream, "ts", ["event_type"], errors, 3, f"{root}/out", f"{root}/state",
                                  period_seconds=3600)


# --- jobs ---------------------------------------------------------------------------

ETL_FENCED = ["case_count", "death_count", "population"]
ETL = f"""
WITH typed AS (
  SELECT {ROW}, CAST(CASE WHEN regexp_full_match(report_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
              THEN report_date END AS DATE) AS report_date,
         COALESCE(region, 'Unknown') AS region, disease_name,
         try_cast(nullif(regexp_extract(trim(case_count), '^([+-]?\\d+)(\\.\\d*)?$', 1), '') AS INT)
           AS case_count,
         try_cast(death_count AS INT) AS death_count, try_cast(population AS BIGINT) AS population
  FROM uploads),
medians AS (SELECT quantile_disc(case_count, 0.5) AS c, quantile_disc(death_count, 0.5) AS d,
                   quantile_disc(population, 0.5) AS p FROM typed),
filled AS (
  SELECT DISTINCT {ROW}, report_date, region, disease_name, COALESCE(case_count, c) AS case_count,
         COALESCE(death_count, d) AS death_count, COALESCE(population, p) AS population
  FROM typed CROSS JOIN medians),
capped AS (
  SELECT {ROW}, report_date, region, disease_name, """ + ", ".join(
    f"CAST(CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END AS DOUBLE)"
    f" AS {c}" for c in ETL_FENCED) + f"""
  FROM filled CROSS JOIN {sql_fences(ETL_FENCED, "filled")}),
ruled AS (
  SELECT *, case_count / population * 100000 AS incidence_rate
  FROM (SELECT * REPLACE (CASE WHEN case_count < 0 THEN 0 ELSE case_count END AS case_count)
        FROM capped))"""


def _etl(spark, sf):
    raw = uploads(spark, sf).drop("incidence_rate")
    raw = raw.withColumnsRenamed({"report_date": "Report Date", "disease_name": "Disease-Name"})
    return jobs.etl_job(raw, "communicable_disease", scratch_path(spark, "etl"), RUN, "nightly",
                        "surveillance", ALL_TIES, TIES)


@query("L01_etl_run", ETL + """
SELECT CAST(weekofyear(report_date) AS INT) AS week, CAST(year(report_date) AS INT) AS year,
       disease_name, ROUND(SUM(case_count), 6) AS total_cases,
       ROUND(SUM(death_count), 6) AS total_deaths,
       ROUND(AVG(incidence_rate), 6) AS avg_incidence_rate
FROM ruled GROUP BY 1, 2, 3""", ("uploads",))
def etl_run(spark, sf):
    return spark.read.parquet(_etl(spark, sf)["weekly"])


@query("L01_etl_processed", ETL + f"""
SELECT * REPLACE (CAST(report_date AS VARCHAR) AS report_date,
                  ROUND(incidence_rate, 6) AS incidence_rate),
       {sql_rolling("disease_name", "case_count")}, '2025-01-31' AS etl_date
FROM ruled""", ("uploads",))
def etl_processed(spark, sf):
    return spark.read.parquet(_etl(spark, sf)["processed"]).drop(
        "etl_timestamp", "etl_job_name", "source_system", "data_version")


@query("L02_quality_run", REPORT_SQL, ("reports",))
def quality_run(spark, sf):
    rows = reports(spark, sf).select(*CQ.JOB_COLUMNS)
    path = jobs.quality_report_job(rows, "reports", scratch_path(spark, "report"), RUN.date())
    return _report(spark, path, Q.quality_job(rows).schema)


@query("L03_aggregation_run", f"""
WITH weeks AS ({AQ.WEEKLY}), previous AS (
  SELECT *, LAG(total_cases) OVER (PARTITION BY region, disease_name ORDER BY week_start)
              AS prev_week_cases FROM weeks)
SELECT 'weekly' AS level, region || disease_name || week_start AS key, total_cases,
       ROUND(CASE WHEN prev_week_cases <> 0 THEN
             CAST(total_cases - prev_week_cases AS DOUBLE) / prev_week_cases * 100 END, 6) AS figure
FROM previous
UNION ALL
SELECT 'daily', region || disease_name || report_date, CAST(SUM(case_count) AS BIGINT),
       ROUND(STDDEV(case_count), 6) FROM cd GROUP BY region, disease_name, report_date
UNION ALL
SELECT 'monthly', region || disease_name || strftime(report_date, '%Y-%m'),
       CAST(SUM(case_count) AS BIGINT), ROUND(AVG(case_count), 6)
FROM cd GROUP BY region, disease_name, strftime(report_date, '%Y-%m')
UNION ALL
SELECT 'rankings', region || report_date, CAST(SUM(case_count) AS BIGINT), ROUND(PERCENT_RANK()
         OVER (PARTITION BY report_date ORDER BY SUM(case_count) DESC), 6)
FROM cd GROUP BY region, report_date""", ("cd",))
def aggregation_run(spark, sf):
    paths = jobs.aggregation_job(communicable(spark, sf), scratch_path(spark, "aggregates"))
    shown = {"daily": (["region", "disease_name", "date"], "stddev_cases"),
             "weekly": (["region", "disease_name", "week_start"], "week_over_week_change"),
             "monthly": (["region", "disease_name", "month"], "avg_daily_cases"),
             "rankings": (["region", "report_date"], "percentile")}
    out = None
    for level, (key, figure) in shown.items():
        part = spark.read.parquet(paths[level]).select(
            F.lit(level).alias("level"), F.concat(*key).alias("key"), "total_cases",
            F.col(figure).alias("figure"))
        out = part if out is None else out.unionByName(part)
    return out


@query("L04_region_aggregation_run", f"""
WITH weeks AS ({AQ.REGION_WEEKS}), months AS ({AQ.REGION_MONTHS}), stats AS ({AQ.REGION_STATS}),
w AS (SELECT *, LAG(weekly_cases) OVER (PARTITION BY region ORDER BY year, week) AS p FROM weeks),
m AS (SELECT *, LAG(monthly_cases) OVER (PARTITION BY region ORDER BY year, month) AS p,
             LAG(monthly_cases) OVER (PARTITION BY region, month ORDER BY year) AS y FROM months)
SELECT 'weekly' AS level, region, year, week AS period, weekly_cases AS cases, avg_daily_cases,
       weekly_cases - p AS change, max_daily_cases::DOUBLE AS figure, days_reported
FROM w
UNION ALL SELECT 'monthly', region, year, month, monthly_cases, avg_daily_cases,
       monthly_cases - y, stddev_daily_cases, unique_diseases FROM m
UNION ALL SELECT 'rankings', region, NULL, NULL, total_cases, avg_cases_per_day,
       RANK() OVER (ORDER BY total_cases DESC), case_fatality_rate, reports_submitted FROM stats""",
       ("cd",))
def region_aggregation_run(spark, sf):
    paths = jobs.region_aggregation_job(communicable(spark, sf), scratch_path(spark, "regions"))
    shown = {
        "weekly": ["year", "week", "weekly_cases", "avg_daily_cases", "wow_change",
                   "max_daily_cases", "days_reported"],
        "monthly": ["year", "month", "monthly_cases", "avg_daily_cases", "yoy_change",
                    "stddev_daily_cases", "unique_diseases"],
        "rankings": [None, None, "total_cases", "avg_cases_per_day", "cases_rank",
                     "case_fatality_rate", "reports_submitted"]}
    names = [("year", "int"), ("period", "int"), ("cases", "bigint"), ("avg_daily_cases", "double"),
             ("change", "bigint"), ("figure", "double"), ("days_reported", "bigint")]
    out = None
    for level, columns in shown.items():
        part = spark.read.parquet(paths[level]).select(
            F.lit(level).alias("level"), "region",
            *[(F.col(c) if c else F.lit(None)).cast(kind).alias(n)
              for c, (n, kind) in zip(columns, names)])
        out = part if out is None else out.unionByName(part)
    return out
