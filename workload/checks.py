"""Profiles, quality checks and rules."""

from datetime import date

from vigil import constants as C
from vigil.operators import quality as Q, rules as V
from workload.cleaning import SQL_DATE, sql_fences
from workload.registry import query
from workload.views import reports, uploads

from pyspark.sql import functions as F

AS_OF = date(2001, 11, 4)


@query("Q01_stage_metrics", """
SELECT 'raw' AS stage, COUNT(*) AS record_count, CAST(5 AS INT) AS column_count,
  'struct<l_orderkey:bigint,l_linenumber:int,report_date:date,region:string,case_count:int>'
    AS schema FROM reports""", ("reports",))
def stage_metrics(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "report_date", "region", "case_count"]
    return Q.stage_metrics(reports(spark, sf).select(*columns), "raw")


PROFILED = {"report_date": "date", "region": "string", "disease_name": "string",
            "case_count": "int", "population": "bigint", "age": "int"}


def _sql_profile(column, kind):
    number = f"CAST({column} AS DOUBLE)" if kind in ("int", "bigint") else "CAST(NULL AS DOUBLE)"
    return f"""
SELECT '{column}' AS column_name, '{kind}' AS data_type,
       COUNT(*) - COUNT({column}) AS null_count,
       ROUND((COUNT(*) - COUNT({column})) * 100.0::DOUBLE / COUNT(*), 6) AS null_percentage,
       ROUND(COUNT({column}) * 100.0::DOUBLE / COUNT(*), 6) AS completeness,
       MIN({number}) AS min, MAX({number}) AS max, ROUND(AVG({number}), 6) AS mean,
       ROUND(STDDEV({number}), 6) AS stddev, quantile_disc({number}, 0.5) AS median,
       COUNT(DISTINCT {column}) + MAX(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END)
         AS distinct_count
FROM reports"""


@query("Q02_profile", " UNION ALL ".join(
    f"(SELECT * REPLACE (CAST(distinct_count AS BIGINT) AS distinct_count) FROM ({_sql_profile(c, k)}))"
    for c, k in PROFILED.items()), ("reports",))
def profile(spark, sf):
    return Q.profile(reports(spark, sf).select(*PROFILED))


CHECKED = ["report_date", "region", "disease_name", "case_count", "population", "age"]


@query("Q03_etl_quality_checks", """
WITH checks AS (""" + " UNION ALL ".join(f"""
  SELECT '{c}_null_check' AS check_name, COUNT(*) - COUNT({c}) AS failing_count,
         (COUNT(*) - COUNT({c})) * 100.0::DOUBLE / COUNT(*) AS percentage, 10.0::DOUBLE AS most
  FROM reports""" for c in CHECKED) + f""" UNION ALL
  SELECT 'duplicate_check', t - u, (t - u) * 100.0::DOUBLE / t, 5.0::DOUBLE
  FROM (SELECT COUNT(*) AS t FROM reports),
       (SELECT COUNT(*) AS u FROM (SELECT DISTINCT {", ".join(CHECKED)} FROM reports)))
SELECT check_name, failing_count, ROUND(percentage, 6) AS percentage,
       percentage <= most AS passed, bool_and(percentage <= most) OVER () AS overall_passed
FROM checks""", ("reports",))
def etl_checks(spark, sf):
    return Q.etl_quality_checks(reports(spark, sf).select(*CHECKED))


CHECK_COLUMNS = "check_name, status, column_name, metric, value, detail, passed"


def _with_status(rows: str, on_failure: str = "FAILED") -> str:
    return f"""SELECT check_name,
  CASE WHEN bool_and(passed) OVER () THEN 'PASSED' ELSE '{on_failure}' END AS status,
  column_name, metric, ROUND(CAST(value AS DOUBLE), 6) AS value,
  CAST(detail AS VARCHAR) AS detail, passed FROM ({rows})"""


def _sql_completeness(columns, view):
    return _with_status(" UNION ALL ".join(f"""
  SELECT 'completeness' AS check_name, '{c}' AS column_name, 'completeness' AS metric,
         COUNT({c})::DOUBLE / COUNT(*) AS value, NULL AS detail,
         COUNT({c})::DOUBLE / COUNT(*) >= 0.95 AS passed FROM {view}""" for c in columns))


def _sql_uniqueness(key, view):
    return f"""SELECT 'uniqueness' AS check_name,
  CASE WHEN t = u THEN 'PASSED' ELSE 'FAILED' END AS status, '{", ".join(key)}' AS column_name,
  metric, CAST(CASE metric WHEN 'total_rows' THEN t WHEN 'unique_rows' THEN u ELSE t - u END
               AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail, t = u AS passed
FROM (SELECT COUNT(*) AS t FROM {view}),
     (SELECT COUNT(*) AS u FROM (SELECT DISTINCT {", ".join(key)} FROM {view})),
     (SELECT unnest(['total_rows', 'unique_rows', 'duplicate_count']) AS metric)"""


def _sql_validity(ranges, view):
    return _with_status(" UNION ALL ".join(f"""
  SELECT 'validity' AS check_name, '{c}' AS column_name, 'invalid_count' AS metric,
         COUNT(*) FILTER ({c} < {r["min"]} OR {c} > {r["max"]}) AS value, NULL AS detail,
         COUNT(*) FILTER ({c} < {r["min"]} OR {c} > {r["max"]}) = 0 AS passed
  FROM {view}""" for c, r in ranges.items()))


def _sql_consistency(columns, view):
    return _with_status(" UNION ALL ".join(f"""
  SELECT 'consistency' AS check_name, '{c}' AS column_name, '{f}_date' AS metric, NULL AS value,
         CAST({f}({c}) AS VARCHAR) AS detail, {f}({c}) IS NOT NULL AS passed FROM {view}"""
                                     for c in columns for f in ("min", "max")), "WARNING")


def _sql_outliers(columns, view, threshold=3.0):
    return _with_status(" UNION ALL ".join(f"""
  SELECT 'outliers' AS check_name, '{c}' AS column_name, '{metric}' AS metric,
         {value} AS value, NULL AS detail, n < t * 0.01 AS passed
  FROM (SELECT COUNT(*) AS t, COUNT(*) FILTER (abs(({c} - m) / s) > {threshold}) AS n
        FROM {view}, (SELECT AVG({c}) AS m, STDDEV({c}) AS s FROM {view}))"""
                                     for c in columns for metric, value in
                                     [("outlier_count", "n"),
                                      ("outlier_percentage", "n * 100.0::DOUBLE / t")]), "WARNING")


@query("Q04_completeness", _sql_completeness(CHECKED, "reports"), ("reports",))
def completeness(spark, sf):
    return Q.completeness(reports(spark, sf).select(*CHECKED))


@query("Q05_uniqueness", _sql_uniqueness(["report_date", "region"], "reports"), ("reports",))
def uniqueness(spark, sf):
    return Q.uniqueness(reports(spark, sf), ["report_date", "region"])


RANGES = {"case_count": {"min": 0, "max": 40}, "age": {"min": 0, "max": 120}}


@query("Q06_validity", _sql_validity(RANGES, "reports"), ("reports",))
def validity(spark, sf):
    return Q.validity(reports(spark, sf), {
        **RANGES, "death_count": {"max": 3}, "no_such_column": {"min": 0, "max": 1}})


@query("Q07_consistency", _sql_consistency(["report_date"], "reports"), ("reports",))
def consistency(spark, sf):
    return Q.consistency(reports(spark, sf))


@query("Q08_outliers_zscore", _sql_outliers(["case_count", "population"], "reports", 1.5),
       ("reports",))
def zscore(spark, sf):
    return Q.outliers_zscore(reports(spark, sf), ["case_count", "population"], 1.5)


JOB_COLUMNS = ["report_date", "region", "disease_name", "case_count", "death_count", "population"]
JOB = " UNION ALL ".join(f"SELECT {CHECK_COLUMNS} FROM ({part})" for part in [
    _sql_completeness(JOB_COLUMNS, "reports"), _sql_uniqueness(Q.JOB_KEY, "reports"),
    _sql_validity(Q.JOB_RANGES, "reports"), _sql_consistency(["report_date"], "reports"),
    _sql_outliers(["case_count", "death_count", "population"], "reports")])


@query("Q10_quality_job", JOB, ("reports",))
def quality_job(spark, sf):
    return Q.quality_job(reports(spark, sf).select(*JOB_COLUMNS))


@query("Q09_quality_summary", f"""
SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (status = 'PASSED') AS passed,
       COUNT(*) FILTER (status = 'FAILED') AS failed,
       COUNT(*) FILTER (status = 'WARNING') AS warnings
FROM (SELECT DISTINCT check_name, status FROM ({JOB}))""", ("reports",))
def quality_summary(spark, sf):
    return Q.quality_summary(Q.quality_job(reports(spark, sf).select(*JOB_COLUMNS)))


# --- rules ------------------------------------------------------------------------

def _flat(results):
    """Results with their lists as text."""
    return results.select(
        "rule_id", "rule_type", "status", "message",
        F.array_join("errors", "; ").alias("errors"),
        F.array_join("warnings", "; ").alias("warnings"))


def sql_rule(rule_id, kind, source, errors=(), warnings=(), messages=None):
    """A rule's result row; errors and warnings are (condition, text expression)."""
    done = messages or {"business_logic": ("Business logic validation completed",) * 2,
                        "data_quality": ("Data quality validation completed",) * 2,
                        "allowed_values": ("Allowed values validation completed",) * 2,
                        "schema": ("Schema validation passed", "Schema validation failed"),
                        "data_type": ("Data type validation passed", "Data type validation failed"),
                        }[kind]

    def texts(pairs):
        return "concat_ws('; ', NULL" + "".join(
            f", CASE WHEN {c} THEN {t} END" for c, t in pairs) + ")"

    return f"""SELECT '{rule_id}' AS rule_id, '{kind}' AS rule_type,
  CASE WHEN e <> '' THEN 'FAILED' WHEN w <> '' THEN 'WARNING' ELSE 'PASSED' END AS status,
  CASE WHEN e <> '' THEN '{done[1]}' ELSE '{done[0]}' END AS message, e AS errors, w AS warnings
FROM (SELECT {texts(errors)} AS e, {texts(warnings)} AS w FROM ({source}))"""


SCHEMA_RULE = {"rule_id": "schema_001", "rule_type": "schema",
               "required_columns": ["report_date", "case_count", "region", "reporter", "age_group"],
               "optional_columns": ["death_count", "gender"]}


@query("V01_rule_schema", sql_rule(
    "schema_001", "schema", "SELECT COUNT(*) AS n FROM reports",
    errors=[("n >= 0", "'Missing columns: reporter, age_group'")]), ("reports",))
def rule_schema(spark, sf):
    return _flat(V.evaluate(reports(spark, sf), [SCHEMA_RULE]))


@query("C05_rule_optional_columns", """
SELECT 'schema_001' AS rule_id, unnest(['optional_death_count', 'optional_gender']) AS key,
       unnest([1.0::DOUBLE, 0.0::DOUBLE]) AS value FROM (SELECT COUNT(*) FROM reports)""",
       ("reports",))
def rule_optional(spark, sf):
    return V.result_details(V.evaluate(reports(spark, sf), [SCHEMA_RULE]))


@query("C16_lineage_fields", sql_rule(
    "lineage_fields", "schema", "SELECT COUNT(*) AS n FROM reports",
    errors=[("n >= 0", "'Missing columns: creation_date, last_modified, data_owner, "
             "retention_period, classification_level'")]), ("reports",))
def lineage(spark, sf):
    tagged = reports(spark, sf).withColumn("source_system", F.lit("surveillance"))
    return _flat(V.evaluate(tagged, [V.lineage_rule()]))


TYPE_RULE = {"rule_id": "types_001", "rule_type": "data_type",
             "column_types": {"report_date": "datetime", "case_count": "integer",
                              "death_count": "integer", "incidence_rate": "float",
                              "region": "string", "l_orderkey": "string", "absent": "boolean"}}


@query("V02_rule_data_type", sql_rule("types_001", "data_type", f"""
  SELECT COUNT(*) FILTER (report_date IS NOT NULL AND {SQL_DATE} IS NULL) AS d,
         COUNT(*) FILTER (case_count IS NOT NULL AND
                          (try_cast(case_count AS BIGINT) IS NULL OR case_count LIKE '%.%')) AS c
  FROM uploads""", errors=[
    ("d > 0", "'Column ''report_date'' has type ''string'', expected ''datetime'''"),
    ("c > 0", "'Column ''case_count'' has type ''string'', expected ''integer'''"),
    ("true", "'Column ''l_orderkey'' has type ''bigint'', expected ''string'''")]), ("uploads",))
def rule_types(spark, sf):
    return _flat(V.evaluate(uploads(spark, sf), [TYPE_RULE]))


def _sql_date_rule(rule_id, low, high):
    return sql_rule(rule_id, "business_logic", f"""
  SELECT COUNT(*) FILTER (report_date < DATE '{low}' OR report_date > DATE '{high}') AS n
  FROM reports""", errors=[
        ("n > 0", "'Found ' || n || ' records with dates outside valid range'")])


@query("V03_rule_date_range", _sql_date_rule("dates_001", "1996-01-01", "2000-12-31"),
       ("reports",))
def rule_dates(spark, sf):
    return _flat(V.evaluate(reports(spark, sf), [{
        "rule_id": "dates_001", "rule_type": "business_logic",
        "date_range": {"column": "report_date", "min": "1996-01-01", "max": "2000-12-31"}}]))


@query("C07_rule_current_date", _sql_date_rule("value_range_validation", "1998-01-01", AS_OF),
       ("reports",))
def rule_current_date(spark, sf):
    return _flat(V.evaluate(reports(spark, sf), [{
        "id": "value_range_validation", "type": "value_ranges",
        "ranges": {"report_date": {"min": "1998-01-01", "max": "current_date"}}}], AS_OF))


@query("V04_rule_value_ranges", sql_rule("range_001", "business_logic", """
  SELECT COUNT(*) FILTER (case_count < 0) AS a, COUNT(*) FILTER (case_count > 45) AS b,
         COUNT(*) FILTER (age > 60) AS c, COUNT(*) FILTER (population < 5000) AS d
  FROM reports""", warnings=[
    ("a > 0", "'Column ''case_count'' has ' || a || ' values below minimum 0'"),
    ("b > 0", "'Column ''case_count'' has ' || b || ' values above maximum 45'"),
    ("c > 0", "'Column ''age'' has ' || c || ' values above maximum 60'"),
    ("d > 0", "'Column ''population'' has ' || d || ' values below minimum 5000'")]),
       ("reports",))
def rule_ranges(spark, sf):
    return _flat(V.evaluate(reports(spark, sf), [{
        "rule_id": "range_001", "rule_type": "value_ranges", "ranges": {
            "case_count": {"min": 0, "max": 45}, "age": {"max": 60},
            "population": {"min": 5000}}}]))


QUALITY_COLUMNS = ["region", "case_count", "population", "age"]


def _sql_null_warnings(columns, limit):
    return [(f"n_{c} > {limit}",
             f"'Column ''{c}'' has ' || printf('%.2f', n_{c} * 100) || "
             f"'% null values (threshold: {limit:.0%})'") for c in columns]


def _sql_null_ratios(columns):
    return ", ".join(f"(COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*) AS n_{c}" for c in columns)


@query("V05_rule_null_ratio", sql_rule(
    "quality_001", "data_quality",
    f"SELECT {_sql_null_ratios(QUALITY_COLUMNS)} FROM reports",
    warnings=_sql_null_warnings(QUALITY_COLUMNS, 0.1)), ("reports",))
def rule_nulls(spark, sf):
    return _flat(V.evaluate(reports(spark, sf).select(*QUALITY_COLUMNS), [
        {"rule_id": "quality_001", "rule_type": "data_quality"}]))


SQL_REPEATED = ("(SELECT COUNT(*) FROM {v}) - (SELECT COUNT(*) FROM "
                "(SELECT DISTINCT {c} FROM {v}))")


@query("V06_rule_duplicates", sql_rule(
    "quality_002", "data_quality",
    "SELECT " + SQL_REPEATED.format(c=", ".join(QUALITY_COLUMNS), v="reports") + " AS n",
    warnings=[("n > 0", "'Found ' || n || ' duplicate rows'")]), ("reports",))
def rule_duplicates(spark, sf):
    return _flat(V.evaluate(reports(spark, sf).select(*QUALITY_COLUMNS), [
        {"rule_id": "quality_002", "rule_type": "data_quality", "null_threshold": 0.9,
         "check_duplicates": True}]))


OUTLIERS = ["case_count", "population", "age"]


def _sql_outside(columns, view, factor="quantile_cont"):
    counts = ", ".join(f"COUNT(*) FILTER ({c} < {c}_lo OR {c} > {c}_hi) AS o_{c}" for c in columns)
    return f"SELECT {counts}, COUNT(*) AS t FROM {view} CROSS JOIN {sql_fences(columns, view, factor)}"


def _sql_outlier_warnings(columns, limit="0"):
    return [(f"o_{c}::DOUBLE / t > {limit}",
             f"'Column ''{c}'' has ' || o_{c} || ' potential outliers'") for c in columns]


@query("V07_rule_outliers_iqr", sql_rule(
    "quality_003", "data_quality", _sql_outside(OUTLIERS, "reports"),
    warnings=_sql_outlier_warnings(OUTLIERS)), ("reports",))
def rule_outliers(spark, sf):
    return _flat(V.evaluate(reports(spark, sf).select(*QUALITY_COLUMNS), [
        {"rule_id": "quality_003", "rule_type": "data_quality", "null_threshold": 0.9,
         "outlier_columns": OUTLIERS}]))


@query("C17_rule_outlier_percentage", sql_rule(
    "quality_004", "data_quality", _sql_outside(OUTLIERS, "reports"),
    warnings=_sql_outlier_warnings(OUTLIERS, "0.02")), ("reports",))
def rule_outlier_share(spark, sf):
    return _flat(V.evaluate(reports(spark, sf).select(*QUALITY_COLUMNS), [
        {"rule_id": "quality_004", "rule_type": "data_quality", "null_threshold": 0.9,
         "outlier_columns": OUTLIERS, "outlier_threshold": C.OUTLIER_LIMIT}]))


CONFIG_QUALITY = {
    "id": "data_quality_checks", "type": "quality", "checks": {
        "null_threshold": 0.1, "duplicate_threshold": 0.05,
        "outlier_detection": {"method": "iqr", "threshold": 1.5},
        "completeness": {"minimum_required": 0.95}}}
CONFIG_COLUMNS = ["region", "case_count", "population"]


def _sql_config_warnings():
    out = []
    for c, nulls in zip(CONFIG_COLUMNS, _sql_null_warnings(CONFIG_COLUMNS, 0.1)):
        out += [nulls, (f"1 - n_{c} < 0.95", f"'Column ''{c}'' is ' || "
                        f"printf('%.2f', (1 - n_{c}) * 100) || '% complete (minimum: 95%)'")]
    out.append(("r::DOUBLE / t > 0.05", "'Found ' || r || ' duplicate rows'"))
    return out + _sql_outlier_warnings(["case_count", "population"])


@query("C06_rule_quality_config", sql_rule(
    "data_quality_checks", "data_quality", f"""
  SELECT * FROM (SELECT {_sql_null_ratios(CONFIG_COLUMNS)} FROM reports),
    ({_sql_outside(["case_count", "population"], "reports")}),
    (SELECT {SQL_REPEATED.format(c=", ".join(CONFIG_COLUMNS), v="reports")} AS r)""",
    warnings=_sql_config_warnings()), ("reports",))
def rule_quality_config(spark, sf):
    return _flat(V.evaluate(reports(spark, sf).select(*CONFIG_COLUMNS), [CONFIG_QUALITY]))


ALLOWED = ["Brand#1", "Brand#2", "Brand#3"]


@query("C04_rule_allowed_values", sql_rule("cd_disease_001", "allowed_values", """
  SELECT COUNT(*) FILTER (disease_name NOT IN ('Brand#1', 'Brand#2', 'Brand#3')) AS n
  FROM reports""", warnings=[
    ("n > 0", "'Column ''disease_name'' has ' || n || ' values outside the allowed list'")]),
       ("reports",))
def rule_allowed(spark, sf):
    return _flat(V.evaluate(reports(spark, sf), [{
        "id": "cd_disease_001", "type": "allowed_values", "column": "disease_name",
        "allowed_values": ALLOWED}]))


@query("C04_disallowed_values", """
SELECT disease_name AS value, COUNT(*) AS records FROM reports
WHERE disease_name NOT IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1""", ("reports",))
def disallowed(spark, sf):
    return V.disallowed_values(reports(spark, sf), "disease_name", ALLOWED)


@query("C08_rule_required_nonnull", sql_rule("required", "data_quality", """
  SELECT COUNT(*) - COUNT(case_count) AS a, COUNT(*) - COUNT(report_date) AS b,
         COUNT(*) - COUNT(disease_name) AS c FROM reports""", errors=[
    ("a > 0", "'Column ''case_count'' has ' || a || ' missing values'"),
    ("b > 0", "'Column ''report_date'' has ' || b || ' missing values'"),
    ("c > 0", "'Column ''disease_name'' has ' || c || ' missing values'")]), ("reports",))
def rule_required(spark, sf):
    return _flat(V.evaluate(reports(spark, sf), [{
        "rule_id": "required", "rule_type": "data_quality", "null_threshold": 0.9,
        "required_nonnull": ["case_count", "report_date", "disease_name"]}]))


NAMED = {"validation_rules": {"communicable_disease": {
    "business_rules": [
        {"name": "Date range validation", "field": "report_date",
         "min": "1998-01-01", "max": "current_date"},
        {"name": "Case count range", "field": "case_count", "min": 0, "max": 45},
        {"name": "Valid diseases", "field": "disease_name", "allowed_values": ALLOWED}]}}}

SQL_NAMED = " UNION ALL ".join([
    _sql_date_rule("Date range validation", "1998-01-01", AS_OF),
    sql_rule("Case count range", "business_logic", """
  SELECT COUNT(*) FILTER (case_count < 0) AS a, COUNT(*) FILTER (case_count > 45) AS b
  FROM reports""", warnings=[
        ("a > 0", "'Column ''case_count'' has ' || a || ' values below minimum 0'"),
        ("b > 0", "'Column ''case_count'' has ' || b || ' values above maximum 45'")]),
    sql_rule("Valid diseases", "allowed_values", """
  SELECT COUNT(*) FILTER (disease_name NOT IN ('Brand#1', 'Brand#2', 'Brand#3')) AS n
  FROM reports""", warnings=[
        ("n > 0", "'Column ''disease_name'' has ' || n || ' values outside the allowed list'")])])


@query("C18_rule_named_fields", SQL_NAMED, ("reports",))
def rule_named(spark, sf):
    return _flat(V.evaluate(reports(spark, sf), V.rules_from_document(NAMED), AS_OF))


@query("V08_rule_dispatch", f"""{SQL_NAMED} UNION ALL
SELECT 'odd', 'spelling', 'WARNING', 'Unknown rule type: spelling', '',
       'Unknown rule type: spelling' FROM (SELECT COUNT(*) FROM reports)""", ("reports",))
def rule_dispatch(spark, sf):
    rules = V.rules_from_document(NAMED) + [
        {"rule_id": "odd", "rule_type": "spelling"},
        {"rule_id": "off", "rule_type": "schema", "enabled": False, "required_columns": ["x"]}]
    return _flat(V.evaluate(reports(spark, sf), rules, AS_OF))


@query("C09_rule_enabled_flag", "SELECT rule_id, status FROM (" + sql_rule(
    "on", "data_quality", "SELECT COUNT(*) - COUNT(case_count) AS n FROM reports",
    errors=[("n > 0", "'x'")]) + ")", ("reports",))
def rule_enabled(spark, sf):
    required = {"rule_type": "data_quality", "null_threshold": 0.9,
                "required_nonnull": ["case_count"]}
    return V.evaluate(reports(spark, sf), [
        {**required, "rule_id": "on"}, {**required, "rule_id": "off", "enabled": False},
    ]).select("rule_id", "status")


@query("V09_aggregate_results", f"""
SELECT CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED'
            WHEN bool_or(status = 'WARNING') THEN 'WARNING' ELSE 'PASSED' END AS status,
       CASE WHEN bool_or(status = 'FAILED') THEN 'Validation failed'
            WHEN bool_or(status = 'WARNING') THEN 'Validation passed with warnings'
            ELSE 'All validations passed' END AS message,
       COALESCE(string_agg(NULLIF(errors, ''), '; '), '') AS errors,
       COALESCE(string_agg(NULLIF(warnings, ''), '; ' ORDER BY rule_id), '') AS warnings
FROM ({SQL_NAMED})""", ("reports",))
def merged(spark, sf):
    results = V.evaluate(reports(spark, sf), V.rules_from_document(NAMED), AS_OF)
    return V.aggregate_results(results).select(
        "status", "message", F.array_join("errors", "; ").alias("errors"),
        F.array_join("warnings", "; ").alias("warnings"))


@query("V05_rule_details", "SELECT 'q' AS rule_id, key, ROUND(value, 6) AS value FROM (" +
       " UNION ALL ".join(f"""
  SELECT '{c}_null_ratio' AS key, (COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*) AS value
  FROM reports""" for c in QUALITY_COLUMNS) + f""" UNION ALL
  SELECT 'duplicate_count', ({SQL_REPEATED.format(c=", ".join(QUALITY_COLUMNS), v="reports")})::DOUBLE
  UNION ALL SELECT 'population_outliers', o_population::DOUBLE
  FROM ({_sql_outside(["population"], "reports")}))""", ("reports",))
def rule_details(spark, sf):
    return V.result_details(V.evaluate(reports(spark, sf).select(*QUALITY_COLUMNS), [
        {"rule_id": "q", "rule_type": "data_quality", "check_duplicates": True,
         "outlier_columns": ["population"]}]))
