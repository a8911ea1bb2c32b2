"""Cleaning, typing, business rules and row flags."""

from datetime import datetime

from vigil import constants as C
from vigil.operators import cleaning as P, flags as Q
from workload.registry import query
from workload.views import ALL_TIES, TIES, communicable, doses, reports, samples, table, uploads

from pyspark.sql import functions as F

ROW = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("P01_clean_column_names", """
SELECT c_custkey AS "customer_key", c_name AS "full_name", c_acctbal AS "acct_bal"
FROM customer""")
def clean_names(spark, sf):
    return P.clean_column_names(table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("FULL-NAME"),
        F.col("c_acctbal").alias("acct_bal")))


@query("P02_standardize_column_names", """
SELECT c_custkey AS "nhs_customer_key", c_name AS "full_name", c_acctbal AS "acct_bal"
FROM customer""")
def standard_names(spark, sf):
    return P.standardize_column_names(table(spark, sf, "customer").select(
        F.col("c_custkey").alias("NHSCustomerKey"), F.col("c_name").alias("full - Name"),
        F.col("c_acctbal").alias("acctBal(%)")))


def _sql_int(column: str, kind: str) -> str:
    return (f"try_cast(nullif(regexp_extract(trim({column}), '^([+-]?\\d+)(\\.\\d*)?$', 1), '')"
            f" AS {kind}) AS {column}")


@query("P03_apply_data_types", f"""
SELECT {ROW}, region, disease_name,
       CAST(CAST(CASE WHEN regexp_full_match(report_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
                 THEN report_date END AS DATE) AS VARCHAR) AS report_date,
       {_sql_int("case_count", "INT")}, {_sql_int("death_count", "INT")},
       {_sql_int("population", "BIGINT")},
       ROUND(try_cast(incidence_rate AS DOUBLE), 6) AS incidence_rate
FROM uploads""", ("uploads",))
def data_types(spark, sf):
    return P.apply_data_types(uploads(spark, sf), "communicable_disease")


SQL_DATE = """COALESCE(
  CASE WHEN regexp_full_match(report_date, '\\d{4}-\\d\\d-\\d\\d') THEN try_strptime(report_date, '%Y-%m-%d') END,
  CASE WHEN regexp_full_match(report_date, '\\d\\d/\\d\\d/\\d{4}') THEN try_strptime(report_date, '%d/%m/%Y') END,
  CASE WHEN regexp_full_match(report_date, '\\d\\d/\\d\\d/\\d{4}') THEN try_strptime(report_date, '%m/%d/%Y') END,
  CASE WHEN regexp_full_match(report_date, '\\d\\d-\\d\\d-\\d{4}') THEN try_strptime(report_date, '%d-%m-%Y') END)"""


@query("P04_normalize_dates", f"""
SELECT {ROW}, CAST(CAST({SQL_DATE} AS DATE) AS VARCHAR) AS report_date FROM uploads""",
       ("uploads",))
def normalize_dates(spark, sf):
    return P.normalize_dates(uploads(spark, sf).select(*TIES, "report_date"), ["report_date"])


def sql_map(mapping: dict[str, str], key: str, otherwise: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {key} {cases} ELSE {otherwise} END"


REGION = sql_map(C.REGION_VARIANTS, "lower(region)", "region")
VALID = "(" + ", ".join(f"'{r}'" for r in C.REGIONS) + ")"


@query("P05_validate_regions", f"""
SELECT {ROW}, region, region IN {VALID} AS valid_region
FROM (SELECT {ROW}, {REGION} AS region FROM uploads)""", ("uploads",))
def regions(spark, sf):
    return P.validate_regions(uploads(spark, sf).select(*TIES, "region"))


@query("C01_rename_aliases", f"""
SELECT {ROW}, report_date, region AS area FROM uploads""", ("uploads",))
def aliases(spark, sf):
    named = uploads(spark, sf).select(
        *TIES, F.col("report_date").alias("date_reported"), F.col("region").alias("area"))
    return P.rename_aliases(named)


@query("C02_map_regions", f"""
SELECT {ROW}, {sql_map(C.REGION_ALIASES, "region", "region")} AS region FROM uploads""",
       ("uploads",))
def region_aliases(spark, sf):
    return P.map_regions(uploads(spark, sf).select(*TIES, "region"))


@query("C03_map_diseases", f"""
SELECT {ROW}, {sql_map(C.DISEASE_ALIASES, "lower(disease_name)", "disease_name")} AS disease_name
FROM uploads""", ("uploads",))
def disease_aliases(spark, sf):
    return P.map_diseases(uploads(spark, sf).select(*TIES, "disease_name"))


@query("P06_fill_null_constant", f"""
SELECT {ROW}, CAST(report_date AS VARCHAR) AS report_date,
       COALESCE(region, 'Unknown') AS region, disease_name,
       COALESCE(case_count, 0) AS case_count, death_count, hospitalization_count,
       COALESCE(population, 0) AS population, COALESCE(age, 0) AS age
FROM reports""", ("reports",))
def fill_constant(spark, sf):
    return P.handle_null_values(reports(spark, sf), "fill")


@query("P07_drop_null_rows", f"""
SELECT * REPLACE (CAST(report_date AS VARCHAR) AS report_date) FROM reports
WHERE report_date IS NOT NULL AND region IS NOT NULL AND case_count IS NOT NULL
  AND population IS NOT NULL AND age IS NOT NULL""", ("reports",))
def drop_nulls(spark, sf):
    return P.handle_null_values(reports(spark, sf), "drop")


@query("P08_fill_null_median", f"""
WITH m AS (SELECT quantile_disc(case_count, 0.5) AS cases, quantile_disc(population, 0.5) AS people,
                  quantile_disc(age, 0.5) AS age FROM reports)
SELECT {ROW}, COALESCE(case_count, m.cases) AS case_count,
       COALESCE(population, m.people) AS population, COALESCE(reports.age, m.age) AS age
FROM reports CROSS JOIN m""", ("reports",))
def fill_median(spark, sf):
    columns = ["case_count", "population", "age"]
    return P.fill_null_median(reports(spark, sf).select(*TIES, *columns), columns)


@query("P09_fill_null_unknown", f"""
SELECT {ROW}, COALESCE(region, 'Unknown') AS region, disease_name, case_count FROM reports""",
       ("reports",))
def fill_unknown(spark, sf):
    return P.fill_null_unknown(
        reports(spark, sf).select(*TIES, "region", "disease_name", "case_count"))


SEEN = "CASE WHEN death_count < 8 THEN report_date END"


@query("P10_fill_null_forward", f"""
SELECT {ROW}, region, CAST(report_date AS VARCHAR) AS report_date,
       CAST(COALESCE(seen_date, LAST_VALUE(seen_date IGNORE NULLS) OVER (
         PARTITION BY region ORDER BY report_date NULLS FIRST, {ROW}
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS VARCHAR) AS seen_date
FROM (SELECT *, {SEEN} AS seen_date FROM cd)""", ("cd",))
def fill_forward(spark, sf):
    seen = communicable(spark, sf).select(
        *TIES, "region", "report_date",
        F.when(F.col("death_count") < 8, F.col("report_date")).alias("seen_date"))
    return P.fill_null_forward(seen, "seen_date", ["region"], "report_date", TIES)


@query("P10_fill_forward_by_time", """
SELECT event_id, event_type, LAST_VALUE(CASE WHEN user_id % 50 = 0 THEN event_id END IGNORE NULLS) OVER (
         PARTITION BY event_type ORDER BY ts NULLS FIRST, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_seen
FROM events""")
def fill_forward_by_time(spark, sf):
    seen = table(spark, sf, "events").select(
        "event_id", "event_type", "ts", F.when(F.col("user_id") % 50 == 0, F.col("event_id")).alias("last_seen"))
    filled = P.fill_null_forward(seen, "last_seen", ["event_type"], "ts", ["event_id"])
    return filled.select("event_id", "event_type", "last_seen")


@query("P11_remove_duplicates", """
SELECT DISTINCT * REPLACE (CAST(report_date AS VARCHAR) AS report_date) FROM reports""",
       ("reports",))
def deduplicate(spark, sf):
    return P.remove_duplicates(reports(spark, sf))


def sql_fences(columns, view, quantile="quantile_disc"):
    parts = ", ".join(
        f"{quantile}({c}, 0.25) - 1.5 * ({quantile}({c}, 0.75) - {quantile}({c}, 0.25)) AS {c}_lo, "
        f"{quantile}({c}, 0.75) + 1.5 * ({quantile}({c}, 0.75) - {quantile}({c}, 0.25)) AS {c}_hi"
        for c in columns)
    return f"(SELECT {parts} FROM {view})"


CAPPED = ["case_count", "death_count", "population"]


@query("P12_cap_outliers_iqr", f"SELECT {ROW}, " + ", ".join(
    f"CAST(CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END AS DOUBLE)"
    f" AS {c}" for c in CAPPED) + f"""
FROM reports CROSS JOIN {sql_fences(CAPPED, "reports")}""", ("reports",))
def cap_outliers(spark, sf):
    return P.cap_outliers_iqr(reports(spark, sf).select(*TIES, *CAPPED), CAPPED)


RUN = datetime(2025, 1, 31, 12, 0, 0)


@query("P13_add_metadata", f"""
SELECT {ROW}, '2025-01-31 12:00:00' AS etl_timestamp, '2025-01-31' AS etl_date, 'nightly' AS etl_job_name,
       'surveillance' AS source_system, '1.0' AS data_version FROM cd""", ("cd",))
def metadata(spark, sf):
    return P.add_metadata(communicable(spark, sf).select(*TIES), "nightly", "surveillance", RUN)


@query("P14_add_audit_columns", f"""
SELECT {ROW}, '2025-01-31 12:00:00' AS etl_timestamp, '2025-01-31' AS etl_date,
       'surveillance' AS source_system, '1.0' AS data_version FROM cd""", ("cd",))
def audit_columns(spark, sf):
    return P.add_audit_columns(communicable(spark, sf).select(*TIES), "surveillance", RUN)


CLAMPED = "CASE WHEN case_count < 0 THEN 0 ELSE case_count END"


@query("P15_clamp_negative", f"SELECT {ROW}, {CLAMPED} AS case_count FROM reports", ("reports",))
def clamp(spark, sf):
    return P.clamp_negative_cases(reports(spark, sf).select(*TIES, "case_count"))


def sql_rate(cases="case_count"):
    return (f"ROUND(CASE WHEN population <> 0 THEN CAST({cases} AS DOUBLE) / population * 100000"
            f" END, 6) AS incidence_rate")


@query("P16_incidence_rate", f"""
SELECT {ROW}, case_count, population, {sql_rate()} FROM reports""", ("reports",))
def incidence(spark, sf):
    return P.add_incidence_rate(reports(spark, sf).select(*TIES, "case_count", "population"))


@query("P17_filter_dose_range", """
SELECT * REPLACE (CAST(vaccination_date AS VARCHAR) AS vaccination_date) FROM doses
WHERE dose_number BETWEEN 1 AND 5""", ("doses",))
def dose_range(spark, sf):
    return P.filter_dose_range(doses(spark, sf))


POSITIVITY = """
SELECT event_id, CAST(surveillance_date AS VARCHAR) AS surveillance_date, sample_count,
       positive_count,
       ROUND(CASE WHEN sample_count > 0 THEN CAST(positive_count AS DOUBLE) / sample_count * 100
                  ELSE 0 END, 6) AS positivity_rate
FROM samples"""


@query("P18_positivity_rate", POSITIVITY, ("samples",))
def positivity(spark, sf):
    return P.add_positivity_rate(samples(spark, sf))


FATALITY = """ROUND(CASE WHEN case_count > 0 THEN CAST(death_count AS DOUBLE) / case_count * 100
  ELSE 0 END, 6) AS case_fatality_rate"""


@query("P19_case_fatality_rate",
       f"SELECT {ROW}, case_count, death_count, {FATALITY} FROM reports", ("reports",))
def fatality(spark, sf):
    return P.add_case_fatality_rate(reports(spark, sf).select(*TIES, "case_count", "death_count"))


AGE_GROUP = """CASE WHEN age < 18 THEN '0-17' WHEN age < 30 THEN '18-29' WHEN age < 50 THEN '30-49'
  WHEN age < 70 THEN '50-69' ELSE '70+' END AS age_group"""


@query("P20_age_group", f"SELECT {ROW}, age, {AGE_GROUP} FROM reports", ("reports",))
def age_groups(spark, sf):
    return P.add_age_group(reports(spark, sf).select(*TIES, "age"))


def sql_rolling(key, cases):
    return f"""ROUND(AVG({cases}) OVER (PARTITION BY {key} ORDER BY report_date NULLS FIRST, {ROW},
      case_count NULLS FIRST, death_count NULLS FIRST, population NULLS FIRST
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS seven_day_avg"""


@query("P21_apply_business_rules", f"""
SELECT * REPLACE (CAST(report_date AS VARCHAR) AS report_date),
       {sql_rolling("disease_name", "case_count")}, {sql_rate()}
FROM (SELECT DISTINCT * REPLACE ({CLAMPED} AS case_count) FROM reports)""", ("reports",))
def business_rules(spark, sf):
    return P.apply_business_rules(P.remove_duplicates(reports(spark, sf)),
                                  "communicable_disease", ALL_TIES)


@query("P21_apply_business_rules_doses", """
SELECT * REPLACE (CAST(vaccination_date AS VARCHAR) AS vaccination_date),
       CAST(SUM(dose_count) OVER (PARTITION BY age_group, vaccine_type) AS BIGINT)
         AS cumulative_doses
FROM doses WHERE dose_number BETWEEN 1 AND 5""", ("doses",))
def business_rules_doses(spark, sf):
    return P.apply_business_rules(doses(spark, sf), "immunisation", ["o_orderkey"])


@query("P21_apply_business_rules_samples", POSITIVITY, ("samples",))
def business_rules_samples(spark, sf):
    return P.apply_business_rules(samples(spark, sf), "surveillance", ["event_id"])


@query("P22_derived_metrics", f"""
SELECT * REPLACE (CAST(report_date AS VARCHAR) AS report_date), {FATALITY},
       {sql_rolling("region", "case_count")}, {AGE_GROUP}
FROM (SELECT DISTINCT * FROM reports)""", ("reports",))
def derived(spark, sf):
    return P.derived_metrics(P.remove_duplicates(reports(spark, sf)), ALL_TIES)


# --- row flags ------------------------------------------------------------------

MISSING = "(report_date IS NULL OR region IS NULL OR case_count IS NULL) AS has_missing_critical"


@query("F01_flag_missing_critical", f"""
SELECT {ROW}, CAST(report_date AS VARCHAR) AS report_date, region, case_count, {MISSING}
FROM reports""", ("reports",))
def missing_critical(spark, sf):
    return Q.flag_missing_critical(
        reports(spark, sf).select(*TIES, "report_date", "region", "case_count"))


@query("F02_flag_outlier", f"""
SELECT {ROW}, population AS case_count,
       population < population_lo OR population > population_hi AS is_outlier
FROM reports CROSS JOIN {sql_fences(["population"], "reports")}""", ("reports",))
def outlier(spark, sf):
    return Q.flag_outlier(reports(spark, sf).select(
        *TIES, F.col("population").alias("case_count")))


COPIES = "COUNT(*) OVER (PARTITION BY report_date, region, disease_name) > 1 AS is_duplicate"


@query("F03_flag_duplicate", f"""
SELECT {ROW}, CAST(report_date AS VARCHAR) AS report_date, region, disease_name, {COPIES}
FROM reports""", ("reports",))
def duplicate(spark, sf):
    return Q.flag_duplicate(reports(spark, sf).select(
        *TIES, "report_date", "region", "disease_name"))


FLAGGED = f"""
WITH typed AS (
  SELECT {ROW}, {SQL_DATE} AS report_date, {REGION} AS region, disease_name,
         {_sql_int("case_count", "INT")} FROM uploads),
flags AS (
  SELECT {ROW}, region, case_count, region IN {VALID} AS valid_region, {MISSING},
         case_count < case_count_lo OR case_count > case_count_hi AS is_outlier, {COPIES}
  FROM typed CROSS JOIN {sql_fences(["case_count"], "typed")})
SELECT *, CASE WHEN has_missing_critical THEN 0.0::DOUBLE WHEN is_outlier THEN 0.7::DOUBLE
               WHEN is_duplicate THEN 0.8::DOUBLE WHEN NOT valid_region THEN 0.9::DOUBLE
               ELSE 1.0::DOUBLE END AS quality_score
FROM flags"""


def _typed_uploads(spark, sf):
    typed = P.normalize_dates(uploads(spark, sf), ["report_date"])
    return P.apply_data_types(typed, "communicable_disease").select(
        *TIES, "report_date", "region", "disease_name", "case_count")


@query("F05_apply_quality_flags", FLAGGED, ("uploads",))
def quality_flags(spark, sf):
    return Q.apply_quality_flags(_typed_uploads(spark, sf)).drop("report_date", "disease_name")


@query("F04_quality_score", f"""
SELECT quality_score, COUNT(*) AS records FROM ({FLAGGED}) GROUP BY 1""", ("uploads",))
def score(spark, sf):
    return Q.apply_quality_flags(_typed_uploads(spark, sf)) \
        .groupBy("quality_score").agg(F.count(F.lit(1)).alias("records"))
