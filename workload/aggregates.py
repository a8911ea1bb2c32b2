"""Aggregates and windows."""

from datetime import date

from vigil.operators import aggregates as A, cleaning as P, windows as W
from workload.registry import query
from workload.views import TIES, communicable, doses, table

from pyspark.sql import functions as F

AS_OF = date(2001, 11, 4)

RATE = "CAST(case_count AS DOUBLE) / population * 100000"


@query("A01_etl_weekly", f"""
SELECT CAST(weekofyear(report_date) AS INT) AS week, CAST(year(report_date) AS INT) AS year,
       disease_name, CAST(SUM(case_count) AS BIGINT) AS total_cases,
       CAST(SUM(death_count) AS BIGINT) AS total_deaths,
       ROUND(AVG({RATE}), 6) AS avg_incidence_rate
FROM cd GROUP BY 1, 2, 3""", ("cd",))
def etl_weekly(spark, sf):
    return A.etl_weekly(P.add_incidence_rate(communicable(spark, sf)))


@query("A01_etl_weekly_iso_year", f"""
SELECT CAST(weekofyear(report_date) AS INT) AS week, CAST(isoyear(report_date) AS INT) AS year,
       disease_name, CAST(SUM(case_count) AS BIGINT) AS total_cases,
       CAST(SUM(death_count) AS BIGINT) AS total_deaths,
       ROUND(AVG({RATE}), 6) AS avg_incidence_rate
FROM cd GROUP BY 1, 2, 3""", ("cd",))
def etl_weekly_iso(spark, sf):
    return A.etl_weekly(P.add_incidence_rate(communicable(spark, sf)), year_mode="iso")


@query("A02_etl_regional", f"""
SELECT region, disease_name, CAST(SUM(case_count) AS BIGINT) AS total_cases,
       ROUND(AVG({RATE}), 6) AS avg_incidence_rate
FROM cd GROUP BY 1, 2""", ("cd",))
def etl_regional(spark, sf):
    return A.etl_regional(P.add_incidence_rate(communicable(spark, sf)))


@query("A03_daily", """
SELECT strftime(report_date, '%Y-%m-%d') AS date, region, disease_name,
       CAST(SUM(case_count) AS BIGINT) AS total_cases,
       CAST(SUM(death_count) AS BIGINT) AS total_deaths,
       CAST(SUM(hospitalization_count) AS BIGINT) AS total_hospitalizations,
       COUNT(*) AS record_count, ROUND(AVG(case_count), 6) AS avg_cases,
       ROUND(STDDEV(case_count), 6) AS stddev_cases,
       MIN(case_count) AS min_cases, MAX(case_count) AS max_cases,
       'daily' AS aggregation_level
FROM cd GROUP BY 1, 2, 3""", ("cd",))
def daily(spark, sf):
    return A.daily(communicable(spark, sf))


WEEKLY = """
SELECT CAST(date_trunc('week', report_date) AS DATE) AS week_start, region, disease_name,
       CAST(SUM(case_count) AS BIGINT) AS total_cases,
       CAST(SUM(death_count) AS BIGINT) AS total_deaths, AVG(case_count) AS avg_daily_cases,
       array_to_string(list_sort(list(CAST(report_date AS VARCHAR))), ',') AS dates_included,
       'weekly' AS aggregation_level
FROM cd GROUP BY 1, 2, 3"""


def _dates_as_text(weekly):
    return A.expand_dates(weekly).withColumn("dates_included", F.array_join(
        F.transform("dates_included", lambda d: d.cast("string")), ","))


@query("A04_weekly", f"""
SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start,
                  ROUND(avg_daily_cases, 6) AS avg_daily_cases)
FROM ({WEEKLY})""", ("cd",))
def weekly(spark, sf):
    return _dates_as_text(A.weekly(communicable(spark, sf)))


@query("W04_wow_change_pct", f"""
WITH weeks AS ({WEEKLY}), previous AS (
  SELECT *, LAG(total_cases) OVER (PARTITION BY region, disease_name ORDER BY week_start)
              AS prev_week_cases FROM weeks)
SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start,
                  ROUND(avg_daily_cases, 6) AS avg_daily_cases),
       ROUND(CASE WHEN prev_week_cases <> 0 THEN
             CAST(total_cases - prev_week_cases AS DOUBLE) / prev_week_cases * 100 END, 6)
         AS week_over_week_change
FROM previous""", ("cd",))
def weekly_change(spark, sf):
    return W.weekly_change_pct(_dates_as_text(A.weekly(communicable(spark, sf))))


@query("A05_monthly", """
SELECT strftime(report_date, '%Y-%m') AS month, region, disease_name,
       CAST(SUM(case_count) AS BIGINT) AS total_cases,
       CAST(SUM(death_count) AS BIGINT) AS total_deaths,
       ROUND(AVG(case_count), 6) AS avg_daily_cases,
       CAST(MIN(report_date) AS VARCHAR) AS period_start,
       CAST(MAX(report_date) AS VARCHAR) AS period_end, 'monthly' AS aggregation_level
FROM cd GROUP BY 1, 2, 3""", ("cd",))
def monthly(spark, sf):
    return A.monthly(communicable(spark, sf))


REGION_WEEKS = """
SELECT CAST(year(report_date) AS INT) AS year, CAST(weekofyear(report_date) AS INT) AS week,
       region, CAST(SUM(case_count) AS BIGINT) AS weekly_cases,
       CAST(SUM(death_count) AS BIGINT) AS weekly_deaths,
       ROUND(AVG(case_count), 6) AS avg_daily_cases,
       MAX(case_count) AS max_daily_cases, MIN(case_count) AS min_daily_cases,
       COUNT(*) AS days_reported
FROM cd GROUP BY 1, 2, 3"""


@query("A06_lib_weekly", REGION_WEEKS, ("cd",))
def region_weeks(spark, sf):
    return A.region_weeks(communicable(spark, sf))


@query("W05_lib_wow", f"""
WITH weeks AS ({REGION_WEEKS}), previous AS (
  SELECT *, LAG(weekly_cases) OVER (PARTITION BY region ORDER BY year, week) AS p FROM weeks)
SELECT * EXCLUDE (p), weekly_cases - p AS wow_change,
       ROUND(CASE WHEN p > 0 THEN CAST(weekly_cases - p AS DOUBLE) / p * 100 END, 6)
         AS wow_change_pct
FROM previous""", ("cd",))
def week_over_week(spark, sf):
    return W.week_over_week(A.region_weeks(communicable(spark, sf)))


REGION_MONTHS = """
SELECT CAST(year(report_date) AS INT) AS year, CAST(month(report_date) AS INT) AS month,
       region, CAST(SUM(case_count) AS BIGINT) AS monthly_cases,
       CAST(SUM(death_count) AS BIGINT) AS monthly_deaths,
       ROUND(AVG(case_count), 6) AS avg_daily_cases,
       ROUND(STDDEV(case_count), 6) AS stddev_daily_cases, COUNT(*) AS days_reported,
       COUNT(DISTINCT disease_name) AS unique_diseases
FROM cd GROUP BY 1, 2, 3"""


@query("A07_lib_monthly", REGION_MONTHS, ("cd",))
def region_months(spark, sf):
    return A.region_months(communicable(spark, sf))


@query("W06_lib_mom", f"""
WITH months AS ({REGION_MONTHS}), previous AS (
  SELECT *, LAG(monthly_cases) OVER (PARTITION BY region ORDER BY year, month) AS p FROM months)
SELECT * EXCLUDE (p), monthly_cases - p AS mom_change,
       ROUND(CASE WHEN p > 0 THEN CAST(monthly_cases - p AS DOUBLE) / p * 100 END, 6)
         AS mom_change_pct
FROM previous""", ("cd",))
def month_over_month(spark, sf):
    return W.month_over_month(A.region_months(communicable(spark, sf)))


@query("W07_lib_yoy", f"""
SELECT *, monthly_cases - LAG(monthly_cases) OVER (PARTITION BY region, month ORDER BY year)
            AS yoy_change
FROM ({REGION_MONTHS})""", ("cd",))
def year_over_year(spark, sf):
    return W.year_over_year(A.region_months(communicable(spark, sf)))


REGION_STATS = """
SELECT *, ROUND(CASE WHEN total_cases > 0 THEN CAST(total_deaths AS DOUBLE) / total_cases * 100
                     ELSE 0 END, 6) AS case_fatality_rate
FROM (SELECT region, CAST(SUM(case_count) AS BIGINT) AS total_cases,
             CAST(SUM(death_count) AS BIGINT) AS total_deaths,
             ROUND(AVG(case_count), 6) AS avg_cases_per_day, COUNT(*) AS reports_submitted
      FROM cd GROUP BY region)"""


@query("A08_lib_regional_stats", REGION_STATS, ("cd",))
def region_stats(spark, sf):
    return A.region_stats(communicable(spark, sf))


@query("W09_lib_region_ranks", f"""
SELECT *, CAST(RANK() OVER (ORDER BY total_cases DESC) AS INT) AS cases_rank,
       CAST(RANK() OVER (ORDER BY case_fatality_rate DESC) AS INT) AS cfr_rank,
       CAST(RANK() OVER (ORDER BY reports_submitted DESC) AS INT) AS reporting_rank
FROM ({REGION_STATS})""", ("cd",))
def region_ranks(spark, sf):
    return W.rank_regions(A.region_stats(communicable(spark, sf)))


@query("W08_daily_region_rank", """
WITH totals AS (SELECT report_date, region, CAST(SUM(case_count) AS BIGINT) AS total_cases
                FROM cd GROUP BY 1, 2)
SELECT CAST(report_date AS VARCHAR) AS report_date, region, total_cases,
       CAST(RANK() OVER w AS INT) AS rank, ROUND(PERCENT_RANK() OVER w, 6) AS percentile
FROM totals WINDOW w AS (PARTITION BY report_date ORDER BY total_cases DESC)""", ("cd",))
def daily_region_rank(spark, sf):
    return W.rank_regions_per_day(A.region_days(communicable(spark, sf)))


SUMMARISED = ["case_count", "death_count", "population"]


@query("A09_summary_statistics", "SELECT disease_name, COUNT(*) AS record_count, " + ", ".join(
    f"CAST(SUM({c}) AS BIGINT) AS {c}_sum, ROUND(AVG({c}), 6) AS {c}_avg, MIN({c}) AS {c}_min, "
    f"MAX({c}) AS {c}_max, ROUND(STDDEV({c}), 6) AS {c}_stddev" for c in SUMMARISED) + """,
       CAST(MIN(report_date) AS VARCHAR) AS earliest_date,
       CAST(MAX(report_date) AS VARCHAR) AS latest_date
FROM cd GROUP BY disease_name""", ("cd",))
def summary_statistics(spark, sf):
    cd = communicable(spark, sf).select("disease_name", "report_date", *SUMMARISED)
    return A.summary_statistics(cd, ["disease_name"])


@query("A10_saved_daily_summary", f"""
SELECT CAST(report_date AS VARCHAR) AS date, region,
       CAST(SUM(case_count) AS BIGINT) AS total_cases,
       CAST(SUM(death_count) AS BIGINT) AS total_deaths, ROUND(AVG(case_count), 6) AS avg_cases
FROM cd WHERE report_date >= DATE '{AS_OF}' - INTERVAL 30 DAY
GROUP BY report_date, region ORDER BY report_date DESC, region""", ("cd",))
def saved_daily_summary(spark, sf):
    return A.saved_daily_summary(spark, communicable(spark, sf), AS_OF)


ROLLING = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, case_count, {key},
       ROUND(AVG(case_count) OVER (
         PARTITION BY {key} ORDER BY report_date NULLS FIRST, l_orderkey, l_linenumber,
         l_partkey, l_suppkey ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS seven_day_avg
FROM {view}"""


@query("W01_rolling7_by_disease", ROLLING.format(key="disease_name", view="cd"), ("cd",))
def rolling_by_disease(spark, sf):
    rolled = W.rolling_average(communicable(spark, sf), ["disease_name"], TIES)
    return rolled.select(*TIES, "case_count", "disease_name", "seven_day_avg")


@query("W03_rolling7_by_region", ROLLING.format(key="region", view="cd"), ("cd",))
def rolling_by_region(spark, sf):
    rolled = W.rolling_average(communicable(spark, sf), ["region"], TIES)
    return rolled.select(*TIES, "case_count", "region", "seven_day_avg")


@query("W01_rolling7_by_time", """
SELECT event_id, event_type, ROUND(AVG(CAST(user_id % 2 = 0 AS INT)) OVER (
         PARTITION BY event_type ORDER BY ts NULLS FIRST, event_id
         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS even_share
FROM events""")
def rolling_by_time(spark, sf):
    """Along timestamps: chunks are ranges of (event_type, ts, event_id)."""
    events = table(spark, sf, "events").withColumn("even", (F.col("user_id") % 2 == 0).cast("int"))
    rolled = W.rolling_average(events, ["event_type"], ["event_id"], "ts", "even", name="even_share")
    return rolled.select("event_id", "event_type", "even_share")


@query("W02_cumulative_doses", """
SELECT *, CAST(SUM(dose_count) OVER (PARTITION BY age_group, vaccine_type) AS BIGINT)
            AS cumulative_doses
FROM (SELECT * REPLACE (CAST(vaccination_date AS VARCHAR) AS vaccination_date) FROM doses)""",
       ("doses",))
def cumulative_doses(spark, sf):
    return W.total_doses(doses(spark, sf))
