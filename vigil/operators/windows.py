"""Rolling averages, group totals, period changes and ranks."""

from pyspark.sql import DataFrame, Window, functions as F

from vigil.functions import measures
from vigil.plans import chunks, skew


def rolling_average(df: DataFrame, partition_by: list[str], tie_break: list[str],
                    order_by: str = "report_date", value: str = "case_count",
                    rows: int = 7, name: str = "seven_day_avg",
                    chunk_rows: int | None = None) -> DataFrame:
    """Mean of the last `rows` rows per partition (rows, not days).

    tie_break makes the order total.
    """
    chunked = chunks.cut(df, partition_by, order_by, tie_break, chunk_rows)
    return chunks.rolling(chunked, value, name, rows)


def total_doses(df: DataFrame, hot_rows: int = skew.HOT_GROUP_ROWS) -> DataFrame:
    """Total (not running) doses of the row's age group and vaccine."""
    return skew.with_group_value(df, ["age_group", "vaccine_type"], "cumulative_doses",
                                 F.sum("dose_count"), hot_rows)


def _previous(measure: str, partition_by: list[str], order_by: list[str]):
    return F.lag(measure).over(Window.partitionBy(*partition_by).orderBy(*order_by))


def weekly_change_pct(weekly: DataFrame) -> DataFrame:
    """Percent change to the previous reported week of a region and disease."""
    return weekly.withColumn(
        "prev_week_cases",
        _previous("total_cases", ["region", "disease_name"], ["week_start"])
    ).withColumn(
        "week_over_week_change",
        measures.change_pct(F.col("total_cases"), F.col("prev_week_cases")))


def _change(df: DataFrame, measure: str, prefix: str, order_by: list[str]) -> DataFrame:
    current, previous = F.col(measure), F.col("__previous")
    return (
        df.withColumn("__previous", _previous(measure, ["region"], order_by))
        .withColumn(f"{prefix}_change", current - previous)
        .withColumn(f"{prefix}_change_pct",
                    F.when(previous > 0, measures.change_pct(current, previous)))
        .drop("__previous")
    )


def week_over_week(weekly: DataFrame) -> DataFrame:
    return _change(weekly, "weekly_cases", "wow", ["year", "week"])


def month_over_month(monthly: DataFrame) -> DataFrame:
    return _change(monthly, "monthly_cases", "mom", ["year", "month"])


def year_over_year(monthly: DataFrame) -> DataFrame:
    """Change to the same month of the previous reported year."""
    previous = _previous("monthly_cases", ["region", "month"], ["year"])
    return monthly.withColumn("yoy_change", F.col("monthly_cases") - previous)


def rank_regions_per_day(totals: DataFrame) -> DataFrame:
    """Rank and percent rank of regions by cases on each day."""
    by_cases = Window.partitionBy("report_date").orderBy(F.desc("total_cases"))
    return totals.withColumns({
        "rank": F.rank().over(by_cases),
        "percentile": F.percent_rank().over(by_cases),
    })


def rank_regions(stats: DataFrame) -> DataFrame:
    """Overall ranks by cases, fatality and reports; the input is one row per region."""
    return stats.withColumns({
        "cases_rank": F.rank().over(Window.orderBy(F.desc("total_cases"))),
        "cfr_rank": F.rank().over(Window.orderBy(F.desc("case_fatality_rate"))),
        "reporting_rank": F.rank().over(Window.orderBy(F.desc("reports_submitted"))),
    })
