from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vigil.functions import dates, measures, text
from vigil.operators import aggregates, cleaning, flags, windows


def values(df, column):
    return [r[column] for r in df.collect()]


def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Report Date", "CASE-count", "x"])
    assert cleaning.clean_column_names(df).columns == ["report_date", "case_count", "x"]


@pytest.mark.parametrize("name, expected", [
    ("reportDate", "report_date"), ("NHSNumber", "nhs_number"), ("Case Count", "case_count"),
    ("case--count", "case_count"), ("ICD10Code", "icd10_code"), ("rate(%)", "rate"),
    ("a.b", "ab"), ("already_snake", "already_snake"), ("X", "x"), ("caseCountUK", "case_count_uk"),
])
def test_snake_case(name, expected):
    assert cleaning.snake_case(name) == expected


def test_name_collisions_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["Case Count", "case-count"])
    with pytest.raises(ValueError, match="case_count"):
        cleaning.clean_column_names(df)
    with pytest.raises(ValueError, match="case_count"):
        cleaning.standardize_column_names(df)


def test_aliases(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["date_reported", "vacc_date", "other"])
    assert cleaning.rename_aliases(df).columns == ["report_date", "vaccination_date", "other"]
    with pytest.raises(ValueError, match="report_date"):
        cleaning.rename_aliases(spark.createDataFrame([(1, 2)], ["date", "report_dt"]))


def test_types(spark):
    df = spark.createDataFrame(
        [("2025-01-31", "12.7", " 5 ", "1e3", "x"), ("31/01/2025", "n/a", "-3", "2.5", "y"),
         (None, "99999999999", "+4", None, "z")],
        ["report_date", "case_count", "death_count", "incidence_rate", "untouched"])
    typed = cleaning.apply_data_types(df, "communicable_disease")
    assert typed.dtypes == [("report_date", "date"), ("case_count", "int"), ("death_count", "int"),
                            ("incidence_rate", "double"), ("untouched", "string")]
    assert [tuple(r) for r in typed.collect()] == [
        (date(2025, 1, 31), 12, 5, 1000.0, "x"), (None, None, -3, 2.5, "y"),
        (None, None, 4, None, "z")]
    assert cleaning.apply_data_types(df, "laboratory").dtypes == df.dtypes


def test_dates(spark):
    written = ["2025-02-01", "01/02/2025", "02/13/2025", "13-02-2025", "junk", None, "1/2/2025"]
    df = spark.createDataFrame([(w,) for w in written], "d string")
    assert values(cleaning.normalize_dates(df, ["d", "absent"]), "d") == [
        date(2025, 2, 1), date(2025, 2, 1), date(2025, 2, 13), date(2025, 2, 13), None, None, None]
    valid = df.select(dates.is_date(F.col("d")).alias("v"))
    assert values(valid, "v") == [True, False, False, False, False, False, False]
    padded = spark.createDataFrame([("2025-1-1",), ("01/02/2025",)], "d string")
    assert values(padded.select(dates.is_date(F.col("d")).alias("v")), "v") == [True, False]
    british = padded.select(dates.is_date(F.col("d"), "%d/%m/%Y").alias("v"))
    assert values(british, "v") == [False, True]


def test_iso_week_at_the_end_of_a_year(spark):
    df = spark.createDataFrame([(date(2024, 12, 30), "London", "x", 1, 1, 1.0)],
                               "report_date date, region string, disease_name string, "
                               "case_count int, death_count int, incidence_rate double")
    calendar = aggregates.etl_weekly(df).first()
    iso = aggregates.etl_weekly(df, "iso").first()
    assert (calendar.week, calendar.year, iso.week, iso.year) == (1, 2024, 1, 2025)
    with pytest.raises(ValueError):
        aggregates.etl_weekly(df, "fiscal")


def test_regions(spark):
    df = spark.createDataFrame([("LONDON",), ("ni",), ("Wales",), ("Manchester",), (None,)],
                               "region string")
    got = cleaning.validate_regions(df).collect()
    assert [tuple(r) for r in got] == [
        ("London", True), ("Northern Ireland", True), ("Wales", True), ("Manchester", False),
        (None, None)]
    exact = spark.createDataFrame([("SE",), ("se",), ("NI",)], "region string")
    assert values(cleaning.map_regions(exact), "region") == ["South East", "se", "Northern Ireland"]


def test_null_strategies(spark):
    df = spark.createDataFrame([(1, "a", 1.5, date(2025, 1, 1)), (None, None, None, None)],
                               "n int, s string, d double, day date")
    assert tuple(cleaning.handle_null_values(df).collect()[1]) == (0, "Unknown", 0.0, None)
    assert cleaning.handle_null_values(df, "drop").count() == 1
    assert cleaning.handle_null_values(df, "none").count() == 2


def test_median_ignores_columns_without_values(spark):
    df = spark.createDataFrame([(1, None), (9, None), (None, None), (3, None)], "a int, b int")
    assert values(cleaning.fill_null_median(df), "a") == [1, 9, 3, 3]
    assert values(cleaning.fill_null_median(df), "b") == [None] * 4


def test_capping_keeps_nulls_and_optionally_types(spark):
    rows = [(v,) for v in [None, 1, 2, 3, 4, 5, 6, 7, 8, 1000]]
    df = spark.createDataFrame(rows, "v int")
    capped = cleaning.cap_outliers_iqr(df)
    assert capped.dtypes == [("v", "double")] and values(capped, "v")[0] is None
    assert values(capped, "v")[-1] == 13.0  # q1 = 3, q3 = 7
    assert cleaning.cap_outliers_iqr(df, keep_type=True).dtypes == [("v", "int")]


def test_rates_with_zero_denominators(spark):
    df = spark.createDataFrame([(5, 0), (0, 10), (None, 10), (5, None)],
                               "case_count int, population int")
    assert values(cleaning.add_incidence_rate(df), "incidence_rate") == [None, 0.0, None, None]
    present = df.withColumn("incidence_rate", F.lit(1.0))
    assert values(cleaning.add_incidence_rate(present), "incidence_rate") == [1.0] * 4
    tests = df.toDF("positive_count", "sample_count")
    assert values(cleaning.add_positivity_rate(tests), "positivity_rate") == [0.0, 0.0, None, 0.0]


def test_age_bands(spark):
    ages = [0, 17, 18, 29, 30, 49, 50, 69, 70, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    bands = ["0-17", "0-17", "18-29", "18-29", "30-49", "30-49", "50-69", "50-69", "70+"]
    assert values(cleaning.add_age_group(df), "age_group") == bands + ["70+"]
    assert values(cleaning.add_age_group(df, "Unknown"), "age_group") == bands + ["Unknown"]


def test_negative_counts(spark):
    df = spark.createDataFrame([(-1,), (None,), (2,)], "case_count int")
    assert values(cleaning.clamp_negative_cases(df), "case_count") == [0, None, 2]


def test_dose_range_drops_missing_numbers(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "dose_number int")
    assert values(cleaning.filter_dose_range(df), "dose_number") == [1, 5]


def test_business_rules_by_dataset(spark, reports):
    ruled = cleaning.apply_business_rules(reports, "communicable_disease", ["case_count"])
    assert "seven_day_avg" in ruled.columns and "incidence_rate" not in ruled.columns
    assert cleaning.apply_business_rules(reports, "laboratory", []).columns == reports.columns


def test_derived_metrics_need_their_columns(reports):
    derived = cleaning.derived_metrics(reports, ["case_count"])
    assert derived.columns == reports.columns + ["case_fatality_rate", "seven_day_avg"]
    assert cleaning.derived_metrics(reports.select("region"), []).columns == ["region"]


def test_metadata(reports):
    run = datetime(2025, 1, 31, 8)
    row = cleaning.add_metadata(reports, "job", "system", run).first()
    assert (row.etl_timestamp, row.etl_date, row.etl_job_name, row.source_system,
            row.data_version) == (run, run.date(), "job", "system", "1.0")


def test_flags_and_score(spark, reports):
    more = spark.createDataFrame(
        [(None, "London", "COVID-19", 100, 1, 1), (date(2025, 1, 9), "Leeds", "RSV", 100, 1, 1),
         (date(2025, 1, 8), "Wales", "RSV", 9000, 1, 1)], reports.schema)
    scored = flags.apply_quality_flags(reports.unionByName(more))
    got = {(r.report_date, r.region, r.case_count): r.quality_score for r in scored.collect()}
    assert got[None, "London", 100] == 0.0
    assert got[date(2025, 1, 8), "Wales", 9000] == 0.7
    assert got[date(2025, 1, 1), "London", 150] == 0.8
    assert got[date(2025, 1, 9), "Leeds", 100] == 0.9
    assert got[date(2025, 1, 5), "Wales", 160] == 1.0


def test_flags_without_any_value(spark):
    df = spark.createDataFrame([(None, None, None, None)],
                               "report_date date, region string, disease_name string, case_count int")
    row = flags.apply_quality_flags(df).first()
    assert row.has_missing_critical and not row.is_outlier and row.quality_score == 0.0


def test_weekly_change_after_a_week_without_cases(spark):
    df = spark.createDataFrame(
        [(date(2025, 1, 6), "L", "x", 0), (date(2025, 1, 13), "L", "x", 5),
         (date(2025, 2, 3), "L", "x", 10)],
        "week_start date, region string, disease_name string, total_cases int")
    changed = windows.weekly_change_pct(df).orderBy("week_start").collect()
    assert [r.week_over_week_change for r in changed] == [None, None, 100.0]


def test_weekly_dates(reports):
    weeks = aggregates.weekly(reports).where("region = 'London' AND disease_name = 'COVID-19'")
    row = weeks.first()
    assert [(d.report_date, d.records) for d in row.dates_included] == [
        (date(2025, 1, 1), 2), (date(2025, 1, 4), 1)]
    flat = aggregates.expand_dates(weeks).first().dates_included
    assert flat == [date(2025, 1, 1), date(2025, 1, 1), date(2025, 1, 4)]


def test_reports_from_day_totals_equal_direct_ones(reports):
    days = aggregates.day_totals(reports)
    pairs = [(aggregates.daily_of(days), aggregates.daily(reports)),
             (aggregates.monthly_of(days), aggregates.monthly(reports)),
             (aggregates.region_weeks_of(days), aggregates.region_weeks(reports)),
             (aggregates.region_stats_of(days), aggregates.region_stats(reports)),
             (aggregates.region_days_of(days), aggregates.region_days(reports))]
    for derived, direct in pairs:
        assert sorted(map(str, derived.select(direct.columns).collect())) == \
            sorted(map(str, direct.collect()))
    merged = {r.region: r for r in aggregates.region_months_of(days).collect()}
    for r in aggregates.region_months(reports).collect():
        assert merged[r.region].stddev_daily_cases == pytest.approx(r.stddev_daily_cases)
        assert merged[r.region].unique_diseases == r.unique_diseases


def test_daily_summary_window(spark, reports):
    summary = aggregates.saved_daily_summary(spark, reports, date(2025, 2, 2)).collect()
    assert [(r.date, r.region) for r in summary] == [
        (date(2025, 1, 5), "Wales"), (date(2025, 1, 4), "London"), (date(2025, 1, 4), "Scotland"),
        (date(2025, 1, 3), "London"), (date(2025, 1, 3), "Wales")]


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [("in/My  file (1)!.CSV",), ("a.b/noext",), ("x/.hidden",), ("lab/available.json",),
         ("collab/x.xml",), ("Outbreak-7/a.tar.gz",)], "p string")
    rows = df.select(
        text.file_extension(F.col("p")).alias("e"), text.dataset_type_of(F.col("p")).alias("t"),
        text.dataset_type_of(F.col("p"), "substring").alias("s"),
        text.sanitize_key(F.col("p")).alias("k")).collect()
    assert [r.e for r in rows] == [".csv", "", "", ".json", ".xml", ".gz"]
    assert [r.t for r in rows] == ["communicable_disease"] * 3 + [
        "laboratory", "communicable_disease", "outbreak"]
    assert rows[4].s == "laboratory"
    assert rows[0].k == "in_My_file_1_.CSV"
    with pytest.raises(ValueError):
        text.dataset_type_of(F.col("p"), "regex")


def test_postcodes(spark):
    df = spark.createDataFrame([("SW1A 1AA",), ("M1 1AE",), ("bad",), (None,)], "p string")
    assert values(df.select(text.outward_postcode(F.col("p")).alias("o")), "o") == \
        ["SW1", "M1", "", None]


def test_outside_bounds(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    v = F.col("v")
    for bounds, expected in [((2, None), [True, False, None]), ((None, 4), [False, True, None]),
                             ((2, 4), [True, True, None]), ((None, None), [False, False, False])]:
        assert values(df.select(measures.outside(v, *bounds).alias("o")), "o") == expected
