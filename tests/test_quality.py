from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vigil.operators import governance, quality


def results(df):
    return {(r.check_name, r.column_name, r.metric): r for r in df.collect()}


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "a", 2.0, None), (2, "a", None, None), (None, None, 4.0, None)],
        "i int, s string, d double, empty int")
    rows = {r.column_name: r for r in quality.profile(df).collect()}
    assert (rows["i"].null_count, rows["i"].distinct_count, rows["i"].median) == (1, 3, 1.0)
    assert (rows["s"].distinct_count, rows["s"].min, rows["s"].data_type) == (2, None, "string")
    assert rows["d"].mean == 3.0 and rows["d"].stddev == pytest.approx(2 ** 0.5)
    assert (rows["empty"].completeness, rows["empty"].distinct_count) == (0.0, 1)
    near = {r.column_name: r.distinct_count for r in quality.distinct_counts(df, True).collect()}
    assert near == {"i": 3, "s": 2, "d": 3, "empty": 1}


def test_distinct_counts_of_dense_and_sparse_columns(spark):
    """Against COUNT(DISTINCT): bitmaps, values next to their ends, wide numbers, texts, dates."""
    df = spark.range(40_000).selectExpr(
        "id AS dense", "if(id % 9 = 0, NULL, id * 1000003) AS sparse", "int(id % 40) - 20 AS few",
        "-32767 + id AS `low end`", "-32768 + id AS below", "id + 91074 AS beyond", "id % 131073 AS `high end`",
        "date_add(DATE'1880-04-15', int(id)) AS days", "date_add(DATE'1800-01-01', int(id % 90)) AS `old days`",
        "if(id % 5 = 0, NULL, id % 2 = 0) AS flag", "string(id % 700) AS text", "if(id % 2 = 0, -0.0D, 0.0D) AS zero",
        "if(id % 3 = 0, double('NaN'), id / 7) AS fraction", "array(id % 11, 1) AS list", "map(id % 3, 1) AS mapped",
        "decimal(id) / 3 AS part", "int(NULL) AS nothing").repartition(5)
    found = {r.column_name: r.distinct_count for r in quality.distinct_counts(df).collect()}
    for c in df.columns:
        assert found.pop(c) == df.selectExpr(f"string(`{c}`) AS v" if c == "mapped" else f"`{c}` AS v") \
            .distinct().count(), c
    assert not found
    assert quality._in_bitmaps(df).keys() == {
        "dense", "few", "low end", "high end", "days", "flag", "nothing"}
    assert {r[1] for r in quality.distinct_counts(df.limit(0)).collect()} <= {0}


def test_profile_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "i int, s string")
    rows = {r.column_name: r for r in quality.profile(df).collect()}
    assert (rows["i"].null_percentage, rows["i"].distinct_count, rows["i"].median) == (0.0, 0, None)
    checks = quality.etl_quality_checks(df).collect()
    assert len(checks) == 3 and all(c.passed and c.overall_passed for c in checks)


def test_etl_checks(spark):
    df = spark.createDataFrame([(1, None)] * 2 + [(i, "x") for i in range(2, 20)], "a int, b string")
    rows = {r.check_name: r for r in quality.etl_quality_checks(df).collect()}
    assert rows["b_null_check"].percentage == 10.0 and rows["b_null_check"].passed
    assert rows["duplicate_check"].failing_count == 1 and rows["duplicate_check"].passed
    strict = quality.etl_quality_checks(df, null_limit=0.05).collect()
    assert not any(r.overall_passed for r in strict)


def test_quality_job(reports):
    found = results(quality.quality_job(reports))
    assert found["uniqueness", "report_date, region", "duplicate_count"].value == 1
    assert found["uniqueness", "report_date, region", "total_rows"].status == "FAILED"
    assert found["consistency", "report_date", "min_date"].detail == "2025-01-01"
    assert found["validity", "case_count", "invalid_count"].passed
    summary = quality.quality_summary(quality.quality_job(reports)).first()
    assert (summary.total_checks, summary.passed, summary.failed, summary.warnings) == (5, 4, 1, 0)


def test_outliers_skip_constant_columns(spark):
    df = spark.createDataFrame([(1, i % 5) for i in range(50)] + [(1, 1000)], "same int, v int")
    found = results(quality.outliers_zscore(df))
    assert ("outliers", "same", "outlier_count") not in found
    assert found["outliers", "v", "outlier_count"].value == 1
    assert found["outliers", "v", "outlier_count"].status == "WARNING"
    assert [r.status for r in quality.outliers_zscore(df, ["same"]).collect()] == ["PASSED"]


def test_validity_needs_both_bounds(spark):
    df = spark.createDataFrame([(5,), (None,), (50,)], "v int")
    assert results(quality.validity(df, {"v": {"min": 0, "max": 10}}))[
        "validity", "v", "invalid_count"].value == 1
    assert [r.status for r in quality.validity(df, {"v": {"max": 10}}).collect()] == ["PASSED"]


def test_consistency_of_an_empty_date(spark):
    df = spark.createDataFrame([(None,)], "report_date date")
    assert {r.status for r in quality.consistency(df).collect()} == {"WARNING"}


def test_uniqueness_counts_null_keys_as_equal(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    found = results(quality.uniqueness(df, ["k"]))
    assert found["uniqueness", "k", "duplicate_count"].value == 1


def test_timeliness(spark):
    df = spark.createDataFrame([(1, date(2025, 1, 1)), (2, date(2025, 1, 2))], "k int, day date")
    for hours, passed in [(24, True), (25, False)]:
        as_of = datetime(2025, 1, 2 + hours // 24, hours % 24)
        rows = governance.quality_dimensions(df, ["k"], {}, "day", as_of).collect()
        row = {r.dimension: r for r in rows}["timeliness"]
        assert (row.value, row.passed) == (hours, passed)


def test_retention(spark):
    df = spark.createDataFrame([(1, "Ann", date(2025, 1, 1)), (2, "Bob", date(2025, 3, 31))],
                               "person_id int, person_name string, day date")
    kept, archived = governance.apply_retention(df, "day", "pii", date(2025, 4, 2))
    assert [r.person_id for r in kept.collect()] == [2]
    assert [r.person_name for r in archived.collect()] == ["***REDACTED***"]
    kept, archived = governance.apply_retention(df, "day", "raw", date(2025, 4, 1))
    assert kept.count() == 2 and archived.count() == 0
    assert governance.apply_retention(df, "day", "raw", date(2025, 4, 2))[1].count() == 0


def test_alarms_need_consecutive_windows(spark):
    times = ["00:01", "00:02", "00:06", "00:07", "00:16", "00:17", "00:21", "00:22", "00:26", "00:27"]
    events = spark.createDataFrame([(f"2025-01-01 {t}:00",) for t in times], "ts string") \
        .select(F.col("ts").cast("timestamp").alias("ts"))
    counted = governance.metric_windows(events, "ts", [], F.lit(1))
    found = [r.alarm_start for r in governance.alarms(counted, [], 1).orderBy("alarm_start").collect()]
    assert found == [datetime(2025, 1, 1, 0, 5), datetime(2025, 1, 1, 0, 20),
                     datetime(2025, 1, 1, 0, 25)]
    three = governance.alarms(counted, [], 1, periods=3).collect()
    assert [r.alarm_start for r in three] == [datetime(2025, 1, 1, 0, 25)]


def test_wide_frame(spark):
    """10,000 rows of 50 numbers: repeated rows, nulls and outliers."""
    from vigil.operators import rules

    df = spark.range(10_000).select(*[F.randn(i).alias(f"col_{i}") for i in range(50)])
    rule = {"rule_id": "q", "rule_type": "data_quality", "check_duplicates": True,
            "outlier_columns": ["col_0", "col_1", "col_2"]}
    result = rules.evaluate(df, [rule]).first()
    assert result.details["duplicate_count"] == 0
    assert 0 < result.details["col_0_outliers"] < 200
