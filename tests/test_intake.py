from datetime import date, datetime

from pyspark.sql import functions as F

from vigil.constants import MAX_FILE_BYTES
from vigil.operators import admission, governance


def manifest(spark):
    return spark.createDataFrame(
        [("in/a.csv", 10), ("in/b.CSV", MAX_FILE_BYTES), ("in/c.csv", MAX_FILE_BYTES + 1),
         ("in/d.pdf", MAX_FILE_BYTES + 1), ("in/e", 1), ("in/f.xlsx", 1)], "path string, size long")


def test_admission(spark):
    rows = {r.path: r for r in admission.admit_files(manifest(spark)).collect()}
    assert [rows[p].valid for p in sorted(rows)] == [True, True, False, False, False, True]
    assert rows["in/c.csv"].reason == "File size 104857601 exceeds maximum 104857600"
    assert rows["in/d.pdf"].reason == "Unsupported file format: .pdf"
    assert rows["in/e"].reason == "Unsupported file format: "


def test_results_and_summary(spark):
    admitted = admission.admit_files(manifest(spark))
    broken = F.when(F.col("path") == "in/a.csv", F.lit("cannot parse"))
    results = admission.processing_results(admitted, broken)
    assert {(r.path, r.status) for r in results.collect()} >= {
        ("in/a.csv", "error"), ("in/b.CSV", "success"), ("in/c.csv", "failed")}
    counts = {r.status: r.processed for r in admission.processing_summary(results).collect()}
    assert counts == {"error": 1, "success": 2, "failed": 3}


def test_quarantine_keys(spark):
    row = admission.quarantine(manifest(spark), date(2025, 2, 3)).first()
    assert (row.quarantine_key, row.quarantine_date) == ("quarantine/2025/02/03/in/a.csv", date(2025, 2, 3))


def test_tags(spark):
    df = manifest(spark).select("path").withColumn(
        "dataset_type", F.when(F.col("path") == "in/a.csv", "outbreak"))
    rows = {r.path: r for r in admission.default_tags(df).collect()}
    assert (rows["in/a.csv"].dataset_type, rows["in/e"].dataset_type) == (
        "outbreak", "communicable_disease")
    assert rows["in/e"].source_organization == "unknown"


def test_rates(spark):
    log = spark.createDataFrame(
        [("d1", "PASSED", False, 1.0, 2.0), ("d1", "FAILED", True, 0.5, 4.0),
         ("d2", "PASSED", False, None, 1.0)],
        "day string, status string, pii_found boolean, completeness double, processing_seconds double")
    rows = {r.day: r for r in governance.rate_metrics(log).collect()}
    assert (rows["d1"].validation_success_rate, rows["d1"].pii_detection_rate,
            rows["d1"].data_completeness, rows["d1"].processing_time) == (50.0, 50.0, 0.75, 3.0)


def test_audit(spark):
    events = spark.createDataFrame(
        [("e2", datetime(2025, 1, 2), "u", "read"), ("e1", datetime(2025, 1, 1), "u", "read"),
         ("e0", datetime(2024, 1, 1), "u", "old"), ("e3", datetime(2025, 1, 1), "v", "read")],
        "event_id string, at timestamp, user_id string, event_type string")
    log = governance.audit_entries(events, "at", 30)
    found = governance.audit_trail(log, "u", datetime(2025, 1, 10)).collect()
    assert [r.event_id for r in found] == ["e1", "e2"]
