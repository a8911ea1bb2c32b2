import re

import pytest
from pyspark.sql import functions as F

from vigil.functions import patterns as X
from vigil.operators import pii


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("Ann", "123 456 7890", "ann@example.org", 1), ("Bob", "987-654-3210", None, 2),
         (None, "1112223334", "c.d@example.co.uk", 3)],
        "patient_name string, nhs_number string, email string, case_count int")


def found(df):
    return {(r.column_name, r.pii_type): r.records for r in df.collect()}


def test_column_names():
    assert pii.flagged_names(["Patient_Name", "disease_name", "case_count", "contactTel"]) == \
        ["Patient_Name", "contactTel"]
    assert pii.flagged_names(["person", "telephone"], X.NAME_INDICATORS_CONFIG) == \
        ["person", "telephone"]  # 'telephone' contains 'phone'


def test_scan(people, reports):
    findings = found(pii.scan(people))
    assert findings["nhs_number", "nhs_number"] == 3
    assert findings["email", "email"] == 2
    assert findings["patient_name", None] == 2
    assert pii.scan(reports).count() == 0
    assert pii.pii_gate(reports).first().status == "PASSED"
    assert pii.pii_gate(people).first().status == "FAILED"


def test_findings_after_many_clean_rows(spark):
    df = spark.range(500).select(F.when(F.col("id") == 490, "x@example.org").otherwise("ok").alias("t"))
    assert found(pii.pii_content_scan(df)) == {("t", "email"): 1}


def test_only_rows_with_a_match_are_counted_in_detail(spark):
    long = "no match here, 12 " * 10
    df = spark.createDataFrame([
        (1, "12", None), (2, None, None), (3, long, "2024-01-01"), (4, long + "AB123456C", ""),
        (5, "a@b.cc", "x"), (6, "\u00e9" * 20 + "7", "4111 1111 1111 1111"), (7, "x", "A11AA")],
        "n int, t string, u string")
    kept = pii._suspects(df, X.INLINE, ["t", "u"])
    assert sorted(r.n for r in kept.collect()) == [4, 5, 6, 7]
    assert found(pii.pii_content_scan(df)) == {
        ("t", "ni_number"): 1, ("t", "email"): 1, ("u", "credit_card"): 1, ("u", "postcode"): 1}


def test_least_is_the_length_of_the_shortest_match():
    shortest = {"nhs_number": "1234567890", "ni_number": "AB123456C", "phone": "0123456789", "email": "a@b.cc",
                "postcode": "A11AA", "dob": "31-12-1999", "credit_card": "4111111111111111"}
    for p in X.INLINE:
        assert re.search(p.regex, shortest[p.name]) and p.least == len(shortest[p.name])


def test_no_text_columns(spark):
    assert pii.scan(spark.range(3)).count() == 0
    assert pii.scan(spark.range(3)).columns == [
        "column_name", "source", "pii_type", "severity", "finding", "records"]


@pytest.mark.parametrize("text, kinds", [
    ("AB123456C", {"ni_number"}), ("SW1A 1AA", {"postcode"}), ("07123456789", {"phone"}),
    ("31-12-1999", {"dob"}), ("4111 1111 1111 1111", {"credit_card"}),
    ("no data, 12345", set()), ("id 99AB123456C1", set()),
])
def test_inline_patterns(spark, text, kinds):
    df = spark.createDataFrame([(text,)], "t string")
    assert {k for _, k in found(pii.pii_content_scan(df))} == kinds


def test_corrected_phone(spark):
    df = spark.createDataFrame([("+447123456789",)], "t string")
    assert not found(pii.pii_content_scan(df, X.INLINE))
    assert found(pii.pii_content_scan(df, X.UK_FIXED)) == {("t", "phone"): 1}


def test_loose_identifier(spark):
    df = spark.createDataFrame([("x1234567890y",), ("123-456-7890",)], "t string")
    assert found(pii.pii_content_scan(df, X.NHS_LOOSE)) == {("t", "nhs_number"): 1}


def test_severity(spark):
    df = spark.createDataFrame([("SW1A 1AA and 123456789",)], "t string")
    findings = pii.pii_content_scan(df, X.UK_CONFIG)
    assert {k for _, k in found(findings)} == {"uk_postcode", "uk_passport"}
    assert {k for _, k in found(pii.findings_of_severity(findings))} == {"uk_passport"}


def test_redaction_keeps_nulls(people):
    columns = pii.flagged_columns(pii.scan(people))
    assert columns == ["email", "nhs_number", "patient_name"]
    rows = pii.redact_columns(people, columns + ["absent"]).orderBy("case_count").collect()
    assert tuple(rows[1]) == ("***REDACTED***", "***REDACTED***", None, 2)


def test_text_actions(spark):
    df = spark.createDataFrame([(
        "Call 07123456789, write a@b.org, lives at SW1A 1AA, born 01.02.1990",)], "t string")
    assert pii.apply_pii_actions(df).first().t == (
        "Call ***REDACTED***, write ***REDACTED***, lives at SW1A ***, born ***REDACTED***")


def test_anonymize(spark):
    df = spark.createDataFrame(
        [(7, 8, "flu", None, "SW1A 1AA", 0.5)],
        "patient_id int, report_id int, disease_name string, job_name string, postcode string, "
        "incidence_rate double")
    row = pii.anonymize(df).first()
    assert row.patient_id == "7902699be42c8a8e46fbbb4501726517e86b22c56a189f7625a6da49081b2451"
    assert (row.report_id, row.disease_name, row.job_name, row.postcode, row.incidence_rate) == \
        (8, "flu", "***REDACTED***", "SW1", 0.5)
    everywhere = pii.anonymize(df, match="substring").first()
    assert len(everywhere.incidence_rate) == 64
    with pytest.raises(ValueError):
        pii.anonymize(df, match="regex")


def test_scan_per_unit_equals_one_by_one(people):
    unit = people.withColumn("file", F.when(F.col("case_count") > 1, "b").otherwise("a"))
    together = pii.scan(unit, by=("file",))
    for f in "ab":
        part = together.where(F.col("file") == f).drop("file")
        assert found(part) == found(pii.scan(unit.where(F.col("file") == f).drop("file")))


def test_many_rows_of_three_columns(spark):
    df = spark.range(100_000).select(
        F.expr("timestamp '2025-01-01' + make_dt_interval(0, id)").cast("string").alias("report_date"),
        F.col("id").alias("case_count"), F.lit("London").alias("region"))
    assert pii.scan(df).count() == 0
