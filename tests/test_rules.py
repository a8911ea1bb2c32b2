from datetime import date

import pytest

from vigil import constants as C
from vigil.operators import rules
from vigil.plans import validation


def evaluate(df, *rule, **kw):
    return rules.evaluate(df, list(rule), **kw).orderBy("position").collect()


def test_schema(reports):
    ok, bad = evaluate(
        reports, {"rule_id": "a", "rule_type": "schema", "required_columns": ["region"]},
        {"rule_id": "b", "rule_type": "schema", "required_columns": ["region", "postcode"],
         "optional_columns": ["death_count", "gender"]})
    assert (ok.status, ok.message, ok.errors) == ("PASSED", "Schema validation passed", [])
    assert (bad.status, bad.errors) == ("FAILED", ["Missing columns: postcode"])
    assert bad.details == {"optional_death_count": 1.0, "optional_gender": 0.0}


def test_types_of_text_columns_are_tested_by_value(spark):
    df = spark.createDataFrame([("1", "2025-01-01", "x"), ("2", "01/02/2025", None)],
                               "n string, d string, s string")
    types = {"n": "integer", "d": "datetime", "s": "string"}
    assert evaluate(df, {"rule_id": "t", "type": "data_types", "column_types": types})[0].status \
        == "PASSED"
    bad = evaluate(df, {"rule_id": "t", "rule_type": "data_type",
                        "column_types": {"s": "float", "n": "boolean"}})[0]
    assert bad.errors[0] == "Column 's' has type 'string', expected 'float'"


def test_declared_types(reports):
    types = {"report_date": "datetime", "case_count": "integer", "region": "string"}
    rule = {"rule_id": "t", "rule_type": "data_type", "column_types": types}
    assert evaluate(reports, rule)[0].status == "PASSED"
    rule["column_types"] = {"case_count": "float", "report_date": "integer"}
    assert len(evaluate(reports, rule)[0].errors) == 2


def test_ranges_and_dates(reports):
    r, = evaluate(reports, {
        "rule_id": "b", "rule_type": "business_logic",
        "date_range": {"column": "report_date", "min": "2025-01-02", "max": "2025-12-31"},
        "value_ranges": {"case_count": {"min": 60, "max": 200}, "death_count": {"max": 10},
                         "absent": {"min": 1}}})
    assert r.status == "FAILED"
    assert r.errors == ["Found 3 records with dates outside valid range"]
    assert r.warnings == ["Column 'case_count' has 1 values below minimum 60",
                          "Column 'case_count' has 1 values above maximum 200",
                          "Column 'death_count' has 1 values above maximum 10"]


def test_both_spellings_agree(reports):
    ranges = {"case_count": {"min": 60}}
    spellings = [{"rule_id": "r", "rule_type": "business_logic", "value_ranges": ranges},
                 {"rule_id": "r", "rule_type": "value_ranges", "ranges": ranges},
                 {"id": "r", "type": "value_ranges", "ranges": ranges}]
    outcomes = {(r.rule_id, r.rule_type, r.status, tuple(r.warnings))
                for s in spellings for r in evaluate(reports, s)}
    assert len(outcomes) == 1


def test_unparsed_dates_are_ignored(spark):
    df = spark.createDataFrame([("2019-01-01",), ("junk",), (None,)], "d string")
    r, = evaluate(df, {"rule_id": "x", "rule_type": "business_logic",
                       "date_range": {"column": "d", "min": "2020-01-01"}})
    assert r.errors == ["Found 1 records with dates outside valid range"]


def test_current_date(reports):
    rule = {"id": "x", "type": "value_ranges", "ranges": {"report_date": {"max": "current_date"}}}
    assert evaluate(reports, rule, as_of=date(2025, 1, 4))[0].status == "FAILED"
    assert evaluate(reports, rule, as_of=date(2025, 1, 5))[0].status == "PASSED"
    with pytest.raises(ValueError, match="as_of"):
        evaluate(reports, rule)


def test_quality(spark):
    rows = [(i, None if i < 3 else 1.0) for i in range(1, 21)]
    df = spark.createDataFrame(rows + [(20, 1.0)], "k int, v double")
    rule = {"rule_id": "q", "rule_type": "data_quality", "null_threshold": 0.05,
            "check_duplicates": True, "outlier_columns": ["v", "k", "absent"]}
    r, = evaluate(df, rule)
    assert r.status == "WARNING"
    assert r.warnings == ["Column 'v' has 9.52% null values (threshold: 5%)",
                          "Found 1 duplicate rows"]
    assert r.details["duplicate_count"] == 1 and r.details["k_outliers"] == 0
    calm, = evaluate(df, {**rule, "null_threshold": 0.1, "duplicate_threshold": 0.05})
    assert calm.status == "PASSED"


def test_outlier_share(spark):
    df = spark.createDataFrame([(i % 10,) for i in range(100)] + [(1000,)], "v int")
    rule = {"rule_id": "q", "rule_type": "data_quality", "outlier_columns": ["v"]}
    assert evaluate(df, rule)[0].warnings == ["Column 'v' has 1 potential outliers"]
    assert evaluate(df, {**rule, "outlier_threshold": C.OUTLIER_LIMIT})[0].status == "PASSED"


def test_empty_frame_passes(spark):
    df = spark.createDataFrame([], "v int, d date")
    found = evaluate(df, {"rule_id": "q", "rule_type": "data_quality", "check_duplicates": True,
                          "outlier_columns": ["v"], "required_nonnull": ["v"]},
                     {"rule_id": "b", "rule_type": "value_ranges", "ranges": {"v": {"min": 0}}})
    assert [r.status for r in found] == ["PASSED", "PASSED"]


def test_unknown_and_disabled(reports):
    found = evaluate(reports, {"rule_id": "u", "rule_type": "poetry"},
                     {"rule_id": "off", "rule_type": "schema", "enabled": False})
    assert [(r.status, r.message) for r in found] == [("WARNING", "Unknown rule type: poetry")]


def test_allowed_values(spark, reports):
    rule = {"id": "a", "type": "allowed_values", "column": "region", "allowed_values": ["London"]}
    assert evaluate(reports, rule)[0].warnings == [
        "Column 'region' has 6 values outside the allowed list"]
    bad = rules.disallowed_values(reports, "region", ["London", "Wales"])
    assert {r.value: r.records for r in bad.collect()} == {"Scotland": 2, "Northern Ireland": 1}


def test_document_with_named_fields():
    document = {"validation_rules": {"immunisation": {
        "schema": {"required_columns": ["dose_number"]},
        "data_types": {"dose_number": "integer"},
        "business_rules": [
            {"name": "doses", "field": "dose_number", "min": 1, "max": 5},
            {"name": "dates", "field": "vaccination_date", "min": "2020-01-01"},
            {"name": "types", "field": "vaccine_type", "allowed_values": ["MMR"]}],
        "data_quality": {"null_threshold": 0.2, "duplicate_threshold": 0.05,
                         "outlier_detection": {"method": "iqr", "threshold": 3},
                         "completeness_checks": [{"field": "region", "required": True},
                                                 {"field": "age_group", "required": False}]}}}}
    found = rules.rules_from_document(document)
    assert [r["rule_type"] for r in found] == [
        "schema", "data_type", "business_logic", "business_logic", "allowed_values", "data_quality"]
    assert found[2]["value_ranges"] == {"dose_number": {"min": 1, "max": 5}}
    assert found[3]["date_ranges"] == [{"column": "vaccination_date", "min": "2020-01-01"}]
    assert found[5]["required_nonnull"] == ["region"] and found[5]["outlier_factor"] == 3
    assert all(r["dataset_type"] == "immunisation" for r in found)


def test_default_rules_on_reports(reports):
    found = rules.evaluate(reports, rules.default_rules(), date(2025, 6, 1))
    by_id = {r.rule_id: r.status for r in found.collect()}
    assert by_id == {
        "schema_validation": "PASSED", "data_type_validation": "PASSED",
        "value_range_validation": "PASSED", "region_validation": "PASSED",
        "data_quality_checks": "PASSED"}
    assert rules.aggregate_results(found).first().message == "All validations passed"


def test_aggregate_order_and_severity(reports):
    found = rules.evaluate(reports, [
        {"rule_id": "z", "rule_type": "poetry"},
        {"rule_id": "a", "rule_type": "schema", "required_columns": ["x"]},
        {"rule_id": "m", "rule_type": "prose"}])
    merged = rules.aggregate_results(found).first()
    assert (merged.status, merged.message) == ("FAILED", "Validation failed")
    assert merged.errors == ["Missing columns: x"]
    assert merged.warnings == ["Unknown rule type: poetry", "Unknown rule type: prose"]


def test_no_rules_pass(reports):
    merged = rules.aggregate_results(rules.evaluate(reports, [])).first()
    assert (merged.status, merged.message) == ("PASSED", "No validation rules applied")
    outcome = validation.validate_dataset(reports, []).first()
    assert (outcome.status, outcome.route) == ("PASSED", "validated")


def test_per_unit_equals_one_by_one(reports):
    rule_set = [
        {"rule_id": "b", "rule_type": "value_ranges", "ranges": {"case_count": {"max": 180}}},
        {"rule_id": "q", "rule_type": "data_quality", "check_duplicates": True,
         "outlier_columns": ["case_count", "death_count"]},
        {"rule_id": "s", "rule_type": "schema", "required_columns": ["region"]}]
    together = rules.evaluate(reports, rule_set, by=["region"]).collect()
    for region in {r.region for r in together}:
        alone = rules.evaluate(reports.where(f"region = '{region}'").drop("region"), rule_set[:2])
        for a in alone.collect():
            b, = [t for t in together if t.region == region and t.position == a.position]
            assert (a.status, a.warnings, a.details) == (b.status, b.warnings, b.details)
    assert {t.status for t in together if t.rule_id == "s"} == {"FAILED"}  # region is the unit


def test_validate_files(spark):
    rows = [("a.csv", "London", "fine"), ("a.csv", "Wales", None), ("b.csv", "Leeds", "fine"),
            ("c.csv", "Wales", "mail me: x.y@example.org"), ("c.csv", "Wales", "fine")]
    df = spark.createDataFrame(rows, "original_file string, region string, remark string")
    rule_set = [{"id": "r", "type": "allowed_values", "column": "region",
                 "allowed_values": C.REGIONS}]
    log = {r.original_file: r for r in validation.validate_files(df, rule_set).collect()}
    assert {f: (r.status, r.route, r.record_count) for f, r in log.items()} == {
        "a.csv": ("PASSED", "validated", 2), "b.csv": ("WARNING", "review", 1),
        "c.csv": ("FAILED", "quarantine", 2)}
    assert log["c.csv"].message == "PII detected in file" and log["a.csv"].completeness == 0.75
    assert {r.status for r in validation.validate_files(df, []).collect()} == {"PASSED", "FAILED"}


def test_outliers_of_text_columns(spark):
    rows = [("f", str(i % 10), str(i)) for i in range(40)] + [("f", "900", "x")]
    df = spark.createDataFrame(rows, "original_file string, v string, w string")
    rule = {"rule_id": "q", "rule_type": "data_quality", "outlier_columns": "numeric"}
    for found in (rules.evaluate(df.drop("original_file"), [rule]),
                  rules.evaluate(df, [rule], by=["original_file"])):
        assert found.first().warnings == ["Column 'v' has 1 potential outliers"]
