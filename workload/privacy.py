"""Finding, redacting and anonymising personal data."""

from vigil.functions import patterns as X
from vigil.operators import pii as D
from workload.registry import query
from workload.views import people, table

from pyspark.sql import functions as F

PEOPLE_TEXT = ["patient_name", "disease_name", "postcode", "phone", "note", "reference", "remark"]


def _sql_names(columns, view):
    return " UNION ALL ".join(f"""
  SELECT '{c}' AS column_name, 'name' AS source, CAST(NULL AS VARCHAR) AS pii_type,
         CAST(NULL AS VARCHAR) AS severity, 'Column name suggests PII: {c}' AS finding,
         COUNT({c}) AS records FROM {view}""" for c in columns)


def _sql_content(columns, patterns, view):
    return "SELECT * FROM (" + " UNION ALL ".join(f"""
  SELECT '{c}' AS column_name, 'content' AS source, '{p.name}' AS pii_type,
         '{p.severity}' AS severity, 'Potential {p.name} detected' AS finding,
         COUNT(*) FILTER (regexp_matches({c}, '{p.regex}')) AS records FROM {view}"""
        for c in columns for p in patterns) + ") WHERE records > 0"


@query("D01_pii_column_names", _sql_names(["patient_id", "patient_name", "postcode", "phone"],
                                          "people"), ("people",))
def names(spark, sf):
    return D.pii_column_names(people(spark, sf))


@query("C11_pii_indicators_config", _sql_names(
    ["individual_ref", "bank_balance", "disease_name"],
    "(SELECT patient_id AS individual_ref, case_count AS bank_balance, disease_name FROM people)"),
       ("people",))
def names_config(spark, sf):
    renamed = people(spark, sf).select(
        F.col("patient_id").alias("individual_ref"), F.col("case_count").alias("bank_balance"),
        "disease_name", F.col("remark").alias("telefax"))
    return D.pii_column_names(renamed, X.NAME_INDICATORS_CONFIG, allowed=())


@query("D02_pii_content_scan", _sql_content(PEOPLE_TEXT, X.INLINE, "people"), ("people",))
def content(spark, sf):
    return D.pii_content_scan(people(spark, sf))


@query("D02_pii_scan_documents", _sql_content(["text"], X.INLINE, "documents"))
def content_documents(spark, sf):
    return D.pii_content_scan(table(spark, sf, "documents"), X.INLINE, ["text"])


@query("D02_pii_scan_uk_config", _sql_content(PEOPLE_TEXT, X.UK_CONFIG, "people"), ("people",))
def content_config(spark, sf):
    return D.pii_content_scan(people(spark, sf), X.UK_CONFIG)


@query("D02_pii_scan_uk_fixed", _sql_content(["text"], X.UK_FIXED, "documents"))
def content_fixed(spark, sf):
    return D.pii_content_scan(table(spark, sf, "documents"), X.UK_FIXED, ["text"])


@query("D09_pii_nhs_loose", _sql_content(["text"], X.NHS_LOOSE, "documents"))
def nhs_loose(spark, sf):
    return D.pii_content_scan(table(spark, sf, "documents"), X.NHS_LOOSE, ["text"])


@query("C19_pii_findings_filter",
       "SELECT * FROM (" + _sql_content(PEOPLE_TEXT, X.UK_CONFIG, "people")
       + ") WHERE upper(severity) IN ('HIGH', 'CRITICAL')", ("people",))
def severe(spark, sf):
    return D.findings_of_severity(D.pii_content_scan(people(spark, sf), X.UK_CONFIG))


FLAGGED = ["patient_id", "patient_name", "postcode", "phone", "note", "reference", "remark"]


@query("D03_pii_redact_columns", "SELECT disease_name, case_count, " + ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN '***REDACTED***' END AS {c}" for c in FLAGGED)
       + " FROM people", ("people",))
def redact(spark, sf):
    frame = people(spark, sf)
    return D.redact_columns(frame, D.flagged_columns(D.scan(frame)))


@query("D04_pii_gate", f"""
SELECT CASE WHEN COUNT(*) > 0 THEN 'FAILED' ELSE 'PASSED' END AS status,
       CASE WHEN COUNT(*) > 0 THEN 'PII detected in file' ELSE 'No PII detected' END AS message,
       COUNT(*) AS findings
FROM ({_sql_names(["patient_id", "patient_name", "postcode", "phone"], "people")}
      UNION ALL {_sql_content(PEOPLE_TEXT, X.INLINE, "people")})""", ("people",))
def gate(spark, sf):
    return D.pii_gate(people(spark, sf))


@query("D05_anonymize_hash_ids", """
SELECT * REPLACE (sha256(CAST(patient_id AS VARCHAR)) AS patient_id) FROM people""", ("people",))
def hash_ids(spark, sf):
    return D.anonymize_hash_ids(people(spark, sf))


@query("D06_anonymize_mask_names", """
SELECT * REPLACE ('***REDACTED***' AS patient_name) FROM people""", ("people",))
def mask_names(spark, sf):
    return D.anonymize_mask_names(people(spark, sf))


POSTCODE = "regexp_extract(postcode, '^([A-Z]{1,2}\\d{1,2})', 1) AS postcode"


@query("D07_generalize_postcode", f"SELECT * REPLACE ({POSTCODE}) FROM people", ("people",))
def postcode(spark, sf):
    return D.generalize_postcode(people(spark, sf))


@query("D08_anonymize_pii", f"""
SELECT * REPLACE (sha256(CAST(patient_id AS VARCHAR)) AS patient_id,
                  '***REDACTED***' AS patient_name, {POSTCODE}) FROM people""", ("people",))
def anonymize(spark, sf):
    return D.anonymize(people(spark, sf))


@query("D08_anonymize_pii_substring", f"""
SELECT sha256(CAST(patient_id AS VARCHAR)) AS patient_id, '***REDACTED***' AS patient_name,
       {POSTCODE}, sha256(CAST(case_count AS VARCHAR)) AS incidence FROM people""", ("people",))
def anonymize_substring(spark, sf):
    return D.anonymize(people(spark, sf).select(
        "patient_id", "patient_name", "postcode", F.col("case_count").alias("incidence")),
        match="substring")


def sql_redacted(column):
    out = column
    for p in X.UK_CONFIG:
        if p.action == "partial_redact":
            out = f"regexp_replace({out}, '{X.POSTCODE_PARTS}', '\\1 ***', 'g')"
        else:
            out = f"regexp_replace({out}, '{p.regex}', '***REDACTED***', 'g')"
    return out


@query("C10_pii_actions", "SELECT patient_id, case_count, " + ", ".join(
    f"{sql_redacted(c)} AS {c}" for c in PEOPLE_TEXT) + " FROM people", ("people",))
def actions(spark, sf):
    return D.apply_pii_actions(people(spark, sf))


@query("C10_pii_actions_documents",
       f"SELECT doc_id, {sql_redacted('text')} AS text FROM documents")
def actions_documents(spark, sf):
    return D.apply_pii_actions(table(spark, sf, "documents").select("doc_id", "text"), ["text"])
