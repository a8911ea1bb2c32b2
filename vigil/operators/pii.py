"""Find, redact and anonymise personal data."""

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vigil.constants import REDACTED
from vigil.functions.patterns import INLINE, NAME_INDICATORS, POSTCODE_PARTS, UK_CONFIG, Pattern
from vigil.functions.text import outward_postcode
from vigil.schemas import name_sql, quoted, rows_of, string_columns, text_sql

# Needed by every disease file and not personal, though it contains 'name'.
NOT_PERSONAL = ("disease_name",)


def flagged_names(columns: list[str], indicators: list[str] = NAME_INDICATORS,
                  allowed: tuple = NOT_PERSONAL) -> list[str]:
    """Column names that contain an indicator word."""
    return [c for c in columns
            if c not in allowed and any(word in c.lower() for word in indicators)]


#: Texts below this size are matched without looking for what a pattern needs.
SHORT_BYTES = 64
_FINDING = ["column_name", "source", "pii_type", "severity", "finding"]


def _findings(df: DataFrame, entries: list[tuple], by: tuple = ()) -> DataFrame:
    """One scan over all (column, source, type, severity, text, condition) entries."""
    needed = {e[6]: f"__needs{i}" for i, e in enumerate(entries) if len(e) > 6}
    df = df.withColumns({name: F.expr(test) for test, name in needed.items()})
    entries = [(*e[:5], f"{needed[e[6]]} AND {e[5]}") if len(e) > 6 else e for e in entries]
    measured = df.groupBy(*[quoted(k) for k in by]).agg(
        F.expr("count(1) AS __rows"),
        *[F.expr(f"count_if({e[5]}) AS f{i}") for i, e in enumerate(entries)])
    rows = [{**dict(zip(_FINDING, map(text_sql, e))), "records": f"f{i}"}
            for i, e in enumerate(entries)]
    if not rows:  # nothing to look for: no findings, but the columns of findings
        rows = [{**{n: text_sql(None) for n in _FINDING}, "records": "0L"}]
        measured = measured.where("false")
    return rows_of(measured, rows, by)


def _name_entries(df, indicators, allowed):
    return [(c, "name", None, None, f"Column name suggests PII: {c}",
             f"{name_sql(c)} IS NOT NULL")
            for c in flagged_names(df.columns, indicators, allowed)]


def _content_entries(df, patterns, columns=None):
    return [(c, "content", p.name, p.severity, f"Potential {p.name} detected",
             f"{name_sql(c)} RLIKE {text_sql(p.regex)}",
             *([f"{name_sql(c)} RLIKE {text_sql(p.needs)}"] if p.needs else []))
            for c in (string_columns(df) if columns is None else columns) for p in patterns]


def _suspects(df: DataFrame, patterns: list[Pattern], columns: list[str]) -> DataFrame:
    """The rows with a match of any pattern in any of the columns.

    Rows without a match are most, and counting every pair of column and pattern costs
    far more than one look at a row's texts: lengths in bytes, never below those in
    characters, pass over most of them.
    """
    if not patterns or any(df.schema[c].dataType != T.StringType() for c in columns):
        return df
    tests = []
    for needs in dict.fromkeys(p.needs for p in patterns):
        own = [p for p in patterns if p.needs == needs]
        matched = " OR ".join(f"octet_length(x) >= {p.least} AND x RLIKE {text_sql(p.regex)}" for p in own)
        needed = f"(octet_length(x) < {SHORT_BYTES} OR x RLIKE {text_sql(needs)}) AND " if needs else ""
        tests.append(f"octet_length(x) >= {min(p.least for p in own)} AND {needed}({matched})")
    texts = f"CAST(array({', '.join(map(name_sql, columns))}) AS ARRAY<STRING>)"
    return df.where(f"exists({texts}, x -> {' OR '.join(f'({t})' for t in tests)})")


def pii_column_names(df: DataFrame, indicators: list[str] = NAME_INDICATORS,
                     allowed: tuple = NOT_PERSONAL) -> DataFrame:
    """Columns whose name suggests personal data, with their non-null values."""
    return _findings(df, _name_entries(df, indicators, allowed))


def pii_content_scan(df: DataFrame, patterns: list[Pattern] = INLINE,
                     columns: list[str] | None = None) -> DataFrame:
    """Rows matching each pattern in each text column; all rows, one scan."""
    return _content_findings(df, patterns, columns)


def _content_findings(df: DataFrame, patterns: list[Pattern], columns: list[str] | None = None,
                      by: tuple = ()) -> DataFrame:
    columns = string_columns(df.drop(*by)) if columns is None else columns
    suspects = _suspects(df, patterns, columns)
    return _findings(suspects, _content_entries(df, patterns, columns), by).where(F.col("records") > 0)


def scan(df: DataFrame, patterns: list[Pattern] = INLINE,
         indicators: list[str] = NAME_INDICATORS, allowed: tuple = NOT_PERSONAL,
         by: tuple = (), present: DataFrame | None = None) -> DataFrame:
    """Findings by column name and by content, per unit when `by` names one.

    `present` gives the columns each unit has (by, columns); a name counts only
    for units that have the column.
    """
    data = df.drop(*by)
    found = _findings(df, _name_entries(data, indicators, allowed), by) \
        .unionByName(_content_findings(df, patterns, by=by))
    named = F.col("source") == "name"
    if present is not None:
        found = found.join(present, list(by))
        named = named & F.array_contains("columns", F.col("column_name"))
    return found.where(named | (F.col("records") > 0)).drop("columns")


def findings_of_severity(findings: DataFrame, severities=("HIGH", "CRITICAL")) -> DataFrame:
    return findings.where(F.upper("severity").isin(*severities))


def redact_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every non-null value of the columns becomes the redaction mark."""
    return df.withColumns({
        c: F.when(quoted(c).isNotNull(), F.lit(REDACTED)) for c in columns if c in df.columns})


def flagged_columns(findings: DataFrame) -> list[str]:
    """Columns with a finding; never more than the frame has columns."""
    return sorted(r.column_name for r in findings.select("column_name").distinct().collect())


def pii_gate(df: DataFrame, patterns: list[Pattern] = INLINE,
             allowed: tuple = NOT_PERSONAL) -> DataFrame:
    """FAILED when anything was found, with the number of findings."""
    found = F.count(F.lit(1))
    return scan(df, patterns, allowed=allowed).agg(found.alias("findings")).select(
        F.when(F.col("findings") > 0, "FAILED").otherwise("PASSED").alias("status"),
        F.when(F.col("findings") > 0, "PII detected in file")
         .otherwise("No PII detected").alias("message"), "findings")


def _named(columns: list[str], word: str, keep: str, match: str) -> list[str]:
    if match == "substring":
        return [c for c in columns if word in c.lower() and c != keep]
    if match == "token":
        return [c for c in columns if word in re.split("[^a-z0-9]+", c.lower()) and c != keep]
    raise ValueError(f"match must be 'token' or 'substring', not {match!r}")


def anonymize_hash_ids(df: DataFrame, match: str = "token") -> DataFrame:
    """SHA-256 of identifier columns, report_id excepted."""
    return df.withColumns({
        c: F.sha2(quoted(c).cast("string"), 256)
        for c in _named(df.columns, "id", "report_id", match)})


def anonymize_mask_names(df: DataFrame, match: str = "token") -> DataFrame:
    """The redaction mark in name columns, disease_name excepted; nulls too."""
    return df.withColumns({
        c: F.lit(REDACTED) for c in _named(df.columns, "name", "disease_name", match)})


def generalize_postcode(df: DataFrame, column: str = "postcode") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, outward_postcode(quoted(column)))


def anonymize(df: DataFrame, match: str = "token") -> DataFrame:
    """Hash identifiers, mask names and shorten postcodes."""
    return df.transform(anonymize_hash_ids, match).transform(anonymize_mask_names, match) \
        .transform(generalize_postcode)


def redact_text(text: Column, patterns: list[Pattern] = UK_CONFIG) -> Column:
    """Replace every match inside a text; postcodes keep their outward part.

    Texts without what any of the patterns needs are passed over.
    """
    needs = sorted({p.needs for p in patterns if p.needs})
    given, needed = text, len(needs) > 0 and all(p.needs for p in patterns)
    for p in patterns:
        if p.action == "partial_redact":
            text = F.regexp_replace(text, POSTCODE_PARTS, "$1 ***")
        else:
            text = F.regexp_replace(text, p.regex, REDACTED)
    return F.when(given.rlike("|".join(needs)), text).otherwise(given) if needed else text


def apply_pii_actions(df: DataFrame, columns: list[str] | None = None,
                      patterns: list[Pattern] = UK_CONFIG) -> DataFrame:
    """redact_text on the given, by default all, text columns."""
    columns = string_columns(df) if columns is None else columns
    return df.withColumns({c: redact_text(quoted(c), patterns) for c in columns})
