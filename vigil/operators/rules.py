"""Declarative validation rules, evaluated together in one aggregate."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vigil import constants as C
from vigil.functions import numbers
from vigil.functions.dates import first_parsed_date
from vigil.functions.measures import outside
from vigil.operators.quality import counted_rows
from vigil.plans import quantiles
from vigil.schemas import (
    literal_sql, name_sql, numeric_columns, quoted, rows_of, string_columns, text_sql,
)

# --- one form for all spellings ---------------------------------------------------


def _is_text(bounds: dict) -> bool:
    return any(isinstance(v, str) for v in bounds.values())


def _split_ranges(ranges: dict[str, dict]) -> dict:
    """Ranges with text bounds are date ranges, the others value ranges."""
    dates = [{"column": c, **b} for c, b in ranges.items() if _is_text(b)]
    values = {c: b for c, b in ranges.items() if not _is_text(b)}
    return {k: v for k, v in [("date_ranges", dates), ("value_ranges", values)] if v}


def normalize_rule(rule: dict) -> dict:
    """A rule in the canonical spelling: rule_id, rule_type, enabled and its settings."""
    rule = dict(rule)
    kind = rule.pop("rule_type", None) or rule.pop("type", None)
    rule.pop("type", None)
    out = {"rule_id": rule.pop("rule_id", None) or rule.pop("id", None),
           "enabled": rule.pop("enabled", True), **rule}
    if kind == "data_types":
        kind = "data_type"
    elif kind == "value_ranges":
        kind = "business_logic"
        out.update(_split_ranges({**out.pop("ranges", {}), **out.pop("value_ranges", {})}))
    elif kind == "quality":
        kind = "data_quality"
        checks = out.pop("checks", {})
        outliers = checks.get("outlier_detection")
        out["null_threshold"] = checks.get("null_threshold", C.NULL_LIMIT)
        if "duplicate_threshold" in checks:
            out.update(check_duplicates=True, duplicate_threshold=checks["duplicate_threshold"])
        if outliers:
            out.update(outlier_columns="numeric", outlier_factor=outliers.get("threshold", 1.5))
        if "completeness" in checks:
            out["minimum_completeness"] = checks["completeness"].get(
                "minimum_required", C.COMPLETENESS_LIMIT)
        required = [f["field"] for f in checks.get("completeness_checks", []) if f.get("required")]
        if required:
            out["required_nonnull"] = required
    if isinstance(out.get("date_range"), dict):
        out.setdefault("date_ranges", []).append(out.pop("date_range"))
    out["rule_type"] = kind
    return out


def _named_field_rules(dataset: str, sections: dict) -> list[dict]:
    """Rules of a per-dataset section document."""
    rules = []
    if "schema" in sections:
        rules.append({"type": "schema", "id": f"{dataset}_schema", **sections["schema"]})
    if "data_types" in sections:
        rules.append({"type": "data_types", "id": f"{dataset}_types",
                      "column_types": sections["data_types"]})
    for r in sections.get("business_rules", []):
        bounds = {k: r[k] for k in ("min", "max") if k in r}
        if bounds:
            rules.append({"type": "value_ranges", "id": r["name"], "ranges": {r["field"]: bounds}})
        if "allowed_values" in r:
            rules.append({"type": "allowed_values", "id": r["name"], "column": r["field"],
                          "allowed_values": r["allowed_values"]})
    if "data_quality" in sections:
        rules.append({"type": "quality", "id": f"{dataset}_quality",
                      "checks": sections["data_quality"]})
    return [{**r, "dataset_type": dataset} for r in rules]


def rules_from_document(document) -> list[dict]:
    """Enabled rules of a rule list, a {rules: [...]} or a {validation_rules: {...}} document."""
    if isinstance(document, dict) and "validation_rules" in document:
        found = [r for d, s in document["validation_rules"].items()
                 for r in _named_field_rules(d, s)]
    elif isinstance(document, dict):
        dataset = document.get("dataset_type")
        found = [{**({"dataset_type": dataset} if dataset else {}), **r}
                 for r in document.get("rules", [])]
    else:
        found = document
    return [r for r in map(normalize_rule, found) if r["enabled"]]


# --- evaluation ---------------------------------------------------------------------

@dataclass
class _Outcome:
    """Messages and measures of one rule as SQL; each message is text or null."""

    errors: list[str]
    warnings: list[str]
    details: list[tuple[str, str]]
    passed: str
    failed: str


class _Measures:
    """Collects the aggregates all rules need and names each.

    `present` is SQL for the columns a unit has; None when all units have all.
    """

    def __init__(self, present: str | None = None):
        self.columns: list[Column] = []
        self.present = present

    def if_present(self, column: str, value: str) -> str:
        if self.present is None:
            return value
        return f"if(array_contains({self.present}, {text_sql(column)}), {value}, NULL)"

    def add(self, aggregate: str | Column) -> str:
        name = f"m{len(self.columns)}"
        column = F.expr(aggregate) if isinstance(aggregate, str) else aggregate
        self.columns.append(column.alias(name))
        return name

    def count(self, condition: str | Column) -> str:
        if isinstance(condition, str):
            return self.add(f"coalesce(sum(if({condition}, __n, 0)), 0)")
        return self.add(F.coalesce(F.sum(F.when(condition, F.col("__n"))), F.lit(0)))


def _message(condition: str, *parts: str) -> str:
    """Text put together from literals and (in braces) SQL, where the condition holds."""
    pieces = [p[1:-1] if p.startswith("{") else text_sql(p) for p in parts]
    return f"if({condition}, concat({', '.join(pieces)}), NULL)"


def _sql(value: str) -> str:
    return "{" + value + "}"


def _schema(rule, df, measures) -> _Outcome:
    required = rule.get("required_columns", [])
    optional = rule.get("optional_columns", [])
    if measures.present is None:
        missing = [c for c in required if c not in df.columns]
        errors = [text_sql(f"Missing columns: {', '.join(missing)}")] if missing else []
        details = [(f"optional_{c}", "1D" if c in df.columns else "0D") for c in optional]
    else:
        wanted = f"CAST(array({', '.join(map(text_sql, required))}) AS ARRAY<STRING>)"
        missing = f"array_except({wanted}, {measures.present})"
        errors = [_message(f"size({missing}) > 0", "Missing columns: ",
                           _sql(f"array_join({missing}, ', ')"))]
        details = [(f"optional_{c}", f"int(array_contains({measures.present}, {text_sql(c)}))")
                   for c in optional]
    return _Outcome(errors, [], details, "Schema validation passed", "Schema validation failed")


_COMPATIBLE = {
    "string": (T.StringType,),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,),
}


def _parsed(column: Column, expected: str) -> Column:
    parsers = {"datetime": first_parsed_date, "integer": numbers.integer, "float": numbers.number}
    return parsers[expected](column) if expected in parsers else column.try_cast(expected)


def _data_type(rule, df, measures) -> _Outcome:
    errors = []
    for c, expected in rule.get("column_types", {}).items():
        if c not in df.columns:
            continue
        actual = df.schema[c].dataType
        if isinstance(actual, _COMPATIBLE.get(expected, ())):
            continue
        message = f"Column '{c}' has type '{actual.simpleString()}', expected '{expected}'"
        if isinstance(actual, T.StringType) and expected in _COMPATIBLE:
            # Text is accepted when every value parses as the expected type.
            value = quoted(c)
            bad = measures.count(value.isNotNull() & _parsed(value, expected).isNull())
            errors.append(_message(f"{bad} > 0", message))
        elif expected != actual.simpleString():
            errors.append(text_sql(message))
    return _Outcome(errors, [], [], "Data type validation passed", "Data type validation failed")


def _as_date(column: Column, kind: T.DataType) -> Column:
    return first_parsed_date(column) if isinstance(kind, T.StringType) else column.cast("date")


def _bound(value, as_of: date | None):
    if value == "current_date":
        if as_of is None:
            raise ValueError("a current_date bound needs an as_of date")
        return as_of
    return date.fromisoformat(value) if isinstance(value, str) else value


def _number_sql(df: DataFrame, c: str) -> str:
    text = isinstance(df.schema[c].dataType, T.StringType)
    return numbers.number_sql(name_sql(c)) if text else name_sql(c)


def _business_logic(rule, df, measures, as_of) -> _Outcome:
    errors, warnings = [], []
    split = _split_ranges(rule.get("value_ranges", {}))
    for r in rule.get("date_ranges", []) + split.get("date_ranges", []):
        if r["column"] in df.columns:
            value = _as_date(quoted(r["column"]), df.schema[r["column"]].dataType)
            found = measures.count(outside(
                value, _bound(r.get("min"), as_of), _bound(r.get("max"), as_of)))
            errors.append(_message(f"{found} > 0", "Found ", _sql(found),
                                   " records with dates outside valid range"))
    for c, r in split.get("value_ranges", {}).items():
        if c not in df.columns:
            continue
        for side, sign, words in [("min", "<", "below minimum"), ("max", ">", "above maximum")]:
            bound = r.get(side)
            if bound is not None:
                found = measures.count(f"{_number_sql(df, c)} {sign} {literal_sql(bound)}")
                warnings.append(_message(f"{found} > 0", f"Column '{c}' has ", _sql(found),
                                         f" values {words} {bound}"))
    done = "Business logic validation completed"
    return _Outcome(errors, warnings, [], done, done)


def _percent(value: str) -> str:
    return _sql(f"format_string('%.2f%%', {value} * 100)")


def _data_quality(rule, df, measures, fences) -> _Outcome:
    errors, warnings, details = [], [], []
    rows = measures.add("coalesce(sum(__n), 0)")

    def share(part: str) -> str:
        return f"try_divide({part}, {rows})"

    limit = rule.get("null_threshold", C.NULL_LIMIT)
    complete = rule.get("minimum_completeness")
    for c in df.columns:
        ratio = measures.if_present(c, share(measures.count(f"{name_sql(c)} IS NULL")))
        details.append((f"{c}_null_ratio", ratio))
        warnings.append(_message(f"{ratio} > {limit}D", f"Column '{c}' has ", _percent(ratio),
                                 f" null values (threshold: {limit:.0%})"))
        if complete is not None:
            warnings.append(_message(
                f"1 - {ratio} < {complete}D", f"Column '{c}' is ", _percent(f"(1 - {ratio})"),
                f" complete (minimum: {complete:.0%})"))
    if rule.get("check_duplicates"):
        repeated = measures.add("coalesce(sum(__n - 1), 0)")
        details.append(("duplicate_count", repeated))
        warnings.append(_message(f"{share(repeated)} > {rule.get('duplicate_threshold', 0.0)}D",
                                 "Found ", _sql(repeated), " duplicate rows"))
    for c in _outlier_columns(rule, df):
        if c not in fences:
            continue
        value, (low, high) = _number_sql(df, c), fences[c]
        found = measures.count(f"{value} < {low} OR {value} > {high}")
        if isinstance(df.schema[c].dataType, T.StringType):
            # Text counts as a numeric column only if every value is a number.
            others = measures.count(f"{name_sql(c)} IS NOT NULL AND {value} IS NULL")
            found = f"if({others} = 0, {found}, NULL)"
        found = measures.if_present(c, found)
        details.append((f"{c}_outliers", found))
        warnings.append(_message(f"{share(found)} > {rule.get('outlier_threshold', 0.0)}D",
                                 f"Column '{c}' has ", _sql(found), " potential outliers"))
    for c in rule.get("required_nonnull", []):
        if c in df.columns:
            missing = measures.if_present(c, measures.count(f"{name_sql(c)} IS NULL"))
            errors.append(_message(f"{missing} > 0", f"Column '{c}' has ", _sql(missing),
                                   " missing values"))
    done = "Data quality validation completed"
    return _Outcome(errors, warnings, details, done, done)


def _outlier_columns(rule: dict, df: DataFrame) -> list[str]:
    """The columns to look at; 'numeric' means all, in a frame of text all text columns."""
    wanted = rule.get("outlier_columns", [])
    numeric, text = numeric_columns(df), string_columns(df)
    return numeric or text if wanted == "numeric" else [c for c in wanted if c in numeric + text]


def _allowed_values(rule, df, measures) -> _Outcome:
    warnings = []
    c = rule["column"]
    if c in df.columns:
        found = measures.count(~quoted(c).isin(rule["allowed_values"]))
        warnings.append(_message(f"{found} > 0", f"Column '{c}' has ", _sql(found),
                                 " values outside the allowed list"))
    done = "Allowed values validation completed"
    return _Outcome([], warnings, [], done, done)


def _outcome(rule, df, measures, as_of, fences) -> _Outcome:
    kind = rule["rule_type"]
    if kind == "schema":
        return _schema(rule, df, measures)
    if kind == "data_type":
        return _data_type(rule, df, measures)
    if kind == "business_logic":
        return _business_logic(rule, df, measures, as_of)
    if kind == "data_quality":
        return _data_quality(rule, df, measures, fences)
    if kind == "allowed_values":
        return _allowed_values(rule, df, measures)
    unknown = f"Unknown rule type: {kind}"
    return _Outcome([], [text_sql(unknown)], [], unknown, unknown)


RESULT_COLUMNS = {
    "position": "int", "rule_id": "string", "rule_type": "string", "status": "string",
    "message": "string", "details": "map<string,double>", "errors": "array<string>",
    "warnings": "array<string>",
}


def _result(position: int, rule: dict, o: _Outcome) -> dict[str, str]:
    """The result row of a rule."""
    errors, warnings = (f"array_compact(CAST(array({', '.join(m)}) AS ARRAY<STRING>))"
                        for m in (o.errors, o.warnings))
    failed, warned = f"size({errors}) > 0", f"size({warnings}) > 0"
    details = ", ".join(f"{text_sql(k)}, double({v})" for k, v in o.details)
    return {
        "position": str(position), "rule_id": text_sql(rule["rule_id"]),
        "rule_type": text_sql(rule["rule_type"]),
        "status": f"CASE WHEN {failed} THEN 'FAILED' WHEN {warned} THEN 'WARNING' "
                  "ELSE 'PASSED' END",
        "message": f"if({failed}, {text_sql(o.failed)}, {text_sql(o.passed)})",
        "details": f"map_filter(CAST(map({details}) AS MAP<STRING, DOUBLE>), "
                   "(k, v) -> v IS NOT NULL)",
        "errors": errors, "warnings": warnings}


def _unit_fences(df: DataFrame, by: list[str], factors: dict[float, set]):
    """Quartile fences per unit as SQL, by factor, and the frame whose columns they name."""
    columns = sorted(set().union(*factors.values()))
    quartiles = df.groupBy(*[quoted(k) for k in by]).agg(*[
        F.expr(f"percentile({_number_sql(df, c)}, array(0.25, 0.75)) AS __q{i}")
        for i, c in enumerate(columns)])
    fences = {}
    for factor, own in factors.items():
        fences[factor] = {}
        for c in own:
            low, high = (f"__q{columns.index(c)}[{side}]" for side in (0, 1))
            spread = f"{factor}D * ({high} - {low})"
            fences[factor][c] = (f"({low} - {spread})", f"({high} + {spread})")
    return quartiles, fences


def evaluate(df: DataFrame, rules: list[dict], as_of: date | None = None,
             by: list[str] | None = None, present: DataFrame | None = None) -> DataFrame:
    """One result row per enabled rule, and per unit when `by` names units such as files.

    `present` gives the columns each unit has (by, columns); other columns of
    the frame do not count for the unit.

    Outlier fences (interpolated quartiles) come from their own passes; every
    other count of every rule comes from a single aggregate. When a rule looks
    for repeated rows, that aggregate runs over the distinct rows with their
    number of copies, so it still is one scan. Units must be of bounded size,
    as admitted files are; a whole table needs no unit.
    """
    by = by or []
    rules = [r for r in map(normalize_rule, rules) if r["enabled"]]
    if not rules:
        return df.select(*[quoted(k) for k in by]).limit(0) \
            .withColumns({name: F.lit(None).cast(kind) for name, kind in RESULT_COLUMNS.items()})
    data = df.drop(*by)
    quality = [r for r in rules if r["rule_type"] == "data_quality"]
    if any(r.get("check_duplicates") for r in quality):
        source = counted_rows(df)
    else:
        source = df.withColumn("__n", F.lit(1).cast("bigint"))
    factors: dict[float, set] = {}
    for r in quality:
        factors.setdefault(r.get("outlier_factor", 1.5), set()).update(_outlier_columns(r, data))
    fences: dict[float, dict] = {}
    if by and any(factors.values()):
        quartiles, fences = _unit_fences(df, by, factors)
        source = source.join(quartiles, by)
    for factor, columns in factors.items() if not by else ():
        if columns:
            found = quantiles.iqr_fences(df, sorted(columns), factor, interpolated=True)
            fences[factor] = {c: (literal_sql(float(low)), literal_sql(float(high)))
                              for c, (low, high) in found.items()}
    measures = _Measures("columns" if present is not None else None)
    results = [
        _result(position, r, _outcome(r, data, measures, as_of,
                                      fences.get(r.get("outlier_factor", 1.5), {})))
        for position, r in enumerate(rules)]
    measured = source.groupBy(*[quoted(k) for k in by]) \
        .agg(F.expr("count(1) AS __rows"), *measures.columns)
    if present is not None:
        measured = measured.join(present, by)
    return rows_of(measured, results, tuple(by))


def result_details(results: DataFrame) -> DataFrame:
    """Measured values as rows: rule_id, key, value."""
    return results.select("rule_id", F.explode("details").alias("key", "value"))


def _severity(status: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in C.STATUSES]), status)


def aggregate_results(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The outcome of a rule set: worst status, all errors and warnings in rule order."""
    by = by or []
    worst = F.min(_severity(F.col("status")))

    def joined(name: str) -> Column:
        # One entry per rule, so the list is as short as the rule set.
        ordered = F.sort_array(F.collect_list(F.struct("position", F.col(name).alias("m"))))
        return F.flatten(F.transform(ordered, lambda e: e["m"]))

    merged = results.groupBy(*[quoted(k) for k in by]).agg(
        worst.alias("worst"), joined("errors").alias("errors"), joined("warnings").alias("warnings"))
    status = F.coalesce(F.get(F.array(*[F.lit(s) for s in C.STATUSES]),
                              F.col("worst").cast("int") - 1), F.lit("PASSED"))
    message = (
        F.when(F.col("worst").isNull(), "No validation rules applied")
        .when(F.col("status") == "ERROR", "Validation encountered errors")
        .when(F.col("status") == "FAILED", "Validation failed")
        .when(F.col("status") == "WARNING", "Validation passed with warnings")
        .otherwise("All validations passed"))
    return merged.withColumn("status", status) \
        .select(*[quoted(k) for k in by], "status", message.alias("message"), "errors", "warnings")


def disallowed_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values outside the list with their number of rows."""
    return df.where(~quoted(column).isin(allowed)).groupBy(quoted(column).alias("value")) \
        .agg(F.count(F.lit(1)).alias("records"))


def lineage_rule(fields: list[str] = C.LINEAGE_FIELDS) -> dict:
    """The schema rule that asks for the lineage metadata columns."""
    return {"rule_id": "lineage_fields", "rule_type": "schema", "required_columns": fields}


def default_rules() -> list[dict]:
    """The default rule set in its configuration spelling."""
    # Rule ids, columns, ranges and thresholds.
    return rules_from_document({"rules": [
        {"id": "schema_validation", "type": "schema", "enabled": True,
         "required_columns": ["report_date", "case_count", "region"],
         "optional_columns": ["death_count", "hospitalization_count", "vaccination_status",
                              "age_group", "gender"]},
        {"id": "data_type_validation", "type": "data_types", "enabled": True,
         "column_types": {
             "report_date": "datetime", "case_count": "integer", "death_count": "integer",
             "hospitalization_count": "integer", "region": "string", "age_group": "string",
             "gender": "string", "vaccination_status": "string"}},
        {"id": "value_range_validation", "type": "value_ranges", "enabled": True,
         "ranges": {"case_count": {"min": 0, "max": 1000000},
                    "death_count": {"min": 0, "max": 10000},
                    "report_date": {"min": "2020-01-01", "max": "current_date"}}},
        {"id": "region_validation", "type": "allowed_values", "enabled": True,
         "column": "region", "allowed_values": C.REGIONS},
        {"id": "data_quality_checks", "type": "quality", "enabled": True,
         "checks": {"null_threshold": 0.1, "duplicate_threshold": 0.05,
                    "outlier_detection": {"method": "iqr", "threshold": 1.5},
                    "completeness": {"minimum_required": 0.95}}},
    ]})
