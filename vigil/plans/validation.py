"""Validation of a dataset, or of many files at once."""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from vigil.functions.measures import share
from vigil.functions.patterns import INLINE, Pattern
from vigil.operators import pii, rules as V
from vigil.schemas import name_sql, quoted, text_sql

PII_MESSAGE = "PII detected in file"


def route(status: Column) -> Column:
    """Where data of a status goes: validated, review or quarantine."""
    return F.when(status == "PASSED", "validated").when(status == "WARNING", "review") \
        .otherwise("quarantine")


def validate_dataset(df: DataFrame, rules: list[dict], as_of: date | None = None,
                     patterns: list[Pattern] = INLINE) -> DataFrame:
    """Outcome of one dataset as one row; personal data stops it before the rules."""
    findings = pii.scan(df, patterns).orderBy("column_name", "finding").collect()  # per column
    if findings:
        texts = [f"{f.column_name}: {f.finding}" for f in findings]
        outcome = df.sparkSession.range(1).select(
            F.lit("FAILED").alias("status"), F.lit(PII_MESSAGE).alias("message"),
            F.array(*[F.lit(t) for t in texts]).alias("errors"),
            F.array().cast("array<string>").alias("warnings"))
    else:
        outcome = V.aggregate_results(V.evaluate(df, rules, as_of))
    return outcome.withColumn("route", route(F.col("status")))


def columns_per_file(df: DataFrame, file: str) -> DataFrame:
    """The columns each file has: as noted by the reader, else those with any value."""
    if "file_columns" in df.columns:
        # distinct() hashes and leaves few; first() of a list would sort all rows, and Spark
        # takes distinct() out from below it.
        noted = df.select(quoted(file), "file_columns").distinct()
        return noted.groupBy(quoted(file)).agg(F.get(F.collect_list("file_columns"), F.lit(0)).alias("columns"))
    filled = ", ".join(f"if(count({name_sql(c)}) > 0, {text_sql(c)}, NULL)"
                       for c in df.columns if c != file)
    return df.groupBy(quoted(file)).agg(F.expr(f"array_compact(array({filled})) AS columns"))


def validate_files(df: DataFrame, rules: list[dict], as_of: date | None = None,
                   patterns: list[Pattern] = INLINE, file: str = "original_file") -> DataFrame:
    """Outcome per file of a frame that holds the rows of many files.

    Every step groups by file instead of looping over files: one scan for the
    patterns, one for the rules, one for the row counts. A file is judged by
    the columns it has, not by those other files add to the frame.
    """
    present = columns_per_file(df, file)
    data = df.drop("file_columns")
    filled = " + ".join(f"int({name_sql(c)} IS NOT NULL)" for c in data.columns if c != file)
    rows = data.groupBy(quoted(file)).agg(
        F.expr("count(1) AS record_count"), F.expr(f"sum({filled}) AS filled"))
    found = pii.scan(data, patterns, by=(file,), present=present).groupBy(quoted(file)).agg(
        F.expr("count(1) AS pii_findings"),
        F.sort_array(F.collect_list(F.concat_ws(": ", "column_name", "finding"))).alias("personal"))
    results = V.evaluate(data, rules, as_of, [file], present)
    judged = V.aggregate_results(results, [file])
    measured = results.select(quoted(file), "rule_id", F.explode("details").alias("k", "v")) \
        .groupBy(quoted(file), "rule_id", "k").agg(F.max("v").alias("v")) \
        .groupBy(quoted(file)).agg(F.map_from_entries(F.sort_array(F.collect_list(
            F.struct(F.concat_ws(".", "rule_id", "k").alias("k"), "v")))).alias("details"))
    personal = F.col("pii_findings") > 0
    empty = F.array().cast("array<string>")
    return (
        rows.join(present, file).join(found, file, "left").join(judged, file, "left")
        .join(measured, file, "left")
        .withColumns({
            "pii_findings": F.coalesce("pii_findings", F.lit(0)),
            "completeness": share(F.col("filled"), F.col("record_count") * F.size("columns")),
            "status": F.when(personal, "FAILED").otherwise(F.coalesce("status", F.lit("PASSED"))),
            "message": F.when(personal, PII_MESSAGE).otherwise(
                F.coalesce("message", F.lit("No validation rules applied"))),
            "errors": F.when(personal, F.col("personal")).otherwise(F.coalesce("errors", empty)),
            "warnings": F.when(personal, empty).otherwise(F.coalesce("warnings", empty))})
        .withColumn("route", route(F.col("status"))).drop("filled", "columns", "personal")
    )
