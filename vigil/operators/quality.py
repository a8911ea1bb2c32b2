"""Profiles and dataset-level checks, all measures of a run in one aggregate."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F, types as T

from vigil import constants as C
from vigil.functions.measures import count_if
from vigil.plans import quantiles
from vigil.schemas import literal_sql, name_sql, numeric_columns, quoted, rows_of, text_sql

#: Numbers of the bitmaps, of 32,768 bits each: from -32,767 to 131,072; days from 1880 on.
BITMAPS = range(5)


def stage_metrics(df: DataFrame, stage: str) -> DataFrame:
    """Row count, column count and schema of a frame as one row."""
    return df.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(stage).alias("stage"), "record_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(df.schema.simpleString()).alias("schema"))


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values per column, null counted as a value.

    The exact form counts whole numbers and dates of a small range in bitmaps. Of
    other columns it shuffles 16 bytes for every distinct value of a task: copies
    collapse before the shuffle, so a frequent value costs nothing. Two values of
    those are taken for one if both their 64-bit hashes are equal: among 10^12 distinct
    values a chance of about 1 in 10^15.
    """
    names = [(c, name_sql(c)) for c in df.columns]
    if approximate:
        measured = df.agg(*[F.expr(
            f"coalesce(approx_count_distinct({n}) + max(int({n} IS NULL)), 0) AS d{i}")
            for i, (_, n) in enumerate(names)])
        return rows_of(measured, [
            {"column_name": text_sql(c), "distinct_count": f"bigint(d{i})"}
            for i, (c, _) in enumerate(names)])
    few = _in_bitmaps(df)
    rest = [c for c in df.columns if c not in few]
    known = rows_of(df.sparkSession.range(1), [
        {"column_name": text_sql(c), "distinct_count": f"bigint({n})"} for c, n in few.items()]) if few else None
    if not rest:
        return known
    pairs = rows_of(df, [{"i": str(i), **_identity(df.schema[c])} for i, c in enumerate(rest)])
    names = F.array(*[F.lit(c) for c in rest])
    counted = pairs.distinct().groupBy("i").agg(F.count(F.lit(1)).alias("distinct_count")) \
        .select(F.element_at(names, F.col("i") + 1).alias("column_name"), "distinct_count")
    return counted.unionByName(known) if few else counted


def _in_bitmaps(df: DataFrame) -> dict[str, int]:
    """Distinct values of whole-number, date and flag columns all of whose values have a bit
    in BITMAPS: one aggregate whose partial results are a few kilobytes per column."""
    values = {}
    for f in df.schema:
        if isinstance(f.dataType, T.IntegralType):
            values[f.name] = f"bigint({name_sql(f.name)})"
        elif isinstance(f.dataType, T.DateType):
            values[f.name] = f"bigint(unix_date({name_sql(f.name)}))"
        elif isinstance(f.dataType, T.BooleanType):
            values[f.name] = f"bigint({name_sql(f.name)})"
    if not values:
        return {}
    measures = []
    for i, v in enumerate(values.values()):
        bucket = f"bitmap_bucket_number({v})"
        bits = " + ".join(
            f"coalesce(bitmap_count(bitmap_construct_agg(bitmap_bit_position({v})) FILTER (WHERE {bucket} = {k})), 0)"
            for k in BITMAPS)
        measures += [f"{bits} + coalesce(max(int({v} IS NULL)), 0) AS d{i}",
                     f"count_if({bucket} NOT BETWEEN {BITMAPS[0]} AND {BITMAPS[-1]}) AS beyond{i}"]
    row = df.agg(*map(F.expr, measures)).first()
    return {c: row[f"d{i}"] for i, c in enumerate(values) if not row[f"beyond{i}"]}


def _identity(field: T.StructField) -> dict[str, str]:
    """Two numbers that tell a value from all others of its column, as SQL: a whole number
    itself, else two 64-bit hashes with seeds of their own. Null is a value."""
    name = name_sql(field.name)
    if isinstance(field.dataType, T.IntegralType):
        return {"a": f"coalesce(bigint({name}), 0L)", "b": f"bigint({name} IS NULL)"}
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        name = f"({name} + 0.0D)"  # turns -0.0 into 0.0, which is the same value
    elif isinstance(field.dataType, T.MapType):
        name = f"string({name})"
    return {"a": f"xxhash64({name})", "b": f"xxhash64('second', {name})"}


def profile(df: DataFrame, approximate_distinct: bool = False) -> DataFrame:
    """Per column: nulls, distinct values, completeness and, for numbers, statistics."""
    numeric = numeric_columns(df)
    measured = ["count(1) AS n"]
    for i, c in enumerate(df.columns):
        name = name_sql(c)
        measured.append(f"count_if({name} IS NULL) AS null{i}")
        if c in numeric:
            value = f"double({name})"
            measured += [f"min({value}) AS min{i}", f"max({value}) AS max{i}",
                         f"avg({value}) AS mean{i}", f"stddev({value}) AS stddev{i}"]
    medians = quantiles.quantiles(df, {c: [0.5] for c in numeric})
    rows = []
    for i, c in enumerate(df.columns):
        median = medians[c][0] if c in medians else None
        rows.append({
            "column_name": text_sql(c),
            "data_type": text_sql(df.schema[c].dataType.simpleString()),
            "null_count": f"null{i}",
            "null_percentage": f"coalesce(try_divide(null{i}, n) * 100, 0D)",
            "completeness": f"coalesce(try_divide(n - null{i}, n) * 100, 0D)",
            **{m: f"{m}{i}" if c in numeric else "double(NULL)"
               for m in ("min", "max", "mean", "stddev")},
            "median": f"double({'NULL' if median is None else literal_sql(median)})"})
    distinct = distinct_counts(df, approximate_distinct)
    return rows_of(df.agg(*map(F.expr, measured)), rows).join(distinct, "column_name", "left") \
        .withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))


def counted_rows(df: DataFrame) -> DataFrame:
    """Each distinct row once, with its number of copies in `__n`."""
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))


def etl_quality_checks(df: DataFrame, null_limit: float = C.NULL_LIMIT,
                       duplicate_limit: float = C.DUPLICATE_LIMIT) -> DataFrame:
    """Null share per column and share of repeated rows against their limits."""
    measured = counted_rows(df).agg(
        F.expr("coalesce(sum(__n), 0) AS total"),
        F.expr("coalesce(sum(__n - 1), 0) AS repeated"),
        *[F.expr(f"coalesce(sum(if({name_sql(c)} IS NULL, __n, 0)), 0) AS null{i}")
          for i, c in enumerate(df.columns)])

    def check(name: str, count: str, limit: float) -> dict[str, str]:
        percentage = f"coalesce(try_divide({count}, total) * 100, 0D)"
        return {"check_name": text_sql(name), "failing_count": count,
                "percentage": percentage, "passed": f"{percentage} <= {limit * 100}D"}

    checks = [check(f"{c}_null_check", f"null{i}", null_limit) for i, c in enumerate(df.columns)]
    checks.append(check("duplicate_check", "repeated", duplicate_limit))
    return rows_of(measured, checks).withColumn(
        "overall_passed", F.min("passed").over(Window.partitionBy(F.lit(0))))


# --- check results --------------------------------------------------------------

@dataclass
class Row:
    """One result of a check, as SQL over the names of its measures."""

    column: str | None
    metric: str
    passed: str
    value: str = "NULL"
    detail: str = "NULL"


@dataclass
class Check:
    """Measures of one check, as SQL by name, and the result rows made from them."""

    name: str
    measures: dict[str, str]
    rows: list[Row]
    on_failure: str = "FAILED"

    def results(self) -> list[dict[str, str]]:
        # A check without columns passes.
        rows = self.rows or [Row(None, "none", "true")]
        passed = " AND ".join(f"({r.passed})" for r in rows)
        status = f"if({passed}, 'PASSED', '{self.on_failure}')"
        return [{
            "check_name": text_sql(self.name), "status": status,
            "column_name": text_sql(r.column), "metric": text_sql(r.metric),
            "value": f"double({r.value})", "detail": f"string({r.detail})",
            "passed": r.passed} for r in rows]


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Evaluate checks in one pass; one row per check, column and metric."""
    measured = df.agg(F.expr("count(1) AS rows"), *[
        F.expr(f"{sql} AS {name}") for c in checks for name, sql in c.measures.items()])
    return rows_of(measured, [r for c in checks for r in c.results()])


def completeness_check(df: DataFrame, threshold: float = C.COMPLETENESS_LIMIT) -> Check:
    rows = []
    for i, c in enumerate(df.columns):
        ratio = f"coalesce(try_divide(filled{i}, rows), 0D)"
        rows.append(Row(c, "completeness", f"{ratio} >= {threshold}D", ratio))
    return Check("completeness", {
        f"filled{i}": f"count({name_sql(c)})" for i, c in enumerate(df.columns)}, rows)


def validity_check(df: DataFrame, ranges: dict[str, dict]) -> Check:
    """Rows outside [min, max]; only columns of the frame with both bounds."""
    columns = [c for c, r in ranges.items() if c in df.columns and {"min", "max"} <= r.keys()]
    measures = {
        f"invalid{i}": f"count_if({name_sql(c)} < {literal_sql(ranges[c]['min'])}"
                       f" OR {name_sql(c)} > {literal_sql(ranges[c]['max'])})"
        for i, c in enumerate(columns)}
    rows = [Row(c, "invalid_count", f"invalid{i} = 0", f"invalid{i}")
            for i, c in enumerate(columns)]
    return Check("validity", measures, rows)


def consistency_check(df: DataFrame) -> Check:
    """Columns named like a date need a smallest and a largest value."""
    columns = [c for c in df.columns if "date" in c.lower()]
    measures, rows = {}, []
    for i, c in enumerate(columns):
        for bound in ("min", "max"):
            name = f"{bound}_date{i}"
            measures[name] = f"{bound}({name_sql(c)})"
            rows.append(Row(c, f"{bound}_date", f"{name} IS NOT NULL", detail=name))
    return Check("consistency", measures, rows, on_failure="WARNING")


def outlier_check(df: DataFrame, columns: list[str] | None = None, threshold: float = 3.0) -> Check:
    """Values more than `threshold` standard deviations from the mean, below 1 % of rows.

    The means come from a first pass over the columns; columns that do not vary
    are left out.
    """
    kinds = (T.IntegerType, T.LongType, T.DoubleType)
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    columns = [c for c in columns if c in df.columns]
    measures, rows = {}, []
    if columns:
        row = df.agg(*[F.expr(e) for i, c in enumerate(columns) for e in (
            f"avg({name_sql(c)}) AS m{i}", f"stddev({name_sql(c)}) AS s{i}")]).first()
        for i, c in enumerate(columns):
            mean, deviation = row[f"m{i}"], row[f"s{i}"]
            if not deviation or deviation <= 0:
                continue
            measures[f"outside{i}"] = (
                f"count_if(abs(({name_sql(c)} - {literal_sql(mean)}) / {literal_sql(deviation)})"
                f" > {threshold}D)")
            passed = f"outside{i} < rows * 0.01D"
            rows += [Row(c, "outlier_count", passed, f"outside{i}"),
                     Row(c, "outlier_percentage", passed, f"try_divide(outside{i}, rows) * 100")]
    return Check("outliers", measures, rows, on_failure="WARNING")


def completeness(df: DataFrame, threshold: float = C.COMPLETENESS_LIMIT) -> DataFrame:
    return run_checks(df, [completeness_check(df, threshold)])


def validity(df: DataFrame, ranges: dict[str, dict]) -> DataFrame:
    return run_checks(df, [validity_check(df, ranges)])


def consistency(df: DataFrame) -> DataFrame:
    return run_checks(df, [consistency_check(df)])


def outliers_zscore(df: DataFrame, columns: list[str] | None = None,
                    threshold: float = 3.0) -> DataFrame:
    return run_checks(df, [outlier_check(df, columns, threshold)])


def uniqueness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows against distinct keys; null keys are equal to each other."""
    keys = df.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("copies"))
    measured = keys.agg(F.expr("coalesce(sum(copies), 0) AS total"), F.expr("count(1) AS distinct"))
    metrics = {"total_rows": "total", "unique_rows": "distinct", "duplicate_count": "total - distinct"}
    check = Check("uniqueness", {}, [
        Row(", ".join(columns), m, "total = distinct", v) for m, v in metrics.items()])
    return rows_of(measured, check.results())


def quality_summary(results: DataFrame) -> DataFrame:
    """Number of checks by outcome."""
    status = F.col("status")
    return results.select("check_name", "status").distinct().agg(
        F.count(F.lit(1)).alias("total_checks"),
        count_if(status == "PASSED").alias("passed"),
        count_if(status == "FAILED").alias("failed"),
        count_if(status == "WARNING").alias("warnings"))


# What the quality job checks.
JOB_KEY = ["report_date", "region"]
JOB_RANGES = {
    "case_count": {"min": 0, "max": 1000000},
    "death_count": {"min": 0, "max": 10000},
}


def quality_job(df: DataFrame) -> DataFrame:
    """All checks of the quality job; one scan, one key count, one pass for means."""
    checked = run_checks(df, [
        completeness_check(df, 0.95), validity_check(df, JOB_RANGES),
        consistency_check(df), outlier_check(df)])
    return checked.unionByName(uniqueness(df, JOB_KEY))
