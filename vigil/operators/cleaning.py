"""Names, types, dates, regions, missing values, duplicates and outliers."""

import re
from collections import Counter
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vigil import constants as C
from vigil.functions import dates, measures, numbers
from vigil.operators import windows
from vigil.plans import chunks, quantiles
from vigil.schemas import date_columns, has_columns, numeric_columns, quoted, string_columns


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    clashes = [n for n, k in Counter(names).items() if k > 1]
    if clashes:
        raise ValueError(f"columns would share a name: {sorted(clashes)}")
    return df.toDF(*names)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names; spaces and dashes become underscores."""
    return _renamed(df, [re.sub("[ -]", "_", c.lower()) for c in df.columns])


def snake_case(name: str) -> str:
    # Word starts: a capital after a small letter or digit, or the last capital of a run.
    words = re.sub(r"(?<=[a-z\d])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    kept = re.sub(r"[^a-z\d_]", "", re.sub("[ -]", "_", words.lower()))
    return re.sub("_{2,}", "_", kept)


def standardize_column_names(df: DataFrame) -> DataFrame:
    """snake_case names without other characters."""
    return _renamed(df, [snake_case(c) for c in df.columns])


def rename_aliases(df: DataFrame, aliases: dict[str, list[str]] = C.DATE_FIELD_ALIASES) -> DataFrame:
    """Rename known aliases to their canonical column name."""
    renames = {}
    for target, names in aliases.items():
        present = [n for n in [target, *names] if n in df.columns]
        if len(present) > 1:
            raise ValueError(f"several columns stand for {target}: {present}")
        if present and present[0] != target:
            renames[present[0]] = target
    return df.withColumnsRenamed(renames)


def _typed(column: Column, source: T.DataType, target: str) -> Column:
    text = isinstance(source, T.StringType)
    if target == "date":
        return dates.parsed_date(column, "yyyy-MM-dd") if text else column.cast("date")
    if target == "double":
        return numbers.number(column) if text else column.try_cast(target)
    kind = "int" if target == "integer" else "bigint"
    return numbers.whole_part(column, kind) if text else column.try_cast(kind)


def apply_data_types(df: DataFrame, dataset_type: str) -> DataFrame:
    """Type the known columns of a dataset; values that do not parse become null."""
    wanted = C.DATASET_COLUMN_TYPES.get(dataset_type, {})
    return df.withColumns({
        c: _typed(quoted(c), df.schema[c].dataType, t)
        for c, t in wanted.items() if c in df.columns
    })


def normalize_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Parse date text written in any of the accepted formats."""
    return df.withColumns({
        c: dates.first_parsed_date(quoted(c)) for c in columns if c in df.columns
    })


def _lookup(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def validate_regions(df: DataFrame, column: str = "region") -> DataFrame:
    """Replace known spellings of a region and mark names outside the list."""
    if column not in df.columns:
        return df
    named = F.coalesce(F.element_at(_lookup(C.REGION_VARIANTS), F.lower(quoted(column))),
                       quoted(column))
    return df.withColumn(column, named) \
        .withColumn("valid_region", quoted(column).isin(C.REGIONS))


def map_values(df: DataFrame, column: str, mapping: dict[str, str],
               ignore_case: bool = False) -> DataFrame:
    """Replace the values that appear in the mapping, keep all others."""
    key = F.lower(quoted(column)) if ignore_case else quoted(column)
    return df.withColumn(column, F.coalesce(F.element_at(_lookup(mapping), key), quoted(column)))


def map_regions(df: DataFrame, column: str = "region") -> DataFrame:
    return map_values(df, column, C.REGION_ALIASES)


def map_diseases(df: DataFrame, column: str = "disease_name") -> DataFrame:
    return map_values(df, column, C.DISEASE_ALIASES, ignore_case=True)


# --- missing values -------------------------------------------------------------

def fill_null_constant(df: DataFrame) -> DataFrame:
    """0 for missing numbers, 'Unknown' for missing text."""
    return df.fillna({
        **{c: 0 for c in numeric_columns(df)},
        **{c: C.UNKNOWN for c in string_columns(df)},
    })


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna()


def handle_null_values(df: DataFrame, strategy: str = "fill") -> DataFrame:
    if strategy == "fill":
        return fill_null_constant(df)
    if strategy == "drop":
        return drop_null_rows(df)
    return df


def fill_null_median(df: DataFrame, columns: list[str] | None = None,
                     look: quantiles.Look | None = None) -> DataFrame:
    """The column's median for missing numbers."""
    columns = numeric_columns(df) if columns is None else columns
    medians = quantiles.quantiles(df, {c: [0.5] for c in columns}, look=look)
    return df.withColumns({
        c: F.coalesce(quoted(c), F.lit(m).cast(df.schema[c].dataType))
        for c, (m,) in medians.items() if m is not None
    })


def fill_null_unknown(df: DataFrame) -> DataFrame:
    return df.fillna({c: C.UNKNOWN for c in string_columns(df)})


def fill_null_forward(df: DataFrame, column: str, partition_by: list[str], order_by: str,
                      tie_break: list[str], chunk_rows: int | None = None) -> DataFrame:
    """The last known value before a missing one, per partition in date order."""
    if column == order_by:
        raise ValueError(f"cannot fill {column} along itself")
    chunked = chunks.cut(df, partition_by, order_by, tie_break, chunk_rows)
    filled = chunks.last_known(chunked, column, "__filled")
    return filled.select(*[
        F.col("__filled").alias(c) if c == column else quoted(c) for c in df.columns
    ])


def handle_missing_values(df: DataFrame, order_by: str | None = None,
                          partition_by: list[str] | None = None,
                          tie_break: list[str] | None = None,
                          look: quantiles.Look | None = None) -> DataFrame:
    """Median for numbers, 'Unknown' for text, last known value for dates.

    Dates are only filled along another date column given as order_by.
    """
    df = fill_null_unknown(fill_null_median(df, look=look))
    for c in date_columns(df) if order_by else []:
        if c != order_by:
            df = fill_null_forward(df, c, partition_by or [], order_by, tie_break or [])
    return df


# --- duplicates and outliers ----------------------------------------------------

def remove_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication; copies collapse before the shuffle."""
    return df.dropDuplicates()


def cap_outliers_iqr(df: DataFrame, columns: list[str] | None = None,
                     keep_type: bool = False, look: quantiles.Look | None = None) -> DataFrame:
    """Clamp numbers to the quartile fences; the result is double unless keep_type."""
    columns = numeric_columns(df) if columns is None else columns
    capped = {}
    for c, (low, high) in quantiles.iqr_fences(df, columns, look=look).items():
        value = measures.clamp(quoted(c), float(low), float(high))
        capped[c] = value.cast(df.schema[c].dataType if keep_type else "double")
    return df.withColumns(capped)


# --- load metadata --------------------------------------------------------------

def add_audit_columns(df: DataFrame, source_system: str, run_time: datetime) -> DataFrame:
    stamp = F.lit(run_time).cast("timestamp")
    return df.withColumns({
        "etl_timestamp": stamp,
        "etl_date": F.lit(run_time.date()),
        "source_system": F.lit(source_system),
        "data_version": F.lit(C.DATA_VERSION),
    })


def add_metadata(df: DataFrame, job_name: str, source_system: str, run_time: datetime) -> DataFrame:
    return add_audit_columns(df, source_system, run_time) \
        .withColumn("etl_job_name", F.lit(job_name))


# --- per-dataset rules ----------------------------------------------------------

def clamp_negative_cases(df: DataFrame) -> DataFrame:
    return df.withColumn("case_count", measures.clamp_negative(F.col("case_count")))


def add_incidence_rate(df: DataFrame) -> DataFrame:
    """Cases per 100,000 where the rate is absent and the population present."""
    if "incidence_rate" in df.columns or "population" not in df.columns:
        return df
    return df.withColumn("incidence_rate",
                         measures.per_100k(F.col("case_count"), F.col("population")))


def filter_dose_range(df: DataFrame, low: int = 1, high: int = 5) -> DataFrame:
    return df.where(F.col("dose_number").between(low, high))


def add_positivity_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("positivity_rate", measures.percentage_or_zero(
        F.col("positive_count"), F.col("sample_count")))


def add_case_fatality_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("case_fatality_rate", measures.percentage_or_zero(
        F.col("death_count"), F.col("case_count")))


def add_age_group(df: DataFrame, null_label: str = "70+") -> DataFrame:
    return df.withColumn("age_group", measures.age_group(F.col("age"), null_label))


def apply_business_rules(df: DataFrame, dataset_type: str, tie_break: list[str]) -> DataFrame:
    """The rules of one dataset type; other types pass unchanged."""
    if dataset_type == "communicable_disease":
        df = clamp_negative_cases(df)
        df = windows.rolling_average(df, ["disease_name"], tie_break)
        return add_incidence_rate(df)
    if dataset_type == "immunisation":
        return windows.total_doses(filter_dose_range(df))
    if dataset_type == "surveillance":
        return add_positivity_rate(df)
    return df


def derived_metrics(df: DataFrame, tie_break: list[str]) -> DataFrame:
    """Fatality rate, rolling average and age band, where their inputs exist."""
    if has_columns(df, "death_count", "case_count"):
        df = add_case_fatality_rate(df)
    if has_columns(df, "report_date", "case_count"):
        df = windows.rolling_average(df, ["region"], tie_break)
    if has_columns(df, "age"):
        df = add_age_group(df)
    return df
