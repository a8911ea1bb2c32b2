"""Schema helpers: which columns of a frame an operator applies to."""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)

def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def integer_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.IntegerType, T.LongType))]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]


def has_columns(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def quoted(name: str) -> Column:
    """Column reference that also works for names with dots or spaces."""
    return F.col(name_sql(name))


# Wide frames need thousands of expressions; as text they reach Spark in one call each.

def name_sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_sql(text: str | None) -> str:
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "''") + "'"


def literal_sql(value) -> str:
    """A number, text or date as SQL."""
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, float):
        return f"double('{value!r}')"
    return text_sql(value) if isinstance(value, str) else repr(value)


def rows_of(measures: DataFrame, rows: list[dict[str, str]], keep: tuple = ()) -> DataFrame:
    """One row per dict of SQL texts over each row of measures, next to the kept columns."""
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in row.items()) + ")" for row in rows)
    return measures.selectExpr(*[name_sql(k) for k in keep], f"inline(array({structs}))")
