"""Numbers written as text.

A cast that fails inside Spark is slow even when it yields null, so that only
text of the right shape reaches the cast.
"""

from pyspark.sql import Column, functions as F

from vigil.schemas import text_sql

INTEGER = r"^[+-]?\d+$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def whole_part(text: Column, kind: str) -> Column:
    """The number before the point ('12.7' is 12); null for other text or overflow."""
    digits = F.regexp_extract(F.trim(text), r"^([+-]?\d+)(\.\d*)?$", 1)
    return F.nullif(digits, F.lit("")).try_cast(kind)


def integer(text: Column) -> Column:
    return F.when(F.trim(text).rlike(INTEGER), text.try_cast("bigint"))


def number(text: Column) -> Column:
    return F.when(F.trim(text).rlike(NUMBER), text.try_cast("double"))


def number_sql(name: str) -> str:
    """number, as SQL over a column name."""
    return f"if(trim({name}) RLIKE {text_sql(NUMBER)}, try_cast({name} AS DOUBLE), NULL)"
