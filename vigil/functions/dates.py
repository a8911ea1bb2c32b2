"""Column expressions for parsing dates and naming periods."""

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from vigil.constants import DATE_FORMATS


def parsed_date(text: Column, fmt: str) -> Column:
    """The date in a format of yyyy, MM and dd with separators, null for anything else.

    The parts are put in ISO order and cast, which is several times faster than
    a pattern parser and does not fail slowly on text of another shape.
    """
    digits = re.sub("[yMd]", r"\\d", re.escape(fmt))
    parts = [F.substring(text, fmt.index(p) + 1, len(p)) for p in ("yyyy", "MM", "dd")]
    return F.when(text.rlike(f"^{digits}$"), F.concat_ws("-", *parts).try_cast("date"))


def first_parsed_date(text: Column, formats: list[str] = DATE_FORMATS) -> Column:
    """The date under the first format that parses; null if none does."""
    return F.coalesce(*[parsed_date(text, f) for f in formats])


def is_date(text: Column, fmt: str = "%Y-%m-%d") -> Column:
    """Whether text is a date in a strftime-style format (%Y, %m, %d)."""
    # A single M or d also accepts a value without leading zero, as strptime does.
    names = {"%Y": "yyyy", "%m": "M", "%d": "d"}
    pattern = reduce(lambda p, n: p.replace(n, names[n]), names, fmt)
    return F.try_to_date(text, pattern).isNotNull()


def week_year(date: Column, year_mode: str = "calendar") -> Column:
    """The year paired with an ISO week number.

    'calendar' pairs week 1 of 30 December 2024 with 2024; 'iso' with 2025.
    """
    if year_mode == "calendar":
        return F.year(date)
    if year_mode == "iso":
        return F.extract(F.lit("YEAROFWEEK"), date)
    raise ValueError(f"year_mode must be 'calendar' or 'iso', not {year_mode!r}")


def week_start(date: Column) -> Column:
    """The Monday of the date's week."""
    return F.date_trunc("week", date).cast("date")
