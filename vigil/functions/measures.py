"""Column expressions for rates, bands and bounded values."""

from pyspark.sql import Column, functions as F


def clamp_negative(value: Column) -> Column:
    """Negative values become 0; null stays null."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def clamp(value: Column, low: float, high: float) -> Column:
    # when/otherwise keeps nulls, which least/greatest would replace by a bound.
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def outside(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """True where the value is below low or above high; null for null values."""
    if low is None and high is None:
        return F.lit(False)
    if low is None:
        return value > F.lit(high)
    if high is None:
        return value < F.lit(low)
    return (value < F.lit(low)) | (value > F.lit(high))


def per_100k(count: Column, population: Column) -> Column:
    return F.try_divide(count, population) * 100000


def percentage_or_zero(part: Column, whole: Column) -> Column:
    """part / whole in percent where whole is positive, else 0."""
    return F.when(whole > 0, F.try_divide(part, whole) * 100).otherwise(F.lit(0.0))


def change_pct(current: Column, previous: Column) -> Column:
    """Percent change; null without a previous value or after 0."""
    return F.try_divide(current - previous, previous) * 100


def share(part: Column, whole: Column) -> Column:
    """part / whole, null for an empty whole."""
    return F.try_divide(part.cast("double"), whole)


def age_group(age: Column, null_label: str = "70+") -> Column:
    """Age bands; a missing age falls into the last band unless labelled."""
    return (
        F.when(age.isNull(), F.lit(null_label))
        .when(age < 18, "0-17").when(age < 30, "18-29")
        .when(age < 50, "30-49").when(age < 70, "50-69")
        .otherwise("70+")
    )


def count_if(condition: Column) -> Column:
    """Rows for which the condition holds; 0, not null, for an empty frame."""
    return F.count(F.when(condition, F.lit(1)))
