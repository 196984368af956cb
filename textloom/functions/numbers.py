"""Small numeric expressions used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(count: Column, total: Column, digits: int = 2) -> Column:
    """Percentage rounded to ``digits``; zero when the total is zero."""
    return F.coalesce(F.round(F.lit(100.0) * count / F.nullif(total, F.lit(0)), digits), F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is zero where the denominator is zero."""
    return F.coalesce(numerator / F.nullif(denominator, F.lit(0)), F.lit(0.0))


def to_double(value: Column) -> Column:
    """Numeric coercion: anything that is not a number counts as 0.0."""
    number = value.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(number)


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))
