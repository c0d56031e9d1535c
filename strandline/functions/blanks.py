"""Arithmetic of report measures, where a missing value is a blank rather than unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(top: Column, bottom: Column, otherwise: float = 0.0) -> Column:
    """``top / bottom`` in double; a blank or zero ``bottom`` gives ``otherwise``."""
    top, bottom = top.cast("double"), bottom.cast("double")
    return F.when(bottom.isNull() | (bottom == 0), F.lit(otherwise)).otherwise(top / bottom)


def blank_minus(left: Column, right: Column) -> Column:
    """Blank counts as zero in a difference, unless both sides are blank."""
    zero = F.lit(0)
    return F.when(
        left.isNotNull() | right.isNotNull(), F.coalesce(left, zero) - F.coalesce(right, zero)
    )


def distinct_with_blank(column: Column) -> Column:
    """Distinct values where blank counts as one value; blank itself over no rows."""
    seen = F.count_distinct(column) + F.coalesce(F.max(column.isNull().cast("int")), F.lit(0))
    return F.when(F.count(F.lit(1)) > 0, seen)
