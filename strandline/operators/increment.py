"""High-water marks and the rows above them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

EPOCH = dt.datetime(1970, 1, 1)
#: Ranges that a set of keys is covered with.
RANGES = 64


def high_water_mark(df: DataFrame | None, column: str) -> dt.datetime:
    """Greatest value of ``column``; the epoch for a missing or empty table."""
    newest = None if df is None else df.agg(F.max(column)).first()[0]
    return newest or EPOCH


def from_micros(micros: int) -> dt.datetime:
    """A mark kept as microseconds since the epoch, whatever zone the driver runs in."""
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)


def newer_than(df: DataFrame, column: str, mark: dt.datetime) -> DataFrame:
    """Rows strictly above ``mark``; a literal of the column's own type reaches the scan."""
    literal = F.lit(mark)
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        literal = F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.filter(F.col(column) > literal)


def in_ranges(keys: DataFrame, ranges: int = RANGES) -> Column:
    """A condition on the one, whole-numbered column of ``keys`` that all its non-null keys meet.

    It is at most ``ranges`` ranges between literals, however many keys there are, so it reaches the scan,
    which skips row groups and pages that hold none. Keys far apart get ranges of their own. What else
    falls into a range has to be sorted out by a join.
    """
    (name,) = keys.columns
    low, high = keys.agg(F.min(name), F.max(name)).first()
    if low is None:
        return F.lit(False)
    cell = F.floor((F.col(name).cast("bigint") - low) * ranges / (high - low + 1))
    found = keys.filter(F.col(name).isNotNull()).groupBy(cell).agg(F.min(name).alias("low"), F.max(name).alias("high"))
    return reduce(Column.__or__, [F.col(name).between(r.low, r.high) for r in found.collect()])
