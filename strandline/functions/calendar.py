"""Date spines, date labels and the same period of the year before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_label(day: Column) -> Column:
    return F.date_format(day, "MMM")


def date_spine(df: DataFrame, column: str) -> DataFrame:
    """Every day of every year that ``column`` touches, with the drill-down labels."""
    day = F.col(column).cast("date")
    ends = df.agg(F.year(F.min(day)).alias("first"), F.year(F.max(day)).alias("last"))
    one, twelve, last = F.lit(1), F.lit(12), F.lit(31)
    days = ends.select(
        F.explode(
            F.sequence(
                F.make_date(F.col("first"), one, one), F.make_date(F.col("last"), twelve, last)
            )
        ).alias("Date")
    )
    return days.select("Date", *date_labels(F.col("Date")))


def date_labels(date: Column) -> list[Column]:
    return [
        F.year(date).alias("Year"),
        F.month(date).alias("MonthNo"),
        F.date_format(date, "MMMM").alias("Month"),
        F.quarter(date).alias("QuarterNo"),
        F.concat(F.lit("Qtr "), F.quarter(date)).alias("Quarter"),
        F.dayofmonth(date).alias("Day"),
    ]


def drill_down(daily: DataFrame, date: str, totals: Sequence[str]) -> DataFrame:
    """Totals at year, quarter, month and day level and overall, in one pass.

    ``daily`` holds ``totals`` already added up per ``date``; a date's labels are its own, so no
    calendar is joined. ``level`` counts the levels a row spells out, 0 being the overall total
    and 4 a single day.
    """
    day = F.to_date(date)
    dated = daily.select(*date_labels(day), *totals)
    levels = ("Year", "QuarterNo", "MonthNo", "Day")
    rolled = dated.rollup(*levels).agg(
        *[F.sum(t).alias(t) for t in totals],
        F.grouping_id(*levels).alias("_open"),
        F.max("Quarter").alias("_quarter"),
        F.max("Month").alias("_month"),
    )
    level = F.lit(len(levels)) - F.bit_count("_open")
    return rolled.select(
        level.alias("level"),
        "Year",
        F.when(level >= 2, F.col("_quarter")).alias("Quarter"),
        "MonthNo",
        F.when(level >= 3, F.col("_month")).alias("Month"),
        "Day",
        *totals,
    )


def year_before(
    dates: DataFrame, groups: Sequence[str], calendar: DataFrame, month_ends: bool = True
) -> DataFrame:
    """For each group of dates, the dates one year earlier that ``calendar`` holds.

    ``dates`` has a ``Date`` column and the group columns. A filter on dates narrows ``dates``;
    ``calendar`` is the whole one, else the year before a chosen year would be unknown. Returns (``groups``, ``Date``)
    without repeats. With ``month_ends`` a group that reaches both 27 and 28 February of the
    year after a leap year also takes in 29 February, as it holds that month's end; a plain
    shift can never land on it. Sizes follow the calendar, not the facts.
    """
    back = dates.select(*groups, F.add_months("Date", -12).alias("Date"), F.col("Date").alias("of"))
    if month_ends:
        leap = F.dayofmonth(F.last_day("Date")) == 29
        ends = back.filter((F.month("of") == 2) & F.dayofmonth("of").isin(27, 28) & leap)
        full = ends.groupBy(*groups, F.last_day("Date").alias("Date")).agg(
            F.count_distinct("of").alias("days")
        )
        back = back.select(*groups, "Date").unionByName(
            full.filter(F.col("days") == 2).select(*groups, "Date")
        )
    known = calendar.select("Date").distinct()
    return back.select(*groups, "Date").distinct().join(known, "Date", "left_semi")
