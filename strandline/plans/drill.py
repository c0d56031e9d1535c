"""Any measure down the levels of the calendar: overall, year, quarter, month and day, in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.calendar import date_labels, year_before
from strandline.plans.metrics import (
    KNOWN,
    MEASURES,
    RELATIONSHIPS,
    Distinct,
    Growth,
    LastYear,
    Members,
    Query,
    Ratio,
    Total,
    needed_measures,
    tagged,
    value_of,
)
from strandline.plans.star import Star

# A period is told by these; a level is how many of them it spells out.
LABELS = ("Year", "QuarterNo", "MonthNo", "Day")
LEVELS = len(LABELS) + 1
KEYS = ("level", *LABELS)
_SPAN = {1: "year", 2: "quarter", 3: "month"}


class _Drill(Query):
    def daily(
        self, fact: str, totals: Mapping[str, Total], distincts: Mapping[str, Distinct], every_date: bool = False
    ) -> DataFrame:
        """(group columns, _date, totals, counters) of one fact, from one scan.

        Distinct values cannot be added up from days. But the dates of a value in order show where it is
        new: at a level it counts in the period of a date if its date before lies in another period. So
        each (value, date) is told the levels at which it counts, and these counters do add up;
        no row is repeated per level. ``_date`` is null for rows without a calendar day, the blank
        member. The date filter is left out with ``every_date``.
        """
        date = RELATIONSHIPS[fact]["date"][0]
        needed = [d for d in self._related(fact) if d != "date"]
        priced = {t.times for t in totals.values() if t.times}
        if priced and "products" not in needed:
            needed.append("products")
        keys = [*(RELATIONSHIPS[fact][d][0] for d in needed), date]
        parts = {t.stored: t for t in totals.values()}
        rows = self._rows(fact, [t.column for t in [*parts.values(), *distincts.values()]])
        values = {n: f"_v{i}" for i, n in enumerate(distincts)}
        if distincts:
            shown = [F.col(d.column).alias(v) for d, v in zip(distincts.values(), values.values())]
            rows = rows.select(*keys, *[t.part(False).alias(n) for n, t in parts.items()], *shown)
        else:
            rows = rows.groupBy(*keys).agg(*[t.part(True).alias(n) for n, t in parts.items()])
        for dimension in needed:
            extra = [*self._columns(dimension), *(priced if dimension == "products" else ())]
            rows = self._attach(rows, fact, dimension, extra, spread=True)
        filtered = "date" in self.where and not every_date
        days = self._dimension("date") if filtered else self.star.date
        # One row per date: bounded whatever the facts are.
        known = F.broadcast(days.select(F.col("Date").alias("_date")))
        rows = rows.join(known, F.col(date) == F.col("_date"), "inner" if filtered else "left")
        held = [*self.by, "_date"]
        if not distincts:
            return rows.groupBy(*held).agg(*[F.sum(c).alias(n) for n, c in self._sums(totals).items()])
        seen = tagged(rows, held, self._sums(totals), values)
        order = Window.partitionBy(*self.by, "_kind", "_value").orderBy(F.col("_date").asc_nulls_first())
        before = F.lag("_date").over(order)
        seen = seen.withColumn("_before", before).withColumn("_first", F.row_number().over(order) == 1)

        def new(level: int) -> Column:
            if level == 0:
                return F.col("_first")
            if level in _SPAN:
                span = _SPAN[level]
                return F.col("_before").isNull() | (F.trunc("_before", span) != F.trunc("_date", span))
            return F.lit(True)

        counters = [
            F.count_if((F.col("_kind") == k) & new(level)).alias(f"_n{k}_{level}")
            for k in range(1, len(distincts) + 1)
            for level in range(LEVELS)
        ]
        return seen.groupBy(*held).agg(*[F.sum(f"`{n}`").alias(n) for n in totals], *counters)

    def by_level(self, daily: DataFrame, totals: Sequence[str], distincts: Sequence[str]) -> DataFrame:
        """``daily`` added up per level and period; it has a row per date and group, so five times that."""
        spread = daily.select("*", F.explode(F.array(*map(F.lit, range(LEVELS)))).alias("level"))
        counts = [
            F.sum(F.get(F.array(*[F.col(f"_n{k}_{v}") for v in range(LEVELS)]), F.col("level"))).alias(n)
            for k, n in enumerate(distincts, start=1)
        ]
        return (
            spread.select("*", *_periods("_date"))
            .groupBy(*self.by, *KEYS)
            .agg(*[F.sum(f"`{n}`").alias(n) for n in totals], *counts)
        )

    def periods(self) -> DataFrame:
        """Every period of every level with its dates: a calendar's length, five times."""
        days = self._dimension("date").select("Date", F.explode(F.array(*map(F.lit, range(LEVELS)))).alias("level"))
        return days.select("Date", "level", *_periods("Date"))

    def last_year(self, fact: str, past: Mapping[str, Total]) -> DataFrame:
        """Totals of the dates a year before those of each period."""
        daily = self.daily(fact, past, {}, every_date=True)
        back = year_before(self.periods(), KEYS, self.star.date, self.month_ends)
        joined = daily.join(F.broadcast(back.withColumnRenamed("Date", "_date")), "_date")
        return joined.groupBy(*self.by, *KEYS).agg(*[F.sum(f"`{n}`").alias(n) for n in past])


def _periods(date: str) -> list[Column]:
    labels = dict(zip(("Year", "MonthNo", "Month", "QuarterNo", "Quarter", "Day"), date_labels(F.col(date))))
    return [F.when(F.col("level") > k, labels[name]).alias(name) for k, name in enumerate(LABELS)]


def metric_drill(
    star: Star,
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, str] | None = None,
    month_ends: bool = True,
) -> DataFrame:
    """``measures`` per period at every level of the calendar, and within ``by``.

    Columns: ``by``, level (0 overall to 4 a day), Year, Quarter, MonthNo, Month, Day, the measures.
    Each fact is scanned once, whatever the measures: sums, distinct counts, ratios of them, the year
    before. Rows whose date the calendar lacks form the blank period of each level. Periods in which every
    measure is blank are left out; ratios are never blank and show every period of the calendar.
    ``by`` takes columns of other dimensions that reach every fact asked for.
    """
    query = _Drill(star, by, where or {}, month_ends)
    plain = needed_measures(measures)
    parts, scalars = [], {}
    for fact in RELATIONSHIPS:
        now = {n: m for n, m in plain.items() if isinstance(m, Total) and m.fact == fact}
        unique = {n: m for n, m in plain.items() if isinstance(m, Distinct) and m.fact == fact}
        past = {n: MEASURES[m.of] for n, m in plain.items() if isinstance(m, LastYear) and MEASURES[m.of].fact == fact}
        if (now or unique or past) and (query.reached(fact) != query.by or "date" in query.home.values()):
            raise ValueError(f"{list(by)} cannot split {fact} within its dates")
        if now or unique:
            parts.append(query.by_level(query.daily(fact, now, unique), list(now), list(unique)))
        if past:
            parts.append(query.last_year(fact, past))
    for name, measure in plain.items():
        if isinstance(measure, Members):
            if query._columns(measure.dimension):
                raise ValueError(f"{name} is split by {list(by)}, not by dates")
            scalars[name] = query.members(name, measure).select(f"`{name}`").scalar()
    never_blank = any(isinstance(KNOWN[m], Ratio | Growth) for m in measures)
    if not parts or never_blank and not by:
        parts.append(query.periods().select(*KEYS).distinct())
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    found = [n for n in plain if n in stacked.columns]
    frame = stacked.groupBy(*by, *KEYS).agg(*[F.max(f"`{n}`").alias(n) for n in found]) if found else stacked
    frame = frame.withColumns(scalars)
    level, quarter, month = F.col("level"), F.col("QuarterNo"), F.col("MonthNo")
    result = frame.select(
        *by, "level", "Year", F.when(level >= 2, F.concat(F.lit("Qtr "), quarter)).alias("Quarter"), "MonthNo",
        F.when(level >= 3, F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM")).alias("Month"), "Day",
        *[value_of(m).alias(m) for m in measures],
    )
    shown = [F.col(f"`{m}`").isNotNull() for m in measures]
    return result.filter(reduce(Column.__or__, shown)).orderBy(*by, "level", "Year", "Quarter", "MonthNo", "Day")
