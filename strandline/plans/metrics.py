"""Report measures over the star schema and the query that groups, sorts and ranks them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.blanks import blank_minus, distinct_with_blank, safe_divide
from strandline.functions.calendar import month_label, year_before
from strandline.operators.lookup import lookup
from strandline.plans.star import Star


@dataclass(frozen=True)
class Total:
    """Sum of a fact column, times a column of the row's product when ``times`` is given.

    With ``counted`` the number of rows that hold a value, of all rows for the column ``*``.
    """

    fact: str
    column: str
    times: str | None = None
    counted: bool = False

    @property
    def stored(self) -> str:
        """The name under which its part sums are kept until the end."""
        return f"_rows_{self.column}" if self.counted else self.column

    def part(self, summed: bool) -> Column:
        """What one row adds, or with ``summed`` what the rows of a group add."""
        if not self.counted:
            return F.sum(self.column) if summed else F.col(self.column)
        held = F.lit(True) if self.column == "*" else F.col(self.column).isNotNull()
        return F.count_if(held) if summed else held.cast("bigint")


@dataclass(frozen=True)
class Distinct:
    """Distinct values of a fact column."""

    fact: str
    column: str


@dataclass(frozen=True)
class Members:
    """Distinct values of a dimension column, or their sum or count; facts do not filter it."""

    dimension: str
    column: str
    how: str = "distinct"

    def of_rows(self) -> Column:
        column = F.col(self.column)
        return {"distinct": distinct_with_blank, "sum": F.sum, "count": F.count}[self.how](column)


@dataclass(frozen=True)
class Ratio:
    top: str
    bottom: str


@dataclass(frozen=True)
class LastYear:
    """A total over the same period of the year before."""

    of: str


@dataclass(frozen=True)
class Growth:
    """Change against the year before, relative to it."""

    of: str
    before: str


Measure = Total | Distinct | Members | Ratio | LastYear | Growth

# Measure names and definitions.
MEASURES: dict[str, Measure] = {
    "Revenue": Total("sales", "Revenue"),
    "Profit": Total("sales", "Profit"),
    "Profit Margin": Ratio("Profit", "Revenue"),
    "Total Orders": Distinct("sales", "OrderNumber"),
    "Total Quantity Sold": Total("sales", "OrderQuantity"),
    "Total Returned Quantity": Total("returns", "ReturnQuantity"),
    "Return Rate": Ratio("Total Returned Quantity", "Total Quantity Sold"),
    "Revenue LY": LastYear("Revenue"),
    "Revenue YoY %": Growth("Revenue", "Revenue LY"),
    "Profit LY": LastYear("Profit"),
    "Profit YoY %": Growth("Profit", "Profit LY"),
    "Total Customers": Distinct("sales", "CustomerKey"),
    "Avg Order Value": Ratio("Revenue", "Total Orders"),
    "Total Countries": Members("territories", "Country"),
    "Total Regions": Members("territories", "Region"),
    "Total Return Orders": Distinct("returns", "ReturnKey"),
    "Total Return Amount": Total("returns", "ReturnQuantity", times="ProductPrice"),
}

# Many-to-one relationships, fact column to dimension column.
RELATIONSHIPS: dict[str, dict[str, tuple[str, str]]] = {
    "sales": {
        "products": ("ProductKey", "ProductKey"),
        "customers": ("CustomerKey", "CustomerKey"),
        "territories": ("TerritoryKey", "TerritoryKey"),
        "date": ("OrderDate", "Date"),
    },
    "returns": {
        "products": ("ProductKey", "ProductKey"),
        "territories": ("TerritoryKey", "TerritoryKey"),
        "date": ("ReturnDate", "Date"),
    },
}

# What a bare column means when it is dropped into a visual.
IMPLICIT_SUMS: dict[str, tuple[str, ...]] = {
    "sales": (
        "OrderLineItem", "OrderQuantity", "ProductPrice", "ProductCost", "Revenue", "Cost",
        "Profit",
    ),
    "returns": ("ReturnQuantity",),
    "date": ("Year", "Month", "Quarter", "DayOfMonth"),
    "customers": ("AnnualIncome", "TotalChildren"),
    "products": ("ProductCost", "ProductPrice"),
}
IMPLICIT_COUNTS = {"products": ("ProductCategoryKey", "ProductSubcategoryKey")}


def _implicit_measures() -> dict[str, Measure]:
    """Default aggregates as measures, named as a visual labels them, and the rows of each fact."""
    found: dict[str, Measure] = {}
    for label, how, tables in (("Sum", "sum", IMPLICIT_SUMS), ("Count", "count", IMPLICIT_COUNTS)):
        for table, columns in tables.items():
            for column in columns:
                fact = Total(table, column, counted=how == "count")
                found[f"{label} of {table}.{column}"] = fact if table in RELATIONSHIPS else Members(table, column, how)
    return found | {f"Rows of {fact}": Total(fact, "*", counted=True) for fact in RELATIONSHIPS}


# Every measure a query can ask for.
KNOWN: dict[str, Measure] = MEASURES | _implicit_measures()


def implicit(table: str, column: str) -> Column:
    """The default aggregate of a column; columns without one cannot be aggregated."""
    if column in IMPLICIT_SUMS.get(table, ()):
        return F.sum(column)
    if column in IMPLICIT_COUNTS.get(table, ()):
        return F.count(column)
    raise KeyError(f"{table}.{column} has no default aggregate")


# Columns a visual can group by, per dimension.
DIMENSIONS: dict[str, tuple[str, ...]] = {
    "products": (
        "ProductKey", "ProductName", "ProductSKU", "ModelName", "ProductDescription",
        "ProductColor", "ProductSize", "ProductStyle", "ProductCategoryKey", "CategoryName",
        "ProductSubcategoryKey", "SubcategoryName", "ProductCost", "ProductPrice",
    ),
    "customers": (
        "CustomerKey", "Prefix", "FullName", "BirthDate", "MaritalStatus", "Gender",
        "EmailAddress", "AnnualIncome", "TotalChildren", "EducationLevel", "Occupation",
        "HomeOwner",
    ),
    "territories": ("TerritoryKey", "Region", "Country", "Continent"),
    "date": (
        "Date", "Year", "Month", "Quarter", "DayOfMonth", "DayName", "IsWeekend", "MonthName",
    ),
}
# Labels that are sorted by another column of their dimension.
SORTED_BY = {"MonthName": "Month"}
# Columns of a sale that its product's price brings.
PRICED = frozenset({"ProductPrice", "ProductCost", "Revenue", "Cost", "Profit"})
HOME = {column: name for name, columns in DIMENSIONS.items() for column in columns}


class Query:
    def __init__(
        self, star: Star, by: Sequence[str], where: Mapping[str, str], month_ends: bool
    ) -> None:
        self.star, self.by, self.where = star, list(by), dict(where)
        self.month_ends = month_ends
        self.home = {c: HOME[c] for c in self.by}

    def _dimension(self, name: str) -> DataFrame:
        frame: DataFrame = getattr(self.star, name)
        if name == "date":
            frame = frame.withColumn("MonthName", month_label(F.col("Date")))
        condition = self.where.get(name)
        return frame.filter(condition) if condition else frame

    def _related(self, fact: str) -> list[str]:
        """Dimensions this query needs for ``fact``: grouped by, or filtered and reachable."""
        grouped = {self.home[c] for c in self.by}
        return [d for d in RELATIONSHIPS[fact] if d in grouped or d in self.where]

    def reached(self, fact: str) -> list[str]:
        """The group columns that ``fact`` is related to; the others do not split its measures."""
        return [c for c in self.by if self.home[c] in RELATIONSHIPS[fact]]

    def _rows(self, fact: str, columns: Sequence[str]) -> DataFrame:
        """The rows of ``fact``; sales without their prices where ``columns`` need none."""
        if fact == "sales" and not PRICED.intersection(columns):
            return self.star.lines
        return getattr(self.star, fact)

    def _attach(
        self, rows: DataFrame, fact: str, dimension: str, columns: Sequence[str], spread: bool
    ) -> DataFrame:
        """Bring in dimension columns; rows the dimension's filter rejects are dropped.

        ``spread`` is for rows of which one key may own many: those not added up yet, or added up
        per combination of several keys.
        """
        key, dim_key = RELATIONSHIPS[fact][dimension]
        # A grouped key column is blank, not the fact's value, where no dimension row exists.
        brought = {f"_{c}" if c == key else c: F.col(c) for c in columns}
        if dimension in self.where:
            brought["_member"] = F.lit(True)
        dim = self._dimension(dimension).select(
            F.col(dim_key).alias(key), *[c.alias(n) for n, c in brought.items()]
        )
        hot = self.star.hot(dimension) if spread and dimension not in self.star.small else None
        joined = lookup(rows, dim, key, dimension in self.star.small, hot)
        if dimension in self.where:
            joined = joined.filter("_member").drop("_member")
        if key in columns:
            joined = joined.withColumn(key, F.col(f"_{key}")).drop(f"_{key}")
        return joined

    def _columns(self, dimension: str) -> list[str]:
        return [c for c in self.by if self.home[c] == dimension]

    def measured(
        self,
        fact: str,
        totals: Mapping[str, Total],
        distincts: Mapping[str, Distinct] | None = None,
        shifted: bool = False,
        summed: Sequence[Total] = (),
    ) -> DataFrame:
        """Totals and distinct counts of one fact per group, from one scan.

        Without distinct counts, fact rows are added up per combination of dimension keys before
        any dimension is joined, so a join sees each combination once, however often it
        occurs. Distinct values are not additive; they keep their rows until the end, where
        Spark removes repeats per group map-side. With ``shifted`` the dates of a group are
        replaced by those of the year before. ``summed`` lists further totals to add up, for
        two calls to share their first step.
        """
        distincts = distincts or {}
        needed = [d for d in self._related(fact) if not (shifted and d == "date")]
        priced = {t.times for t in totals.values() if t.times}
        if priced and "products" not in needed:
            needed.append("products")
        date = RELATIONSHIPS[fact]["date"][0]
        keys = [RELATIONSHIPS[fact][d][0] for d in needed] + ([date] if shifted else [])
        parts = {t.stored: t for t in [*totals.values(), *summed]}
        parts = {name: parts[name] for name in sorted(parts)}
        rows = self._rows(fact, [t.column for t in [*parts.values(), *distincts.values()]])
        dealt = [self.star.dealt.get(d.column) for d in distincts.values()]
        dealt = [F.col(c).alias("_dealt") for c in dealt if len(dealt) == 1 and c in rows.columns]
        if distincts or not keys:
            values = {f"_v{i}": F.col(d.column) for i, d in enumerate(distincts.values())}
            rows = rows.select(
                *keys, *[t.part(False).alias(n) for n, t in parts.items()], *[v.alias(n) for n, v in values.items()], *dealt
            )
        else:
            values = {}
            rows = rows.groupBy(*keys).agg(*[t.part(True).alias(n) for n, t in parts.items()])
        for dimension in needed:
            extra = [*self._columns(dimension), *(priced if dimension == "products" else ())]
            rows = self._attach(rows, fact, dimension, extra, spread=bool(distincts) or len(keys) > 1)
        if shifted:
            groups = self._columns("date")
            dates = self._dimension("date").select("Date", *groups)
            back = year_before(dates, groups, self.star.date, self.month_ends)
            # A date belongs to one group, so this is no longer than the calendar.
            rows = rows.join(F.broadcast(back.withColumnRenamed("Date", date)), date)
        sums = self._sums(totals)
        if dealt:
            # The rows of a value are in one task already: repeats go without a shuffle.
            seen = rows.groupBy(*self.reached(fact), "_dealt", "_v0").agg(*[F.sum(c).alias(n) for n, c in sums.items()]) if sums else (
                rows.select(*self.reached(fact), "_dealt", "_v0").distinct()
            )
            counted = F.when(F.count(F.lit(1)) > 0, F.count(F.lit(1)))
            return seen.groupBy(*self.reached(fact)).agg(
                *[F.sum(f"`{n}`").alias(n) for n in sums], *[counted.alias(n) for n in distincts]
            )
        if len(distincts) > 1:
            return in_one_pass(rows, self.reached(fact), sums, dict(zip(distincts, values)))
        return rows.groupBy(*self.reached(fact)).agg(
            *[F.sum(c).alias(n) for n, c in sums.items()],
            *[distinct_with_blank(F.col(v)).alias(n) for n, v in zip(distincts, values)],
        )

    @staticmethod
    def _sums(totals: Mapping[str, Total]) -> dict[str, Column]:
        return {n: F.col(t.stored) * F.col(t.times) if t.times else F.col(t.stored) for n, t in totals.items()}

    def members(self, name: str, measure: Members) -> DataFrame:
        rows = self._dimension(measure.dimension).groupBy(*self._columns(measure.dimension))
        return rows.agg(measure.of_rows().alias(name))

    def attach_far(self, groups: DataFrame, part: DataFrame) -> DataFrame:
        """``groups`` with the measures of ``part``, which only some of the group columns split.

        Its value repeats over the groups that differ in the other columns alone: a total is a
        single value, else the part has one row per combination of its columns.
        """
        near = [c for c in self.by if c in part.columns]
        values = [c for c in part.columns if c not in near]
        if not near:
            return groups.withColumns({v: part.select(f"`{v}`").scalar() for v in values})
        told = part.select(*[F.col(c).alias(f"_{c}") for c in near], *[f"`{v}`" for v in values])
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in near])
        return groups.join(told, same, "left").drop(*[f"_{c}" for c in near])

    def groups(self) -> DataFrame | None:
        """All groups there can be, when they come from one dimension."""
        homes = set(self.home.values())
        if len(homes) != 1:
            return None
        return self._dimension(homes.pop()).select(*self.by).distinct()


def tagged(rows: DataFrame, by: Sequence[str], sums: Mapping[str, Column], values: Mapping[str, str]) -> DataFrame:
    """What a group holds, once: (``by``, _kind, _value, a column per sum).

    Kind 0 carries the sums; kind k the values of the k-th of ``values``, null being one of them. Repeats
    within a group are removed map-side, before anything is shuffled, so a value that owns a large
    share of the rows is one row per task.
    """
    shown = [F.col(v).cast("string") for v in values.values()]
    kinds = F.posexplode(F.array(F.lit(None).cast("string"), *shown) if sums else F.array(*shown))
    added = {f"_s{i}": c for i, c in enumerate(sums.values())}
    spread = rows.select(*by, *[c.alias(n) for n, c in added.items()], kinds.alias("_kind", "_value"))
    if not sums:
        spread = spread.withColumn("_kind", F.col("_kind") + 1)
        return spread.distinct()
    first = F.col("_kind") == 0
    seen = spread.groupBy(*by, "_kind", "_value")
    return seen.agg(*[F.sum(F.when(first, F.col(a))).alias(n) for a, n in zip(added, sums)])


def in_one_pass(rows: DataFrame, by: Sequence[str], sums: Mapping[str, Column], values: Mapping[str, str]) -> DataFrame:
    """Sums and several distinct counts per group; ``values`` names the column that each counts."""
    counts = {n: F.count_if(F.col("_kind") == k) for k, n in enumerate(values, start=1)}
    return tagged(rows, by, sums, values).groupBy(*by).agg(
        *[F.sum(f"`{n}`").alias(n) for n in sums], *[F.when(F.count(F.lit(1)) > 0, c).alias(n) for n, c in counts.items()]
    )


def needed_measures(names: Sequence[str]) -> dict[str, Measure]:
    """The plain measures behind ``names``, ratios and growth taken apart."""
    plain: dict[str, Measure] = {}
    for name in names:
        match KNOWN[name]:
            case Ratio(top, bottom):
                plain |= needed_measures([top, bottom])
            case Growth(of, before):
                plain |= needed_measures([of, before])
            case measure:
                plain[name] = measure
    return plain


def value_of(name: str) -> Column:
    match KNOWN[name]:
        case Ratio(top, bottom):
            return safe_divide(value_of(top), value_of(bottom))
        case Growth(of, before):
            return safe_divide(blank_minus(value_of(of), value_of(before)), value_of(before))
    return F.col(f"`{name}`")


def _sorted_by(result: DataFrame, star: Star, column: str, by: Sequence[str]) -> DataFrame:
    """``result`` in the order of a group column, or of the column that it is sorted by."""
    sorter = SORTED_BY.get(column, column)
    if sorter in result.columns:
        return result.orderBy(sorter, *by)
    labels = Query(star, [column], {}, True)._dimension(HOME[column])
    place = labels.groupBy(F.col(column).alias("_label")).agg(F.min(sorter).alias("_place"))
    # One row per label, and a label is a value of a dimension that the groups already hold.
    joined = result.join(place, F.col(column).eqNullSafe(F.col("_label")), "left")
    return joined.orderBy("_place", *by).drop("_label", "_place")


def metric_query(
    star: Star,
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, str] | None = None,
    top: int | None = None,
    month_ends: bool = True,
    order_by: str | None = None,
) -> DataFrame:
    """``measures`` per group of dimension columns, greatest first measure first.

    With ``order_by``, a group column, groups come in that column's order instead; a label with a
    column to sort by comes in the order of that one (months by their number). A measure that
    some group column does not reach repeats its value over that column's groups.

    ``where`` maps a dimension to a SQL condition on it; it reaches the facts related to that
    dimension. Fact rows without a dimension row fall into the null group. Groups in which
    every measure is blank are left out. ``top`` keeps the groups ranked up to that place by
    the first measure, ties included.
    """
    query = Query(star, by, where or {}, month_ends)
    plain = needed_measures(measures)
    parts: list[DataFrame] = []
    for fact in RELATIONSHIPS:
        now = {n: m for n, m in plain.items() if isinstance(m, Total) and m.fact == fact}
        unique = {n: m for n, m in plain.items() if isinstance(m, Distinct) and m.fact == fact}
        past = {
            n: MEASURES[m.of]
            for n, m in plain.items()
            if isinstance(m, LastYear) and MEASURES[m.of].fact == fact
        }
        both = [*now.values(), *past.values()]
        if now or unique:
            parts.append(query.measured(fact, now, unique, summed=both))
        if past:
            parts.append(query.measured(fact, past, shifted=True, summed=both))
    for name, measure in plain.items():
        if isinstance(measure, Members):
            parts.append(query.members(name, measure))

    never_blank = any(isinstance(KNOWN[m], Ratio | Growth) for m in measures)
    if never_blank and by and (groups := query.groups()) is not None:
        parts.append(groups)
    split = [p for p in parts if all(c in p.columns for c in by)]
    far = [p for p in parts if not all(c in p.columns for c in by)]
    if far and not split:
        if (groups := query.groups()) is None:
            raise ValueError(f"no measure of {list(measures)} is related to all of {list(by)}")
        split = [groups]
    elif far and (groups := query.groups()) is not None:
        split.append(groups)
    parts = split
    frame = parts[0]
    if len(parts) > 1:
        # Each part has at most one row per group; grouping keeps null groups together.
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        found = [n for n in plain if n in stacked.columns]
        frame = stacked.groupBy(*by).agg(*[F.max(f"`{n}`").alias(n) for n in found])
    for part in far:
        frame = query.attach_far(frame, part)

    result = frame.select(*by, *[value_of(m).alias(m) for m in measures])
    if by:
        shown = [F.col(f"`{m}`").isNotNull() for m in measures]
        result = result.filter(reduce(Column.__or__, shown))
        first = F.col(f"`{measures[0]}`")
        if top is not None:
            place = F.rank().over(Window.orderBy(first.desc_nulls_last()))
            result = result.withColumn("_place", place).filter(F.col("_place") <= top)
            result = result.drop("_place")
        if order_by is None:
            result = result.orderBy(first.desc_nulls_last(), *by)
        else:
            result = _sorted_by(result, star, order_by, by)
    return result
