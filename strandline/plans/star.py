"""The star schema: Gold tables that are planned when a query first asks for them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strandline.contracts import SOURCES
from strandline.operators import star as gold
from strandline.operators.cleaning import CLEANERS, gate
from strandline.operators.latest import keep_latest
from strandline.operators.lookup import SMALL_LOOKUP_BYTES, hot_keys, stored_bytes
from strandline.sources.adapters import DEALT, SALES, TIES, Tables, dense_calendar, raw

# Sources whose rows carry an arrival time; the others come with one row per key.
TIMED = ("sales", "returns")

# One row per date, and there are fewer than 3.7 million dates: the calendar's size is bounded
# whatever the facts are.
BOUNDED = frozenset({"date"})


class Star:
    """What a measure query needs: two facts, four dimensions and what is known of their size.

    ``small`` names the dimensions whose size was checked to allow a broadcast; of the others
    ``hot`` tells the keys that own much of the facts.
    """

    sales: DataFrame
    returns: DataFrame
    products: DataFrame
    customers: DataFrame
    territories: DataFrame
    date: DataFrame
    small: frozenset[str] = BOUNDED

    def hot(self, dimension: str) -> DataFrame | None:
        """The keys of ``dimension`` to split, under the facts' name for the key."""
        known = self.__dict__.setdefault("_hot", {})
        if dimension not in known:
            known[dimension] = None if dimension in self.small else self._find_hot(dimension)
        return known[dimension]

    def _find_hot(self, dimension: str) -> DataFrame | None:
        return None

    #: By column of ``lines`` another that it determines and that its rows are dealt out by.
    dealt: Mapping[str, str] = {}

    @property
    def lines(self) -> DataFrame:
        """Sales for measures that use no price; a star that prices them lazily has them bare."""
        return self.sales


def silver(tables: Tables, source: str, spoiled: bool = False, dealt: bool = False) -> DataFrame:
    """Cleaned, gated, newest-per-key rows of ``source``, as one lazy plan.

    With ``dealt`` they keep the columns that they are dealt out by.
    """
    spec, within = SOURCES[source], DEALT.get(source, ())
    rows = gate(CLEANERS[source](raw(tables, source, spoiled)), source)
    if source in TIMED:
        rows = keep_latest(rows, spec.keys, ties=TIES[source], within=within)
    rows = rows.select(*spec.columns, *(within if dealt else ()))
    # Every calendar column follows from the date, so equal keys are equal rows.
    return rows.distinct() if source == "calendar" else rows


class SourceStar(Star):
    """Gold tables straight from the source tables, each a lazy plan.

    ``dense_dates`` takes a calendar without gaps, which year-before measures need. ``small``
    replaces the size check.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        dense_dates: bool = False,
        small: frozenset[str] | None = None,
    ) -> None:
        self.tables = Tables(spark, folder)
        self._dense = dense_dates
        if small is not None:
            self.small = BOUNDED | small

    @cached_property
    def small(self) -> frozenset[str]:
        """Dimensions whose source files are small enough to broadcast what comes of them."""
        sources = {"products": "part", "customers": "customer", "territories": "nation"}
        paths = {d: self.tables.path(t) for d, t in sources.items()}
        sizes = stored_bytes(self.tables.spark, *paths.values())
        few = {d for d, p in paths.items() if 0 < sizes[p] <= SMALL_LOOKUP_BYTES}
        return BOUNDED | few

    def _find_hot(self, dimension: str) -> DataFrame | None:
        """Best sellers, great customers and large territories, found in the one column that names
        them. Orders stand for their lines, and customers for theirs: a sketch is a hint."""
        table, name, key = {
            "products": ("lineitem", SALES["ProductKey"], "ProductKey"),
            "customers": ("orders", SALES["CustomerKey"], "CustomerKey"),
            "territories": ("customer", SALES["TerritoryKey"], "TerritoryKey"),
        }[dimension]
        return hot_keys(self.tables[table].selectExpr(f"{name} AS {key}"), key)

    @cached_property
    def _silver_products(self) -> DataFrame:
        return silver(self.tables, "products")

    dealt = {"OrderNumber": DEALT["sales"][0]}

    @cached_property
    def lines(self) -> DataFrame:
        return silver(self.tables, "sales", dealt=True)

    @cached_property
    def sales(self) -> DataFrame:
        few = "products" in self.small
        return gold.fact_sales(self.lines, self._silver_products, few, self.hot("products"))

    @cached_property
    def returns(self) -> DataFrame:
        return gold.fact_returns(silver(self.tables, "returns"))

    @cached_property
    def products(self) -> DataFrame:
        few = "products" in self.small
        products, group = self._silver_products, "ProductSubcategoryKey"
        return gold.dim_products(
            products,
            silver(self.tables, "product_sub_category"),
            silver(self.tables, "product_category"),
            few,
            None if few else hot_keys(products.select(group), group),
        )

    @cached_property
    def customers(self) -> DataFrame:
        return gold.dim_customers(silver(self.tables, "customers"))

    @cached_property
    def territories(self) -> DataFrame:
        return gold.dim_territories(silver(self.tables, "territories"))

    @cached_property
    def date(self) -> DataFrame:
        if self._dense:
            days = dense_calendar(self.tables).selectExpr("CAST(Date AS STRING) AS Date")
            return gold.dim_date(gate(CLEANERS["calendar"](days), "calendar"))
        return gold.dim_date(silver(self.tables, "calendar"))
