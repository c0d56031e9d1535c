"""The layered lake: where its tables live and how one run moves new files through it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.contracts import GOLD_PROCESSED, MARK, PROCESSED, SOURCES
from strandline.operators import star as gold
from strandline.operators.increment import EPOCH, from_micros, in_ranges, newer_than
from strandline.operators.lookup import SMALL_LOOKUP_BYTES, hot_keys
from strandline.operators.quality import (
    QualityGateError,
    append_audit,
    audited_mark,
    enforce,
    quality_report,
    read_audit,
)
from strandline.plans.star import BOUNDED, Star
from strandline.sources.keyed_table import KeyedTable, keyed_table
from strandline.sources.landing import FILES_PER_BATCH
from strandline.streaming.bronze import start_ingest
from strandline.streaming.silver import start_refine


# Of each Silver table the column by which changed lookups find the rows they concern.
RESTATED_BY = {"sales": ("ProductKey",), "products": ("ProductSubcategoryKey",)}


@dataclass(frozen=True)
class Lake:
    """Folders of one lake. ``buckets`` sets how finely keyed tables are rewritten.

    ``incoming`` names landing folders that lie elsewhere, as those that lakes have in common.
    """

    spark: SparkSession
    root: str
    buckets: int = 64
    files_per_batch: int = FILES_PER_BATCH
    incoming: str | None = None

    def landing(self, source: str) -> str:
        return f"{self.incoming or f'{self.root}/incoming'}/{source}"

    def bronze(self, source: str) -> str:
        return f"{self.root}/bronze/{source}"

    def silver(self, source: str) -> KeyedTable:
        # Sorted by load time, so that a slice above a mark skips what was there before, and within
        # it by what rows are looked up by, so that a restatement skips what it does not concern.
        path, keys = f"{self.root}/silver/{source}", SOURCES[source].keys
        return keyed_table(self.spark, path, keys, self.buckets, [PROCESSED, *RESTATED_BY.get(source, ())])

    def gold(self, name: str) -> KeyedTable:
        path, spec = f"{self.root}/gold/{name}", GOLD[name]
        return keyed_table(self.spark, path, spec.keys, self.buckets, spec.cluster)

    def marks(self, name: str) -> str:
        return f"{self.root}/marks/{name}"

    def audit(self, source: str) -> str:
        return f"{self.root}/data_quality_check/{source}"

    def checkpoint(self, layer: str, source: str) -> str:
        return f"{self.root}/checkpoints/{layer}/{source}"


def _fits(table: KeyedTable) -> bool:
    """Whether a table may be broadcast, going by the files it consists of now."""
    return 0 < table.live_bytes() <= SMALL_LOOKUP_BYTES


def _fact_sales(lake: Lake, lines: DataFrame) -> DataFrame:
    """Priced lines, in even partitions: lines are dealt out before they are priced, when they are
    narrower, by the product if the prices are too many to broadcast."""
    products = lake.silver("products")
    if _fits(products):
        return gold.fact_sales(lines.hint("rebalance"), products.read(), True)
    return gold.fact_sales(lines, products.read(), False, hot_keys(lines, "ProductKey"), merge=True)


def _dim_products(lake: Lake, products: DataFrame) -> DataFrame:
    groups, tops = lake.silver("product_sub_category"), lake.silver("product_category")
    few = _fits(groups) and _fits(tops)
    hot = None if few else hot_keys(products, "ProductSubcategoryKey")
    return gold.dim_products(products, groups.read(), tops.read(), few, hot)


def _groups_of(lake: Lake, categories: DataFrame) -> DataFrame:
    """The subcategories of changed categories."""
    groups = lake.silver("product_sub_category").read()
    changed = categories.select("ProductCategoryKey").distinct()
    return groups.join(changed, "ProductCategoryKey", "left_semi").select("ProductSubcategoryKey")


@dataclass(frozen=True)
class GoldTable:
    source: str  # the Silver table whose new rows drive the load
    keys: tuple[str, ...]
    build: Callable[[Lake, DataFrame], DataFrame]
    cluster: tuple[str, ...] = ()  # what reports filter by
    # Silver tables that rows are looked up in: which driving rows their changed rows concern, as
    # a frame of one driving column.
    lookups: Mapping[str, Callable[[Lake, DataFrame], DataFrame]] = field(default_factory=dict)
    # Whether the rows lie in even partitions, as out of a shuffle or of the files of Silver.
    even: bool = False


GOLD: dict[str, GoldTable] = {
    "dim_customers": GoldTable(
        "customers", ("CustomerKey",), lambda lake, rows: gold.dim_customers(rows)
    ),
    "dim_date": GoldTable("calendar", ("Date",), lambda lake, rows: gold.dim_date(rows)),
    "dim_products": GoldTable(
        "products",
        ("ProductKey",),
        _dim_products,
        lookups={
            "product_sub_category": lambda lake, rows: rows.select("ProductSubcategoryKey"),
            "product_category": _groups_of,
        },
    ),
    "dim_territories": GoldTable(
        "territories", ("TerritoryKey",), lambda lake, rows: gold.dim_territories(rows)
    ),
    # A line keeps its identity when its product is corrected.
    "fact_sales": GoldTable(
        "sales",
        ("OrderNumber", "OrderLineItem"),
        _fact_sales,
        ("OrderDate",),
        {"products": lambda lake, rows: rows.select("ProductKey")},
        even=True,
    ),
    "fact_returns": GoldTable(
        "returns", ("ReturnKey",), lambda lake, rows: gold.fact_returns(rows), ("ReturnDate",), even=True
    ),
}


def _drain(queries: Iterable[StreamingQuery]) -> None:
    """Wait for streams that run side by side; the first failure is raised after the last end."""
    failures = []
    for query in list(queries):
        try:
            query.awaitTermination()
        except StreamingQueryException as failure:
            failures.append(failure)
    if failures:
        raise failures[0]


def ingest_sources(lake: Lake, *sources: str) -> None:
    _drain(
        start_ingest(
            lake.spark,
            source,
            lake.landing(source),
            lake.bronze(source),
            lake.checkpoint("bronze", source),
            files_per_batch=lake.files_per_batch,
        )
        for source in sources
    )


def refine_sources(lake: Lake, *sources: str) -> None:
    _drain(
        start_refine(
            lake.spark,
            source,
            lake.bronze(source),
            lake.silver(source),
            lake.checkpoint("silver", source),
        )
        for source in sources
    )


def validate_source(lake: Lake, source: str, halt: bool = True) -> DataFrame | None:
    """Report on Silver rows not validated yet, keep it in the audit log, then halt on failure.

    None when there is nothing new. With ``halt`` off a failed slice only leaves its report
    and counts as looked at.
    """
    path = lake.audit(source)
    try:
        log = read_audit(lake.spark, path)
    except AnalysisException:
        log = None
    mark = audited_mark(log, advance_on_failure=not halt)
    rows = newer_than(lake.silver(source).read(), PROCESSED, mark)
    report = quality_report(rows, source).persist()
    try:
        if report.isEmpty():
            return None
        append_audit(report, path)
        if halt:
            enforce(report)
    finally:
        report.unpersist()
    return read_audit(lake.spark, path).filter(F.col(MARK) > F.lit(mark))


_MARKS = "load BIGINT, source STRING, mark BIGINT"


def gold_marks(lake: Lake, name: str) -> tuple[int, dict[str, int]]:
    """How many loads a Gold table took, and how far each Silver table was taken, in microseconds."""
    try:
        log = lake.spark.read.schema(_MARKS).parquet(lake.marks(name))
        rows = log.groupBy("source").agg(F.max("mark").alias("mark"), F.max("load").alias("load")).collect()
    except AnalysisException:
        return 0, {}
    return max((r.load for r in rows), default=0), {r.source: r.mark for r in rows}


def _note_marks(lake: Lake, name: str, load: int, marks: Mapping[str, int]) -> None:
    """Written after the load: one that dies in between is repeated under its number, with the same result."""
    cells = [c for source, mark in marks.items() for c in (F.lit(source), F.lit(mark).cast("bigint"))]
    rows = lake.spark.range(1).select(F.lit(load).cast("bigint").alias("load"), F.explode(F.create_map(*cells)).alias("source", "mark"))
    rows.write.mode("append").parquet(lake.marks(name))


def load_gold(lake: Lake, name: str) -> bool:
    """Build and merge the Gold rows of Silver rows above the table's mark; False if none.

    Rows below the mark are built again when what they look up has changed: a product that
    lands after its sale prices it, a renamed category reaches its products. Of these rows a scan
    reads the pages that hold a changed key. The marks each load reached, of the driving table and
    of its lookups, are kept in a log, so they are known without a scan.
    """
    spec, target = GOLD[name], lake.gold(name)
    loads, marks = gold_marks(lake, name)

    def changed(source: str) -> tuple[DataFrame, int | None]:
        rows = newer_than(lake.silver(source).read(), PROCESSED, from_micros(marks.get(source, 0)))
        return rows, rows.agg(F.unix_micros(F.max(PROCESSED))).first()[0]

    rows, newest = changed(spec.source)
    reached = marks | ({} if newest is None else {spec.source: newest})
    concerned = []
    for source, concerns in spec.lookups.items():
        looked_up, at = changed(source)
        if at is not None:
            reached[source] = at
            concerned.append(concerns(lake, looked_up))
    if reached == marks:
        return False
    if concerned and spec.source in marks:
        keys = reduce(DataFrame.unionByName, concerned).distinct()
        older = lake.silver(spec.source).read()
        older = older.filter(F.col(PROCESSED) <= F.lit(from_micros(marks[spec.source])))
        older = older.filter(in_ranges(keys)).join(keys, keys.columns, "left_semi")
        rows = rows.unionByName(older.select(*rows.columns))
    if spec.source not in reached:  # nothing that drives this table has landed yet
        return False
    built = spec.build(lake, rows).withColumns(
        {GOLD_PROCESSED: F.current_timestamp(), MARK: F.lit(from_micros(reached[spec.source]))}
    )
    target.upsert(built, loads + 1, spec.even)
    _note_marks(lake, name, loads + 1, reached)
    return True


def _side_by_side(work: Callable[[str], object], names: Iterable[str]) -> list[Exception]:
    """Runs ``work`` for independent names, a few jobs at a time; what went wrong, in order of the names."""

    def attempt(name: str) -> Exception | None:
        try:
            work(name)
        except Exception as failure:  # noqa: BLE001 - handed to the caller
            return failure
        return None

    with ThreadPoolExecutor(max_workers=4) as pool:
        return [failure for failure in pool.map(attempt, names) if failure]


def refresh(lake: Lake, halt: bool = True) -> None:
    """One run over all sources: Bronze, Silver, rules, Gold.

    Every source is checked and leaves its audit rows; only then do broken rules stop the run.
    """
    ingest_sources(lake, *SOURCES)
    refine_sources(lake, *SOURCES)
    failures = _side_by_side(lambda source: validate_source(lake, source, halt), SOURCES)
    for failure in failures:
        if not isinstance(failure, QualityGateError):
            raise failure
    if failures:
        raise QualityGateError("; ".join(map(str, failures)))
    for failure in _side_by_side(lambda name: load_gold(lake, name), GOLD):
        raise failure


def register_views(lake: Lake) -> list[str]:
    """Make stored tables readable from SQL as ``silver_<source>`` and ``gold_<table>``.

    A view shows the table as it is now; register again after the next run.
    """
    tables = {f"silver_{s}": lake.silver(s) for s in SOURCES}
    tables |= {f"gold_{g}": lake.gold(g) for g in GOLD}
    found = {name: table for name, table in tables.items() if table.exists()}
    for name, table in found.items():
        table.read().createOrReplaceTempView(name)
    return list(found)


class LakeStar(Star):
    """The star schema as last loaded into a lake."""

    def __init__(self, lake: Lake) -> None:
        self.lake = lake

    @cached_property
    def small(self) -> frozenset[str]:
        names = ("products", "customers", "territories")
        return BOUNDED | {n for n in names if _fits(self.lake.gold(f"dim_{n}"))}

    def _find_hot(self, dimension: str) -> DataFrame | None:
        key = {"products": "ProductKey", "customers": "CustomerKey", "territories": "TerritoryKey"}[dimension]
        return hot_keys(self.sales.select(key), key)

    @cached_property
    def sales(self) -> DataFrame:
        return self.lake.gold("fact_sales").read()

    @cached_property
    def returns(self) -> DataFrame:
        return self.lake.gold("fact_returns").read()

    @cached_property
    def products(self) -> DataFrame:
        return self.lake.gold("dim_products").read()

    @cached_property
    def customers(self) -> DataFrame:
        return self.lake.gold("dim_customers").read()

    @cached_property
    def territories(self) -> DataFrame:
        return self.lake.gold("dim_territories").read()

    @cached_property
    def date(self) -> DataFrame:
        return self.lake.gold("dim_date").read()
