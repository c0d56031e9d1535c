"""Every query by name, as a function of a session and a folder of source tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strandline.contracts import INGESTED, MARK, PROCESSED, SOURCES
from strandline.functions.calendar import date_spine, drill_down
from strandline.functions.values import parse_date
from strandline.operators import star as gold
from strandline.operators.cleaning import CLEANERS, clean_returns, gate
from strandline.operators.increment import EPOCH, high_water_mark, newer_than
from strandline.operators.latest import keep_latest
from strandline.operators.merge import merge_rows
from strandline.operators.quality import (
    QualityGateError,
    append_audit,
    count_duplicates,
    quality_report,
    read_audit,
    verdict,
)
from strandline.plans.lake import GOLD, Lake, LakeStar, gold_marks, ingest_sources, refine_sources, refresh
from strandline.plans.drill import metric_drill
from strandline.plans.metrics import KNOWN, Growth, Ratio, implicit, metric_query
from strandline.plans.star import SourceStar, silver
from strandline.session import run_folder
from strandline.sources.adapters import DEALT, TIES, Tables, raw
from strandline.sources.keyed_table import keyed_table
from strandline.sources.landing import landing_fresh, landing_ready, newest_change
from strandline.sources.namespaces import LAYERS, create_namespaces
from strandline.streaming.bronze import start_ingest
from strandline.streaming.silver import silver_batch, start_clean, start_refine

Query = Callable[[SparkSession, str], DataFrame]

# The two halves that lines and events arrive in.
FIRST_LINES, LATER_LINES = "l_linestatus = 'F'", "l_linestatus = 'O'"
FIRST_EVENTS = "ts < TIMESTAMP_NTZ '2024-01-21 00:00:00'"
LATER_EVENTS = "ts >= TIMESTAMP_NTZ '2024-01-21 00:00:00'"
CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def snake(name: str) -> str:
    return name.lower().replace(" %", "_pct").replace(" ", "_").replace(".", "_")


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the way a report receives them."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, DecimalType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in decimals})


def _report(df: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """Measures under plain names, ratios rounded to six digits."""
    df = as_doubles(df)
    for name in measures:
        if isinstance(KNOWN[name], Ratio | Growth):
            df = df.withColumn(name, F.round(F.col(f"`{name}`"), 6))
        df = df.withColumnsRenamed({name: snake(name)})
    return df


# name: (measures, group columns, further arguments)
VISUALS: dict[str, tuple[tuple[str, ...], tuple[str, ...], dict]] = {
    "revenue_by_region_map": (("Revenue",), ("Region", "Country"), {}),
    "revenue_profit_by_month": (("Revenue", "Profit"), ("Month", "MonthName"), {"order_by": "MonthName"}),
    "revenue_by_category": (("Revenue",), ("CategoryName",), {}),
    "orders_by_category": (("Total Orders",), ("CategoryName",), {}),
    "profit_by_category": (("Profit",), ("CategoryName",), {}),
    "return_rate_by_category": (("Return Rate",), ("CategoryName",), {}),
    "revenue_by_country": (("Revenue",), ("Country",), {}),
    "revenue_by_region": (("Revenue",), ("Region",), {}),
    "revenue_by_year": (("Revenue",), ("Year",), {}),
    "revenue_by_occupation": (("Revenue",), ("Occupation",), {}),
    "revenue_by_gender": (("Revenue",), ("Gender",), {}),
    "return_amount_by_country": (("Total Return Amount",), ("Country",), {}),
    "top_customers_revenue": (("Revenue",), ("FullName",), {"top": 11}),
    "top_products_revenue": (("Revenue",), ("ProductName",), {"top": 10}),
    "top_products_returned": (("Total Returned Quantity",), ("ProductName",), {"top": 10}),
    "kpi_revenue": (("Revenue",), (), {}),
    "kpi_profit": (("Profit",), (), {}),
    "kpi_profit_margin": (("Profit Margin",), (), {}),
    "kpi_total_orders": (("Total Orders",), (), {}),
    "kpi_total_quantity": (("Total Quantity Sold",), (), {}),
    "kpi_return_rate": (("Return Rate",), (), {}),
    "kpi_returned_quantity": (("Total Returned Quantity",), (), {}),
    "kpi_total_customers": (("Total Customers",), (), {}),
    "kpi_avg_order_value": (("Avg Order Value",), (), {}),
    "kpi_total_countries": (("Total Countries",), (), {}),
    "kpi_total_regions": (("Total Regions",), (), {}),
    "kpi_return_orders": (("Total Return Orders",), (), {}),
    "kpi_return_amount": (("Total Return Amount",), (), {}),
    "revenue_by_category_filtered": (
        ("Revenue", "Total Orders", "Return Rate"),
        ("CategoryName",),
        {"where": {"territories": "Country = 'Asia'", "date": "Year = 1997"}},
    ),
    # Measures that a group column does not reach.
    "return_rate_by_gender": (("Total Quantity Sold", "Return Rate"), ("Gender",), {}),
    "total_countries_by_category": (("Total Countries",), ("CategoryName",), {}),
    "countries_and_revenue_by_year": (("Revenue", "Total Countries"), ("Year",), {}),
    "returns_by_category_and_gender": (
        ("Total Quantity Sold", "Total Returned Quantity"), ("CategoryName", "Gender"), {},
    ),
    # Several distinct counts of one fact.
    "orders_and_customers_by_category": (("Total Orders", "Total Customers"), ("CategoryName",), {}),
    "kpi_orders_customers_quantity": (("Total Quantity Sold", "Total Orders", "Total Customers"), (), {}),
    # Default aggregates of columns, and rows.
    "implicit_by_country_filtered": (
        ("Sum of sales.OrderQuantity", "Rows of sales", "Sum of returns.ReturnQuantity", "Rows of returns"),
        ("Country",),
        {"where": {"date": "Year = 1997"}},
    ),
    "implicit_by_category": (
        ("Sum of products.ProductPrice", "Count of products.ProductSubcategoryKey", "Sum of sales.OrderLineItem"),
        ("CategoryName",),
        {},
    ),
}

# Drill-downs by date: (measures, group columns, further arguments).
DRILLS: dict[str, tuple[tuple[str, ...], tuple[str, ...], dict]] = {
    "drill_orders_by_date": (("Total Orders", "Return Rate"), (), {}),
    "drill_customers_by_country": (("Total Customers", "Total Orders", "Revenue"), ("Country",), {"where": {"date": "Year = 1997"}}),
    "drill_last_year": (("Revenue", "Revenue LY", "Revenue YoY %"), (), {}),
}

IN_1997 = {"date": "Year = 1997"}

# Measures that look a year back run over the calendar without gaps.
YEAR_BACK: dict[str, tuple[tuple[str, ...], tuple[str, ...], dict]] = {
    "revenue_ly_total": (("Revenue", "Revenue LY"), (), {}),
    "revenue_ly_by_year": (("Revenue", "Revenue LY"), ("Year",), {}),
    "revenue_ly_by_year_shift": (
        ("Revenue", "Revenue LY"), ("Year",), {"month_ends": False},
    ),
    "revenue_yoy_by_month": (
        ("Revenue", "Revenue LY", "Revenue YoY %"), ("Year", "Month"), {},
    ),
    "profit_ly_by_year": (("Profit", "Profit LY"), ("Year",), {}),
    "profit_yoy_by_month": (("Profit", "Profit LY", "Profit YoY %"), ("Year", "Month"), {}),
    "revenue_ly_filtered": (("Revenue", "Revenue LY"), (), {"where": IN_1997}),
    "revenue_yoy_filtered": (
        ("Revenue", "Revenue LY", "Revenue YoY %"), ("Month",), {"where": IN_1997},
    ),
    "profit_ly_by_category_filtered": (
        ("Profit", "Profit LY"), ("CategoryName",), {"where": IN_1997},
    ),
}


# Visuals as built when no dimension but the calendar is small enough to broadcast.
SPREAD: dict[str, tuple[tuple[str, ...], tuple[str, ...], dict]] = {
    "revenue_by_gender_spread": (("Revenue",), ("Gender",), {}),
    "orders_by_gender_spread": (("Total Orders",), ("Gender",), {}),
    "revenue_by_category_and_country_spread": (("Revenue",), ("CategoryName", "Country"), {}),
}


def _visual(spark: SparkSession, folder: str, name: str) -> DataFrame:
    dense = name in YEAR_BACK
    measures, by, options = (VISUALS | YEAR_BACK | SPREAD)[name]
    star = SourceStar(spark, folder, dense, small=frozenset() if name in SPREAD else None)
    return _report(metric_query(star, measures, by, **options), measures)


def _drill(spark: SparkSession, folder: str, name: str) -> DataFrame:
    measures, by, options = DRILLS[name]
    star = SourceStar(spark, folder, dense_dates=name == "drill_last_year")
    return _report(metric_drill(star, measures, by, **options), measures)


# ---- cleaning, gates, newest rows -------------------------------------------------------


def _cleaned(tables: Tables, source: str, spoiled: bool = False, **options) -> DataFrame:
    return CLEANERS[source](raw(tables, source, spoiled, **options))


def clean_query(spark: SparkSession, folder: str, source: str) -> DataFrame:
    return _cleaned(Tables(spark, folder), source).select(*SOURCES[source].columns)


def gate_query(spark: SparkSession, folder: str, source: str) -> DataFrame:
    rows = gate(_cleaned(Tables(spark, folder), source, spoiled=True), source)
    return rows.select(*SOURCES[source].columns)


def dedup_query(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """Newest row per key of rows that repeat their keys."""
    spec = SOURCES[source]
    rows = gate(_cleaned(Tables(spark, folder), source, spoiled=True, repeated=True), source)
    if source not in TIES:
        rows = rows.withColumn(INGESTED, F.lit("2024-01-01").cast("timestamp_ntz"))
    ties = TIES.get(source, spec.ties)
    return keep_latest(rows, spec.keys, ties=ties).select(*spec.columns)


def clean_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates written in every accepted layout, and in some that are not."""
    texts = Tables(spark, folder)["orders"].selectExpr("o_orderkey", f"{DATE_TEXTS} AS text")
    return texts.withColumn("day", parse_date("text"))


DATE_TEXTS = (
    "CASE o_orderkey % 7 "
    "WHEN 0 THEN concat(CAST(month(o_orderdate) AS STRING), '/', "
    "CAST(day(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING)) "
    "WHEN 1 THEN concat(CAST(month(o_orderdate) AS STRING), '-', "
    "CAST(day(o_orderdate) AS STRING), '-', CAST(year(o_orderdate) AS STRING)) "
    "WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) "
    "WHEN 3 THEN concat(lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/', "
    "lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', CAST(year(o_orderdate) AS STRING)) "
    "WHEN 4 THEN concat(CAST(year(o_orderdate) AS STRING), '-02-30') "
    "WHEN 5 THEN o_orderpriority ELSE NULL END"
)


def return_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean_returns(raw(Tables(spark, folder), "returns", spoiled=True))
    return rows.groupBy("ReturnKey", "ReturnDate", "TerritoryKey", "ProductKey").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("ReturnQuantity").alias("quantity")
    )


# ---- Gold -------------------------------------------------------------------------------


def gold_query(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return as_doubles(getattr(SourceStar(spark, folder), table))


def fact_sales_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as built when the product list is too large to broadcast."""
    return as_doubles(SourceStar(spark, folder, small=frozenset()).sales)


# ---- quality ----------------------------------------------------------------------------


def _spoiled_report(spark: SparkSession, folder: str, source: str) -> DataFrame:
    rows = _cleaned(Tables(spark, folder), source, spoiled=True)
    return quality_report(rows.withColumn(PROCESSED, F.current_timestamp()), source)


def dq_report(spark: SparkSession, folder: str, source: str) -> DataFrame:
    report = _spoiled_report(spark, folder, source)
    return report.select("table_name", "rule_name", "status", "failed_rows")


def dq_dup(spark: SparkSession, folder: str, source: str) -> DataFrame:
    return count_duplicates(_cleaned(Tables(spark, folder), source, spoiled=True), source)


def dq_verdict(spark: SparkSession, folder: str) -> DataFrame:
    reports = [_spoiled_report(spark, folder, s) for s in SOURCES]
    return verdict(reduce(DataFrame.unionByName, reports))


def _silver_report(spark: SparkSession, folder: str, source: str) -> DataFrame:
    rows = silver(Tables(spark, folder), source)
    return quality_report(rows.withColumn(PROCESSED, F.current_timestamp()), source)


def dq_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Which tables the gate stops."""
    reports = reduce(DataFrame.unionByName, [_silver_report(spark, folder, s) for s in SOURCES])
    return verdict(reports).select("table_name", (F.col("verdict") == "FAIL").alias("stopped"))


def dq_audit_append(spark: SparkSession, folder: str) -> DataFrame:
    """The audit log after two slices."""
    path = run_folder(spark, "audit")
    tables = Tables(spark, folder)
    for lines in (FIRST_LINES, LATER_LINES):
        rows = _cleaned(tables, "sales", spoiled=True, where=lines)
        rows = rows.withColumn(PROCESSED, F.current_timestamp())
        append_audit(quality_report(rows, "sales"), path)
    return read_audit(spark, path).select("table_name", "rule_name", "status", "failed_rows")


def dq_audit_two_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """The audit log over two versions: the first slice was written before there was a count of rows checked,
    when counts of failures were narrower."""
    path, tables = run_folder(spark, "audit"), Tables(spark, folder)
    slices = [
        quality_report(_cleaned(tables, "sales", spoiled=True, where=lines).withColumn(PROCESSED, F.current_timestamp()), "sales")
        for lines in (FIRST_LINES, LATER_LINES)
    ]
    older = slices[0].drop("checked_rows").withColumn("failed_rows", F.col("failed_rows").cast("int"))
    append_audit(older.select("rule_name", "table_name", "failed_rows", "status", MARK, "evaluation_timestamp"), path)
    append_audit(slices[1], path)
    return read_audit(spark, path).select("table_name", "rule_name", "status", "failed_rows", "checked_rows")


# ---- upserts and marks ------------------------------------------------------------------


def _latest_events(tables: Tables, where: str) -> DataFrame:
    rows = tables["events"].filter(where)
    return keep_latest(rows, ["user_id"], "ts", ["event_id"])


def upsert_events(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    first, later = (_latest_events(tables, w) for w in (FIRST_EVENTS, LATER_EVENTS))
    return merge_rows(first, later, ["user_id"])


def upsert_null_key(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    loose = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    first, later = (
        _latest_events(tables, w).withColumn("user_id", loose)
        for w in (FIRST_EVENTS, LATER_EVENTS)
    )
    return merge_rows(first, later, ["user_id"])


def _sales_drop(tables: Tables, where: str) -> DataFrame:
    spec = SOURCES["sales"]
    rows = gate(_cleaned(tables, "sales", where=where), "sales")
    return keep_latest(rows, spec.keys, ties=TIES["sales"]).select(*spec.columns)


def upsert_sales(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    first, later = (_sales_drop(tables, w) for w in (FIRST_LINES, LATER_LINES))
    return merge_rows(first, later, SOURCES["sales"].keys)


def upsert_fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Facts merged on a key that includes the product: a changed product adds a line."""
    star = SourceStar(spark, folder)
    products = silver(star.tables, "products")
    first, later = (
        gold.fact_sales(
            _sales_drop(star.tables, w), products, "products" in star.small, star.hot("products")
        )
        for w in (FIRST_LINES, LATER_LINES)
    )
    keys = ["OrderNumber", "OrderLineItem", "ProductKey"]
    return as_doubles(merge_rows(first, later, keys))


def upsert_keyed_table(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table after two batches, the second delivered twice."""
    tables = Tables(spark, folder)
    table = keyed_table(spark, run_folder(spark, "keyed"), SOURCES["sales"].keys, 8)
    table.upsert(_sales_drop(tables, FIRST_LINES), 1)
    for _ in range(2):
        table.upsert(_sales_drop(tables, LATER_LINES), 2)
    return table.read()


def upsert_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    """A table created empty and then loaded."""
    rows = silver(Tables(spark, folder), "customers")
    table = keyed_table(spark, run_folder(spark, "keyed"), SOURCES["customers"].keys, 8)
    table.bootstrap(rows)
    table.upsert(rows, 1)
    return table.read()


def hwm_slice(spark: SparkSession, folder: str) -> DataFrame:
    """Events above the mark of those already loaded."""
    events = Tables(spark, folder)["events"]
    mark = high_water_mark(events.filter(FIRST_EVENTS), "ts")
    return newer_than(events, "ts", mark)


def gold_hwm(spark: SparkSession, folder: str) -> DataFrame:
    """Marks of a first and of a second load."""
    events = Tables(spark, folder)["events"]
    first = high_water_mark(events.limit(0), "ts")
    second = high_water_mark(events.filter(FIRST_EVENTS), "ts")
    loads = [
        newer_than(rows, "ts", mark).agg(
            F.lit(load).alias("load"),
            F.lit(mark == EPOCH).alias("from_epoch"),
            F.max("ts").alias("mark"),
            F.count(F.lit(1)).alias("rows"),
        )
        for load, mark, rows in ((1, first, events.filter(FIRST_EVENTS)), (2, second, events))
    ]
    return loads[0].unionByName(loads[1])


# ---- landing, Bronze, Silver streams ----------------------------------------------------


def _dropped(
    tables: Tables, source: str, change: Callable[[DataFrame], DataFrame] = lambda rows: rows, **options
) -> DataFrame:
    """Landing rows for ``source``, changed by ``change``, as they are dealt out to files.

    The rows of one key go to one file: within a drop the order of files means nothing. Where rows
    are dealt out by a column that their key determines, they go as they are, without another shuffle.
    """
    columns, dealt = [f.name for f in SOURCES[source].landing_schema], DEALT.get(source, ())
    rows = change(raw(tables, source, **options).select(*columns, *dealt))
    keys = [k for k in SOURCES[source].keys if k in columns] or ["ReturnDate", "TerritoryKey", "ProductKey"]
    if not dealt:
        return rows.repartition(*keys)
    # A window asks for the rows of one value in one task, in which the join has left them, sorted.
    alike = F.count(F.lit(1)).over(Window.partitionBy(*dealt))
    return rows.withColumn("_alike", alike).filter("_alike > 0").select(*columns)


def _drop(lake: Lake, tables: Tables, source: str, *change: Callable[[DataFrame], DataFrame], **options) -> None:
    """Write landing files for ``source``."""
    rows = _dropped(tables, source, *change, **options)
    rows.write.mode("append").options(**CSV).csv(lake.landing(source))


def _lake(spark: SparkSession, label: str, **options) -> Lake:
    return Lake(spark, run_folder(spark, label), buckets=4, **options)


def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze after two drops and three runs, with what lineage says about each row."""
    lake, tables = _lake(spark, "bronze"), Tables(spark, folder)
    for lines in (FIRST_LINES, LATER_LINES):
        _drop(lake, tables, "sales", where=lines)
        ingest_sources(lake, "sales")
    ingest_sources(lake, "sales")
    bronze = spark.read.parquet(lake.bronze("sales"))
    return bronze.select(
        *[f.name for f in SOURCES["sales"].landing_schema],
        F.col("source_file").like("%/incoming/sales/%.csv").alias("from_landing"),
        (F.to_date(INGESTED) == F.col("ingestion_date")).alias("dated"),
    )


def bronze_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze after a good drop and two that break the contract: only the first got in."""
    lake, tables = _lake(spark, "contract"), Tables(spark, folder)
    _drop(lake, tables, "customers")
    ingest_sources(lake, "customers")
    columns = [f.name for f in SOURCES["customers"].landing_schema]
    rows = raw(tables, "customers")
    for broken in (rows.withColumn("New", F.lit("x")), rows.select(*reversed(columns))):
        broken.write.mode("append").options(**CSV).csv(lake.landing("customers"))
        try:
            ingest_sources(lake, "customers")
        except StreamingQueryException:
            continue
        raise AssertionError("a file that breaks the contract was ingested")
    return spark.read.parquet(lake.bronze("customers")).select(*columns)


def silver_stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Silver sales after two drops, each streamed through Bronze."""
    lake, tables = _lake(spark, "silver"), Tables(spark, folder)
    for lines in (FIRST_LINES, LATER_LINES):
        _drop(lake, tables, "sales", where=lines)
        ingest_sources(lake, "sales")
        refine_sources(lake, "sales")
    return lake.silver("sales").read().drop(PROCESSED)


def silver_batch_cuts(spark: SparkSession, folder: str) -> DataFrame:
    """Silver sales after three drops of repeated keys in one run, with small and large batches.

    Both lakes take them from one landing folder.
    """
    landed, tables, found = _lake(spark, "cuts"), Tables(spark, folder), []
    more = lambda rows: rows.withColumn("OrderQuantity", F.col("OrderQuantity") + 1)
    for lines, change in ((FIRST_LINES, more), (LATER_LINES, more), (FIRST_LINES, lambda r: r)):
        _drop(landed, tables, "sales", change, where=lines)
    for cut in (1, 1000):
        lake = _lake(spark, "cuts", files_per_batch=cut, incoming=f"{landed.root}/incoming")
        ingest_sources(lake, "sales")
        refine_sources(lake, "sales")
        found.append(lake.silver("sales").read().drop(PROCESSED).withColumn("cut", F.lit(cut)))
    return found[0].unionByName(found[1])


def lakehouse_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per category of a lake filled by two drops and three runs, the third without news.

    Half of the products land after their sales, and a category is renamed by the second drop.
    """
    lake, tables = _lake(spark, "steps"), Tables(spark, folder)
    for source in SOURCES:
        part = {"products": "p_partkey % 2 = 0", "sales": FIRST_LINES}.get(source)
        _drop(lake, tables, source, where=part)
    refresh(lake, halt=False)
    _drop(lake, tables, "products", where="p_partkey % 2 = 1")
    _drop(lake, tables, "sales", where=LATER_LINES)
    renamed = F.concat("CategoryName", F.lit(" goods"))
    _drop(lake, tables, "product_category", lambda r: r.withColumn("CategoryName", renamed), where="p_type = 'PROMO'")
    refresh(lake, halt=False)
    before = {name: gold_marks(lake, name) for name in GOLD}
    refresh(lake, halt=False)
    if before != {name: gold_marks(lake, name) for name in GOLD}:
        raise AssertionError("a run without news changed Gold")
    return lake_report(lake)


def lakehouse_gate(spark: SparkSession, folder: str) -> DataFrame:
    """What the audit log of every source holds after a run that the gate stopped before Gold."""
    lake, tables = _lake(spark, "gate"), Tables(spark, folder)
    for source in SOURCES:
        _drop(lake, tables, source)
    try:
        refresh(lake)
    except QualityGateError:
        logs = [read_audit(spark, lake.audit(source)) for source in SOURCES]
        loaded = F.lit(any(lake.gold(name).exists() for name in GOLD))
        kept = ("table_name", "rule_name", "status", "failed_rows")
        return reduce(DataFrame.unionByName, logs).select(*kept, loaded.alias("gold_loaded"))
    raise AssertionError("broken rules did not stop the run")


def setup_namespaces(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of one table in the database of every layer, each stored below the layer's folder."""
    root, tables = run_folder(spark, "namespaces"), Tables(spark, folder)
    names = create_namespaces(spark, root, f"lake_{root[-12:]}_")
    rows = _cleaned(tables, "customers").withColumn(PROCESSED, F.current_timestamp())
    layers = (raw(tables, "customers"), rows, gold.dim_customers(rows), quality_report(rows, "customers"))
    found = []
    for name, layer, frame in zip(names, LAYERS, layers, strict=True):
        frame.write.saveAsTable(f"{name}.customers")
        inside = F.col("_metadata.file_path").contains(f"/{layer}/")
        found.append(
            spark.table(f"{name}.customers").select(inside.alias("inside")).agg(
                F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("rows"), F.min("inside").alias("inside")
            )
        )
    return reduce(DataFrame.unionByName, found)


# What the files of a landing folder are made by: one file per value of the column.
PIECES = {"customers": "Occupation", "products": "ProductSize", "territories": "Country", "returns": "TerritoryKey"}
#: Sales that are rare, or that no table has: a source may have little to land, or nothing.
FEW_SALES, NO_SALES = "l_quantity > 49 AND l_linenumber = 7", "l_quantity < 0"


def _drop_pieces(lake: Lake, tables: Tables, source: str, piece: str, where: str | None = None) -> None:
    columns = [f.name for f in SOURCES[source].landing_schema]
    rows = raw(tables, source, where=where).select(*columns).withColumn("piece", F.col(piece))
    folder = f"{lake.landing(source)}/{uuid.uuid4().hex[:8]}"
    rows.repartition("piece").write.partitionBy("piece").options(**CSV).csv(folder)


def _landed(spark: SparkSession, folder: str) -> tuple[Lake, Tables]:
    lake, tables = _lake(spark, "landing"), Tables(spark, folder)
    for source, piece in PIECES.items():
        _drop_pieces(lake, tables, source, piece)
    return lake, tables


def landing_ready_query(spark: SparkSession, folder: str) -> DataFrame:
    """Which sources have landed, in how many files: one for each value that their rows have."""
    lake, tables = _landed(spark, folder)
    _drop_pieces(lake, tables, "sales", "TerritoryKey", FEW_SALES)
    _drop_pieces(lake, tables, "calendar", "Date", "o_totalprice < 0 AND o_orderdate IS NULL")
    return landing_ready(spark, f"{lake.root}/incoming")


def landing_fresh_query(spark: SparkSession, folder: str) -> DataFrame:
    """Which sources have changed since a first wave of files, and in how many files."""
    lake, tables = _landed(spark, folder)
    root = f"{lake.root}/incoming"
    since = newest_change(spark, root) + dt.timedelta(milliseconds=1)
    _drop_pieces(lake, tables, "sales", "TerritoryKey", FEW_SALES)
    _drop_pieces(lake, tables, "returns", "TerritoryKey", NO_SALES)
    _drop_pieces(lake, tables, "customers", "Gender", "c_acctbal > 0")
    return landing_fresh(spark, root, since)


def silver_stream_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Silver sales from a Bronze table of the catalog: merged into a keyed table, and kept as a history.

    The newest rows of the history are those of the keyed table.
    """
    lake, tables = _lake(spark, "named"), Tables(spark, folder)
    bronze_db, silver_db, *_ = create_namespaces(spark, f"{lake.root}/catalog", f"lake_{lake.root[-12:]}_")
    bronze, history = f"{bronze_db}.sales", f"{silver_db}.sales_history"
    merged, kept = lake.silver("sales"), lake.checkpoint("history", "sales")
    for lines in (FIRST_LINES, LATER_LINES):
        _drop(lake, tables, "sales", where=lines)
        paths = (lake.landing("sales"), lake.bronze("sales"), lake.checkpoint("bronze", "sales"))
        start_ingest(spark, "sales", *paths, table=bronze).awaitTermination()
        start_refine(spark, "sales", bronze, merged, lake.checkpoint("silver", "sales"), named=True).awaitTermination()
        start_clean(spark, "sales", bronze, history, kept).awaitTermination()
    newest = silver_batch(spark.table(history), "sales")
    ways = {"keyed": merged.read(), "history": newest}
    return reduce(DataFrame.unionByName, [rows.drop(PROCESSED).withColumn("way", F.lit(way)) for way, rows in ways.items()])


def filled_lake(spark: SparkSession, folder: str) -> Lake:
    """A lake that took one drop of every source from CSV files to Gold."""
    lake, tables = _lake(spark, "lake"), Tables(spark, folder)
    for source in SOURCES:
        _drop(lake, tables, source)
    refresh(lake, halt=False)
    return lake


def lake_report(lake: Lake) -> DataFrame:
    measures = ("Revenue", "Total Orders", "Return Rate")
    return _report(metric_query(LakeStar(lake), measures, ["CategoryName"]), measures)


# Visuals that are answered from stored Gold tables too.
STORED = ("revenue_by_category", "orders_by_category", "return_rate_by_category", "top_customers_revenue", "kpi_avg_order_value")
_LAKES: dict[tuple[str, str], Lake] = {}


def stored_lake(spark: SparkSession, folder: str) -> Lake:
    """The lake that the report queries of a session share: filled when the first of them asks."""
    name = (spark.sparkContext.applicationId, folder)
    if name not in _LAKES:
        _LAKES[name] = filled_lake(spark, folder)
    return _LAKES[name]


def _stored_visual(spark: SparkSession, folder: str, name: str) -> DataFrame:
    measures, by, options = VISUALS[name]
    return _report(metric_query(LakeStar(stored_lake(spark, folder)), measures, by, **options), measures)


def lakehouse_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per category out of a lake that was filled from CSV files end to end."""
    return lake_report(filled_lake(spark, folder))


# ---- dates and default aggregates -------------------------------------------------------


def date_spine_query(spark: SparkSession, folder: str) -> DataFrame:
    return date_spine(SourceStar(spark, folder).date, "Date")


def _hierarchy(spark: SparkSession, folder: str, column: str) -> DataFrame:
    star = SourceStar(spark, folder)
    daily = star.sales.groupBy(column).agg(F.sum("Revenue").alias("revenue"))
    return as_doubles(drill_down(daily, column, ["revenue"]))


def date_hierarchy_birthdate(spark: SparkSession, folder: str) -> DataFrame:
    star = SourceStar(spark, folder)
    spent = star.sales.groupBy("CustomerKey").agg(F.sum("Revenue").alias("revenue"))
    born = star.customers.select("CustomerKey", "BirthDate")
    daily = spent.join(born, "CustomerKey", "left").groupBy("BirthDate")
    daily = daily.agg(F.sum("revenue").alias("revenue"))
    return as_doubles(drill_down(daily, "BirthDate", ["revenue"]))


def implicit_sum_quantity(spark: SparkSession, folder: str) -> DataFrame:
    lines = SourceStar(spark, folder).lines
    return lines.agg(implicit("sales", "OrderQuantity").alias("quantity"))


def implicit_count_category(spark: SparkSession, folder: str) -> DataFrame:
    products = SourceStar(spark, folder).products
    counted = implicit("products", "ProductCategoryKey").alias("categories")
    return products.groupBy("ProductColor").agg(counted)


GOLD_VIEWS = {
    "dim_customers": "customers",
    "dim_date": "date",
    "dim_products": "products",
    "dim_territories": "territories",
    "fact_sales": "sales",
    "fact_returns": "returns",
}


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for source in SOURCES:
        found[f"clean_{source}"] = partial(clean_query, source=source)
        found[f"gate_{source}"] = partial(gate_query, source=source)
        found[f"dedup_{source}"] = partial(dedup_query, source=source)
        found[f"dq_report_{source}"] = partial(dq_report, source=source)
        found[f"dq_dup_{source}"] = partial(dq_dup, source=source)
    for name, table in GOLD_VIEWS.items():
        found[name] = partial(gold_query, table=table)
    for name in (*VISUALS, *YEAR_BACK, *SPREAD):
        found[name] = partial(_visual, name=name)
    for name in STORED:
        found[f"stored_{name}"] = partial(_stored_visual, name=name)
    for name in DRILLS:
        found[name] = partial(_drill, name=name)
    return found | {
        "clean_dates": clean_dates,
        "return_key": return_key,
        "fact_sales_spread": fact_sales_spread,
        "dq_verdict": dq_verdict,
        "dq_gate": dq_gate,
        "dq_audit_append": dq_audit_append,
        "dq_audit_two_schemas": dq_audit_two_schemas,
        "silver_stream_by_name": silver_stream_by_name,
        "upsert_events": upsert_events,
        "upsert_null_key": upsert_null_key,
        "upsert_sales": upsert_sales,
        "upsert_fact_sales": upsert_fact_sales,
        "upsert_keyed_table": upsert_keyed_table,
        "upsert_bootstrap": upsert_bootstrap,
        "hwm_slice": hwm_slice,
        "gold_hwm": gold_hwm,
        "bronze_ingest": bronze_ingest,
        "bronze_contract": bronze_contract,
        "silver_stream_upsert": silver_stream_upsert,
        "landing_ready": landing_ready_query,
        "landing_fresh": landing_fresh_query,
        "lakehouse_refresh": lakehouse_refresh,
        "lakehouse_incremental": lakehouse_incremental,
        "lakehouse_gate": lakehouse_gate,
        "setup_namespaces": setup_namespaces,
        "silver_batch_cuts": silver_batch_cuts,
        "date_spine": date_spine_query,
        "date_hierarchy_orderdate": partial(_hierarchy, column="OrderDate"),
        "date_hierarchy_stockdate": partial(_hierarchy, column="StockDate"),
        "date_hierarchy_birthdate": date_hierarchy_birthdate,
        "implicit_sum_quantity": implicit_sum_quantity,
        "implicit_count_category": implicit_count_category,
    }
