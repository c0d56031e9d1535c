"""The eight landing sources, derived from order, customer, part and nation tables.

``spoiled=True`` blanks or garbles some values (no row is added or dropped) so that gates and
rules have something to find. The expressions are SQL understood by Spark and DuckDB alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.contracts import INGESTED


class Tables:
    """The parquet tables of one folder, each opened on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(self.path(name))
        return self._open[name]


def _us_date(column: str, sep: str = "/") -> str:
    parts = f", '{sep}', ".join(f"CAST({p}({column}) AS STRING)" for p in ("month", "day", "year"))
    return f"concat({parts})"


CALENDAR = {"Date": _us_date("o_orderdate")}

CUSTOMERS = {
    "CustomerKey": "CAST(c_custkey AS INT)",
    "Prefix": "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'MR.' "
    "ELSE 'MS.' END",
    "FirstName": "concat(' ', lower(split_part(c_name, '#', 1)))",
    "LastName": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END",
    "BirthDate": "concat(CAST(1 + c_custkey % 12 AS STRING), '/', "
    "CAST(1 + c_custkey % 28 AS STRING), '/', CAST(1950 + c_custkey % 50 AS STRING))",
    "MaritalStatus": "CASE WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'S' END",
    "Gender": "CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'f' "
    "ELSE 'M' END",
    "EmailAddress": "CASE WHEN c_custkey % 50 = 0 THEN 'bad-address' "
    "ELSE concat('c', CAST(c_custkey AS STRING), '@example.com') END",
    "AnnualIncome": "concat('$', CAST(CAST(floor(abs(c_acctbal)) AS INT) AS STRING), ',000 ')",
    "TotalChildren": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS INT) END",
    "EducationLevel": "'Bachelors '",
    "Occupation": "c_mktsegment",
    "HomeOwner": "CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END",
}

TERRITORIES = {
    "SalesTerritoryKey": "n_nationkey",
    "Region": "lower(n_name)",
    "Country": "r_name",
    "Continent": "CASE WHEN r_name = 'AMERICA' THEN 'americas' "
    "WHEN r_name IN ('ASIA', 'MIDDLE EAST') THEN 'asia' ELSE lower(r_name) END",
}

SALES = {
    "OrderDate": f"CASE o_orderkey % 5 WHEN 0 THEN {_us_date('o_orderdate')} "
    f"WHEN 1 THEN {_us_date('o_orderdate', '-')} "
    "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "StockDate": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "OrderNumber": "concat(' SO', CAST(o_orderkey AS STRING))",
    "ProductKey": "CAST(l_partkey AS INT)",
    "CustomerKey": "CAST(o_custkey AS INT)",
    "TerritoryKey": "c_nationkey",
    "OrderLineItem": "l_linenumber",
    "OrderQuantity": "CAST(CASE WHEN l_partkey % 10 = 0 THEN -l_quantity ELSE l_quantity END "
    "AS INT)",
    INGESTED: "l_shipdate",
    "tie0": "l_orderkey",
    "tie2": "l_suppkey",
}

RETURNS = {
    "ReturnDate": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "TerritoryKey": "c_nationkey",
    "ProductKey": "CAST(l_partkey AS INT)",
    "ReturnQuantity": "CAST(l_quantity AS INT)",
    INGESTED: "o_orderdate",
    "tie1": "l_orderkey",
    "tie2": "l_linenumber",
    "tie3": "l_suppkey",
}

# What ``spoiled`` puts in place of good values.
SPOILED = {
    "calendar": {
        "Date": f"CASE WHEN day(o_orderdate) = 13 THEN 'junk' "
        f"WHEN day(o_orderdate) = 17 THEN NULL ELSE {_us_date('o_orderdate')} END",
    },
    "customers": {
        "CustomerKey": "CASE WHEN c_custkey % 41 = 0 THEN NULL "
        "WHEN c_custkey % 43 = 0 THEN 7 ELSE CAST(c_custkey AS INT) END",
        "EmailAddress": "CASE WHEN c_custkey % 50 = 0 THEN 'bad-address' "
        "WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 59 = 0 THEN 'a@b' "
        "ELSE concat('c', CAST(c_custkey AS STRING), '@example.com') END",
    },
    "products": {
        "ProductKey": "CASE WHEN p_partkey % 61 = 0 THEN NULL WHEN p_partkey % 67 = 0 THEN 5 "
        "ELSE CAST(p_partkey AS INT) END",
        "ProductSKU": "CASE WHEN p_partkey % 71 = 0 THEN '  ' "
        "ELSE concat(' SK-', CAST(p_partkey AS STRING)) END",
        "ProductName": "CASE WHEN p_partkey % 73 = 0 THEN ' ' ELSE p_name END",
        "ProductPrice": "CASE WHEN p_partkey % 79 = 0 THEN '-1.5' WHEN p_partkey % 83 = 0 "
        "THEN '1' WHEN p_partkey % 89 = 0 THEN 'abc' ELSE CAST(p_retailprice AS STRING) END",
    },
    "product_category": {
        "ProductCategoryKey": "CASE WHEN p_type = 'PROMO' THEN NULL ELSE category_key END",
        "CategoryName": "CASE WHEN p_type = 'LARGE' THEN ' ' ELSE lower(p_type) END",
    },
    "product_sub_category": {
        "ProductSubcategoryKey": "CASE WHEN p_brand = 'Brand#3' THEN NULL "
        "ELSE subcategory_key END",
        "ProductCategoryKey": "CASE WHEN p_brand = 'Brand#4' THEN NULL ELSE category_key END",
        "SubcategoryName": "CASE WHEN p_brand = 'Brand#5' THEN ' ' "
        "ELSE concat(lower(p_type), ' ', p_brand) END",
    },
    "territories": {
        "SalesTerritoryKey": "CASE WHEN n_nationkey % 8 = 3 THEN NULL ELSE n_nationkey END",
        "Region": "CASE WHEN n_nationkey % 5 = 1 THEN '  ' ELSE lower(n_name) END",
        "Country": "CASE WHEN n_nationkey % 5 = 2 THEN NULL ELSE r_name END",
        "Continent": "CASE WHEN n_nationkey % 7 = 4 THEN '' ELSE lower(r_name) END",
    },
    "sales": {
        "OrderDate": "CASE WHEN o_orderkey % 13 = 0 THEN 'junk' "
        "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
        "StockDate": "CASE WHEN o_orderkey % 37 = 0 THEN '2016-02-30' "
        "ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END",
        "OrderNumber": "CASE WHEN o_orderkey % 19 = 0 THEN NULL "
        "ELSE concat(' SO', CAST(o_orderkey AS STRING)) END",
        "ProductKey": "CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(l_partkey AS INT) END",
        "CustomerKey": "CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END",
        "TerritoryKey": "CASE WHEN c_nationkey = 4 THEN NULL ELSE c_nationkey END",
        "OrderLineItem": "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_linenumber END",
        "OrderQuantity": "CAST(CASE WHEN l_partkey % 41 = 0 THEN 0 "
        "WHEN l_partkey % 47 = 0 THEN NULL ELSE l_quantity END AS INT)",
    },
    "returns": {
        "ReturnDate": "CASE WHEN l_orderkey % 13 = 0 THEN 'junk' "
        "ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END",
        "TerritoryKey": "CASE WHEN c_nationkey = 4 THEN NULL ELSE c_nationkey END",
        "ProductKey": "CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(l_partkey AS INT) END",
        "ReturnQuantity": "CAST(CASE WHEN l_partkey % 41 = 0 THEN 0 "
        "WHEN l_partkey % 47 = 0 THEN NULL ELSE -l_quantity END AS INT)",
    },
}

# Keys of the two product levels come from a hash of their text, which needs neither a join
# nor a numbering of all products in one place. They are INT by contract, so that of many
# thousands of names two may share a key; the sources that name them fail then.
CATEGORY_KEY = "CAST(conv(substr(md5(p_type), 1, 7), 16, 10) AS INT)"
SUBCATEGORY_KEY = "CAST(conv(substr(md5(concat(p_type, '|', p_brand)), 1, 7), 16, 10) AS INT)"

PRODUCTS = {
    "ProductKey": "CAST(p_partkey AS INT)",
    "ProductSubcategoryKey": "CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE subcategory_key END",
    "ProductSKU": "concat(' SK-', CAST(p_partkey AS STRING))",
    "ProductName": "p_name",
    "ModelName": "split_part(p_name, ' ', 2)",
    "ProductDescription": "CAST(NULL AS STRING)",
    "ProductColor": "split_part(p_name, ' ', 1)",
    "ProductSize": "CAST(p_size AS STRING)",
    "ProductStyle": "CAST(NULL AS STRING)",
    "ProductCost": "CAST(round(p_retailprice * 0.6, 2) AS STRING)",
    "ProductPrice": "CAST(p_retailprice AS STRING)",
}

PRODUCT_CATEGORY = {"ProductCategoryKey": "category_key", "CategoryName": "lower(p_type)"}

PRODUCT_SUB_CATEGORY = {
    "ProductSubcategoryKey": "subcategory_key",
    "SubcategoryName": "concat(lower(p_type), ' ', p_brand)",
    "ProductCategoryKey": "category_key",
}

COLUMNS = {
    "calendar": CALENDAR,
    "customers": CUSTOMERS,
    "product_category": PRODUCT_CATEGORY,
    "product_sub_category": PRODUCT_SUB_CATEGORY,
    "products": PRODUCTS,
    "returns": RETURNS,
    "sales": SALES,
    "territories": TERRITORIES,
}

# Sources that are distinct values of a larger table, and those with text-derived keys.
SMALL = ("calendar", "product_category", "product_sub_category")
KEYED_BY_TEXT = ("product_category", "product_sub_category", "products")

# Orders rows of one key that carry the same ingest time.
# Rows come out of the join of lines and orders dealt out by this column, which their key determines.
DEALT = {"sales": ("tie0",)}
TIES = {"sales": ("ProductKey", "tie2"), "returns": ("tie1", "tie2", "tie3")}


def order_lines(tables: Tables) -> DataFrame:
    """Order lines with their order and its customer's nation.

    Orders meet customers before they meet their lines, so the lines are shuffled once. The
    merge join keeps that plan at every size: Spark would otherwise broadcast short lines.
    """
    orders = tables["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    customers = tables["customer"].select("c_custkey", "c_nationkey")
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
    lines = tables["lineitem"]
    return lines.join(placed.hint("merge"), lines.l_orderkey == placed.o_orderkey)


def raw(
    tables: Tables,
    source: str,
    spoiled: bool = False,
    repeated: bool = False,
    where: str | None = None,
) -> DataFrame:
    """Landing rows of ``source``, with ingest time and tie columns where the table has them.

    ``repeated`` leaves the small sources as they fall out of the large tables, one row per
    order, part or customer, so that each key comes many times. ``where`` picks underlying
    rows, to split a table into successive drops.
    """
    columns = COLUMNS[source] | (SPOILED[source] if spoiled else {})
    category, subcategory = F.expr(CATEGORY_KEY), F.expr(SUBCATEGORY_KEY)
    match source:
        case "calendar":
            base = tables["orders"].select("o_orderdate")
        case "customers":
            base = tables["customer"]
        case "territories":
            nations, regions = tables["nation"], tables["region"]
            base = nations.join(regions, nations.n_regionkey == regions.r_regionkey, "left")
            if repeated:
                customers = tables["customer"].select("c_nationkey")
                base = customers.join(base, customers.c_nationkey == base.n_nationkey)
        case "sales":
            base = order_lines(tables)
        case "returns":
            base = order_lines(tables).filter("l_returnflag = 'R'")
        case "product_category":
            base = tables["part"].select("p_type")
        case "product_sub_category":
            base = tables["part"].select("p_type", "p_brand")
        case "products":
            base = tables["part"]
    if source in SMALL and not repeated:
        base = base.distinct()
    if source in KEYED_BY_TEXT:
        base = base.withColumn("category_key", category)
        if source != "product_category":
            base = base.withColumn("subcategory_key", subcategory)
    if source in ("product_category", "product_sub_category") and not repeated:
        key = "category_key" if source == "product_category" else "subcategory_key"
        names = F.count(F.lit(1)).over(Window.partitionBy(key))
        clash = F.raise_error(F.concat(F.lit(f"two names share the {key} "), F.col(key)))
        base = base.withColumn(key, F.when(names > 1, clash).otherwise(F.col(key)).cast("int"))
    if where:
        base = base.filter(where)
    return base.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def dense_calendar(tables: Tables) -> DataFrame:
    """Every date from the first order to the last."""
    return (
        tables["orders"]
        .selectExpr(
            "min(CAST(o_orderdate AS DATE)) AS low", "max(CAST(o_orderdate AS DATE)) AS high"
        )
        .selectExpr("explode(sequence(low, high)) AS Date")
    )
