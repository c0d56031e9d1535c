"""Gold tables from Silver: four dimensions and two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.lookup import lookup


# Names, order and types of the columns of the Gold tables, in this module.


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "CustomerKey",
        "Prefix",
        F.concat_ws(" ", "FirstName", "LastName").alias("FullName"),
        "BirthDate",
        "MaritalStatus",
        "Gender",
        "EmailAddress",
        "AnnualIncome",
        "TotalChildren",
        "EducationLevel",
        "Occupation",
        "HomeOwner",
    )


def dim_date(calendar: DataFrame) -> DataFrame:
    return calendar.select(
        F.col("Date").cast("date").alias("Date"),
        F.col("year").cast("int").alias("Year"),
        F.col("month").cast("int").alias("Month"),
        F.col("quarter").cast("int").alias("Quarter"),
        F.col("dayOfMonth").cast("int").alias("DayOfMonth"),
        "DayName",
        F.col("IsWeekend").cast("boolean").alias("IsWeekend"),
    )


def dim_products(
    products: DataFrame,
    subcategories: DataFrame,
    categories: DataFrame,
    small_groups: bool = False,
    hot_subcategories: DataFrame | None = None,
) -> DataFrame:
    """Products with their two levels of grouping; a level that is not found stays null.

    The two levels are joined to each other first, so products are joined once.
    """
    groups = subcategories.select(
        "ProductSubcategoryKey",
        F.col("ProductSubcategoryKey").alias("_found"),
        "ProductCategoryKey",
        "SubcategoryName",
    )
    tops = categories.select(
        "ProductCategoryKey", F.col("ProductCategoryKey").alias("_top"), "CategoryName"
    )
    tree = lookup(groups, tops, "ProductCategoryKey", small_groups).drop("ProductCategoryKey")
    joined = lookup(
        products, tree, "ProductSubcategoryKey", small_groups, hot_subcategories, ["ProductKey"]
    )
    return joined.select(
        "ProductKey",
        "ProductName",
        "ProductSKU",
        "ModelName",
        "ProductDescription",
        "ProductColor",
        "ProductSize",
        "ProductStyle",
        F.col("_top").alias("ProductCategoryKey"),
        "CategoryName",
        F.col("_found").alias("ProductSubcategoryKey"),
        "SubcategoryName",
        F.col("ProductCost").cast("decimal(10,4)").alias("ProductCost"),
        F.col("ProductPrice").cast("decimal(10,4)").alias("ProductPrice"),
    )


def dim_territories(territories: DataFrame) -> DataFrame:
    return territories.select(
        F.col("SalesTerritoryKey").cast("int").alias("TerritoryKey"),
        "Region",
        "Country",
        "Continent",
    )


def fact_sales(
    sales: DataFrame,
    products: DataFrame,
    small_products: bool = False,
    hot_products: DataFrame | None = None,
    merge: bool = False,
) -> DataFrame:
    """Order lines priced from the product list, amounts fixed to four decimals.

    ``hot_products`` names the best sellers for a product list too large to broadcast, and ``merge``
    keeps Spark from broadcasting it all the same; see ``lookup``.
    """
    prices = products.select(
        "ProductKey",
        F.col("ProductPrice").alias("_price"),
        F.col("ProductCost").alias("_cost"),
    )
    line = ["OrderNumber", "OrderLineItem"]
    priced = lookup(sales, prices, "ProductKey", small_products, hot_products, line, merge)
    revenue = F.col("OrderQuantity") * F.col("_price")
    cost = F.col("OrderQuantity") * F.col("_cost")
    amounts = {
        "ProductPrice": F.col("_price"),
        "ProductCost": F.col("_cost"),
        "Revenue": revenue,
        "Cost": cost,
        "Profit": revenue - cost,
    }
    return priced.select(
        F.col("OrderDate").cast("date").alias("OrderDate"),
        F.col("StockDate").cast("date").alias("StockDate"),
        "OrderNumber",
        *[
            F.col(c).cast("int").alias(c)
            for c in (
                "ProductKey", "CustomerKey", "TerritoryKey", "OrderLineItem", "OrderQuantity"
            )
        ],
        *[amount.cast("decimal(18,4)").alias(name) for name, amount in amounts.items()],
    )


def fact_returns(returns: DataFrame) -> DataFrame:
    return returns.select(
        "ReturnKey",
        F.col("ReturnDate").cast("date").alias("ReturnDate"),
        *[
            F.col(c).cast("int").alias(c)
            for c in ("TerritoryKey", "ProductKey", "ReturnQuantity")
        ],
    )
