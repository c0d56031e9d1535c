"""Bronze to Silver typing and standardising, one stateless function per source.

Every cleaner keeps columns it does not know, so it works on batches and streams alike.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.contracts import PROCESSED, SOURCES
from strandline.functions.values import (
    NOT_APPLICABLE,
    filled,
    magnitude,
    money,
    number,
    parse_date,
    shout,
    surrogate_key,
    tidy,
    titled,
    whole,
)


def clean_calendar(df: DataFrame) -> DataFrame:
    day = F.col("Date")
    return df.withColumn("Date", parse_date("Date")).withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "quarter": F.quarter(day),
            "dayOfMonth": F.dayofmonth(day),
            "DayName": F.initcap(F.date_format(day, "EEEE")),
            # Sunday is 1 and Saturday 7; a missing date is no weekend.
            "IsWeekend": F.coalesce(F.dayofweek(day).isin(1, 7), F.lit(False)),
        }
    )


def clean_customers(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "CustomerKey": whole("CustomerKey"),
            "AnnualIncome": money("AnnualIncome"),
            "BirthDate": parse_date("BirthDate"),
            "Prefix": filled("Prefix"),
            **{c: shout(c) for c in ("FirstName", "LastName", "Gender", "MaritalStatus")},
            **{c: tidy(c) for c in ("EducationLevel", "Occupation")},
            "TotalChildren": F.coalesce(whole("TotalChildren"), F.lit(0)),
        }
    )


def clean_product_category(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "ProductCategoryKey": whole("ProductCategoryKey"),
            "CategoryName": titled("CategoryName"),
        }
    )


def clean_product_sub_category(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "ProductSubcategoryKey": whole("ProductSubcategoryKey"),
            "ProductCategoryKey": whole("ProductCategoryKey"),
            "SubcategoryName": titled("SubcategoryName"),
        }
    )


def clean_products(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "ProductKey": whole("ProductKey"),
            "ProductSubcategoryKey": whole("ProductSubcategoryKey"),
            "ProductSKU": tidy("ProductSKU"),
            **{c: shout(c) for c in ("ProductName", "ModelName", "ProductDescription")},
            **{
                c: shout(c, NOT_APPLICABLE)
                for c in ("ProductColor", "ProductSize", "ProductStyle")
            },
            "ProductCost": number("ProductCost"),
            "ProductPrice": number("ProductPrice"),
        }
    )


def clean_returns(df: DataFrame) -> DataFrame:
    typed = df.withColumns(
        {
            "ReturnDate": parse_date("ReturnDate"),
            "TerritoryKey": whole("TerritoryKey"),
            "ProductKey": whole("ProductKey"),
            "ReturnQuantity": magnitude("ReturnQuantity"),
        }
    )
    # Returns carry no identity of their own. Quantity is not part of the key, so two
    # returns of one product in one territory on one day count as the same return.
    return typed.withColumn(
        "ReturnKey",
        surrogate_key(("ReturnDate", "DEFAULT_DATE"), ("TerritoryKey", "-1"), ("ProductKey", "-1")),
    )


def clean_sales(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "OrderNumber": F.trim("OrderNumber"),
            **{
                c: whole(c) for c in ("OrderLineItem", "ProductKey", "CustomerKey", "TerritoryKey")
            },
            "OrderQuantity": magnitude("OrderQuantity"),
            "OrderDate": parse_date("OrderDate"),
            "StockDate": parse_date("StockDate"),
        }
    )


def clean_territories(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "SalesTerritoryKey": whole("SalesTerritoryKey"),
            **{c: titled(c) for c in ("Region", "Country", "Continent")},
        }
    )


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "calendar": clean_calendar,
    "customers": clean_customers,
    "product_category": clean_product_category,
    "product_sub_category": clean_product_sub_category,
    "products": clean_products,
    "returns": clean_returns,
    "sales": clean_sales,
    "territories": clean_territories,
}


def clean(df: DataFrame, source: str) -> DataFrame:
    """Typed rows stamped with the moment they were processed."""
    return CLEANERS[source](df).withColumn(PROCESSED, F.current_timestamp())


def gate(df: DataFrame, source: str) -> DataFrame:
    """Rows whose required columns are all present."""
    present: list[Column] = [F.col(c).isNotNull() for c in SOURCES[source].required]
    return df.filter(reduce(Column.__and__, present))
