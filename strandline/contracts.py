"""What each of the eight sources looks like: landing columns, identity and Silver columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

PROCESSED = "silver_processed_timestamp"
INGESTED = "ingestion_timestamp"
LANDED = "file_modified"  # when the row's file was last changed, by the landing folder's clock
SOURCE_FILE = "source_file"
GOLD_PROCESSED = "gold_processed_timestamp"
MARK = "max_silver_processed_timestamp"


@dataclass(frozen=True)
class Source:
    name: str
    landing: str  # header columns, in file order, as a DDL string
    keys: tuple[str, ...]  # one Silver row per key
    required: tuple[str, ...]  # rows with a null here never reach Silver
    columns: tuple[str, ...]  # Silver columns, without the processing mark

    @property
    def landing_schema(self) -> StructType:
        return StructType.fromDDL(self.landing)

    @property
    def bronze_schema(self) -> StructType:
        return StructType.fromDDL(
            f"{self.landing}, {INGESTED} TIMESTAMP, {SOURCE_FILE} STRING, ingestion_date DATE, "
            f"{LANDED} TIMESTAMP"
        )

    @property
    def ties(self) -> tuple[str, ...]:
        """Columns that order rows of one key which arrived in the same file."""
        return tuple(c for c in self.columns if c not in self.keys)


# Names and types every landing file must carry.
SOURCES: dict[str, Source] = {
    s.name: s
    for s in (
        Source(
            "calendar",
            "Date STRING",
            ("Date",),
            ("Date", "year", "month"),
            ("Date", "year", "month", "quarter", "dayOfMonth", "DayName", "IsWeekend"),
        ),
        Source(
            "customers",
            "CustomerKey INT, Prefix STRING, FirstName STRING, LastName STRING, "
            "BirthDate STRING, MaritalStatus STRING, Gender STRING, EmailAddress STRING, "
            "AnnualIncome STRING, TotalChildren INT, EducationLevel STRING, "
            "Occupation STRING, HomeOwner STRING",
            ("CustomerKey",),
            ("CustomerKey",),
            (
                "CustomerKey", "Prefix", "FirstName", "LastName", "BirthDate",
                "MaritalStatus", "Gender", "EmailAddress", "AnnualIncome",
                "TotalChildren", "EducationLevel", "Occupation", "HomeOwner",
            ),
        ),
        Source(
            "product_category",
            "ProductCategoryKey INT, CategoryName STRING",
            ("ProductCategoryKey",),
            ("ProductCategoryKey",),
            ("ProductCategoryKey", "CategoryName"),
        ),
        Source(
            "product_sub_category",
            "ProductSubcategoryKey INT, SubcategoryName STRING, ProductCategoryKey INT",
            ("ProductSubcategoryKey",),
            ("ProductSubcategoryKey",),
            ("ProductSubcategoryKey", "ProductCategoryKey", "SubcategoryName"),
        ),
        Source(
            "products",
            "ProductKey INT, ProductSubcategoryKey INT, ProductSKU STRING, "
            "ProductName STRING, ModelName STRING, ProductDescription STRING, "
            "ProductColor STRING, ProductSize STRING, ProductStyle STRING, "
            "ProductCost STRING, ProductPrice STRING",
            ("ProductKey",),
            ("ProductKey",),
            (
                "ProductKey", "ProductSubcategoryKey", "ProductSKU", "ProductName",
                "ModelName", "ProductDescription", "ProductColor", "ProductSize",
                "ProductStyle", "ProductCost", "ProductPrice",
            ),
        ),
        Source(
            "returns",
            "ReturnDate STRING, TerritoryKey INT, ProductKey INT, ReturnQuantity INT",
            ("ReturnKey",),
            ("ReturnKey",),
            ("ReturnKey", "ReturnDate", "TerritoryKey", "ProductKey", "ReturnQuantity"),
        ),
        Source(
            "sales",
            "OrderDate STRING, StockDate STRING, OrderNumber STRING, ProductKey INT, "
            "CustomerKey INT, TerritoryKey INT, OrderLineItem INT, OrderQuantity INT",
            ("OrderNumber", "OrderLineItem"),
            ("OrderNumber", "OrderLineItem", "OrderDate"),
            (
                "OrderDate", "StockDate", "OrderNumber", "ProductKey", "CustomerKey",
                "TerritoryKey", "OrderLineItem", "OrderQuantity",
            ),
        ),
        Source(
            "territories",
            "SalesTerritoryKey INT, Region STRING, Country STRING, Continent STRING",
            ("SalesTerritoryKey",),
            ("SalesTerritoryKey",),
            ("SalesTerritoryKey", "Region", "Country", "Continent"),
        ),
    )
}
