from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strandline.functions import values as v
from strandline.functions.blanks import blank_minus, distinct_with_blank, safe_divide
from strandline.operators.cleaning import (
    clean_calendar,
    clean_customers,
    clean_product_category,
    clean_products,
    clean_returns,
    clean_sales,
    clean_territories,
    gate,
)

D = dt.date

DATES = [
    ("05/06/2016", D(2016, 5, 6)),
    ("25/12/2016", D(2016, 12, 25)),
    ("1-2-2015", D(2015, 1, 2)),
    ("12-31-2015", D(2015, 12, 31)),
    ("1/2/2015", D(2015, 1, 2)),
    ("2016-03-01", D(2016, 3, 1)),
    ("2016-02-29", D(2016, 2, 29)),
    ("2016-02-30", None),
    ("2/29/2015", None),
    ("1/2/15", None),
    (" 1/2/2015", None),
    ("31/12/2016 10:00", None),
    ("2016-3-1", None),
    ("25-12-2016", None),
    ("2016/03/01", None),
    ("junk", None),
    ("", None),
    (None, None),
]


def test_dates_take_the_first_layout_that_fits(spark):
    rows = spark.createDataFrame(DATES, "t STRING, want DATE")
    got = rows.select("t", "want", v.parse_date("t").alias("got")).collect()
    assert [(r.t, r.got) for r in got] == [(r.t, r.want) for r in got]


def test_dates_agree_with_trying_every_layout(spark, tiny):
    """The separator shortcut changes nothing against four plain attempts."""
    orders = spark.read.parquet(f"{tiny}/orders.parquet")
    shapes = ["M/d/yyyy", "M-d-yyyy", "yyyy-MM-dd", "dd/MM/yyyy", "d-M-yyyy", "yyyy/MM/dd", "MMM"]
    texts = orders.select(
        F.explode(F.array(*[F.date_format("o_orderdate", s) for s in shapes])).alias("t")
    )
    plain = F.coalesce(*[F.try_to_date(F.col("t"), s) for s in shapes[:4]])
    differing = texts.filter(~v.parse_date("t").eqNullSafe(plain))
    assert differing.count() == 0
    assert texts.filter(plain.isNotNull()).count() > 0


@pytest.mark.parametrize(
    ("text", "want"), [("$90,000 ", 90000.0), ("abc", None), ("", None), (None, None), ("1e3", 1e3)]
)
def test_money(spark, text, want):
    rows = spark.createDataFrame([(text,)], "m STRING")
    assert rows.select(v.money("m")).first()[0] == want


def test_numbers_never_raise(spark):
    rows = spark.createDataFrame([("abc",), ("",), ("-3",), (None,)], "n STRING")
    got = rows.select(v.number("n"), v.whole("n"), v.magnitude("n")).collect()
    assert [tuple(r) for r in got] == [(None,) * 3, (None,) * 3, (-3.0, -3, 3), (None,) * 3]


def test_smallest_int_has_no_magnitude(spark):
    rows = spark.createDataFrame([(-(2**31),), (-5,)], "n INT")
    assert [r[0] for r in rows.select(v.magnitude("n")).collect()] == [None, 5]


def test_customer_defaults_and_casing(spark):
    schema = (
        "CustomerKey INT, Prefix STRING, FirstName STRING, LastName STRING, BirthDate STRING, "
        "MaritalStatus STRING, Gender STRING, EmailAddress STRING, AnnualIncome STRING, "
        "TotalChildren INT, EducationLevel STRING, Occupation STRING, HomeOwner STRING"
    )
    rows = spark.createDataFrame(
        [
            (1, None, None, " li ", "1/2/1980", None, "f", None, "$1,0 00", None, " A ", None, None),
            (2, " mr ", "x", None, "bad", "m", None, "e", "x", 3, None, " Bo ", "Y"),
        ],
        schema,
    )
    one, two = clean_customers(rows).collect()
    assert (one.Prefix, one.FirstName, one.LastName) == ("Unknown", "UNKNOWN", "LI")
    assert (one.MaritalStatus, one.Gender, one.AnnualIncome) == ("UNKNOWN", "F", 1000.0)
    assert (one.TotalChildren, one.EducationLevel, one.Occupation) == (0, "A", "Unknown")
    assert (one.EmailAddress, one.HomeOwner, one.BirthDate) == (None, None, D(1980, 1, 2))
    assert (two.Prefix, two.LastName, two.Occupation) == (" mr ", "UNKNOWN", "Bo")
    assert (two.BirthDate, two.AnnualIncome, two.TotalChildren) == (None, None, 3)


def test_product_defaults(spark):
    schema = (
        "ProductKey INT, ProductSubcategoryKey INT, ProductSKU STRING, ProductName STRING, "
        "ModelName STRING, ProductDescription STRING, ProductColor STRING, ProductSize STRING, "
        "ProductStyle STRING, ProductCost STRING, ProductPrice STRING"
    )
    rows = spark.createDataFrame([(1, None, None, None, " m ", None, None, "s", None, "", "2.5")], schema)
    got = clean_products(rows).first()
    assert (got.ProductSKU, got.ProductName, got.ModelName) == ("Unknown", "UNKNOWN", "M")
    assert (got.ProductColor, got.ProductSize, got.ProductStyle) == ("NA", "S", "NA")
    assert (got.ProductCost, got.ProductPrice) == (None, 2.5)


def test_titles(spark):
    rows = spark.createDataFrame(
        [(1, "  north WEST-usa ", None, "  ")],
        "SalesTerritoryKey INT, Region STRING, Country STRING, Continent STRING",
    )
    got = clean_territories(rows).first()
    assert (got.Region, got.Country, got.Continent) == ("North West-usa", "Unknown", "")
    named = spark.createDataFrame([(1, None)], "ProductCategoryKey INT, CategoryName STRING")
    assert clean_product_category(named).first().CategoryName == "Unknown"


def test_return_key(spark):
    schema = "ReturnDate STRING, TerritoryKey INT, ProductKey INT, ReturnQuantity INT"
    rows = spark.createDataFrame([("1/18/2015", 9, 312, -2), ("junk", None, None, 1)], schema)
    one, two = clean_returns(rows).collect()
    assert one.ReturnKey == "7eb8a31e87bc05d58cc4b33c4565c715"
    assert one.ReturnQuantity == 2
    import hashlib

    assert two.ReturnKey == hashlib.md5(b"DEFAULT_DATE||-1||-1").hexdigest()


def test_weekend_and_day_name(spark):
    rows = spark.createDataFrame([("2015-01-03",), ("1/5/2015",), ("junk",)], "Date STRING")
    sat, mon, bad = clean_calendar(rows).collect()
    assert (sat.DayName, sat.IsWeekend, sat.quarter) == ("Saturday", True, 1)
    assert (mon.DayName, mon.IsWeekend, mon.dayOfMonth) == ("Monday", False, 5)
    assert (bad.Date, bad.year, bad.IsWeekend) == (None, None, False)
    assert gate(clean_calendar(rows), "calendar").count() == 2


def test_sales_gate_needs_three_columns(spark):
    schema = (
        "OrderDate STRING, StockDate STRING, OrderNumber STRING, ProductKey INT, CustomerKey INT, "
        "TerritoryKey INT, OrderLineItem INT, OrderQuantity INT"
    )
    rows = spark.createDataFrame(
        [
            ("2016-01-01", "x", " SO1 ", None, None, None, 1, -3),
            ("x", "2016-01-01", "SO2", 1, 1, 1, 1, 1),
            ("2016-01-01", None, None, 1, 1, 1, 1, 1),
            ("2016-01-01", None, "SO3", 1, 1, 1, None, 1),
        ],
        schema,
    )
    (kept,) = gate(clean_sales(rows), "sales").collect()
    assert (kept.OrderNumber, kept.OrderQuantity, kept.StockDate) == ("SO1", 3, None)


def test_blank_arithmetic(spark):
    rows = spark.createDataFrame(
        [(4.0, 2.0), (4.0, 0.0), (4.0, None), (None, 2.0), (None, None)], "a DOUBLE, b DOUBLE"
    )
    a, b = F.col("a"), F.col("b")
    got = rows.select(safe_divide(a, b), blank_minus(a, b)).collect()
    assert [tuple(r) for r in got] == [
        (2.0, 2.0), (0.0, 4.0), (0.0, 4.0), (None, -2.0), (0.0, None),
    ]


def test_blank_is_one_distinct_value(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "x STRING")
    count = distinct_with_blank(F.col("x"))
    assert rows.agg(count).first()[0] == 3
    assert rows.filter("x IS NOT NULL").agg(count).first()[0] == 2
    assert rows.limit(0).agg(count).first()[0] is None
