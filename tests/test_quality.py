from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strandline.contracts import MARK, PROCESSED, SOURCES
from strandline.operators.cleaning import CLEANERS
from strandline.operators.increment import EPOCH
from strandline.operators.quality import (
    RULES,
    QualityGateError,
    append_audit,
    audited_mark,
    count_duplicates,
    enforce,
    quality_report,
    read_audit,
    verdict,
)

DAY = dt.date(2016, 1, 4)
# A row that passes every rule, per table, and per rule the values that break it.
GOOD = {
    "calendar": dict(
        Date=DAY, year=2016, month=1, quarter=1, dayOfMonth=4, DayName="Monday", IsWeekend=False
    ),
    "customers": dict(CustomerKey=1, EmailAddress="a@b.c"),
    "product_category": dict(ProductCategoryKey=1, CategoryName="Bikes"),
    "product_sub_category": dict(
        ProductSubcategoryKey=1, ProductCategoryKey=1, SubcategoryName="Road"
    ),
    "products": dict(
        ProductKey=1, ProductSubcategoryKey=1, ProductSKU="S", ProductName="N",
        ProductCost=1.0, ProductPrice=2.0,
    ),
    "returns": dict(
        ReturnKey="k1", ReturnDate=DAY, TerritoryKey=1, ProductKey=1, ReturnQuantity=1
    ),
    "sales": dict(
        OrderDate=DAY, StockDate=DAY, OrderNumber="S1", ProductKey=1, CustomerKey=1,
        TerritoryKey=1, OrderLineItem=1, OrderQuantity=1,
    ),
    "territories": dict(SalesTerritoryKey=1, Region="R", Country="C", Continent="K"),
}
BREAKS = {
    "calendar": [
        dict(Date=None), dict(year=None), dict(month=None), dict(quarter=None),
        dict(dayOfMonth=None), dict(DayName=" "), dict(IsWeekend=None), dict(month=13),
        dict(quarter=0), dict(dayOfMonth=32),
    ],
    "customers": [dict(CustomerKey=None), dict(EmailAddress="a@b")],
    "product_category": [dict(ProductCategoryKey=None), dict(CategoryName="  ")],
    "product_sub_category": [
        dict(ProductSubcategoryKey=None), dict(ProductCategoryKey=None), dict(SubcategoryName=""),
    ],
    "products": [
        dict(ProductKey=None), dict(ProductSubcategoryKey=None), dict(ProductSKU=""),
        dict(ProductName=None), dict(ProductCost=-1.0), dict(ProductCost=3.0),
    ],
    "returns": [
        dict(ReturnKey=""), dict(ReturnDate=None), dict(TerritoryKey=None),
        dict(ProductKey=None), dict(ReturnQuantity=0),
    ],
    "sales": [
        dict(OrderNumber=None), dict(OrderLineItem=None), dict(ProductKey=None),
        dict(CustomerKey=None), dict(TerritoryKey=None), dict(OrderDate=None),
        dict(StockDate=None), dict(OrderQuantity=0),
    ],
    "territories": [
        dict(SalesTerritoryKey=None), dict(Region=""), dict(Country=None), dict(Continent=" "),
    ],
}


def _frame(spark, source: str, rows: list[dict], at: dt.datetime = dt.datetime(2024, 5, 1)):
    """Rows with the source's Silver types; columns not given are null."""
    empty = spark.createDataFrame([], SOURCES[source].landing_schema)
    columns = SOURCES[source].columns
    typed = CLEANERS[source](empty).select(*columns).schema
    schema = StructType([StructField(f.name, f.dataType) for f in typed])
    data = [tuple(r.get(c) for c in columns) for r in rows]
    return spark.createDataFrame(data, schema).withColumn(PROCESSED, F.lit(at))


def _keyed(source: str, n: int) -> dict:
    """The good row under its ``n``-th key."""
    key = SOURCES[source].keys[0]
    first = GOOD[source][key]
    other = DAY + dt.timedelta(n) if key == "Date" else f"{first}{n}" if isinstance(first, str) else n
    return GOOD[source] | {key: other}


def test_there_are_56_rules():
    assert sum(len(r) + 2 for r in RULES.values()) == 56


@pytest.mark.parametrize("source", list(SOURCES))
def test_every_rule_fires_on_its_row_only(spark, source):
    good = [_keyed(source, n) for n in range(100, 103)]
    clean = quality_report(_frame(spark, source, good), source)
    assert {r.status for r in clean.collect()} == {"PASS"}
    assert verdict(clean).first().verdict == "PASS"
    # One broken row per rule, each under a key of its own: every rule finds exactly its row.
    broken = [_keyed(source, 200 + i) | b for i, b in enumerate(BREAKS[source])]
    report = quality_report(_frame(spark, source, good + broken), source)
    lines = {r.rule_name: (r.failed_rows, r.status) for r in report.collect()}
    want = {rule.name: (1, rule.breach) for rule in RULES[source]}
    assert len(broken) == len(want) and want.items() <= lines.items()
    assert {v for k, v in lines.items() if k not in want} == {(0, "PASS")}


@pytest.mark.parametrize("source", list(SOURCES))
def test_duplicates_count_every_member(spark, source):
    rows = _frame(spark, source, [_keyed(source, 5)] * 3 + [_keyed(source, 6)])
    assert tuple(count_duplicates(rows, source).first()) == (4, 3)
    lines = {r.rule_name: r for r in quality_report(rows, source).collect()}
    assert lines["Unique Primary Key Grain"].failed_rows == 3
    assert lines["Unique Primary Key Grain"].status == "FAIL"


def test_null_keys_form_one_group(spark):
    rows = _frame(spark, "customers", [dict(EmailAddress="a@b.c")] * 2)
    lines = {r.rule_name: r.failed_rows for r in quality_report(rows, "customers").collect()}
    assert lines["Unique Primary Key Grain"] == 2 and lines["Valid Primary Keys"] == 2


def test_empty_slice_reports_nothing(spark):
    assert quality_report(_frame(spark, "sales", []), "sales").count() == 0


def test_unknown_passes_bounds(spark):
    row = GOOD["sales"] | dict(OrderQuantity=None)
    lines = {r.rule_name: r.status for r in quality_report(_frame(spark, "sales", [row]), "sales").collect()}
    assert lines["Logical Bounds: OrderQuantity > 0"] == "PASS"


def test_warning_does_not_stop_the_load(spark):
    row = GOOD["products"] | dict(ProductPrice=1.0, ProductCost=2.0)
    report = quality_report(_frame(spark, "products", [row]), "products")
    assert {r.status for r in report.collect()} == {"PASS", "WARNING"}
    enforce(report)


def test_gate_raises(spark):
    row = GOOD["sales"] | dict(ProductKey=None)
    with pytest.raises(QualityGateError, match="sales"):
        enforce(quality_report(_frame(spark, "sales", [row]), "sales"))


def test_failed_slices_are_looked_at_again(spark, tmp_path):
    path, one, two = str(tmp_path / "audit"), dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2)
    bad = GOOD["sales"] | dict(ProductKey=None)
    append_audit(quality_report(_frame(spark, "sales", [GOOD["sales"]], one), "sales"), path)
    append_audit(quality_report(_frame(spark, "sales", [bad], two), "sales"), path)
    log = read_audit(spark, path)
    assert log.count() == 20 and MARK in log.columns
    assert audited_mark(log) == one
    assert audited_mark(log, advance_on_failure=True) == two
    assert audited_mark(None) == EPOCH
