"""Measures down the calendar's levels, and several distinct counts from one pass."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from strandline.plans.drill import metric_drill
from strandline.plans.metrics import KNOWN, metric_query
from strandline.plans.star import SourceStar, Star

FIRST, LAST = dt.date(2015, 11, 20), dt.date(2017, 3, 5)


class SmallStar(Star):
    pass


def rows_of(seed):
    """Orders that stretch over dates, blanks, dates beyond the calendar, unknown keys."""
    rng = random.Random(seed)
    span = (LAST - FIRST).days
    days = [FIRST + dt.timedelta(rng.randint(0, span)) for _ in range(60)] + [dt.date(2014, 1, 1), None]
    sales = [
        (rng.choice([None, *(f"O{k}" for k in range(40))]), rng.choice([None, 1, 2, 3]), rng.choice([1, 2, 9]), rng.choice([1, 2, 9]),
         rng.choice(days), rng.choice([None, 1, 5]), rng.choice([None, 10, 25]))
        for _ in range(400)
    ]
    returns = [(f"R{rng.randint(0, 30)}", rng.choice(days), rng.choice([1, 2, 9]), rng.choice([1, 2]), rng.choice([None, 1, 2])) for _ in range(80)]
    return sales, returns


@pytest.fixture(scope="module")
def small(spark):
    sales, returns = rows_of(4)
    s = SmallStar()
    s.sales = spark.createDataFrame(
        sales, "OrderNumber string, CustomerKey int, ProductKey int, TerritoryKey int, OrderDate date, OrderQuantity int, Revenue int"
    ).repartition(5)
    s.returns = spark.createDataFrame(returns, "ReturnKey string, ReturnDate date, TerritoryKey int, ProductKey int, ReturnQuantity int")
    s.products = spark.createDataFrame([(1, "A", 10), (2, "B", 20)], "ProductKey int, CategoryName string, ProductPrice int")
    s.territories = spark.createDataFrame([(1, "N", "US"), (2, "S", "FR")], "TerritoryKey int, Region string, Country string")
    s.customers = spark.createDataFrame([(1, "F")], "CustomerKey int, Gender string")
    days = spark.sql(f"SELECT explode(sequence(DATE'{FIRST}', DATE'{LAST}')) AS Date")
    s.date = days.select("Date", F.year("Date").alias("Year"), F.month("Date").alias("Month"), F.quarter("Date").alias("Quarter"))
    return s, sales, returns


def prefix(day, level):
    if day is None or not FIRST <= day <= LAST:
        day = None
    parts = (None,) * 4 if day is None else (day.year, (day.month + 2) // 3, day.month, day.day)
    return (level, *parts[:level], *(None,) * (4 - level))


def periods(result):
    return {(r.level, r.Year, None if r.Quarter is None else int(r.Quarter[-1]), r.MonthNo, r.Day): r for r in result.collect()}


def brute(rows, day, value):
    found = {}
    for row in rows:
        for level in range(5):
            found.setdefault(prefix(row[day], level), []).append(row[value])
    return found


def test_distinct_counts_and_ratios_at_every_level(small):
    star, sales, returns = small
    result = metric_drill(star, ["Total Orders", "Total Customers", "Revenue", "Return Rate", "Rows of sales", "Total Regions"])
    found = periods(result)
    assert result.count() == len(found)
    orders, customers, revenue, sold = (brute(sales, 4, k) for k in (0, 1, 6, 5))
    returned = brute(returns, 1, 4)
    every = {prefix(FIRST + dt.timedelta(k), level) for k in range((LAST - FIRST).days + 1) for level in range(5)}
    assert set(found) == set(orders) | set(returned) | every
    total = lambda values: sum(v for v in values if v is not None) if any(v is not None for v in values) else None
    for key, row in found.items():
        assert row["Total Orders"] == (len(set(orders[key])) if key in orders else None)
        assert row["Total Customers"] == (len(set(customers[key])) if key in customers else None)
        assert row["Revenue"] == total(revenue.get(key, []))
        assert row["Rows of sales"] == (len(orders[key]) if key in orders else None)
        below = total(sold.get(key, []))
        assert row["Return Rate"] == (0.0 if not below else None if total(returned.get(key, [])) is None else total(returned[key]) / below)
        assert row["Total Regions"] == 2


def test_labels(small):
    star, *_ = small
    rows = metric_drill(star, ["Revenue"]).where("level = 3 AND Year = 2016").collect()
    assert {(r.Quarter, r.MonthNo, r.Month) for r in rows} <= {(f"Qtr {(m + 2) // 3}", m, dt.date(2000, m, 1).strftime("%B")) for m in range(1, 13)}
    top = metric_drill(star, ["Revenue"]).where("level < 3").collect()
    assert all(r.Month is None and r.Day is None for r in top)


def test_groups_filters_and_prices(small):
    star, sales, returns = small
    country = {1: "US", 2: "FR"}
    found = metric_drill(star, ["Total Return Amount", "Total Return Orders"], ["Country"], {"date": "Year = 2016"}).where("level = 1").collect()
    price, wanted = {1: 10, 2: 20}, {}
    for key, day, land, product, quantity in returns:
        if day and day.year == 2016:
            wanted.setdefault(country.get(land), []).append((key, None if quantity is None else quantity * price[product]))
    assert {r.Country: (float(r["Total Return Amount"]), r["Total Return Orders"]) for r in found} == {
        c: (float(sum(v or 0 for _, v in rows)), len({k for k, _ in rows})) for c, rows in wanted.items()
    }
    assert {r.Year for r in found} == {2016}
    with pytest.raises(ValueError):
        metric_drill(star, ["Return Rate"], ["Gender"])
    with pytest.raises(ValueError):
        metric_drill(star, ["Revenue"], ["Year"])


@pytest.mark.parametrize("where", [{}, {"date": "Year = 2017"}])
def test_year_before_at_each_level_equals_the_grouped_query(small, where):
    star, *_ = small
    found = periods(metric_drill(star, ["Revenue", "Revenue LY", "Revenue YoY %"], where=where))
    for level, by in ((0, []), (1, ["Year"]), (3, ["Year", "Quarter", "Month"])):
        for r in metric_query(star, ["Revenue", "Revenue LY", "Revenue YoY %"], by, where).collect():
            if level and r.Year is None:
                continue
            key = (level, *(r[c] for c in by[:level]), *(None,) * (4 - level))
            assert tuple(found[key][m] for m in ("Revenue", "Revenue LY", "Revenue YoY %")) == tuple(r)[-3:]


def scans(frame, table):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{table}", plan))


def test_each_fact_is_scanned_once(spark, tiny):
    star = SourceStar(spark, tiny)
    assert scans(metric_drill(star, ["Total Orders", "Total Customers", "Total Quantity Sold"]), "l_orderkey") == 1
    assert scans(metric_drill(star, ["Total Orders", "Return Rate"]), "l_orderkey") == 2
    assert scans(metric_query(star, ["Total Orders", "Total Customers", "Total Quantity Sold"], ["CategoryName"]), "l_orderkey") == 1


def test_several_distinct_counts_with_blanks(small):
    star, sales, _ = small
    found = {r.CategoryName: r for r in metric_query(star, ["Total Orders", "Total Customers", "Revenue"], ["CategoryName"]).collect()}
    for key, name in ((1, "A"), (2, "B"), (9, None)):
        rows = [r for r in sales if r[2] == key]
        assert (found[name]["Total Orders"], found[name]["Total Customers"]) == (len({r[0] for r in rows}), len({r[1] for r in rows}))
        assert found[name]["Revenue"] == sum(r[6] or 0 for r in rows)
    empty = SmallStar()
    empty.__dict__ |= star.__dict__ | {"sales": star.sales.limit(0)}
    assert tuple(metric_query(empty, ["Total Orders", "Total Customers", "Revenue"]).first()) == (None, None, None)


def test_default_aggregates_are_measures(small):
    star, sales, returns = small
    found = metric_query(star, ["Sum of sales.OrderQuantity", "Rows of sales", "Sum of products.ProductPrice"], ["CategoryName"]).collect()
    assert {r.CategoryName: tuple(r)[1:] for r in found} == {
        name: (sum(r[5] or 0 for r in sales if r[2] == key), sum(r[2] == key for r in sales), price)
        for key, name, price in ((1, "A", 10), (2, "B", 20), (9, None, None))
    }
    assert "Count of products.ProductCategoryKey" in KNOWN and "Sum of sales.OrderNumber" not in KNOWN
