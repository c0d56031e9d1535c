"""Measures over a small hand-made star, and dates of the year before."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strandline.functions.calendar import date_spine, drill_down, year_before
from strandline.plans.metrics import IMPLICIT_SUMS, MEASURES, implicit, metric_query
from strandline.plans.star import SourceStar, Star

D = dt.date


class SmallStar(Star):
    pass


@pytest.fixture(scope="module")
def star(spark):
    s = SmallStar()
    s.products = spark.createDataFrame(
        [(1, "A", "Bikes", 10.0), (2, "B", "Bikes", 20.0), (3, "C", "Caps", 5.0), (4, "D", "Unsold", 1.0)],
        "ProductKey INT, ProductName STRING, CategoryName STRING, ProductPrice DOUBLE",
    ).withColumn("ProductPrice", F.col("ProductPrice").cast("decimal(10,4)"))
    s.customers = spark.createDataFrame(
        [(1, "X Y", "F"), (2, "X Y", "M"), (3, "Z", "M")],
        "CustomerKey INT, FullName STRING, Gender STRING",
    )
    s.territories = spark.createDataFrame(
        [(1, "N", "US"), (2, "S", "US"), (3, "E", "FR"), (4, None, None)],
        "TerritoryKey INT, Region STRING, Country STRING",
    )
    days = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2017-06-30')) AS Date")
    s.date = days.select(
        "Date", F.year("Date").alias("Year"), F.month("Date").alias("Month"),
        F.quarter("Date").alias("Quarter"),
    )
    sales = [
        # order, line, product, customer, territory, date, qty, revenue, profit
        ("O1", 1, 1, 1, 1, D(2015, 2, 10), 1, 10, 4),
        ("O1", 2, 3, 1, 1, D(2015, 2, 10), 2, 10, 5),
        ("O2", 1, 2, 2, 2, D(2016, 2, 10), 1, 20, 5),
        ("O3", 1, 9, 3, 3, D(2016, 2, 29), 1, None, None),
        ("O4", 1, 2, 3, 3, D(2016, 2, 29), 3, 60, 15),
        ("O5", 1, 1, None, 1, D(2017, 2, 28), 4, 40, 16),
        (None, 1, 1, 1, 1, D(2014, 1, 1), 1, 10, 4),
    ]
    s.sales = spark.createDataFrame(
        [(*r[:7], *(None if v is None else Decimal(v) for v in r[7:])) for r in sales],
        "OrderNumber STRING, OrderLineItem INT, ProductKey INT, CustomerKey INT, "
        "TerritoryKey INT, OrderDate DATE, OrderQuantity INT, Revenue DECIMAL(18,4), "
        "Profit DECIMAL(18,4)",
    )
    s.returns = spark.createDataFrame(
        [("a", D(2016, 3, 1), 1, 1, 2), ("b", D(2016, 3, 1), 3, 9, 1), ("c", D(2010, 1, 1), 3, 3, 1)],
        "ReturnKey STRING, ReturnDate DATE, TerritoryKey INT, ProductKey INT, ReturnQuantity INT",
    )
    return s


def ask(star, measures, by=(), **options):
    rows = metric_query(star, measures, by, **options).collect()
    values = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in rows]
    return values if by else values[0]


def test_cards(star):
    assert ask(star, ["Revenue", "Profit"]) == (150.0, 49.0)
    assert ask(star, ["Total Orders"]) == (6,)  # five numbers and one blank
    assert ask(star, ["Total Customers"]) == (4,)  # three keys and one blank
    assert ask(star, ["Total Quantity Sold", "Total Returned Quantity"]) == (13, 4)
    assert ask(star, ["Return Rate"]) == (4 / 13,)
    assert ask(star, ["Profit Margin", "Avg Order Value"]) == (49 / 150, 150 / 6)
    assert ask(star, ["Total Countries", "Total Regions"]) == (3, 4)
    assert ask(star, ["Total Return Orders", "Total Return Amount"]) == (3, 25.0)
    assert ask(star, ["Total Orders", "Total Customers", "Revenue"]) == (6, 4, 150.0)


def test_unmatched_rows_fall_into_the_blank_group(star):
    got = dict(ask(star, ["Total Quantity Sold"], ["CategoryName"]))
    assert got == {"Bikes": 10, "Caps": 2, None: 1}


def test_groups_without_any_value_are_hidden(star):
    assert dict(ask(star, ["Revenue"], ["CategoryName"])) == {"Bikes": 140.0, "Caps": 10.0}


def test_ratios_show_every_group(star):
    got = dict(ask(star, ["Return Rate"], ["CategoryName"]))
    assert got == {"Bikes": 2 / 10, "Caps": 1 / 2, "Unsold": 0.0, None: 1.0}


def test_distinct_counts_are_not_additive(star):
    assert dict(ask(star, ["Total Orders"], ["CategoryName"])) == {"Bikes": 5, "Caps": 1, None: 1}


def test_namesakes_merge(star):
    assert ask(star, ["Revenue"], ["FullName"])[:2] == [("Z", 60.0), ("X Y", 50.0)]


def test_top_keeps_ties(star):
    assert len(ask(star, ["Total Quantity Sold"], ["ProductName"], top=1)) == 1
    rows = ask(star, ["Total Returned Quantity"], ["ProductName"], top=2)
    assert {r[1] for r in rows} == {2, 1} and len(rows) == 3


def test_filters_flow_from_dimension_to_fact(star):
    got = ask(star, ["Revenue", "Total Orders"], ["CategoryName"], where={"territories": "Country = 'FR'"})
    assert got == [("Bikes", 60.0, 1), (None, None, 1)]
    # Customers do not filter returns.
    where = {"customers": "Gender = 'F'"}
    assert ask(star, ["Revenue", "Total Returned Quantity"], where=where) == (30.0, 4)
    assert ask(star, ["Total Countries"], where=where) == (3,)


def test_group_by_a_key_blanks_unmatched_facts(star):
    got = dict(ask(star, ["Total Quantity Sold"], ["ProductKey"]))
    assert got == {1: 6, 2: 4, 3: 2, None: 1}


def test_a_group_that_does_not_reach_a_measure_repeats_it(star):
    genders = {r[0] for r in star.customers.select("Gender").distinct().collect()}
    assert dict(ask(star, ["Total Returned Quantity"], ["Gender"])) == dict.fromkeys(genders, 4)
    both = ask(star, ["Revenue", "Total Returned Quantity"], ["Gender"])
    assert {r[0] for r in both} >= genders and {r[2] for r in both} == {4}
    assert {r[1] for r in ask(star, ["Total Countries"], ["CategoryName"])} == {3}
    split = dict(ask(star, ["Total Returned Quantity"], ["CategoryName"]))
    mixed = ask(star, ["Total Quantity Sold", "Total Returned Quantity"], ["CategoryName", "Gender"])
    assert all(r[3] == split.get(r[0]) for r in mixed)
    with pytest.raises(ValueError, match="related to all of"):
        ask(star, ["Total Countries"], ["CategoryName", "Gender"])


def test_same_period_last_year(star):
    got = ask(star, ["Revenue", "Revenue LY", "Revenue YoY %"], ["Year"])
    # 28 February 2017 ends its month, so 29 February 2016 belongs to the year before.
    assert sorted(got, key=lambda r: (r[0] is None, r[0])) == [
        (2015, 20.0, None, 0.0),
        (2016, 80.0, 20.0, 3.0),
        (2017, 40.0, 80.0, -0.5),
        (None, 10.0, None, 0.0),
    ]
    plain = ask(star, ["Revenue LY"], ["Year"], month_ends=False)
    assert dict(plain) == {2016: 20.0, 2017: 20.0}


def test_blank_revenue_against_last_year_is_minus_one(star):
    got = ask(star, ["Revenue YoY %"], ["Year", "Month"])
    assert {(2016, 2): 3.0, (2017, 2): -0.5}.items() <= {r[:2]: r[2] for r in got}.items()
    halves = ask(star, ["Revenue YoY %"], ["Quarter"], where={"date": "Year = 2017 AND Month > 2"})
    assert dict(halves) == {1: 0.0, 2: 0.0}


def test_last_year_without_a_date_filter(star):
    # Every date is in context: all that lies at least a year before the calendar's end.
    assert ask(star, ["Revenue", "Revenue LY"]) == (150.0, 100.0)
    by_country = ask(star, ["Revenue LY"], ["Country", "Year"])
    assert {r[:2]: r[2] for r in by_country} == {
        ("US", 2016): 20.0, ("US", 2017): 20.0, ("FR", 2017): 60.0,
    }


def test_last_year_covers_the_same_part_of_a_year(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2016-03-10')) AS Date")
    dates = days.select("Date", F.year("Date").alias("Year"))
    back = year_before(dates, ["Year"], dates).groupBy("Year").agg(F.max("Date"), F.count("*")).collect()
    # 28 and 29 February 2016 both go back to 28 February 2015, which counts once.
    assert [tuple(r) for r in back] == [(2016, D(2015, 3, 10), 69)]


def test_month_end_needs_both_last_days(spark):
    days = [(D(2017, 2, 28), 1), (D(2016, 2, 28), 0), (D(2016, 2, 29), 0)]
    dates = spark.createDataFrame(days, "Date DATE, g INT")
    assert [r.Date for r in year_before(dates, ["g"], dates).collect()] == [D(2016, 2, 28)]
    more = dates.union(spark.createDataFrame([(D(2017, 2, 27), 1)], "Date DATE, g INT"))
    got = sorted(r.Date for r in year_before(more, ["g"], more).collect())
    assert got == [D(2016, 2, 28), D(2016, 2, 29)]


def test_spine_fills_whole_years(spark):
    df = spark.createDataFrame([(D(2015, 3, 1),), (D(2016, 2, 2),)], "d DATE")
    spine = date_spine(df, "d")
    assert spine.count() == 365 + 366
    last = spine.orderBy(F.desc("Date")).first()
    assert (last.Date, last.Quarter, last.Month) == (D(2016, 12, 31), "Qtr 4", "December")


def test_drill_down_levels(spark):
    daily = spark.createDataFrame(
        [(D(2015, 3, 1), 1), (D(2015, 3, 2), 2), (D(2015, 4, 1), 4), (D(2016, 1, 1), 8)],
        "d DATE, v INT",
    )
    rows = drill_down(daily, "d", ["v"]).collect()
    totals = {(r.level, r.Year, r.Quarter, r.Month, r.Day): r.v for r in rows}
    assert totals[(0, None, None, None, None)] == 15
    assert totals[(1, 2015, None, None, None)] == 7
    assert totals[(2, 2015, "Qtr 1", None, None)] == 3
    assert totals[(3, 2015, "Qtr 2", "April", None)] == 4
    assert totals[(4, 2016, "Qtr 1", "January", 1)] == 8
    assert len(rows) == 1 + 2 + 3 + 3 + 4


def test_default_aggregates(spark, star):
    assert star.sales.agg(implicit("sales", "OrderQuantity")).first()[0] == 13
    with pytest.raises(KeyError):
        implicit("sales", "OrderNumber")
    assert "Revenue" in IMPLICIT_SUMS["sales"] and len(MEASURES) == 17


def test_one_shared_first_step_for_both_years(spark, tiny):
    """The fact is read once for a period and the period before it."""
    query = metric_query(SourceStar(spark, tiny, dense_dates=True), ["Revenue", "Revenue LY"], ["Year"])
    query.collect()
    plan = query._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    plan = re.sub(r"#\d+L?", "", plan)
    assert "ReusedExchange [OrderDate" in plan and plan.count("FileScan parquet [l_") == 1


def test_large_products_give_the_same_answers(spark, tiny):
    small = SourceStar(spark, tiny)
    large = SourceStar(spark, tiny, small=frozenset())
    for measures, by in ((["Revenue", "Total Orders"], ["CategoryName"]), (["Profit"], ["ProductName"])):
        want, got = (metric_query(s, measures, by).collect() for s in (small, large))
        assert sorted(map(str, want)) == sorted(map(str, got))


UNPRICED = (
    (["Total Quantity Sold"], ["Country"]), (["Total Orders"], []), (["Total Customers"], []),
    (["Return Rate"], ["Country"]),
)


@pytest.mark.parametrize("measures, by", UNPRICED)
def test_measures_without_prices_read_no_products(spark, tiny, measures, by):
    star = SourceStar(spark, tiny, small=frozenset({"customers", "territories"}))
    plan = metric_query(star, measures, by)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_retailprice" not in plan and "p_partkey" not in plan and "approx_top_k" not in plan


def test_the_year_before_a_chosen_year(spark, tiny):
    star = SourceStar(spark, tiny, dense_dates=True)
    chosen = {"date": "Year = 1997"}
    before = ask(star, ["Revenue"], where={"date": "Year = 1996"})
    assert ask(star, ["Revenue", "Revenue LY"], where=chosen)[1] == before[0] > 0


def test_labels_come_in_the_order_of_their_column(spark, tiny):
    star = SourceStar(spark, tiny)
    names = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    for by in (["Month", "MonthName"], ["MonthName"]):
        rows = metric_query(star, ["Revenue"], by, order_by="MonthName").collect()
        assert [r.MonthName for r in rows] == names
    assert [r.Year for r in metric_query(star, ["Revenue"], ["Year"], order_by="Year").collect()] == sorted(
        r.Year for r in metric_query(star, ["Revenue"], ["Year"]).collect()
    )
