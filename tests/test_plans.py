"""How often rows move: shuffles of order lines, and what the rule report shuffles."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from strandline.contracts import INGESTED, LANDED, PROCESSED, SOURCE_FILE, SOURCES
from strandline.operators import star as gold
from strandline.operators.cleaning import CLEANERS, clean
from strandline.operators.lookup import hot_keys
from strandline.operators.quality import RULES, quality_report
from strandline.plans.catalog import FIRST_LINES, _dropped
from strandline.plans.metrics import metric_query
from strandline.plans.star import SourceStar, silver
from strandline.sources.adapters import Tables, raw
from strandline.sources.keyed_table import keyed_table
from strandline.streaming.silver import silver_batch


def plan(frame) -> str:
    """The plan that is run, one node a line, indented by depth."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles_above(text: str, table: str) -> list[str]:
    """The exchanges on the way from the scan of a column's table to the result, the lowest last."""
    depth = lambda line: len(re.match(r"[ :+\-]*", line)[0])
    lines, found = text.splitlines(), []
    (at,) = [i for i, line in enumerate(lines) if re.search(rf"FileScan parquet \[[^\]]*\b{table}", line)]
    level = depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            if "Exchange " in line and "Broadcast" not in line:
                found.append(line)
    return found[::-1]


def test_order_lines_are_shuffled_once_for_the_fact(spark, tiny):
    star = SourceStar(spark, tiny)
    (only,) = shuffles_above(plan(star.sales), "l_linenumber")
    assert "l_orderkey" in only
    assert star.sales.count() == silver(Tables(spark, tiny), "sales").count()


def test_distinct_orders_need_no_shuffle_of_their_own(spark, tiny):
    found = shuffles_above(plan(metric_query(SourceStar(spark, tiny), ["Total Orders"], ["CategoryName"])), "l_linenumber")
    assert "l_orderkey" in found[-1]
    assert all("CategoryName" in line or "rangepartitioning" in line for line in found[:-1])
    assert sum("hashpartitioning" in line for line in found) == 2


@pytest.mark.parametrize("source", ["sales", "customers"])
def test_rule_counters_are_not_shuffled_by_key(spark, tiny, source):
    rows = CLEANERS[source](raw(Tables(spark, tiny), source, spoiled=True)).withColumn(PROCESSED, F.current_timestamp())
    report = quality_report(rows, source)
    text = plan(report)
    partial = [line for line in text.splitlines() if "HashAggregate" in line and "_rule" in line and "partial_count" in line]
    assert len(partial) == 1
    assert re.findall(r"partial_\w+", partial[0]) == ["partial_count"]
    assert report.count() == len(RULES[source]) + 2


def test_a_drop_of_sales_is_not_shuffled_after_its_join(spark, tiny):
    """Also a changed one; the lines of an order still go to one file."""
    more = lambda rows: rows.withColumn("OrderQuantity", F.col("OrderQuantity") + 1)
    rows = _dropped(Tables(spark, tiny), "sales", more, where=FIRST_LINES)
    (only,) = shuffles_above(plan(rows), "l_linenumber")
    assert "l_orderkey" in only
    assert rows.columns == SOURCES["sales"].landing_schema.names
    files = rows.withColumn("file", F.spark_partition_id()).groupBy("OrderNumber").agg(F.countDistinct("file").alias("n"))
    assert files.agg(F.max("n")).first()[0] == 1


def test_a_silver_batch_is_dealt_out_before_it_is_sorted(spark, tiny):
    """What a task sorts is a partition of the shuffle, not all that a reader hands to it."""
    bronze = Tables(spark, tiny)["orders"].selectExpr(
        "CAST(o_orderdate AS STRING) AS OrderDate", "'2016-01-01' AS StockDate", "CAST(o_orderkey AS STRING) AS OrderNumber",
        "1 AS ProductKey", "CAST(o_custkey AS INT) AS CustomerKey", "1 AS TerritoryKey", "1 AS OrderLineItem", "2 AS OrderQuantity",
    ).withColumns({INGESTED: F.current_timestamp(), SOURCE_FILE: F.lit("f"), LANDED: F.current_timestamp()})
    text = plan(silver_batch(clean(bronze.unionByName(bronze), "sales"), "sales"))
    lines = text.splitlines()
    dealt = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning(OrderNumber" in line)
    sorts = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line or " Sort [" in line]
    assert sorts and max(sorts) < dealt


def test_even_rows_are_written_as_they_lie_into_few_buckets(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id AS k", "id AS v").repartition(3)
    for buckets, even, files in ((1, True, 3), (1, False, 1), (16, True, 16)):
        table = keyed_table(spark, str(tmp_path / f"{buckets}{even}"), ["k"], buckets)
        table.upsert(rows, 1, even)
        assert len(list((tmp_path / f"{buckets}{even}").glob("batch=1/*/*.parquet"))) == files
        table.upsert(spark.createDataFrame([(5, -1), (9000, -2)], "k LONG, v LONG"), 2, even)
        assert {r.k: r.v for r in table.read().collect()} == {**{i: i for i in range(3000)}, 5: -1, 9000: -2}


def test_merged_prices_are_shuffled_at_every_size(spark, tiny):
    tables = Tables(spark, tiny)
    lines, products = silver(tables, "sales"), silver(tables, "products")
    merged = gold.fact_sales(lines, products, False, hot_keys(lines, "ProductKey", 4), merge=True)
    assert "hashpartitioning(ProductKey" in plan(merged)
    wanted = gold.fact_sales(lines, products, True)
    assert merged.exceptAll(wanted).count() == 0 and merged.count() == wanted.count()
