"""Landing, streams, stored tables and whole runs."""

from __future__ import annotations

import datetime as dt
import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException

from strandline.contracts import MARK, PROCESSED, SOURCES
from strandline.operators.increment import high_water_mark, in_ranges
from strandline.operators.quality import QualityGateError, read_audit
from strandline.plans.lake import (
    Lake,
    LakeStar,
    gold_marks,
    ingest_sources,
    load_gold,
    refine_sources,
    refresh,
    register_views,
    validate_source,
)
from strandline.plans.metrics import metric_query
from strandline.session import run_folder, shared_folder
from strandline.sources.keyed_table import keyed_table
from strandline.sources.landing import landing_fresh, landing_ready
from strandline.sources.namespaces import create_namespaces
from strandline.streaming.bronze import start_ingest

def drop(lake: Lake, source: str, name: str, *lines: str, header: str | None = None) -> None:
    folder = Path(lake.landing(source))
    folder.mkdir(parents=True, exist_ok=True)
    header = header or ",".join(SOURCES[source].landing_schema.names)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


@pytest.fixture
def lake(spark, tmp_path) -> Lake:
    return Lake(spark, str(tmp_path), buckets=4)


def test_bronze_takes_each_file_once(lake, spark):
    drop(lake, "product_category", "a.csv", "1,Bikes", "2,Caps")
    for _ in range(2):
        ingest_sources(lake, "product_category")
    drop(lake, "product_category", "b.csv", "3,")
    ingest_sources(lake, "product_category")
    rows = spark.read.parquet(lake.bronze("product_category")).collect()
    assert sorted((r.ProductCategoryKey, r.CategoryName) for r in rows) == [
        (1, "Bikes"), (2, "Caps"), (3, None),
    ]
    assert {r.source_file.rsplit("/", 1)[1] for r in rows} == {"a.csv", "b.csv"}
    assert all(r.ingestion_date == r.ingestion_timestamp.date() for r in rows)


@pytest.mark.parametrize(
    ("header", "line"),
    [
        ("CategoryName,ProductCategoryKey", "Bikes,1"),
        ("ProductCategoryKey,CategoryName,New", "1,Bikes,x"),
        ("ProductCategoryKey", "1"),
    ],
)
def test_broken_contract_stops_the_stream(lake, spark, header, line):
    drop(lake, "product_category", "bad.csv", line, header=header)
    with pytest.raises(StreamingQueryException):
        ingest_sources(lake, "product_category")
    assert not list(Path(lake.bronze("product_category")).glob("*.parquet"))


def test_windows_line_ends(lake, spark):
    folder = Path(lake.landing("calendar"))
    folder.mkdir(parents=True)
    (folder / "c.csv").write_bytes(b"Date\r\n1/1/2015\r\n1/2/2015\r\n")
    ingest_sources(lake, "calendar")
    refine_sources(lake, "calendar")
    days = [r.Date for r in lake.silver("calendar").read().collect()]
    assert sorted(days) == [dt.date(2015, 1, 1), dt.date(2015, 1, 2)]


def test_one_broken_source_does_not_hold_up_the_others(lake, spark):
    drop(lake, "product_category", "bad.csv", "1,Bikes,x", header="ProductCategoryKey,CategoryName,New")
    drop(lake, "calendar", "a.csv", "1/1/2015")
    with pytest.raises(StreamingQueryException):
        ingest_sources(lake, "product_category", "calendar")
    assert spark.read.parquet(lake.bronze("calendar")).count() == 1


SALES_ONE = ["1/5/2016,1/1/2016,SO1,1,1,1,1,2", "2016-01-06,1/1/2016, SO2 ,1,2,1,1,-3"]
SALES_TWO = ["1/5/2016,1/1/2016,SO1,2,1,1,1,9", "junk,1/1/2016,SO9,1,1,1,1,1", "1/7/2016,x,SO3,1,,1,1,1"]


def _silver(lake: Lake, source: str = "sales") -> list[tuple]:
    table = lake.silver(source).read().drop(PROCESSED)
    return sorted(map(str, table.select(*SOURCES[source].columns).collect()))


def test_two_drops_equal_one(spark, tmp_path):
    apart, together = (Lake(spark, str(tmp_path / n), buckets=4) for n in ("apart", "together"))
    for name, lines in (("1.csv", SALES_ONE[1:]), ("2.csv", SALES_TWO)):
        drop(apart, "sales", name, *lines)
        ingest_sources(apart, "sales")
        refine_sources(apart, "sales")
    drop(together, "sales", "all.csv", *SALES_ONE[1:], *SALES_TWO)
    ingest_sources(together, "sales")
    refine_sources(together, "sales")
    assert _silver(apart) == _silver(together) and len(_silver(apart)) == 3


def test_late_correction_replaces_the_whole_row(lake):
    for name, lines in (("1.csv", SALES_ONE), ("2.csv", SALES_TWO)):
        drop(lake, "sales", name, *lines)
        ingest_sources(lake, "sales")
        refine_sources(lake, "sales")
    rows = {r.OrderNumber: r for r in lake.silver("sales").read().collect()}
    assert sorted(rows) == ["SO1", "SO2", "SO3"]
    assert (rows["SO1"].ProductKey, rows["SO1"].OrderQuantity) == (2, 9)
    assert (rows["SO2"].OrderQuantity, rows["SO3"].StockDate) == (3, None)


def test_nothing_new_changes_nothing(lake):
    drop(lake, "sales", "1.csv", *SALES_ONE)
    ingest_sources(lake, "sales")
    refine_sources(lake, "sales")
    before = lake.silver("sales")._live()
    refine_sources(lake, "sales")
    assert lake.silver("sales")._live() == before


def batches(table):
    return {bucket: batch for bucket, (batch, _) in table._live().items()}


def test_keyed_table_rewrites_touched_buckets_only(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path / "t"), ["k"], 8)
    assert not table.exists()
    table.upsert(spark.range(100).selectExpr("id AS k", "id AS v"), 1)
    before = batches(table)
    table.upsert(spark.createDataFrame([(5, -1), (1000, -2)], "k LONG, v LONG"), 2)
    after = batches(table)
    assert before == dict.fromkeys(range(8), 1)
    assert 1 <= sum(after[b] == 2 for b in after) <= 2 and set(after.values()) == {1, 2}
    assert {r.k: r.v for r in table.read().collect()} == {**{i: i for i in range(100)}, 5: -1, 1000: -2}
    with pytest.raises(ValueError):
        table.upsert(spark.range(1).selectExpr("id AS k", "id AS v"), 0)


def test_a_replayed_batch_writes_the_same_rows(spark, tmp_path):
    """Also one with null keys, which match nothing, and one that died while it was written."""
    table = keyed_table(spark, str(tmp_path / "t"), ["k"], 2)
    table.upsert(spark.createDataFrame([(1, 1), (2, 1), (None, 1)], "k INT, v INT"), 1)
    second = spark.createDataFrame([(2, 2), (3, 2), (None, 2)], "k INT, v INT")
    wanted = [(1, 1), (2, 2), (3, 2), (None, 1), (None, 2)]
    stray = spark.createDataFrame([(9, 9, 0)], "k INT, v INT, bucket INT")
    stray.write.partitionBy("bucket").parquet(f"{table.path}/batch=2")
    for _ in range(3):
        table.upsert(second, 2)
        assert sorted(map(tuple, table.read().collect()), key=str) == sorted(wanted, key=str)


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path / "t"), ["k"], 2)
    none = spark.createDataFrame([], "k INT, v INT")
    table.upsert(none, 1)
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([(1, 1)], "k INT, v INT"), 2)
    table.upsert(none, 3)
    assert [tuple(r) for r in table.read().collect()] == [(1, 1)]


def test_only_live_files_count_for_the_size(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path / "t"), ["k"], 1)
    rows = spark.range(1000).selectExpr("id AS k", "rand() AS v")
    table.upsert(rows, 1)
    once = table.live_bytes()
    for n in range(2, 5):
        table.upsert(rows, n)
    assert 0 < table.live_bytes() < 1.5 * once


def scanned(frame) -> int:
    """Rows that the file scans of a plan hand on."""
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.length()))


def test_a_restatement_reads_the_pages_of_changed_keys(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path / "t"), ["line"], 1, ["at", "ProductKey"])
    rows = spark.range(400_000).selectExpr("id AS line", "1 AS at", "CAST(id * 7919 % 1000 AS INT) AS ProductKey")
    table.upsert(rows, 1)
    keys = spark.createDataFrame([(17,), (903,), (None,)], "ProductKey INT")
    chosen = table.read().filter(in_ranges(keys))
    assert chosen.count() == 800
    assert scanned(chosen) < 0.25 * 400_000
    many = spark.range(0, 1000, 3).selectExpr("CAST(id AS INT) AS ProductKey")
    assert table.read().filter(in_ranges(many)).join(many, "ProductKey", "left_semi").count() == 334 * 400
    assert table.read().filter(in_ranges(keys.limit(0))).count() == 0


@pytest.mark.parametrize("cut", [1, 1000])
def test_the_newest_file_wins_wherever_batches_end(spark, tmp_path, cut):
    lake = Lake(spark, str(tmp_path / f"cut{cut}"), buckets=2, files_per_batch=cut)
    for n, name in enumerate(("Apple", "Zebra", "Mango")):
        drop(lake, "product_category", f"{'bca'[n]}.csv", f"1,{name}")
        time.sleep(0.02)
    ingest_sources(lake, "product_category")
    refine_sources(lake, "product_category")
    assert [r.CategoryName for r in lake.silver("product_category").read().collect()] == ["Mango"]


def test_null_keys_are_added_each_time(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path / "t"), ["k"], 2)
    for batch in (1, 2):
        table.upsert(spark.createDataFrame([(None, 1)], "k INT, v INT"), batch)
    assert table.read().count() == 2


def test_bootstrap_keeps_columns_of_an_empty_table(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path / "t"), ["k"], 2)
    table.bootstrap(spark.createDataFrame([(1, 1.5)], "k INT, v DOUBLE"))
    assert table.read().count() == 0 and table.read().dtypes == [("k", "int"), ("v", "double")]
    table.bootstrap(spark.createDataFrame([(1, 1)], "k INT, w INT"))
    assert table.read().columns == ["k", "v"]


def test_landing_checks(spark, tmp_path):
    for source, name in (("sales", "a.csv"), ("returns", "b.CSV"), ("products", "c.txt")):
        (tmp_path / source).mkdir()
        (tmp_path / source / name).write_text("x\n")
    ready = {r.source for r in landing_ready(spark, str(tmp_path)).collect() if r.ready}
    assert ready == {"sales"}
    newest = (tmp_path / "sales" / "a.csv").stat().st_mtime
    for shift, fresh in ((-5, {"sales", "returns"}), (60, set())):
        since = dt.datetime.fromtimestamp(newest + shift)
        got = landing_fresh(spark, str(tmp_path), since).collect()
        assert len(got) == 8 and {r.source for r in got if r.fresh} == fresh


FULL = {
    "calendar": ["1/5/2016", "1/6/2016"],
    "customers": ["1,MR.,al,bo,1/1/1980,M,M,a@b.c,\"$90,000 \",2,Hi,Pro,Y"],
    "product_category": ["1,bikes"],
    "product_sub_category": ["1,road bikes,1"],
    "products": ["1,1,S1,p one,m,d,red,L,U,1.5,4.0"],
    "returns": ["1/6/2016,1,1,1"],
    "sales": ["1/5/2016,1/1/2016,SO1,1,1,1,1,2", "1/6/2016,1/1/2016,SO2,1,1,1,1,3"],
    "territories": ["1,north,france,europe"],
}


def _fill(lake: Lake) -> None:
    for source, lines in FULL.items():
        drop(lake, source, "1.csv", *lines)


def test_whole_run_and_second_run(lake, spark):
    _fill(lake)
    refresh(lake)
    star = LakeStar(lake)
    (row,) = metric_query(star, ["Revenue", "Total Orders", "Return Rate"], ["CategoryName"]).collect()
    assert (row.CategoryName, float(row.Revenue), row["Total Orders"]) == ("Bikes", 20.0, 2)
    assert row["Return Rate"] == 1 / 5
    assert not load_gold(lake, "fact_sales") and validate_source(lake, "sales") is None
    # A corrected line reaches the fact, and only its rows carry the new mark.
    drop(lake, "sales", "2.csv", "1/5/2016,1/1/2016,SO1,1,1,1,1,10")
    ingest_sources(lake, "sales")
    refine_sources(lake, "sales")
    validate_source(lake, "sales")
    assert load_gold(lake, "fact_sales")
    facts = {r.OrderNumber: r for r in lake.gold("fact_sales").read().collect()}
    assert {k: float(r.Revenue) for k, r in facts.items()} == {"SO1": 40.0, "SO2": 12.0}
    assert facts["SO1"][MARK] > facts["SO2"][MARK]
    gold = lake.gold("fact_sales")
    assert high_water_mark(gold.read(), MARK).timestamp() == gold_marks(lake, "fact_sales")[1]["sales"] / 1e6
    names = register_views(lake)
    assert "gold_fact_sales" in names and "silver_sales" in names
    assert spark.sql("SELECT sum(OrderQuantity) FROM gold_fact_sales").first()[0] == 13
    assert read_audit(spark, lake.audit("sales")).count() == 20


def test_gate_halts_and_reports_first(lake, spark):
    _fill(lake)
    drop(lake, "sales", "2.csv", "1/7/2016,1/1/2016,SO7,,1,1,1,1")
    ingest_sources(lake, "sales")
    refine_sources(lake, "sales")
    with pytest.raises(QualityGateError, match="sales"):
        validate_source(lake, "sales")
    log = read_audit(spark, lake.audit("sales"))
    assert log.filter("status = 'FAIL'").first().rule_name == "Required Column: ProductKey"
    with pytest.raises(QualityGateError):  # the slice is looked at again
        validate_source(lake, "sales")


def test_a_stopped_run_has_audited_every_source(lake, spark):
    _fill(lake)
    drop(lake, "calendar", "2.csv", "1/7/2016")
    drop(lake, "returns", "2.csv", "1/6/2016,,1,1")
    drop(lake, "sales", "2.csv", "1/7/2016,1/1/2016,SO7,,1,1,1,1")
    with pytest.raises(QualityGateError, match="returns.*sales"):
        refresh(lake)
    assert all(read_audit(spark, lake.audit(source)).count() > 0 for source in SOURCES)
    assert not lake.gold("fact_sales").exists()


def test_changed_lookups_restate_gold(lake, spark):
    _fill(lake)
    drop(lake, "sales", "late.csv", "1/6/2016,1/1/2016,SO9,2,1,1,1,5")
    refresh(lake)
    assert metric_query(LakeStar(lake), ["Revenue"]).first()[0] == 20
    drop(lake, "products", "2.csv", "2,1,S2,p two,m,d,red,L,U,1.0,7.0")
    drop(lake, "product_category", "2.csv", "1,cycles")
    refresh(lake)
    rows = metric_query(LakeStar(lake), ["Revenue"], ["CategoryName"]).collect()
    assert [(r.CategoryName, float(r.Revenue)) for r in rows] == [("Cycles", 55.0)]
    assert not load_gold(lake, "fact_sales") and not load_gold(lake, "dim_products")


def test_namespaces_and_catalog_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    names = create_namespaces(spark, str(tmp_path), prefix="t_")
    assert create_namespaces(spark, str(tmp_path), prefix="t_") == names
    assert set(names) <= {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    drop(lake, "product_category", "a.csv", "1,Bikes")
    args = ("product_category", lake.landing("product_category"), lake.bronze("product_category"))
    checkpoint, table = lake.checkpoint("bronze", "x"), "t_bronze.product_category"
    start_ingest(spark, *args, checkpoint, table=table).awaitTermination()
    assert spark.catalog.tableExists("t_bronze.product_category")
    assert spark.table("t_bronze.product_category").count() == 1
    assert spark.readStream.table("t_bronze.product_category").isStreaming


def _session(**conf: str):
    """Something with the configuration of a session and nothing else."""
    known = {k.replace("_", "."): v for k, v in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: known.get(key, default)))


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = _session(spark_checkpoint_dir="hdfs://x/shared/", spark_master="yarn")
    assert shared_folder(named) == "hdfs://x/shared"
    assert run_folder(named, "x") != run_folder(named, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_session(spark_master="yarn"))
    assert shared_folder(spark) == shared_folder(spark)


def test_lakes_share_a_landing_folder(spark, tmp_path):
    """Each takes the files under its own checkpoint, by its own cut."""
    landed = Lake(spark, str(tmp_path / "landed"), buckets=2)
    for name, quantity in (("a.csv", 1), ("b.csv", 7)):
        drop(landed, "sales", name, f"1/5/2016,1/1/2016,SO1,1,1,1,1,{quantity}", f"1/5/2016,1/1/2016,SO{name},1,1,1,1,1")
        time.sleep(0.02)
    for cut in (1, 1000):
        lake = Lake(spark, str(tmp_path / f"cut{cut}"), buckets=2, files_per_batch=cut, incoming=f"{landed.root}/incoming")
        ingest_sources(lake, "sales")
        refine_sources(lake, "sales")
        rows = {r.OrderNumber: r.OrderQuantity for r in lake.silver("sales").read().collect()}
        assert rows == {"SO1": 7, "SOa.csv": 1, "SOb.csv": 1}
