"""Newest row per key, merges, marks and lookups, against plain Python."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from strandline.operators.increment import EPOCH, high_water_mark, newer_than
from strandline.operators.latest import keep_latest
from strandline.operators.lookup import hot_keys, lookup, stored_bytes
from strandline.operators.merge import merge_rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_against_brute_force(spark):
    rng = random.Random(7)
    # Key 0 owns a third of the rows; times and ties repeat, some are null.
    rows = [
        (
            0 if rng.random() < 0.33 else rng.randrange(40),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, 1, 2, 3, 4]),
            i,
        )
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "k INT, ts INT, a INT, b INT").repartition(6)
    best = {}
    for k, ts, a, b in rows:
        rank = (-(ts if ts is not None else -1), -1 if a is None else a, b)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, ts, a, b))
    latest = keep_latest(df, ["k"], "ts", ["a", "b"])
    below_shuffle = _plan(latest).split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle
    assert sorted(tuple(r) for r in latest.collect()) == sorted(v for _, v in best.values())


def test_merge_replaces_whole_rows_and_keeps_null_keys(spark):
    schema = "k1 INT, k2 STRING, x INT, y INT"
    target = spark.createDataFrame(
        [(1, "a", 1, 1), (1, "b", 2, 2), (None, "a", 3, 3), (2, "a", 4, 4)], schema
    )
    updates = spark.createDataFrame(
        [(None, 9, "a", 1), (None, 8, "a", None), (None, 7, "c", 3)], "y INT, x INT, k2 STRING, k1 INT"
    )
    merged = {tuple(r) for r in merge_rows(target, updates, ["k1", "k2"]).collect()}
    assert merged == {
        (1, "a", 9, None), (1, "b", 2, 2), (None, "a", 3, 3), (2, "a", 4, 4),
        (None, "a", 8, None), (3, "c", 7, None),
    }


def test_marks(spark):
    day = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)
    for kind in ("TIMESTAMP", "TIMESTAMP_NTZ"):
        rows = spark.createDataFrame(
            [(day,), (day + dt.timedelta(microseconds=1),), (None,)], f"ts {kind}"
        )
        assert high_water_mark(None, "ts") == EPOCH
        assert high_water_mark(rows.limit(0), "ts") == EPOCH
        assert high_water_mark(rows, "ts") == day + dt.timedelta(microseconds=1)
        assert newer_than(rows, "ts", day).count() == 1
        assert newer_than(rows, "ts", EPOCH).count() == 2


def test_mark_reaches_the_scan(spark, tiny):
    events = spark.read.parquet(f"{tiny}/events.parquet")
    plan = _plan(newer_than(events, "ts", dt.datetime(2024, 1, 20)))
    assert "GreaterThan(ts,2024-01-20" in plan.split("PushedFilters")[1]


def _skewed(spark):
    """A third of the rows on one key, a tenth without a key, the rest spread out."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 10 == 1, None).otherwise(n % 500)
    return spark.range(0, 30_000, numPartitions=6).select(n, key.cast("int").alias("k"))


def test_hot_keys_are_found(spark):
    found = {r.k: r.salts for r in hot_keys(_skewed(spark), "k", 64).collect()}
    # A third of all rows, a little more of those that have a key.
    assert 64 / 3 < found[7] < 64 / 2 and len(found) <= 64 and sum(found.values()) <= 128
    assert hot_keys(_skewed(spark).limit(0), "k").count() == 0


def test_salted_lookup_equals_plain_join(spark):
    left = _skewed(spark)
    right = spark.range(0, 400).select(
        F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v")
    )
    plain = left.join(right, "k", "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = lookup(left, right, "k", hot=hot_keys(left, "k"), spread=["id"])
        assert sorted(salted.columns) == sorted(plain.columns)
        rows = salted.select(*plain.columns)
        assert rows.exceptAll(plain).count() == 0 and plain.exceptAll(rows).count() == 0
        assert "SortMergeJoin" in _plan(salted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_and_null_keys_are_dealt_out(spark):
    left = _skewed(spark)
    right = spark.createDataFrame([(7, "x")], "k INT, v STRING")
    # What the join sees: rows per (key, salt).
    hot = hot_keys(left, "k", 64)
    marked = left.join(F.broadcast(hot.withColumnRenamed("k", "h")), F.col("k") == F.col("h"), "left")
    spread = marked.filter("h IS NOT NULL").withColumn("s", F.pmod(F.xxhash64("id"), "salts"))
    sizes = [r["count"] for r in spread.groupBy("k", "s").count().collect()]
    assert max(sizes) < 1.5 * 30_000 / 64
    assert lookup(left, right, "k", hot=hot).filter("v = 'x'").count() == left.filter("k = 7").count()


def test_small_lookup_is_broadcast(spark):
    right = spark.createDataFrame([(7, "x")], "k INT, v STRING")
    assert "BroadcastHashJoin" in _plan(lookup(_skewed(spark), right, "k", small=True))


def test_stored_bytes(spark, tiny):
    from pathlib import Path

    paths = [f"{tiny}/part.parquet", f"{tiny}/customer.parquet"]
    assert stored_bytes(spark, *paths) == {p: Path(p).stat().st_size for p in paths}
    (url,) = stored_bytes(spark, f"file://{paths[0]}").values()
    assert url == Path(paths[0]).stat().st_size
