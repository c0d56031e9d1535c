from __future__ import annotations

import hashlib
import math
import random

import pytest

from strandline.llm.catalog import oracle_sql, queries
from strandline.llm.centroid import cluster, prepared

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, size, clusters, rounds):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:clusters]]
    away = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((away(v, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(own[k]) for x in zip(*own[k])] if k in own else c for k, c in enumerate(centroids)]
    return sorted([(i, near(v)[1], near(v)[0]) for i, v in kept], key=str), centroids


def vectors(seed, n, size):
    rng = random.Random(seed)
    rows = [(k, [rng.choice([-1.5, 0.0, 0.25, 2.0]) + rng.gauss(0, 0.1) for _ in range(size)]) for k in range(n)]
    rows = [(i, [float(round(x * 64)) / 64 for x in v]) for i, v in rows]
    odd = [None, [], [1.0] * (size - 1), [1.0] * (size + 1), [None] + [1.0] * (size - 1), [float("nan")] * size, [float("inf")] * size]
    return [*rows, *[(900 + k, v) for k, v in enumerate(odd)], *rows[:3], (None, rows[4][1]), (None, rows[5][1]), (rows[6][0], rows[7][1])]


@pytest.mark.parametrize("n, size, clusters", [(60, 3, 5), (40, 8, 16), (8, 4, 20)])
def test_clusters_are_those_of_plain_arithmetic(spark, n, size, clusters):
    rows = vectors(n, n, size)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "7 AS cluster", "'v' AS V", "1 AS Distance").repartition(3)
    found, centroids = cluster(frame, size=size, clusters=clusters)
    assert (sorted(map(tuple, found.collect()), key=str), centroids) == brute(rows, size, clusters, 3)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(k, [1.0, 1.0]) for k in range(20)] + [(50, [3.0, 1.0])]
    found, centroids = cluster(spark.createDataFrame(rows, SCHEMA), size=2, clusters=16)
    assert (sorted(map(tuple, found.collect()), key=str), centroids) == brute(rows, 2, 16, 3)
    assert len({row.cluster for row in found.collect()}) <= 2 and len(centroids) == 16


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, [1.0])], SCHEMA)
    found, centroids = cluster(frame)
    assert (found.columns, found.count(), centroids) == (["vec_id", "cluster", "distance"], 0, [])
    assert prepared(frame.limit(0)).count() == 0


def test_query_without_a_kept_vector(spark, tmp_path):
    spark.createDataFrame([(1, [1.0])], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries()["op13_centroids"](spark, str(tmp_path))
    assert (found.count(), len(found.columns)) == (0, 6)


def test_sums_raise_instead_of_overflowing(spark):
    rows = [(k, [float(2**40) * k, 0.0]) for k in range(3)]
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        cluster(spark.createDataFrame(rows, SCHEMA), size=2, clusters=1)[0].collect()


def test_query_against_sql_and_plan(spark, tiny):
    from oracle_check import compare, connect

    query = queries()["op13_centroids"](spark, tiny)
    assert compare(query, connect(tiny), oracle_sql()["op13_centroids"]) is None
    assert not any(word in query._jdf.queryExecution().toString() for word in ("Python", "Arrow", "Pandas"))
