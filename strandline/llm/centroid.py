"""Centroid clustering in integers, by expressions that stay in the JVM.

Vectors become integers, ``floor(SCALE * x)``, so that every sum is exact and every run gives the same
clusters. A vector's squared distance to a centroid is an ``aggregate`` over ``zip_with`` of its array
and the centroid's literal array; ``array_min`` over the structs (distance, number) picks the nearest,
the smaller number at a tie. New centroids come from one sum per component and a count, combined
map-side: the shuffle holds a row per cluster and task, however many vectors a cluster has.

The prepared vectors are written once and read in every round; only the centroids (``CLUSTERS`` rows)
reach the driver and go out again as literals. Starting centroids are a top-k by hash.

Nulls and edge cases: vectors that are null, of another length, or hold a null, NaN or infinity are
left out; with fewer vectors than clusters there are as many clusters as vectors; no vectors give no
rows; a null id is hashed as empty; repeated rows are vectors of their own, equal ids in the start are
ordered by their components. Sums are 64-bit and raise an error instead of overflowing. Columns but id
and vector are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import staged, table

#: Components of a vector, what they are multiplied by, clusters, rounds, and the seed of the start.
SIZE, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, "1"


def prepared(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = SIZE) -> DataFrame:
    """(vec_id, v) of the vectors with ``size`` finite components, v as integers."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("x") == size) & finite).select("vec_id", F.transform("x", lambda x: F.floor(SCALE * x)).alias("v"))


def _literal(numbers: list[int]) -> Column:
    return F.expr(f"array({','.join(f'{n}L' for n in numbers)})")


def distance(vector: Column, centroid: list[int]) -> Column:
    squares = F.zip_with(vector, _literal(centroid), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, square: total + square)


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """struct<distance, cluster> of the nearest centroid, the first of equals."""
    away = [F.struct(distance(vector, c).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(centroids)]
    return F.array_min(F.array(*away))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> list[list[int]]:
    """The vectors whose seeded id has the smallest hashes."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    hashed = vectors.select(F.sha2(told.cast("binary"), 256).alias("hash"), "v")
    return [list(row.v) for row in hashed.orderBy("hash", "v").limit(clusters).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: the floored means of their vectors; empty ones stay."""
    size = len(centroids[0])
    assigned = vectors.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), *(F.get("v", F.lit(i)).alias(f"v{i}") for i in range(size)))
    sums = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *(F.sum(f"v{i}").alias(f"v{i}") for i in range(size)))
    means = {row.cluster: [row[f"v{i}"] // row.n for i in range(size)] for row in sums.collect()}
    return [means.get(k, old) for k, old in enumerate(centroids)]


def cluster(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = SIZE, clusters: int = CLUSTERS,
    rounds: int = ROUNDS, seed: str = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every vector that is kept, and the centroids."""
    kept = staged(prepared(vectors, vec_id, vector, size), "vectors")
    centroids = first_centroids(kept, clusters, seed)
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    found = kept.select("vec_id", nearest(F.col("v"), centroids).alias("at"))
    return staged(found.select("vec_id", "at.cluster", "at.distance"), "clusters"), centroids


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's cluster and distance, the inertia of its cluster and of all, and its centroid's digest."""
    found, centroids = cluster(table(spark, folder, "embeddings"))
    sums = {row.cluster: row.total for row in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    own = _literal([sums.get(k, 0) for k in range(len(digests))])
    digest = F.expr(f"array({','.join(repr(d) for d in digests)})")
    return found.select(
        "vec_id", "cluster", "distance", F.get(own, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"), F.get(digest, F.col("cluster")).alias("centroid_sha256"),
    )


def _sql() -> str:
    """The same in SQL: distances over zipped lists, means over components set out in rows."""
    away = "list_sum(list_transform(list_zip(v.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    at = lambda k: f"SELECT v.r, v.vec_id, v.v, min({away}::HUGEINT * {CLUSTERS} + c.k) AS m FROM v, c{k} c GROUP BY v.r, v.vec_id, v.v"
    rounds = "".join(
        f"""), a{k} AS (
    {at(k)}
), s{k} AS (
    SELECT (m % {CLUSTERS})::INT AS k, i, count(*) AS n, sum(v[i])::BIGINT AS s FROM a{k}, range(1, {SIZE + 1}) t(i) GROUP BY ALL
), c{k + 1} AS (
    SELECT c.k, coalesce(n.c, c.c) AS c FROM c{k} c LEFT JOIN (
        SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{k} GROUP BY k) n USING (k)
"""
        for k in range(ROUNDS)
    )
    return f"""
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE}
), c0 AS (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c
    FROM (SELECT sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM v) ORDER BY h, v LIMIT {CLUSTERS}
{rounds}), z AS (
    {at(ROUNDS)}
)
SELECT vec_id, (m % {CLUSTERS})::INT AS "cluster", (m // {CLUSTERS})::BIGINT AS distance,
    sum(m // {CLUSTERS}) OVER (PARTITION BY m % {CLUSTERS})::BIGINT AS cluster_inertia, sum(m // {CLUSTERS}) OVER ()::BIGINT AS inertia,
    sha256(list_aggregate(c.c, 'string_agg', ',')) AS centroid_sha256
FROM z JOIN c{ROUNDS} c ON c.k = m % {CLUSTERS}
"""


OP13_SQL = _sql()
