"""Mixing sources to target weights by capped water-filling, with DataFrame operations only.

Every source asks for its weight's share of the words to take. A source cannot give more than
``max_epochs`` times what it has: it is clamped there, and the excess goes to the others by weight,
until nobody is above. In the end there is one water level: source s gets min(cap_s, level * weight_s).
Sorted by cap / weight, the clamped sources come first, so the level follows from running sums over
the table of sources, one row each.

A source's target is so many whole repetitions of all its documents, and of a seeded sample of them
one more. Documents are sampled in the order of a seeded hash until the words reach what is missing.
The order is cut into ``SLICES`` hash slices per source: sums of slices give the words before each, and
running sums within a slice the rest. So every row is shuffled and ordered once, within its slice, and
no source is ever gathered in one task.

Nulls and edge cases: a null text has no words; documents without a source form the source null, last
in order; a source without words has target 0; documents without words are taken 0 words. Equal rows
are told apart by nothing, so any one of them may be the last one taken. An empty table gives one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.frames import fresh, table

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Words to take, as a share of all words, and how often a source may be repeated.
SHARE, MAX_EPOCHS = 1.5, 2
#: Hash ranges per source.
SLICES = 4096
SEED = "strandline-mix-1"


def n_words(text: str) -> F.Column:
    """Runs of anything but space and the control characters 9 to 13."""
    return F.coalesce(F.size(F.regexp_extract_all(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), F.lit(0)).cast("bigint")


def draw(*columns: str, seed: str = SEED) -> F.Column:
    """A number below 2**48 that depends on the seed and the columns alone."""
    told = F.concat_ws("|", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns))
    return F.conv(F.substring(F.md5(told.cast("binary")), 1, 12), 16, 10).cast("bigint")


def water_levels(
    sources: DataFrame, source: str = "source", size: str = "source_size", weight: str = "weight", share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``sources`` (a row per source) with its target in words, ``target``.

    The windows run over one row per source. Sources of size 0 have cap 0 and take nothing.
    """
    everything = Window.partitionBy()
    rising = Window.orderBy(F.col("ratio"), F.col("order_of"))
    capped = sources.withColumn("cap", F.lit(max_epochs) * F.col(size)).withColumn("ratio", F.col("cap") / F.col(weight))
    capped = capped.withColumn("order_of", F.struct(F.col(source).isNull(), source))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    running = (
        capped.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum(weight).over(everything) - F.coalesce(F.sum(weight).over(before), F.lit(0)))
        .withColumn("wanted", F.lit(share) * F.sum(size).over(everything))
        # The level if this source and all after it are below their caps.
        .withColumn("level", (F.col("wanted") - F.col("cap_before")) / F.col("weight_left"))
        .withColumn("clamped", F.col("level") >= F.col("ratio"))
        # The true level is that of the first source that is not clamped.
        .withColumn("level", F.min(F.when(~F.col("clamped"), F.struct("ratio", "order_of", "level"))).over(everything)["level"])
    )
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col(weight))
    return running.withColumn("target", target).drop(
        "cap", "ratio", "order_of", "cap_before", "weight_left", "wanted", "level", "clamped"
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken; then ``keep``."""
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(text).alias("size"),
        F.md5(F.col(text).cast("string").cast("binary")).alias("digest"), F.struct(*keep, F.lit(0).alias("_")).alias("kept"),
    )
    rows = rows.withColumn("draw", draw("doc_id", "digest", seed=seed)).withColumn("slice", F.expr(f"CAST(draw % {SLICES} AS INT)"))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    sums = slices.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    which = F.array(*map(F.lit, weights))
    levels = water_levels(sums.withColumn("weight", F.element_at(which, (place % len(weights) + 1).cast("int"))), share=share, max_epochs=max_epochs)
    # Whole repetitions, and the words of the sampled one more.
    levels = levels.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    levels = levels.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    order = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    same = slices["source"].eqNullSafe(levels["source"])
    points = slices.join(levels, same).drop(levels["source"]).withColumn("before", F.coalesce(F.sum("slice_size").over(order), F.lit(0)))
    here = Window.partitionBy("source", "slice").orderBy("draw", "doc_id", "size", "digest").rowsBetween(Window.unboundedPreceding, -1)
    points = points.select(
        F.col("source").alias("_source"), F.col("slice").alias("_slice"), "source_size", "target", "whole", "rest", "before", "slice_size"
    )
    joined = rows.join(points, rows["source"].eqNullSafe(points["_source"]) & (rows["slice"] == points["_slice"]))
    joined = joined.withColumn("words_before", F.col("before") + F.coalesce(F.sum("size").over(here), F.lit(0)))
    # A document is in the sample when at least half of it lies before the point where the sample is full.
    sampled = F.col("words_before") + F.col("size") / 2 <= F.col("rest")
    copies = F.when(F.col("size") > 0, F.col("whole") + sampled.cast("bigint")).otherwise(F.col("whole")).cast("bigint")
    return joined.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *(F.col(f"kept.`{c}`").alias(c) for c in keep),
    )


def materialise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its own columns alone.

    Documents without words, which weigh nothing, stay once.
    """
    payload, = fresh(docs, "payload")
    whole = docs.withColumn(payload, F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    mixed = mix(whole, doc_id, text, source, keep=(payload,))
    times = F.when(F.col("size") > 0, F.col("copies")).otherwise(1).cast("int")
    return mixed.select(F.explode(F.array_repeat(payload, times)).alias(payload)).select(
        *(F.col(f"{payload}.`{c}`").alias(c) for c in docs.columns)
    )


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# The same in SQL: the level from running sums, and one running sum of words per source.
OP6_SQL = rf"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(text) AS digest,
        ('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, '-'), coalesce(md5(text), '-'))), 1, 12))::BIGINT AS draw
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}
        {" ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(WEIGHTS))} END AS weight
    FROM d GROUP BY source
), c AS (
    SELECT *, {MAX_EPOCHS} * source_size AS cap, {MAX_EPOCHS} * source_size / weight AS ratio FROM s
), l AS (
    SELECT *, ({SHARE}::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER ()
            - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS own
    FROM c
), t AS (
    SELECT source, source_size, CASE WHEN own >= ratio THEN cap::DOUBLE ELSE weight * (
        SELECT own FROM l WHERE own < ratio ORDER BY ratio, source NULLS LAST LIMIT 1) END AS target
    FROM l
), q AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), p AS (
    SELECT d.doc_id, d.size, q.source_size, q.target, q.whole, q.target - q.whole * q.source_size AS rest,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw % {SLICES}, d.draw, d.doc_id NULLS FIRST, d.size, d.digest NULLS FIRST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_before
    FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target, (size * (whole + (words_before + size / 2 <= rest)::INT))::BIGINT AS taken FROM p
"""
