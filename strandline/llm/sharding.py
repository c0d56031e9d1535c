"""K-d tree sharding by bytes, with DataFrame operations only.

A node of the tree holds the documents of a box in the space of their metadata (size, source,
language) and owes a number of shards. It is cut along its widest dimension, as a share of the whole
table's width, at the weighted median: where the bytes on the left fit the shards that go left. Each
level cuts all its nodes at once. Leaves owe one shard and so hold the target bytes, as nearly as
whole documents allow.

A cut is found without sorting: along the dimension every document has a 60-bit place, the dimension
first and a hash of the document after it, so that a value that a third of the documents share is cut,
too. Bytes are summed by the first 15 bits of the place, then, inside the one range that holds the
cut, by the next 15, and so on until the range is as good as exact. The driver learns a few numbers
per node and pass; a node has one row per range at most.

Slots number the documents of a shard from 0. Each shard is cut into hash ranges; ranges get their
first slot from their counts, documents theirs within their range, so no shard is gathered in a task.

Nulls and edge cases: a null text has no bytes; null sources and languages are values like others,
lowest in order; documents without an id are told apart by their place in the table; rows equal in id
and text cannot be told apart and share a shard. Fewer documents than shards leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.frames import staged, table

SHARDS = 40
#: Bits of a place, of the hash in it, and of one pass.
PLACE_BITS, HASH_BITS, PASS_BITS = 60, 40, 15
#: Hash ranges per shard in which slots are numbered.
RANGES = 1024
#: A cut is as good as exact when it is off by this share of a shard's bytes at most.
EXACT = 1e-3
DIMENSIONS = ("by_size", "by_source", "by_lang")


def metadata(docs: DataFrame, doc_id: str, text: str, source: str, lang: str) -> DataFrame:
    """(doc_id, size, text_crc32, the dimensions as 20-bit numbers, tie) of every row of ``docs``."""
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    scale = 1 << (PLACE_BITS - HASH_BITS)

    def spread(column: str) -> Column:  # names in an order of their own, null first
        return F.coalesce(F.expr(f"1 + crc32(CAST(CAST(`{column}` AS STRING) AS BINARY)) % {scale - 1}"), F.lit(0)).cast("bigint")

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), (F.octet_length(raw).cast("bigint") + 16).alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"), spread(source).alias("by_source"), spread(lang).alias("by_lang"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.monotonically_increasing_id()).alias("of"),
    )
    by_size = F.least(F.lit(scale - 1), F.floor(F.log2(F.col("size")) * (scale / 40))).cast("bigint")
    tie = F.expr(f"xxhash64(of, text_crc32) & {(1 << HASH_BITS) - 1}")
    return rows.withColumn("by_size", by_size).withColumn("tie", tie).drop("of")


def place(dimension: str) -> Column:
    return F.col(dimension) * (1 << HASH_BITS) + F.col("tie")


def _by_node(numbers: dict[int, float]) -> Column:
    """A row's number by its node; the nodes are as many as shards at most."""
    return F.create_map(*(F.lit(x) for pair in numbers.items() for x in pair))[F.col("node")]


def _cuts(rows: DataFrame, wanted: dict[int, float], exact: float) -> dict[int, int]:
    """By node, the last place that goes left, for ``wanted`` bytes to go left as nearly as places allow.

    Pass by pass, a node's range is the one in which its cut lies: ``low`` is the range's first place
    and ``before`` the bytes below it. ``rows``: node, size, place.
    """
    low, before, width, cuts = dict.fromkeys(wanted, 0), dict.fromkeys(wanted, 0.0), PLACE_BITS, {}
    while left := [k for k in wanted if k not in cuts]:
        top, width = width, max(0, width - PASS_BITS)
        inside = rows.where(F.col("node").isin(left)).withColumn("at", F.col("place") - _by_node({k: low[k] for k in left}))
        inside = inside.where(F.col("at").between(0, (1 << top) - 1))
        sums = inside.groupBy("node", F.shiftright("at", width).alias("range")).agg(F.sum("size").alias("bytes"))
        earlier = Window.partitionBy("node").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        below = sums.withColumn("below", _by_node({k: before[k] for k in left}) + F.coalesce(F.sum("bytes").over(earlier), F.lit(0)))
        # The first range that the cut does not lie beyond; there is one, for all bytes reach the goal.
        holds = below.where(F.col("below") + F.col("bytes") >= _by_node({k: wanted[k] for k in left}))
        for node, (at, start, size) in holds.groupBy("node").agg(F.min(F.struct("range", "below", "bytes"))).collect():
            first = low[node] + (at << width)
            if width == 0 or size <= exact:
                # Whichever side of the range is nearer to the goal.
                takes = wanted[node] - start >= start + size - wanted[node]
                cuts[node] = first + (1 << width) - 1 if takes else first - 1
            else:
                low[node], before[node] = first, float(start)
    return cuts


def assign(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (size, tie and the dimensions) with the number of the leaf they fall into, ``node``.

    A node is named by the first of the shards that it owes, and written again with each level.
    """
    owed, extent = {0: shards}, {}
    rows = rows.withColumn("node", F.lit(0))
    bounds = [f(F.col(d)).alias(f"{name}_{d}") for d in DIMENSIONS for name, f in (("lo", F.min), ("hi", F.max))]
    while any(n > 1 for n in owed.values()):
        found = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *bounds).collect()}
        if not found:
            break
        widest, wanted = {}, {}
        for node, r in found.items():
            spans = {d: r[f"hi_{d}"] - r[f"lo_{d}"] for d in DIMENSIONS}
            extent = extent or {d: max(1, s) for d, s in spans.items()}
            if owed[node] > 1:
                widest[node] = max(DIMENSIONS, key=lambda d: (spans[d] / extent[d], -DIMENSIONS.index(d)))
                wanted[node] = float(r["bytes"] * (owed[node] // 2) / owed[node])
        along = F.lit(0).cast("bigint")
        for dimension in set(widest.values()):
            along = F.when(F.col("node").isin([k for k, d in widest.items() if d == dimension]), place(dimension)).otherwise(along)
        placed = rows.withColumn("place", along)
        smallest = min(r["bytes"] / owed[node] for node, r in found.items())
        cuts = _cuts(placed.select("node", "size", "place"), wanted, EXACT * smallest)
        goes = F.col("node").isin(list(cuts)) & (F.col("place") > _by_node(cuts))
        rows = staged(placed.withColumn("node", F.when(goes, _by_node({k: k + owed[k] // 2 for k in cuts})).otherwise(F.col("node"))).drop("place"), "level")
        owed = {k: n for node, n in owed.items() for k, n in ([(node, n // 2), (node + n // 2, n - n // 2)] if n > 1 else [(node, n)])}
    return rows


def shard(
    docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang"
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``."""
    rows = staged(metadata(docs, doc_id, text, source, lang), "metadata")
    part = F.expr(f"CAST(tie DIV {(1 << HASH_BITS) // RANGES} AS INT)")
    placed = assign(rows, shards).select("doc_id", "size", "text_crc32", "tie", F.col("node").alias("shard"), part.alias("part"))
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    here = Window.partitionBy("shard", "part").orderBy("tie", "doc_id", "text_crc32", "size")
    numbered = placed.withColumn("place", F.row_number().over(here) - 1).join(firsts, ["shard", "part"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).alias("slot"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard and slot; shards hold near equal bytes."""
    found = shard(table(spark, folder, "documents"))
    return found.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
