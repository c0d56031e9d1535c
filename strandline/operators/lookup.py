"""Left join to a keyed lookup that holds up when one key owns much of the left side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup is broadcast only when the files it comes from are together no larger than this.
SMALL_LOOKUP_BYTES = 16 * 1024 * 1024
# Counters of a heavy-hitter sketch for every partition of a shuffle.
COUNTERS = 8


def shuffle_width(spark: SparkSession) -> int:
    """Into how many partitions a shuffle deals its rows."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored_bytes(spark: SparkSession, *paths: str) -> dict[str, int]:
    """File sizes under each path, taken from one listing; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(list(paths))
        .select("path", "length")
    )
    # Listings spell the scheme their own way (file:/ for file:///), so it is left out.
    tails = {p: p.split("://", 1)[-1] for p in paths}
    under = F.coalesce(
        *[F.when(F.contains("path", F.lit(tail)), F.lit(p)) for p, tail in tails.items()]
    )
    sizes = files.groupBy(under.alias("root")).agg(F.sum("length").alias("bytes")).collect()
    return dict.fromkeys(paths, 0) | {r.root: r.bytes for r in sizes}


def hot_keys(df: DataFrame, key: str, width: int | None = None) -> DataFrame:
    """Keys that fill a shuffle partition by themselves, and over how many to deal each.

    With ``width`` partitions (those of the session's shuffles) such a key holds at least one in
    ``width`` of the non-null rows, so there are at most ``width`` of them, and their ``salts`` add
    up to no more than twice that, whatever the input. Each task sends one heavy-hitter sketch, so
    the input is not shuffled. Which keys are found decides only how the work is spread, never
    which rows come out.
    """
    width = width or shuffle_width(df.sparkSession)
    sketch = df.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k({key}, {width}, {COUNTERS * width})").alias("top"),
        F.count(F.lit(1)).alias("total"),
    )
    share = F.col("hit.count") * width / F.col("total")
    return (
        sketch.select("total", F.explode("top").alias("hit"))
        .filter(share >= 1)
        .select(F.col("hit.item").alias(key), F.ceil(share).cast("int").alias("salts"))
    )


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    small: bool = False,
    hot: DataFrame | None = None,
    spread: Sequence[str] = (),
    merge: bool = False,
) -> DataFrame:
    """``left`` with the columns of its one matching ``right`` row, null where none matches.

    ``small`` says that the size of ``right`` was checked and allows a broadcast. Otherwise,
    given ``hot``, rows of a hot key are dealt over its ``salts`` by a hash of ``spread`` (all
    left columns by default) and only the lookup rows of those few keys are repeated; null
    keys, which match nothing, are dealt over all partitions. With neither it is a plain join. With
    ``merge`` the dealt rows are shuffled at every size, so that they come out in even partitions.
    """
    if small:
        return left.join(F.broadcast(right), on=key, how="left")
    if hot is None:
        return left.join(right, on=key, how="left")
    marked = F.broadcast(hot.select(F.col(key).alias("_hot"), F.col("salts").alias("_salts")))
    ways = F.when(F.col(key).isNull(), F.lit(shuffle_width(left.sparkSession))).otherwise(
        F.coalesce("_salts", F.lit(1))
    )
    dealt = F.pmod(F.xxhash64(*(spread or left.columns)), ways).cast("int")
    salted = left.join(marked, F.col(key) == F.col("_hot"), "left").withColumn("_salt", dealt)
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = (
        right.join(marked, F.col(key) == F.col("_hot"), "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_hot", "_salts")
    )
    if merge:
        repeated = repeated.hint("merge")
    return salted.drop("_hot", "_salts").join(repeated, on=[key, "_salt"], how="left").drop("_salt")
