"""URL filter: fixed rules first, then two character language models.

Rules name a host and the beginning of a path; the longest that fits decides. URLs that no rule
decides are judged by variable-order Markov models over characters, one of the URLs that rules allow
and one of those they block. A model's chance of a character mixes the orders 0 to ``ORDER``: each
order's estimate is smoothed by the one below with the weight of the distinct characters seen there
(Witten-Bell), down to a uniform chance. The score is the difference of the two log-likelihoods per
character; the threshold is the one that errs least, evenly over both kinds, on the labelled URLs.
One labelled URL in ``HELD_OUT``, told by its checksum, is not counted and serves to find the threshold,
so that no URL vouches for itself; if these or the others lack a kind, all labelled URLs do both.

Counts are exact and cover every other labelled URL: a table of grams (``ORDER`` characters and the one
after them, 48 bits) that grows with the URLs. What a gram adds to a score depends on the gram alone, so
the chances are worked out once per gram, order by order: a context's rows of the order above, at most
``ALPHABET`` ** 2, meet once to be added up and for the context's sums, and are joined with the order
below. Tasks that score hold the ``held`` commonest grams and add up what they hold; other grams of a URL
leave as rows, are joined with the table and added up by URL. Amounts are whole multiples of
2 ** -``UNIT``, so the sum is the same either way and in any order.

Nulls and edge cases: a null URL, or one without ``://``, has an empty host and path and no rule; a
null or empty text has score 0 and is allowed if the threshold is not above 0. If either kind has no
labelled URL, nothing can be learned and the method allows. Repeated rows count and are judged each
time. Result columns get free names if kept columns have theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from strandline.llm.frames import batched, fresh, raw_texts, staged, table

# The rules, as host and beginning of the path, and their verdicts.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}

#: Longest context in characters, and characters told apart (bytes; 0 marks both ends).
ORDER, ALPHABET = 5, 256
#: Grams that a scoring task holds, 16 bytes each.
HELD = 1 << 18
#: One labelled URL in so many is kept from the counts, for the threshold.
HELD_OUT = 4
#: Amounts are rounded to this many binary places.
UNIT = 30
#: Bounds and bins of the histogram of scores.
SCORE_RANGE, BINS = 8.0, 4000

_KINDS = ("allow", "block")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, beginning = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + beginning)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def decided(pages: DataFrame, url: str = "url", rules: dict[str, str] = RULES, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The ``keep`` columns, then url, host, path, rule and the rule's verdict (null without one)."""
    return _unpacked(_decided(pages, url, rules, keep), keep, "url", "host", "path", "rule", "verdict")


def _decided(pages: DataFrame, url: str, rules: dict[str, str], keep: tuple[str, ...]) -> DataFrame:
    """The kept columns as a struct ``kept``, then url, host, path, rule and the rule's verdict."""
    kept = F.struct(*(F.col(f"`{c}`") for c in keep), F.lit(0).alias("_"))
    rows = pages.select(kept.alias("kept"), F.col(f"`{url}`").cast("string").alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for rule, says in rules.items():
        verdict = F.when(F.col("rule") == rule, says).otherwise(verdict)
    return rows.withColumn("verdict", verdict)


def _unpacked(rows: DataFrame, keep: tuple[str, ...], *results: str) -> DataFrame:
    own = rows.select(*(F.col(f"kept.`{c}`").alias(c) for c in keep))
    return rows.select(*(F.col(f"kept.`{c}`").alias(c) for c in keep), *(F.col(r).alias(n) for r, n in zip(results, fresh(own, *results), strict=True)))


def grams(raw: bytes) -> np.ndarray:
    """For every character of a URL and its end: the ``ORDER`` characters before it and itself, a byte each."""
    data = np.frombuffer(b"\0" * ORDER + raw + b"\0", np.uint8).astype(np.int64)
    found = np.zeros(len(raw) + 1, np.int64)
    for k in range(ORDER + 1):
        found = (found << 8) | data[k : k + len(found)]
    return found


def _held_out() -> Column:
    return F.crc32(F.col("url").cast("binary")) % HELD_OUT == 0


def count_grams(rows: DataFrame) -> DataFrame:
    """(gram, n, allow, block): every gram of the column url, how often it stands in all URLs, and in those ``counted`` of each kind.

    rows: url, verdict and counted; what is not counted only tells what is asked for.
    """
    kind = F.when(F.col("counted") & F.col("verdict").isNotNull(), F.when(F.col("verdict") == "block", 2).otherwise(1)).otherwise(0)
    told = rows.where("url IS NOT NULL").select(kind.alias("kind"), F.col("url").cast("binary"))
    names = ("n", *_KINDS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [grams(raw) for raw in batch.column(1).to_pylist()]
            kind = np.repeat(batch.column(0).to_numpy(), [len(f) for f in found]).astype(np.int64)
            different, at = np.unique(np.concatenate(found), return_inverse=True)
            n = np.bincount(kind * len(different) + at, minlength=3 * len(different)).reshape(3, -1)
            yield pa.record_batch([pa.array(c) for c in (different, n.sum(axis=0), n[1], n[2])], names=["gram", *names])

    counts = batched(told, count, ", ".join(f"{c} bigint" for c in ("gram", *names)))
    return counts.groupBy("gram").agg(*(F.sum(c).alias(c) for c in names))


def gram_values(counts: DataFrame) -> DataFrame:
    """(gram, n, amount): what a gram adds to a URL's score, times 2 ** UNIT.

    ``counts`` is read once per order, and should be staged.
    """
    context = F.shiftright("gram", 8)
    sums = {}
    for order in range(ORDER, -1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1))
        rows = (counts if order == ORDER else sums[order + 1]).select(shorter.alias("gram"), "n", *_KINDS)
        rows = rows.withColumn("context", context).repartition("context")
        sums[order] = rows.groupBy("context", "gram").agg(*(F.sum(c).alias(c) for c in ("n", *_KINDS)))
    below = None
    for order in range(ORDER + 1):
        same = Window.partitionBy("context")
        rows = sums[order].select(
            "gram", "n", *_KINDS, *(F.sum(k).over(same).alias(f"{k}_seen") for k in _KINDS),
            *(F.sum(F.when(F.col(k) > 0, 1).otherwise(0)).over(same).alias(f"{k}_kinds") for k in _KINDS),
        )
        if below is None:
            rows = rows.select("*", *(F.lit(1.0 / ALPHABET).alias(f"{k}_below") for k in _KINDS))
        else:
            # The two lowest orders have at most ALPHABET + ALPHABET ** 2 rows of three numbers.
            lower = F.broadcast(below) if order <= 2 else below
            rows = rows.withColumn("shorter", F.col("gram").bitwiseAND(F.lit((1 << (8 * order)) - 1))).join(lower, "shorter")
        chances = []
        for k in _KINDS:
            seen, kinds, lower = F.col(f"{k}_seen"), F.col(f"{k}_kinds"), F.col(f"{k}_below")
            chances.append(F.when(seen > 0, (F.col(k) + kinds * lower) / (seen + kinds)).otherwise(lower).alias(f"{k}_below"))
        rows = rows.select("gram", "n", *chances)
        below = rows.select(F.col("gram").alias("shorter"), *(f"{k}_below" for k in _KINDS))
    amount = F.round((F.log("allow_below") - F.log("block_below")) * F.lit(float(1 << UNIT))).cast("bigint")
    return rows.select("gram", "n", amount.alias("amount"))


def learn(rows: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The table of ``gram_values`` for the grams of all ``rows`` (url, verdict), learned from those that have a verdict
    and are not held out, and the rows (url, verdict) to find the threshold with; None when either verdict is missing."""
    labelled = rows.where("verdict IS NOT NULL AND url IS NOT NULL")
    found = {(r["verdict"], r["out"]) for r in labelled.select("verdict", _held_out().alias("out")).distinct().collect()}
    if not all(any(verdict == kind for verdict, _ in found) for kind in _KINDS):
        return None
    halves = len(found) == 2 * len(_KINDS)
    counted = ~_held_out() if halves else F.lit(True)
    counts = staged(count_grams(rows.select("url", "verdict", counted.alias("counted"))), "url-grams")
    return staged(gram_values(counts), "url-values"), labelled.where(_held_out()) if halves else labelled


def scored(rows: DataFrame, values: DataFrame, held: int = HELD) -> DataFrame:
    """``rows`` (with a column url) and each URL's score; the rows are staged.

    Every gram of the URLs must be in ``values``.
    """
    at = rows.columns.index("url")
    common = values.orderBy(F.col("n").desc(), "gram").limit(held).select("gram", "amount").toArrow().sort_by("gram")
    shared = rows.sparkSession.sparkContext.broadcast((common.column("gram").to_numpy(), common.column("amount").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, amounts = shared.value
        for batch in batches:
            totals, sizes, lacking = [], [], []
            for raw in raw_texts(batch.column(at)):
                found = grams(raw) if raw else np.zeros(0, np.int64)
                place = np.searchsorted(keys, found)
                place[place == len(keys)] = 0
                here = keys[place] == found
                totals.append(int(amounts[place[here]].sum()))
                sizes.append(len(found))
                lacking.append(found[~here].tolist())
            columns = [*batch.columns, pa.array(totals, pa.int64()), pa.array(sizes, pa.int64()), pa.array(lacking, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=[*batch.schema.names, "total", "size", "lacking"])

    more = [StructField("total", LongType()), StructField("size", LongType()), StructField("lacking", ArrayType(LongType()))]
    found = staged(batched(rows, run, StructType([*rows.schema, *more])), "url-scores")
    if values.count() > held:
        # One row per URL that lacks grams, so that copies are not repeated; its bytes tell it.
        key = F.unhex(F.md5(F.col("url").cast("binary")))
        urls = found.where(F.size("lacking") > 0).select(key.alias("key"), "lacking").dropDuplicates(["key"])
        rest = urls.select("key", F.explode("lacking").alias("gram")).join(values, "gram").groupBy("key").agg(F.sum("amount").alias("rest"))
        found = found.join(rest, key == F.col("key"), "left").withColumn("total", F.col("total") + F.coalesce("rest", F.lit(0)))
    score = F.when(F.col("size") > 0, F.col("total") / F.col("size") / float(1 << UNIT)).otherwise(0.0)
    return found.select(*rows.columns, score.alias("score"))


def threshold_of(labelled: DataFrame) -> float:
    """The threshold that errs least on the rows (verdict, score), from a histogram."""
    bin_of = F.floor((F.col("score") + SCORE_RANGE) * (BINS / (2 * SCORE_RANGE)))
    bins = labelled.groupBy((F.col("verdict") == "block").alias("blocked"), F.greatest(F.lit(0), F.least(F.lit(BINS - 1), bin_of)).alias("bin")).count()
    tally = np.zeros((2, BINS))
    for row in bins.collect():
        tally[int(row["blocked"]), row["bin"]] = row["count"]
    tally /= tally.sum(axis=1, keepdims=True)
    # Errors when all from bin k on are allowed: the allowed below it, and the blocked from it on.
    errors = np.concatenate([[0], np.cumsum(tally[0])]) + np.concatenate([np.cumsum(tally[1][::-1])[::-1], [0]])
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float((best[0] + best[-1]) / 2 * (2 * SCORE_RANGE / BINS) - SCORE_RANGE)


def filter_urls(
    pages: DataFrame, url: str = "url", rules: dict[str, str] = RULES, keep: tuple[str, ...] = ("page_id",), held: int = HELD
) -> DataFrame:
    """The ``keep`` columns, then url, host, path, rule, verdict and score of every row of ``pages``."""
    rows = _decided(pages, url, rules, keep)
    results = ("url", "host", "path", "rule", "verdict", "score")
    model = learn(rows.select("url", "verdict"))
    if model is None:
        return _unpacked(rows.withColumn("score", F.lit(0.0)).withColumn("verdict", F.coalesce("verdict", F.lit("allow"))), keep, *results)
    values, calibration = model
    threshold = threshold_of(scored(calibration, values, held))
    method = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return _unpacked(scored(rows, values, held).withColumn("verdict", F.coalesce("verdict", method)), keep, *results)


def op5_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's host, path, rule, verdict and score."""
    return filter_urls(table(spark, folder, "pages")).drop("url")
