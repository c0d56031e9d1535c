"""Quality rules judged by host: documents fail rules, hosts have failure rates, verdicts go back.

Every document is tested by the base rules, and for its host by three more: too many symbols, too many
repeated lines, words too short or too long on average. Failures are added up by host (the document's
source), and a host's rate is shrunk towards the corpus: rates follow a beta distribution fitted to all
hosts by their mean and variance (an empirical prior), so that a host of few documents is judged by what
is usual and one of many by what it showed. A host is rejected, and with it the documents that pass the
base rules, when it is surely out of line: its shrunk rate, less ``CERTAIN`` standard deviations of what
is known of it, lies above the prior's mean by as many of the prior's and is ``LIFT`` times the mean or
more. Where most documents of the corpus fail, no host is out of line.

Host sums are combined before they are shuffled, so a host with a third of the rows is one row per
task. Verdicts are joined back to the measured rows, which carry numbers only; the rows of hosts that
would fill a partition are dealt over several.

Nulls and edge cases: a null text is empty (no words, fails); documents without a source have no host
and are judged by themselves alone; with one host or equal rates the prior is as good as certain, and
every host is judged by the corpus's rate. An empty table gives none. Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import batched, raw_text, staged, table
from strandline.operators.lookup import hot_keys, lookup

#: Words in a window; a document fails with fewer words, or more repeated words in a hundred.
WINDOW, MIN_WORDS, MAX_REPEATED = 3, 50, 50
#: For hosts only: symbols in a hundred words, repeated lines in a hundred lines, letters a word at least and at most.
MAX_SYMBOLS, MAX_DUP_LINES, WORD_LENGTH = 10, 30, (3, 10)
#: Standard deviations for "surely" (one side, 95 %), and how far above the usual rate a rejected host is.
CERTAIN, LIFT = 1.645, 2
#: Documents' worth of the prior: never less than one, and never more than a million.
PRIOR_RANGE = (1.0, 1e6)

# Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_STARTS_POINT = np.ones(256, bool)
_STARTS_POINT[0x80:0xC0] = False
_IN_WORD = _STARTS_POINT.copy()
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of a text that are looked at together.
PIECE = 1 << 20

MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint"


def _repeated(words: list[bytes]) -> int:
    """Words in windows that stand at least twice in the text."""
    if len(words) <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    number = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    # Exact: windows are numbered two words at a time, so that any two numbers fit in one.
    windows = number
    for k in range(1, WINDOW):
        pairs = windows[: len(number) - k] * np.int64(len(number) + 1) + number[k:]
        windows = np.unique(pairs, return_inverse=True)[1]
    twice = np.flatnonzero(np.bincount(windows)[windows] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measures(raw: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word) of a UTF-8 text."""
    chars = symbols = 0
    for at in range(0, len(raw), PIECE):
        data = np.frombuffer(raw, np.uint8, min(PIECE, len(raw) - at), at)
        chars += int(_IN_WORD[data].sum())
        symbols += int(_IS_SYMBOL[data].sum())
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeated(words), len(lines)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(doc_id, host, the measures, base_failed, rule_failed) of every row of ``docs``."""
    source = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(host).cast("string").alias("host"), raw_text(text).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in MEASURES.split(", ")]
        for batch in batches:
            rows = np.array([measures(raw) for raw in batch.column(2).to_pylist()], np.int64).reshape(-1, len(names))
            columns = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(len(names))]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], names=["doc_id", "host", *names])

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    shortest, longest = WORD_LENGTH
    for_host = (
        F.col("base_failed")
        | (100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))
        | ~F.col("word_chars").between(shortest * F.col("n_words"), longest * F.col("n_words"))
    )
    measured = batched(source, run, f"doc_id bigint, host string, {MEASURES}")
    return measured.withColumn("base_failed", failed).withColumn("rule_failed", for_host)


def host_rates(measured: DataFrame) -> DataFrame:
    """(host, n_docs, n_failed, rate, rejected) of every host.

    The rate is the mean of the host's beta distribution, the prior of all hosts and its own documents
    taken together.
    """
    hosts = measured.where("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("rule_failed").cast("bigint")).alias("n_failed")
    )
    raw = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(
        F.avg(raw).alias("mean"), F.coalesce(F.var_samp(raw), F.lit(0.0)).alias("variance"),
        # A rate of n documents varies by mean * (1 - mean) / n even if all hosts are alike.
        F.avg(1 / F.col("n_docs")).alias("per_doc"),
    )
    level = F.col("mean") * (1 - F.col("mean"))
    between = F.greatest(F.col("variance") - level * F.col("per_doc"), F.lit(0.0))
    weight = F.when(between > 0, level / between - 1).otherwise(PRIOR_RANGE[1])
    prior = prior.select("mean", F.greatest(F.lit(PRIOR_RANGE[0]), F.least(F.lit(PRIOR_RANGE[1]), weight)).alias("weight"))
    mean, weight = (prior.select(name).scalar() for name in ("mean", "weight"))
    usual = mean + CERTAIN * F.sqrt(mean * (1 - mean) / (weight + 1))
    rate = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n_docs") + weight + 1))
    return hosts.withColumn("rate", rate).withColumn("rejected", F.col("rate") - CERTAIN * spread > F.greatest(usual, LIFT * mean))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The measured rows of ``docs`` with host_rate (null without a host) and kept."""
    measured = staged(measure(docs, doc_id, text, host), "measures")
    rates = host_rates(measured).select("host", F.col("rate").alias("host_rate"), "rejected")
    rows = lookup(measured, rates, "host", hot=hot_keys(measured, "host"))
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))).drop("rejected")


def op7_hosts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its measures and whether it and its host pass."""
    return judge(table(spark, folder, "documents")).drop("host").withColumn("host_rate", F.round("host_rate", 9))


# The same in SQL: windows of three words as lists, the prior and the rates as above.
OP7_SQL = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), m AS (
    SELECT doc_id, source, len(words) AS n_words,
        len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))) AS n_lines,
        len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
            - len(list_distinct(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
        words, row_number() OVER () AS r
    FROM d
), w AS (
    SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM m)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM w) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), j AS (
    SELECT m.*, coalesce(covered.n, 0) AS n_repeat_words,
        n_words < 50 OR 100 * coalesce(covered.n, 0) > 50 * n_words AS base_failed,
        n_words < 50 OR 100 * coalesce(covered.n, 0) > 50 * n_words OR 10 * n_symbols > n_words
            OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 3 * n_words OR word_chars > 10 * n_words AS rule_failed
    FROM m LEFT JOIN covered USING (r)
), h AS (
    SELECT source, count(*) AS n_docs, sum(rule_failed::INT) AS n_failed FROM j WHERE source IS NOT NULL GROUP BY source
), p AS (
    SELECT avg(n_failed / n_docs) AS mean, coalesce(var_samp(n_failed / n_docs), 0) AS variance, avg(1 / n_docs) AS per_doc FROM h
), q AS (
    SELECT mean, sqrt(mean * (1 - mean)) AS one, greatest(1, least(1e6, CASE WHEN variance > mean * (1 - mean) * per_doc
        THEN mean * (1 - mean) / (variance - mean * (1 - mean) * per_doc) - 1 ELSE 1e6 END)) AS weight FROM p
), v AS (
    SELECT source, n_docs + weight + 1 AS known, (n_failed + mean * weight) / (n_docs + weight) AS rate,
        greatest(mean + 1.645 * one / sqrt(weight + 1), 2 * mean) AS usual
    FROM h, q
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines, base_failed,
    rule_failed, round(rate, 9) AS host_rate,
    NOT base_failed AND coalesce(rate - 1.645 * sqrt(rate * (1 - rate) / known) <= usual, true) AS kept
FROM j LEFT JOIN v ON j.source = v.source
"""
