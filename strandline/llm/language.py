"""Language identification with one bit-sliced Bloom filter over character trigrams.

Learning counts, for every language, in what share of its texts an n-gram stands (over all learning
texts) and keeps the n-grams that reach ``min_share``. They go into a single Bloom filter whose slots
are bit masks over the languages: looking an n-gram up in it ANDs a few slots and gives every
language that has the n-gram at once. A text is decided by the per-language counts of its n-grams,
each corrected for the n-grams that the filter reports by mistake.

The score below which a document is of no known language is calibrated on the learning texts, for texts
of like length apart: of few n-grams a score says less. Each text is scored in its own language without
itself; the threshold of a length is as high as all but ``LOST`` of these scores allow, evenly over
languages, so that clean documents stay. Lengths with too few texts to tell take the threshold of all.

Nulls and edge cases: a null text, or one without a letter, is ``und`` with score 0; bytes that are no
UTF-8 are read as U+FFFD, which is no letter; learning rows
without a language or text teach nothing; without any learning row every text is ``und``. Ties go to
the language first by code point. Repeated rows count as often as they come.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strandline.llm.frames import batched, decoded, fresh, table

UNKNOWN = "und"
#: Longer texts are read in pieces of this many characters.
PIECE = 1 << 20
#: An n-gram belongs to a language when it stands in at least this share of the language's texts.
MIN_SHARE = 0.003
#: Looked-up slots per n-gram, and slots per n-gram of the richest language.
HASHES, SLOTS_PER_GRAM = 3, 16
#: A document is always rejected as of no known language below this score; calibration can only raise it.
MIN_SCORE = 0.2
#: Bins of the histogram of scores, from 0 to 1.
BINS = 1000
#: Share of the own texts that may fall below the threshold, and of how many at least it is taken.
LOST, ENOUGH = 0.004, 1000
#: Lengths told apart: powers of two of the number of n-grams.
LENGTHS = 24

_SEED = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_letters: list[np.ndarray] = []


def _letter() -> np.ndarray:
    """By code point: itself for a letter, else 0; built once in each process."""
    if not _letters:
        points = np.arange(sys.maxunicode + 1, dtype=np.uint64)
        points[[not chr(c).isalpha() for c in range(len(points))]] = 0
        _letters.append(points)
    return _letters[0]


def grams(text: str) -> np.ndarray:
    """The n-grams of ``text``, three code points of 21 bits in one number.

    Letters are lower-cased; what stands between them counts as one blank, as do both ends.
    """
    found, before, text = [], _BLANK, text.lower()
    for at in range(0, len(text), PIECE):
        points = _letter()[np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
        points = np.concatenate([before, points, _BLANK[: at + PIECE >= len(text)]])
        kept = points != 0
        kept[1:] |= kept[:-1]
        kept[0] = True
        points = points[kept]
        found.append((points[:-2] << _HIGH) | (points[1:-1] << _LOW) | points[2:])
        before = points[-2:]
    return np.concatenate(found) if found else np.empty(0, np.uint64)


_BLANK, _HIGH, _LOW = np.zeros(1, np.uint64), np.uint64(42), np.uint64(21)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Filter:
    """``slots[s, w]`` has bit b set when a word of language ``languages[64 * w + b]`` fell on slot s."""

    languages: list[str]
    slots: np.ndarray
    mistakes: np.ndarray  # by language, the chance that a foreign n-gram is reported
    others: Filter | None = None  # of the n-grams that reach min_share even without one text that has them

    @classmethod
    def build(cls, languages: list[str], members: list[np.ndarray]) -> Filter:
        most = max((len(m) for m in members), default=0)
        size = 1 << max(10, int(most * SLOTS_PER_GRAM - 1).bit_length() if most else 0)
        slots = np.zeros((size, max(1, -(-len(languages) // 64))), np.uint64)
        for k, gram in enumerate(members):
            for place in _places(gram, size):
                slots[place, k // 64] |= np.uint64(1) << np.uint64(k % 64)
        bits = [(slots[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1) for k in range(len(languages))]
        return cls(languages, slots, np.array([b.mean() for b in bits]) ** HASHES)

    def shares(self, gram: np.ndarray) -> np.ndarray:
        """By language, the share of the n-grams that it has, corrected for mistakes."""
        mask = np.bitwise_and.reduce([self.slots[p] for p in _places(gram, len(self.slots))])
        hits = self._popcounts(mask)
        return np.clip((hits / max(1, len(gram)) - self.mistakes) / (1 - self.mistakes), 0, 1)

    def _popcounts(self, mask: np.ndarray) -> np.ndarray:
        """By language, in how many masks its bit is set."""
        if len(self.languages) <= 10:  # few enough masks to count each, then add up those with a bit
            times = np.bincount(mask[:, 0].astype(np.int64), minlength=1 << len(self.languages))
            sets = np.arange(len(times))
            return np.array([times[(sets >> k) & 1 == 1].sum() for k in range(len(self.languages))])
        return np.array(
            [((mask[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).sum() for k in range(len(self.languages))]
        )

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        share = self.shares(grams(text))
        best = int(np.argmax(share))
        return self.languages[best], float(share[best])


def _places(gram: np.ndarray, size: int) -> list[np.ndarray]:
    return [((gram * _SEED[k]) >> np.uint64(32)) & np.uint64(size - 1) for k in range(HASHES)]


def _known(examples: DataFrame, text: str, lang: str) -> DataFrame:
    return examples.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL"
    )


def learn(examples: DataFrame, text: str = "text", lang: str = "lang", min_share: float = MIN_SHARE) -> Filter:
    """The filter learned from all ``examples``.

    What comes to the driver is bounded: a language has at most (mean n-grams of a text) / min_share
    members, and the languages themselves.
    """
    known = _known(examples, text, lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            for body, name in zip(decoded(batch.column(0)), decoded(batch.column(1)), strict=True):
                held.setdefault(name, []).append(np.unique(grams(body)))
            for name, found in held.items():
                gram, texts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.record_batch(
                    [pa.array([name] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(texts.astype(np.int64))],
                    names=["lang", "gram", "texts"],
                )

    counts = (
        batched(known, count, "lang string, gram bigint, texts bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("texts").alias("texts"))
    )
    totals = known.groupBy("lang").agg(F.count(F.lit(1)).alias("all_texts"))
    # One row per language, as many as are collected below.
    members = counts.join(F.broadcast(totals), "lang").where(F.col("texts") >= min_share * F.col("all_texts"))
    without = F.when(F.col("texts") - 1 >= min_share * (F.col("all_texts") - 1), F.when(F.col("texts") > 1, F.col("gram")))
    lists = [F.sort_array(F.collect_list(c)).alias(name) for c, name in ((F.col("gram"), "grams"), (without, "others"))]
    found = members.groupBy("lang").agg(*lists).orderBy("lang").toArrow()
    languages = found.column("lang").to_pylist()
    sets, others = (
        [np.asarray(found.column(name)[k].values, np.int64).view(np.uint64) for k in range(len(languages))] for name in ("grams", "others")
    )
    model = Filter.build(languages, sets)
    model.others = Filter.build(languages, others)
    return model


def length_of(gram: np.ndarray) -> int:
    return min(LENGTHS - 1, len(gram).bit_length())


def calibrate(examples: DataFrame, model: Filter, text: str = "text", lang: str = "lang") -> np.ndarray:
    """By length, the score below which a text is of none of the languages of ``model``, learned from ``examples``.

    It is ``MIN_SCORE`` at least. One count per language, length and bin is collected.
    """
    place = {name: k for k, name in enumerate(model.languages)}
    shared = examples.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for body, name in zip(decoded(batch.column(0)), decoded(batch.column(1)), strict=True):
                if name in place and has_letter(body):
                    gram = grams(body)
                    own = shared.value.others.shares(gram)[place[name]]
                    found.append((place[name], length_of(gram), int(own * BINS)))
            rows = np.array(found, np.int64).reshape(-1, 3)
            yield pa.record_batch([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)], names=["lang", "length", "bin"])

    tally = np.zeros((len(place), LENGTHS, BINS + 1))
    scored = batched(_known(examples, text, lang), count, "lang bigint, length bigint, bin bigint")
    for row in scored.groupBy("lang", "length", "bin").count().collect():
        tally[row["lang"], row["length"], row["bin"]] = row["count"]

    def threshold(texts: np.ndarray) -> float:
        """texts: by language a histogram of scores."""
        texts = texts[texts.sum(axis=1) > 0]
        own = (texts / texts.sum(axis=1, keepdims=True)).mean(axis=0)
        lost = np.concatenate([[0], np.cumsum(own)[:-1]])  # below bin k
        return max(MIN_SCORE, int(np.flatnonzero(lost <= LOST)[-1]) / BINS)

    if not tally.any():
        return np.full(LENGTHS, MIN_SCORE)
    of_all = threshold(tally.sum(axis=1))
    return np.array([threshold(tally[:, k]) if tally[:, k].sum() >= ENOUGH else of_all for k in range(LENGTHS)])


def identify(docs: DataFrame, model: Filter, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs``, with the predicted language and its score, under free names if these are taken."""
    pred, score = fresh(docs, pred, score)
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [shared.value.predict(body) for body in decoded(batch.column(at))]
            yield pa.record_batch(
                [*batch.columns, pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64())],
                names=[*batch.schema.names, pred, score],
            )

    return batched(docs, run, StructType([*docs.schema, StructField(pred, StringType()), StructField(score, DoubleType())]))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents that nothing is learned from: crc32 of the id as text is 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_known(docs: DataFrame, model: Filter, text: str = "text", min_score: np.ndarray | float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text is of a known language, with their own columns alone.

    min_score: one threshold, or one by length as ``calibrate`` finds them.
    """
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast((model, np.broadcast_to(np.asarray(min_score, float), LENGTHS)))

    def known(body: str | None) -> bool:
        model, least = shared.value
        if not model.languages or not has_letter(body):
            return False
        gram = grams(body)
        return bool(model.shares(gram).max() >= least[length_of(gram)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([known(body) for body in decoded(batch.column(at))], pa.bool_()))

    return batched(docs, run, docs.schema)


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = table(spark, folder, "documents")
    model = learn(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
