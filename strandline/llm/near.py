"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A text's k-mers are its two-word windows, told apart by how often each occurred before: short enough
to outlive edits to a fifth of the words, wherever these stand. One sketch value takes the ``PICKED`` k-mers with the smallest hashes and hashes them together in text order, so
that texts agree on it when they share k-mers *and* their order: it answers to edit similarity.
``SKETCHES`` such values are drawn. Texts of at most ``FEW`` words have few k-mers, of which an edit
takes many, and get ``SINGLES`` more values of one k-mer each. Texts that agree on any are candidates; a candidate pair is
accepted when the word edit distance, computed within the band of diagonals that the threshold
leaves, is at most ``1 - similarity`` of the longer text. Accepted pairs are links; documents of a
connected component form a class, named by its smallest doc_id.

Large groups: equal texts are collapsed first (one row per distinct text, partial aggregation);
within a bucket of equal sketch values every text is compared with the bucket's smallest text only, its
anchor, never all with all. Texts whose numbers of words rule a link with the anchor out are dealt out
again with those of like numbers of words. A text that is unlike an anchor goes on by what tells it from
all the anchors that it was compared with, ``OWN`` minima over the k-mers that none of them has, among the
texts that had one of these anchors too. What
thousands of texts have in common, a passage, is so out of the way after a round or two, and texts that
are like each other meet again. Texts of which the anchors have nearly all go on by their sketch values
among themselves, once. Rounds go on, each with new anchors, until no pair is left that was not
compared. No bucket is capped, and comparisons grow with a bucket's size, not with its square. A pair is
overlooked if it agrees on no sketch value, or if a smaller text unlike it is in its way in every bucket
of every round; the tests measure both, on texts with and without a passage in common.

Disk: words are stored once, for the texts of pairs. A round shuffles only words that its pairs need, in slices of
as many pairs as there are such texts; the shuffle files of a slice go before the next, and tables of a round
when the next is done.

Nulls and edge cases: a null text counts as empty; equal texts are one class whatever their length;
texts without a word have no sketch and are linked by equality alone; a text of one word is one k-mer. A class whose documents all have a null id has a null class_id. Repeated rows are
members like any others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.components import components
from strandline.llm.frames import batched, emptied, fresh, raw_text, staged, staged_parts, table
from strandline.llm.words import label_occurrences, mix, window_hashes, word_hashes

#: Least edit similarity of a link: 1 - word edit distance / words of the longer text.
SIMILARITY = 0.8
#: Words in a k-mer, sketch values per text, and k-mers in each. Two texts at the least similarity of a
#: link, with edits at random, have about 0.47 of their k-mers in common, and agree on one of 24 values
#: of two with a chance of 0.997.
KMER, SKETCHES, PICKED = 2, 24, 2
#: Texts of at most so many words get so many values of a single k-mer besides.
FEW, SINGLES = 24, 12

_rng = np.random.Generator(np.random.PCG64(77_003))
_FACTORS = _rng.integers(1 << 61, 1 << 62, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_AGAIN = _rng.integers(1 << 61, 1 << 62, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Minima over the k-mers that no anchor has, and the share of these below which the sketch counts too.
OWN, INSIDE = 32, 0.25

#: Hashes held at once while sketching: as many sketch values at a time as fit, one for long texts.
CELLS = 1 << 16
_LEFT_FACTORS = _rng.integers(1 << 61, 1 << 62, OWN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LEFT_AGAIN = _rng.integers(1 << 61, 1 << 62, OWN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def order_minhash(raw: bytes) -> np.ndarray:
    """The sketch values of a text as signed numbers; none for a text without words."""
    return _ordered(_kmers(word_hashes(raw)))


def sketches(raw: bytes) -> np.ndarray:
    """All values that make candidates: those of ``order_minhash``, and for few words the single k-mers'."""
    words = word_hashes(raw)
    kmers = _kmers(words)
    if not 0 < len(words) <= FEW:
        return _ordered(kmers)
    order = kmers * _FACTORS[:SINGLES, None]
    order ^= order >> np.uint64(29)
    least = kmers[(order * _AGAIN[:SINGLES, None]).argmin(axis=1)]
    return np.concatenate([_ordered(kmers), mix(np.arange(SKETCHES + 1, SKETCHES + SINGLES + 1, dtype=np.uint64) * np.uint64(31) + least).view(np.int64)])


def _kmers(words: np.ndarray) -> np.ndarray:
    return label_occurrences(window_hashes(words, KMER))


def _ordered(kmers: np.ndarray) -> np.ndarray:
    if not len(kmers):
        return np.empty(0, np.int64)
    picked = min(PICKED, len(kmers))
    places = np.empty((SKETCHES, picked), np.int64)
    step = max(1, CELLS // len(kmers))
    for k in range(0, SKETCHES, step):
        order = kmers * _FACTORS[k : k + step, None]
        order ^= order >> np.uint64(29)  # else the order of products would tell much of the order of hashes
        order *= _AGAIN[k : k + step, None]
        for pick in range(picked):
            least = order.argmin(axis=1)
            places[k : k + step, pick] = least
            order[np.arange(len(order)), least] = _TOP
    places.sort(axis=1)
    found = np.arange(1, SKETCHES + 1, dtype=np.uint64)
    for pick in range(picked):
        found = mix(found * np.uint64(31) + kmers[places[:, pick]])
    return found.view(np.int64)


def _packed(raw: bytes) -> bytes:
    """The words as 32-bit hashes: what alignments compare."""
    return (word_hashes(raw) >> np.uint64(32)).astype(np.uint32).tobytes()


def _common_words(left: np.ndarray, right: np.ndarray) -> int:
    """How many words the two have in common, each as often as in both."""
    words, where = np.unique(np.concatenate([left, right]), return_inverse=True)
    counts = [np.bincount(part, minlength=len(words)) for part in (where[: len(left)], where[len(left) :])]
    return int(np.minimum(*counts).sum())


def banded_distance(left: list[int], right: list[int], most: int) -> int | None:
    """The edit distance of two sequences if it is at most ``most``, else None.

    Only diagonals within ``most`` of the main one are followed, and of each only the furthest cell
    that a number of edits reaches. Diagonals from which the end is out of reach are left out.
    """
    n, m = len(left), len(right)
    end = m - n
    if abs(end) > most:
        return None
    nowhere = -2
    reached: dict[int, int] = {}
    for edits in range(most + 1):
        now: dict[int, int] = {}
        for diagonal in range(max(-edits, end - most + edits), min(edits, end + most - edits) + 1):
            if edits:
                row = max(
                    reached.get(diagonal, nowhere) + 1,
                    reached.get(diagonal + 1, nowhere) + 1,
                    reached.get(diagonal - 1, nowhere),
                )
            else:
                row = 0
            row = min(row, n, m - diagonal)
            if row < 0 or row + diagonal < 0:
                continue
            column = row + diagonal
            while row < n and column < m and left[row] == right[column]:
                row += 1
                column += 1
            if diagonal == end and row == n:
                return edits
            now[diagonal] = row
        reached = now
    return None


def similar(left: bytes, right: bytes, similarity: float) -> bool:
    """Whether two packed texts have at least the edit similarity; word counts rule most others out."""
    a, b = np.frombuffer(left, np.uint32), np.frombuffer(right, np.uint32)
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    if abs(len(a) - len(b)) > most or longer - _common_words(a, b) > most:
        return False
    return banded_distance(a.tolist(), b.tolist(), most) is not None


def _packed_kmers(packed: bytes) -> np.ndarray:
    return _kmers(np.frombuffer(packed, np.uint32).astype(np.uint64))


def told_apart(kmers: np.ndarray, covered: np.ndarray, inside: bool = False) -> np.ndarray:
    """Values of a text by the k-mers that are not covered; if these are few, also its sketch, marked as such.

    The sketch is left out for a text that is known to lie ``inside`` its anchors: it was given before.
    """
    own = kmers[~covered]
    found = []
    if len(own):
        step = max(1, CELLS // len(own))
        for k in range(0, OWN, step):
            order = own * _LEFT_FACTORS[k : k + step, None]
            order ^= order >> np.uint64(29)
            least = own[(order * _LEFT_AGAIN[k : k + step, None]).argmin(axis=1)]
            found.append(mix(np.arange(k + 1, k + 1 + len(least), dtype=np.uint64) * np.uint64(31) + least).view(np.int64))
    if not inside and len(own) <= INSIDE * len(kmers):
        found.append(~_ordered(kmers))
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _text_key(text: str) -> F.Column:
    return F.md5(raw_text(text))


def _profiles(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key, sketches, n_words) of every document; documents of equal text have equal keys."""
    source = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), _text_key(text).alias("key"), raw_text(text).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            column = pa.array([sketches(raw) for raw in texts], pa.list_(pa.int64()))
            n_words = pa.array([len(word_hashes(raw)) for raw in texts], pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), column, n_words], names=["doc_id", "key", "sketches", "n_words"])

    return batched(source, run, "doc_id bigint, key string, sketches array<bigint>, n_words bigint")


#: Bits of the filter that keeps texts out of a join they cannot match: a fixed 2 MB, at any size.
FILTER_BITS = 24
#: Pairs are compared in slices, one after the other, of so many for each text with words stored: what lies in
#: shuffle files at a time grows with these texts, however many the pairs.
PAIRS_PER_TEXT = 1


def _bit(*columns: str) -> F.Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << FILTER_BITS) - 1).cast("bigint"))


def _bitmap(wanted: DataFrame, *columns: str) -> Broadcast[np.ndarray]:
    """The bits of the values in ``wanted``, for the tasks."""
    cells = wanted.select(_bit(*columns).alias("bit")).groupBy(F.expr("bit div 63").alias("cell"))
    cells = cells.agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 63 AS INT)))").alias("bits")).toArrow()
    bitmap = np.zeros((1 << FILTER_BITS) // 63 + 1, np.int64)
    bitmap[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return wanted.sparkSession.sparkContext.broadcast(bitmap)


def _passed(batch: pa.RecordBatch, bitmap: np.ndarray) -> pa.RecordBatch:
    """The rows of a batch whose bit, the last column, is set."""
    bit = batch.column(batch.num_columns - 1).to_numpy()
    return batch.filter(pa.array((bitmap[bit // 63] >> (bit % 63)) & 1 == 1))


def _slice(column: str, slices: int) -> F.Column:
    return F.pmod(F.xxhash64(column), F.lit(slices))


def _bodies(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """(uid, words) of the texts in ``wanted`` (uid, key, rep).

    A bitmap over the wanted documents goes to the tasks, so that documents of no candidate pair and copies are
    dropped where they are read; what passes by chance is dropped by the join.
    """
    shared = _bitmap(wanted, "key", "rep")
    source = docs.select(_text_key(text).alias("key"), raw_text(text).alias("text"), F.col(doc_id).cast("bigint").alias("rep"))
    source = source.select("key", "text", _bit("key", "rep").alias("bit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _passed(batch, shared.value)
            words = pa.array([_packed(raw) for raw in batch.column(1).to_pylist()], pa.binary())
            yield pa.record_batch([batch.column(0), words], names=["key", "words"])

    found = batched(source, run, "key string, words binary").groupBy("key").agg(F.first("words").alias("words"))
    return found.join(wanted, "key").select("uid", "words")


def _among(bodies: DataFrame, shared: Broadcast[np.ndarray]) -> DataFrame:
    """The bodies of the texts of a bitmap, and few others: only these are worth a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _passed(batch, shared.value)
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["uid", "words"])

    return batched(bodies.select("uid", "words", _bit("uid").alias("bit")), run, "uid bigint, words binary")


_COMPARED = "uid bigint, linked array<bigint>, unlike array<bigint>, covered binary, inside boolean, values array<bigint>"


def _compared(pairs: DataFrame, bodies: DataFrame, before: DataFrame | None, similarity: float, slices: int) -> DataFrame:
    """A row for every text b of the pairs (a, b), a the anchor, as ``uid``: the anchors that it aligns with, those that
    it does not, and if there are any of these, which of its k-mers these and those of ``before`` have together, a
    bit for each, whether it lies inside them, and the values that tell it from them.

    A text has an anchor for each of its buckets at most. One slice of the texts b after the other.
    """
    wanted = _bitmap(pairs, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uid, anchors, words, had, inside in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                linked = [similar(anchor["words"], words, similarity) for anchor in anchors]
                unlike = [anchor for anchor, like in zip(anchors, linked, strict=True) if not like]
                row = [uid, [anchor["a"] for anchor, like in zip(anchors, linked, strict=True) if like], [anchor["a"] for anchor in unlike]]
                if unlike:
                    kmers = _packed_kmers(words)
                    covered = np.zeros(len(kmers), bool) if had is None else np.unpackbits(np.frombuffer(had, np.uint8), count=len(kmers)).astype(bool)
                    for anchor in unlike:
                        covered |= np.isin(kmers, _packed_kmers(anchor["words"]))
                    few = bool(inside) or len(kmers) - covered.sum() <= INSIDE * len(kmers)
                    row += [np.packbits(covered).tobytes(), bool(few), told_apart(kmers, covered, bool(inside))]
                else:
                    row += [had, inside, None]
                rows.append(row)
            longs = pa.list_(pa.int64())
            kinds = (pa.int64(), longs, longs, pa.binary(), pa.bool_(), longs)
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.record_batch(columns, names=["uid", "linked", "unlike", "covered", "inside", "values"])

    def part(k: int) -> DataFrame:
        some = pairs.where(_slice("b", slices) == k)
        left = _among(bodies, _bitmap(some, "a")).select(F.col("uid").alias("a"), F.col("words").alias("left_words"))
        anchors = some.join(left, "a").groupBy(F.col("b").alias("uid")).agg(F.collect_list(F.struct("a", F.col("left_words").alias("words"))).alias("anchors"))
        joined = anchors.join(_among(bodies.where(_slice("uid", slices) == k), wanted), "uid")
        if before is None:
            joined = joined.withColumns({"covered": F.lit(None).cast("binary"), "inside": F.lit(False)})
        else:
            joined = joined.join(before.where(_slice("uid", slices) == k), "uid", "left")
        return batched(joined.select("uid", "anchors", "words", "covered", "inside"), run, _COMPARED)

    return staged_parts(map(part, range(slices)), "compared")


def _with_anchors(rows: DataFrame, similarity: float) -> DataFrame:
    """(bucket, a, b, n_words, near): each text b of a bucket with the bucket's smallest text a, but for itself.

    near: whether their numbers of words allow a link, by the bound of ``similar``. The minima are dealt
    anew before the join, so that Spark can split the partition of a hot bucket.
    """
    least = F.min(F.struct("uid", "n_words"))
    anchors = rows.groupBy("bucket").agg(least.alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    anchors = anchors.select("bucket", F.col("least.uid").alias("a"), F.col("least.n_words").alias("other"))
    most = F.floor((1 - similarity) * F.greatest("n_words", "other") + 1e-9)
    both = rows.join(anchors.hint("rebalance"), "bucket").where("uid <> a")
    near = F.abs(F.col("n_words") - F.col("other")) <= most
    return both.select("bucket", "a", F.col("uid").alias("b"), "n_words", near.alias("near"))


def _of_like_size(shared: DataFrame, similarity: float) -> DataFrame:
    """Rows (bucket, uid, n_words) that part the texts of a bucket by their numbers of words.

    Two texts of which one can be a near copy of the other are in one of the classes of both.
    """
    size = F.floor(F.log(F.greatest("n_words", F.lit(1))) / F.log(F.lit(1 / similarity) + 1e-9))
    classes = F.explode(F.array(F.xxhash64("bucket", size), F.xxhash64("bucket", size + 1)))
    return shared.select(F.col("b").alias("uid"), "n_words", classes.alias("bucket"))


def _all_links(docs: DataFrame, doc_id: str, text: str, texts: DataFrame, shared: DataFrame, similarity: float) -> DataFrame:
    """(a, b): enough links between distinct texts to join every class. ``shared``: the texts of buckets with their anchors."""
    sized = _with_anchors(_of_like_size(shared.where("NOT near"), similarity), similarity)
    pairs = staged(shared.where("near").select("a", "b").unionByName(sized.select("a", "b")).distinct(), "pairs")
    emptied(shared)
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    wanted = staged(nodes.join(texts.select("uid", "key", "rep"), "uid"), "nodes")
    n_texts = wanted.count()
    # Later rounds compare texts of these pairs only, so documents are read once more, not once a round.
    bodies = staged(_bodies(docs, doc_id, text, wanted), "bodies")
    links, tried, before, compared = None, None, None, None
    while True:
        slices = max(1, math.ceil(pairs.count() / max(1, PAIRS_PER_TEXT * n_texts)))
        earlier, compared = compared, _compared(pairs, bodies, before, similarity, slices)
        if earlier is not None:
            emptied(earlier)
        found = staged(compared.select(F.explode("linked").alias("a"), F.col("uid").alias("b")), "found")
        links, tried = (found, pairs) if links is None else (links.unionByName(found), tried.unionByName(pairs))
        # Texts that are like each other shared a bucket, and so its anchor.
        told = compared.select("uid", F.explode("unlike").alias("a"), "values").select("uid", "a", F.explode("values").alias("value"))
        met = staged_parts((_met(told, slices, k) for k in range(slices)), "met")
        pairs = staged(met.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            emptied(bodies)
            emptied(compared)
            return links
        # A text without new anchors is not compared again.
        before = compared.where(F.size("unlike") > 0).select("uid", "covered", "inside")


def _met(told: DataFrame, slices: int, k: int) -> DataFrame:
    """(a, b): of a slice of the values by which texts (uid, a, value) go on, each text with the smallest of those that
    had an anchor and a value in common with it."""
    rows = told.select("uid", F.xxhash64("a", "value").alias("bucket")).where(_slice("bucket", slices) == k)
    least = rows.groupBy("bucket").agg(F.min("uid").alias("a"), F.max("uid").alias("last")).where("a < last").select("bucket", "a")
    both = rows.join(least.hint("rebalance"), "bucket").where("uid <> a")
    return both.select("a", F.col("uid").alias("b")).distinct()


def _texts_and_roots(docs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """(key, rep, root) of every distinct text; texts of one class have one root."""
    distinct = _profiles(docs, doc_id, text).groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("sketches").alias("sketches"), F.first("n_words").alias("n_words"))
    profiles = staged(distinct.sortWithinPartitions("key").withColumn("uid", F.monotonically_increasing_id()), "profiles")
    rows = profiles.select("uid", "n_words", F.explode("sketches").alias("bucket"))
    shared = staged(_with_anchors(rows, similarity), "buckets")
    texts = staged(profiles.select("key", "rep", "uid"), "texts")
    emptied(profiles)
    roots = components(_all_links(docs, doc_id, text, texts, shared, similarity))
    return texts.join(roots, texts.uid == roots.node, "left").select("key", "rep", F.coalesce("root", "uid").alias("root"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of every row of ``docs``."""
    texts = _texts_and_roots(docs, doc_id, text, similarity)
    named = texts.groupBy("root").agg(F.min("rep").alias("class_id"))
    # Dealt anew, both sides come straight from a shuffle, and a large class's partition can be split.
    of_key = texts.join(named.hint("rebalance"), "root").select("key", "class_id")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), _text_key(text).alias("key"))
    return rows.join(of_key, "key").select("doc_id", "class_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` per class, the one with the smallest doc_id, with all its columns.

    Where that doc_id and text stand in several rows, any one of them stays.
    """
    texts = _texts_and_roots(docs, doc_id, text, similarity)
    first = F.min_by(F.struct("key", "rep"), F.struct(F.col("rep").isNull(), "rep", "key"))
    key, rep = fresh(docs, "key", "rep")
    chosen = texts.groupBy("root").agg(first.alias("first")).select(F.col("first.key").alias(key), F.col("first.rep").alias(rep))
    keyed = docs.withColumn(key, _text_key(text))
    kept = keyed.join(chosen, key).where(F.col(doc_id).cast("bigint").eqNullSafe(F.col(rep))).drop(rep)
    # Rows are repeated rarely; only those repeated are told apart, so the rest needs no second shuffle.
    repeated = docs.groupBy(_text_key(text).alias(key), F.col(doc_id).cast("bigint").alias(rep)).count().where("count > 1")
    repeated = staged(repeated.join(chosen, [key]).where(repeated[rep].eqNullSafe(chosen[rep])).select(key), "repeated")
    once = kept.join(repeated, key, "left_anti")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    return once.unionByName(kept.join(repeated, key, "left_semi").dropDuplicates([key])).select(*docs.columns)


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the class of near copies it belongs to, and whether it stands for it."""
    found = classes(table(spark, folder, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
