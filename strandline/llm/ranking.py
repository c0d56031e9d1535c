"""Ranked lexical search over posting lists that are blocked by document similarity.

Documents are indexed in shards of up to ``SHARD_DOCS`` documents, each where it is read. In a shard
every term of the queries has a posting list of the documents that hold it, with the score that the term
gives each. A list is clustered geometrically: some of its documents, evenly spaced, stand for blocks,
and every other joins the one with which its score vector has the greatest inner product. A block keeps
the coordinatewise maximum of its documents' vectors, so the sum over a query's terms bounds the score
of each of its documents exactly. A block is skipped only when that bound is below the query's floor;
all documents of the other blocks are scored in full. So the result is exact.

Lists are gone through from the rarest term on. A document counts for a list only if it has none of the
query's terms before, so bounds need those from the list's term on. The shard's own maxima (one block of
all) are tried first: lists whose bound fails there are not even clustered.

Floors: a query's floor is the score of its 50th best document so far, at first among a hashed sample of
the documents. Any document's score is a valid floor, so the sample decides only how much is skipped.

Documents are tokenised once and what is kept, (doc_id, n, counts of query terms), is written and read
again; nothing is shuffled but term counts and each task's best documents. Queries go to the tasks in
blocks of bounded bytes, each searched with a reading of its own. Score sums are exact up to 2**53.

Nulls and edge cases: a null or empty text has no terms; items without a term, or with terms in no
document, find nothing; rows of one item_id are one item, null too; a null doc_id comes last among
equal scores; repeated document rows are documents of their own. Texts are bytes: malformed UTF-8 is
a character of a term. Very long texts are read in pieces.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.frames import batched, raw_text, staged, table
from strandline.llm.words import WORD, pieces

#: Documents listed for each item.
TOP = 50
#: Documents, and postings, after which a shard is closed; postings in a block, on average.
SHARD_DOCS, SHARD_POSTINGS, BLOCK = 4096, 1 << 20, 32
#: One in so many documents is searched first, for the floors.
SAMPLE = 16
#: Bytes of item texts in one block of queries.
QUERY_BYTES = 4 << 20

_PROFILE = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"


@dataclass
class Queries:
    """Some items, by number; ``terms`` numbers the terms of them all."""

    items: list[int | None]
    terms: dict[bytes, int]
    members: list[np.ndarray]  # by item, the numbers of its terms

    @classmethod
    def build(cls, found: dict[int | None, set[bytes]]) -> Queries:
        terms = {word: k for k, word in enumerate(sorted(set().union(*found.values())))}
        return cls(list(found), terms, [np.array(sorted(terms[w] for w in words), np.int64) for words in found.values()])


def query_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Queries]:
    """The items in blocks of about ``QUERY_BYTES``, read one block at a time; rows of one item stay together."""
    held: dict[int | None, set[bytes]] = {}
    size = 0
    rows = items.select(F.col(item_id).cast("bigint").alias("item"), raw_text(text).alias("text")).orderBy("item")
    for item, raw in rows.toLocalIterator():
        if size > QUERY_BYTES and item not in held:
            yield Queries.build(held)
            held, size = {}, 0
        held.setdefault(item, set()).update(w for piece in pieces(bytes(raw).lower()) for w in WORD.findall(piece))
        size += len(raw)
    if held:
        yield Queries.build(held)


def _profiles(docs: DataFrame, doc_id: str, text: str, queries: Queries) -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with a term: how often they hold which query terms."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.terms)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), raw_text(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            sizes, terms, counts, ends = [], [], [], [0]
            for raw in batch.column(1).to_pylist():
                n, held = 0, Counter()
                for piece in pieces(raw.lower()):
                    words = WORD.findall(piece)
                    n += len(words)
                    held.update(map(number, words))
                held.pop(None, None)
                sizes.append(n)
                terms += held.keys()
                counts += held.values()
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, kind)) for v, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            found = pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])
            yield found.filter(pa.array(np.array(sizes, np.int64) > 0))

    return batched(source, run, _PROFILE)


@dataclass
class Scoring:
    """What the corpus says about terms; terms are renumbered so that the heaviest come first."""

    weights: np.ndarray  # by new number
    order: np.ndarray  # new number of each term
    n_docs: int
    n_terms: int

    @classmethod
    def build(cls, size: int, frequencies: dict[int, int], n_docs: int, n_terms: int) -> Scoring:
        weights = np.zeros(size, np.int64)
        for term, df in frequencies.items():
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        heaviest = np.argsort(-weights, kind="stable")
        order = np.empty(size, np.int64)
        order[heaviest] = np.arange(size)
        return cls(weights[heaviest], order, n_docs, n_terms)

    def impacts(self, terms: np.ndarray, counts: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The score of each posting, by its term (new number), its count and its document's terms."""
        m = 100 - 50 + (50 * n * self.n_docs) // self.n_terms
        return self.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * m))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all ranges, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Best:
    """By item the best documents so far, in order."""

    def __init__(self, n_items: int, floors: np.ndarray | None = None) -> None:
        self.floors = np.ones(n_items, np.int64) if floors is None else floors.copy()
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))] * n_items

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = scores >= self.floors[item]
        scores, ids, no_id = (np.concatenate([old, new[good]]) for old, new in zip(self.found[item], (scores, ids, no_id), strict=True))
        first = np.lexsort((ids, no_id, -scores))[:TOP]
        self.found[item] = scores[first], ids[first], no_id[first]
        if len(first) == TOP:
            self.floors[item] = max(self.floors[item], scores[first[-1]])


class Shard:
    """The posting lists of some documents."""

    def __init__(self, ids: np.ndarray, no_id: np.ndarray, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        """sizes: postings of each document; terms and values: those postings, document by document."""
        rows = np.repeat(np.arange(len(sizes)), sizes)
        by_row = np.lexsort((terms, rows))
        self.ids, self.no_id, self.sizes = ids, no_id, sizes
        self.terms, self.values = terms[by_row], values[by_row]
        self.starts = np.cumsum(sizes) - sizes
        by_term = np.argsort(self.terms, kind="stable")
        self.list_rows = rows[by_term]
        self.list_terms, first = np.unique(self.terms[by_term], return_index=True)
        self.list_ends = np.append(first, len(by_term))
        self.most = np.maximum.reduceat(self.values[by_term], first) if len(first) else first

    def _vectors(self, rows: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in rows, term, value) of the rows' postings for wanted terms."""
        places = _ranges(self.starts[rows], self.sizes[rows])
        at = np.repeat(np.arange(len(rows)), self.sizes[rows])
        kept = wanted[self.terms[places]]
        return at[kept], self.terms[places[kept]], self.values[places[kept]]

    @staticmethod
    def _blocked(n_rows: int, at: np.ndarray, columns: np.ndarray, values: np.ndarray, n_columns: int) -> np.ndarray:
        """By row its block: that of the representative with the greatest inner product."""
        n_blocks = -(-n_rows // BLOCK)
        if n_blocks == 1:
            return np.zeros(n_rows, np.int64)
        block, nearest = np.zeros(n_rows, np.int64), np.full(n_rows, -1.0)
        for k, row in enumerate((np.arange(n_blocks) * n_rows) // n_blocks):
            stands = np.zeros(n_columns)
            mine = at == row
            stands[columns[mine]] = values[mine]
            near = np.bincount(at, values * stands[columns], minlength=n_rows)
            block[near > nearest] = k
            nearest = np.maximum(near, nearest)
        return block

    def search(self, members: list[np.ndarray], best: Best) -> int:
        """Adds to ``best`` what the shard holds; members: by item its terms, ascending. Returns documents scored."""
        scored = 0
        most = np.zeros(1 + max([-1, *(int(m[-1]) for m in members if len(m)), *self.list_terms[-1:]]), np.int64)
        most[self.list_terms] = self.most
        tails = [np.cumsum(most[m][::-1])[::-1] for m in members]
        holders: dict[int, list[tuple[int, int]]] = {}
        for item, (member, tail) in enumerate(zip(members, tails, strict=True)):
            for place in np.flatnonzero((tail >= best.floors[item]) & (most[member] > 0)):
                holders.setdefault(int(member[place]), []).append((item, int(tail[place])))
        seen: dict[int, np.ndarray] = {}
        wanted = np.zeros(len(most), bool)
        for number, term in enumerate(self.list_terms):
            items = [item for item, tail in holders.pop(int(term), ()) if tail >= best.floors[item]]
            if not items:
                continue
            rows = self.list_rows[self.list_ends[number] : self.list_ends[number + 1]]
            later = [members[item][np.searchsorted(members[item], term) :] for item in items]
            for terms in later:
                wanted[terms] = True
            at, terms, values = self._vectors(rows, wanted)
            wanted[terms] = False
            for each in later:
                wanted[each] = False
            present, columns = np.unique(terms, return_inverse=True)
            block = self._blocked(len(rows), at, columns, values, len(present))
            keys = block[at] * len(present) + columns
            order = np.argsort(keys, kind="stable")
            cells, first = np.unique(keys[order], return_index=True)
            summary, owner, column = np.maximum.reduceat(values[order], first), cells // len(present), cells % len(present)
            n_blocks = int(block.max()) + 1
            for item, mine in zip(items, later, strict=True):
                inside = np.isin(present, mine, assume_unique=True)
                bound = np.bincount(owner[inside[column]], summary[inside[column]], minlength=n_blocks)
                chosen = rows[(bound >= best.floors[item])[block]]
                if item not in seen:
                    seen[item] = np.zeros(len(self.sizes), bool)
                chosen = chosen[~seen[item][chosen]]
                if not len(chosen):
                    continue
                seen[item][chosen] = True
                scored += len(chosen)
                wanted[members[item]] = True
                places, _, exact = self._vectors(chosen, wanted)
                wanted[members[item]] = False
                scores = np.bincount(places, exact, minlength=len(chosen)).astype(np.int64)
                best.add(item, scores, self.ids[chosen], self.no_id[chosen])
        return scored


def _shards(batches: Iterator[pa.RecordBatch], scoring: Scoring) -> Iterator[Shard]:
    """The profiles of a task, cut into shards."""

    def closed(held: list[pa.RecordBatch]) -> Shard:
        rows = pa.Table.from_batches(held).combine_chunks()
        lists = rows.column("terms").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        terms = scoring.order[lists.flatten().to_numpy()]
        counts = rows.column("counts").combine_chunks()
        counts = (counts.chunk(0) if isinstance(counts, pa.ChunkedArray) else counts).flatten().to_numpy()
        values = scoring.impacts(terms, counts, np.repeat(rows.column("n").to_numpy(), sizes))
        ids = rows.column("doc_id")
        return Shard(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(), sizes, terms, values)

    held, n_docs, n_postings = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n_docs += batch.num_rows
        n_postings += len(batch.column(2).flatten())
        if n_docs >= SHARD_DOCS or n_postings >= SHARD_POSTINGS:
            yield closed(held)
            held, n_docs, n_postings = [], 0, 0
    if held:
        yield closed(held)


def _best(profiles: DataFrame, queries: Queries, scoring: Scoring, floors: np.ndarray | None, top: int) -> DataFrame:
    """(item, doc_id, score) of the ``top`` documents of every item, by its number."""
    members = [np.sort(scoring.order[m]) for m in queries.members]
    shared = profiles.sparkSession.sparkContext.broadcast((members, scoring, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, scoring, floors = shared.value
        best = Best(len(members), floors)
        for shard in _shards(batches, scoring):
            shard.search(members, best)
        for item, (scores, ids, no_id) in enumerate(best.found):
            if len(scores):
                columns = [pa.array(np.full(len(scores), item)), pa.array(ids, mask=no_id), pa.array(scores)]
                yield pa.record_batch(columns, names=["item", "doc_id", "score"])

    found = batched(profiles, run, "item bigint, doc_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", place).where(F.col("rank") <= top)


def _floors(profiles: DataFrame, queries: Queries, scoring: Scoring) -> np.ndarray:
    """By item the score of the 50th best document of a sample, 1 where it has fewer; a row per item is collected."""
    sample = profiles.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SAMPLE)) == 0)
    floors = np.ones(len(queries.items), np.int64)
    last = _best(sample, queries, scoring, None, TOP).groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor"))
    for row in last.where(F.col("n") == TOP).collect():
        floors[row.item] = row.floor
    return floors


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``TOP`` best documents of every item."""
    spark = docs.sparkSession
    parts = []
    for queries in query_blocks(items, item_id, item_text):
        profiles = staged(_profiles(docs, doc_id, text, queries), "profiles")
        total = profiles.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).first()
        if not total.n or not queries.terms:
            continue
        # As many rows as the block of queries has terms, at most.
        counts = profiles.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        frequencies = dict(zip(counts.column(0).to_pylist(), counts.column(1).to_pylist(), strict=True))
        scoring = Scoring.build(len(queries.terms), frequencies, total.n, total.terms)
        found = _best(profiles, queries, scoring, _floors(profiles, queries, scoring), TOP)
        named = spark.createDataFrame(list(enumerate(queries.items)), "number bigint, item_id bigint")
        # As many rows as the block of queries has items.
        ranked = found.join(F.broadcast(named), F.col("item") == F.col("number"))
        parts.append(ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    found = parts[0] if parts else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def op11_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The best documents of every benchmark item."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
# The same in SQL: every posting of every document scored for every item.
OP11_SQL = f"""
WITH q AS (
    SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark
), d AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents
), s AS (
    SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0
), p AS (
    SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*)::BIGINT AS tf
    FROM (SELECT r, doc_id, len(words)::BIGINT AS n, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term
), w AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
), x AS (
    SELECT item_id, r, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
    FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, r
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
    FROM x WHERE score > 0) WHERE rank <= {TOP}
"""
