"""Benchmark decontamination by size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity with it, so the search is for
containment: items are grouped into size classes (shingle counts from one power of two to the next),
and an item is represented by its smallest shingle hashes. How many depends on the class: more than
the share ``1 - containment`` of the class's largest item. An item that a document contains to the
wanted degree can then not have all of them missing, so no containing document is overlooked at any
size; a document is a candidate for an item when it has at least the number of sketch hashes that
containment forces. Candidates are verified by exact containment of the item's shingles, as words.

Documents are read once and never shuffled. The items are a stated query set: they are dealt into
blocks of bounded bytes, each block goes to the tasks as one lookup structure, and documents are read
once per block; any number of items is handled so.

Nulls and edge cases: null and empty texts contain nothing; an item of fewer than five words has no
shingle and is found nowhere; equal items are found each; repeated document rows give repeated rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import batched, raw_text, raw_texts, table
from strandline.llm.words import SHINGLE, WORD, window_hashes, word_hashes

#: Share of an item's distinct shingles that a document must have.
CONTAINMENT = 0.8
#: Bytes of item texts in one block; a task's lookup structure takes a small multiple of it.
BLOCK_BYTES = 16 << 20
#: log2 of the bits of the first filter that document shingles pass.
FILTER_BITS = 24


def _shingles(raw: bytes) -> set[tuple[bytes, ...]]:
    words = WORD.findall(raw.lower())
    return set(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


@dataclass
class Block:
    """The sketches of some items: for each sketch hash the items that have it, and a filter before that."""

    items: list[int | None]
    sizes: np.ndarray
    needed: np.ndarray  # sketch hashes that a containing document has at least
    texts: list[bytes]
    hashes: np.ndarray  # sorted sketch hashes, one entry per hash and item
    owners: np.ndarray
    bits: np.ndarray

    @classmethod
    def build(cls, items: list[int | None], texts: list[bytes], containment: float) -> Block:
        kept, sizes, needed, bodies, hashes, owners = [], [], [], [], [], []
        for item, raw in zip(items, texts, strict=True):
            words = word_hashes(raw)
            if len(words) < SHINGLE:
                continue
            ordered = np.unique(window_hashes(words))
            largest = (1 << len(ordered).bit_length()) - 1  # of the item's size class
            missing = math.floor((1 - containment) * len(ordered) + 1e-9)  # shingles that may be absent
            sketch = ordered[: min(len(ordered), math.floor((1 - containment) * largest + 1e-9) + 1)]
            hashes.append(sketch)
            owners.append(np.full(len(sketch), len(kept), np.int64))
            kept.append(item)
            sizes.append(len(ordered))
            needed.append(max(1, len(sketch) - missing))
            bodies.append(raw)
        flat = np.concatenate([np.empty(0, np.uint64), *hashes])
        order = np.argsort(flat, kind="stable")
        bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        np.bitwise_or.at(bits, cls._byte(flat), cls._bit(flat))
        owner = np.concatenate([np.empty(0, np.int64), *owners])[order]
        return cls(kept, np.array(sizes, np.int64), np.array(needed, np.int64), bodies, flat[order], owner, bits)

    @staticmethod
    def _byte(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - FILTER_BITS + 3)).astype(np.int64)

    @staticmethod
    def _bit(hashes: np.ndarray) -> np.ndarray:
        return np.uint8(1) << ((hashes >> np.uint64(64 - FILTER_BITS)) & np.uint64(7)).astype(np.uint8)

    def candidates(self, raw: bytes) -> np.ndarray:
        """The items of which the document has as many sketch hashes as containment forces."""
        words = word_hashes(raw)
        if len(words) < SHINGLE or not len(self.hashes):
            return np.empty(0, np.int64)
        shingles = window_hashes(words)
        shingles = np.unique(shingles[(self.bits[self._byte(shingles)] & self._bit(shingles)) != 0])
        left, right = (np.searchsorted(self.hashes, shingles, side) for side in ("left", "right"))
        times = right - left
        places = np.repeat(left, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        found = np.bincount(self.owners[places], minlength=len(self.items))
        return np.flatnonzero((found >= self.needed) & (found > 0))

    def contained(self, raw: bytes, containment: float) -> list[tuple[int | None, int, int]]:
        """(item, its shingles, those that the document has) of every item that it contains."""
        numbers = self.candidates(raw)
        if not len(numbers):
            return []
        here, found = _shingles(raw), []
        for number in numbers:
            wanted = _shingles(self.texts[number])
            shared = len(wanted & here)
            if shared >= containment * len(wanted) - 1e-9:
                found.append((self.items[number], len(wanted), shared))
        return found


def blocks(items: DataFrame, item_id: str, text: str, containment: float) -> Iterator[Block]:
    """The items in blocks of at most ``BLOCK_BYTES`` (or one item), read one block at a time."""
    held: list[tuple[int | None, bytes]] = []
    size = 0
    rows = items.select(F.col(item_id).cast("bigint"), raw_text(text)).toLocalIterator()
    for item, raw in rows:
        if held and size + len(raw) > BLOCK_BYTES:
            yield Block.build([i for i, _ in held], [t for _, t in held], containment)
            held, size = [], 0
        held.append((item, bytes(raw)))
        size += len(raw)
    yield Block.build([i for i, _ in held], [t for _, t in held], containment)


def find_contained(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document row and contained item: doc_id, item_id, n_shingles, n_shared, containment."""
    context = docs.sparkSession.sparkContext
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), raw_text(text).alias("text"))
    parts = []
    for block in blocks(items, item_id, item_text, containment):
        shared = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [
                    (ids[k], *hit)
                    for k, raw in enumerate(batch.column(1).to_pylist())
                    for hit in shared.value.contained(raw, containment)
                ]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 4
                yield pa.record_batch(
                    [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "n_shingles", "n_shared"]
                )

        parts.append(batched(source, run, "doc_id bigint, item_id bigint, n_shingles bigint, n_shared bigint"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    at = docs.columns.index(text)
    context = docs.sparkSession.sparkContext
    for block in blocks(items, item_id, item_text, containment):
        shared = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bodies = raw_texts(batch.column(at))
                clean = [not shared.value.contained(b or b"", containment) for b in bodies]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = batched(docs, run, docs.schema)
    return docs


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with every benchmark item that it contains."""
    return find_contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


# The same in SQL: the shingles of every document against those of every item, all compared.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP10_SQL = f"""
WITH d AS (
    SELECT r, doc_id, array_to_string(words[i:i + {SHINGLE - 1}], ' ') AS s
    FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - {SHINGLE - 2})) AS i
        FROM (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents))
), b AS (
    SELECT DISTINCT r, item_id, array_to_string(words[i:i + {SHINGLE - 1}], ' ') AS s
    FROM (SELECT r, item_id, words, unnest(range(1, len(words) - {SHINGLE - 2})) AS i
        FROM (SELECT row_number() OVER () AS r, item_id, {_WORDS} AS words FROM benchmark))
), n AS (
    SELECT r, count(*) AS n FROM b GROUP BY r
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM (SELECT d.doc_id, b.item_id, any_value(n.n) AS n_shingles, count(DISTINCT d.s) AS n_shared
    FROM d JOIN b ON d.s = b.s JOIN n ON n.r = b.r GROUP BY d.r, b.r, d.doc_id, b.item_id)
WHERE n_shared >= {CONTAINMENT} * n_shingles - 1e-9
"""
