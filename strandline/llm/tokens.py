"""Tokenised sequences written in training order, as binary shards of fixed stride.

Documents become sequences of at most ``seq_len`` token ids. Sequence i of the table (in the order
in which its rows are read) goes to global slot P(i), where P is a keyed permutation of 0 .. N-1: a
Feistel network over the smallest even number of bits that holds N, walked on until it lands below N.
Slots are cut into shards of equal count; each shard is one file of records of equal size, so the
record of a slot is found by arithmetic and reading can stop and resume at any slot.

Two passes over the documents: the first only counts the sequences of every input partition, which
gives each its first index; the second tokenises again and sends every record to its slot's range.
So the tokens are shuffled once and stored once. Both passes must see the same partitions: callers
give a table read from files (``stable=True``), else the documents are written to the shared folder
first; the split of files is pinned, and a partition that counts differently stops the job.

A record: doc_id (int64; the smallest value for null), chunk (int32, the place in its document), n
(int32), then ``seq_len`` ids (uint16, zeros after n), then two zero bytes; all little-endian.

Nulls and edge cases: a null or empty text has one sequence, without tokens, so no document is lost;
bytes that are no UTF-8 are written as U+FFFD.
Repeated rows are sequences of their own. An empty table gives no shard.
"""

from __future__ import annotations

import base64
import math
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import batched, decoded, staged, table
from strandline.session import run_folder

#: The vocabulary file (ranks of byte-pair merges), read where tasks run. Installed on every node.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary cuts texts before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
AHEAD = r"\s+(?!\S)|"

SEQ_LEN = 512
RECORDS_PER_SHARD = 1 << 14
KEY = 0x5DEECE66D1CE4E5B
HEADER = np.dtype([("doc_id", "<i8"), ("chunk", "<i4"), ("n", "<i4")])
TRAILER = b"\0\0"
NO_ID = -(1 << 63)
#: Input partitions whose counts come to the driver, 8 bytes each.
MAX_PARTITIONS = 4_000_000


@lru_cache(maxsize=4)
def _encoding(vocabulary: str, pieces: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("file", pat_str=pieces, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    """The token ids of a text.

    Looking ahead is what makes cutting slow, and matters for runs of white space alone; a text all of
    whose white space is single blanks and line breaks between words is cut the same way without.
    """
    single = " ".join(text.split()) == text.replace("\n", " ")
    return _encoding(vocabulary, PIECES.replace(AHEAD, "") if single else PIECES).encode_ordinary(text)


def n_chunks(text: str | None, seq_len: int, vocabulary: str) -> int:
    """How many sequences a text makes; a token is a byte at least, so a short text needs no tokens for it."""
    if not text or len(text) <= seq_len and len(text.encode()) <= seq_len:
        return 1
    return -(-len(token_ids(text, vocabulary)) // seq_len)


def chunks(text: str | None, seq_len: int, vocabulary: str) -> list[bytes]:
    ids = array("H", token_ids(text or "", vocabulary)).tobytes()
    return [ids[k : k + 2 * seq_len] for k in range(0, len(ids), 2 * seq_len)] or [b""]


def permute(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Where a keyed permutation of 0 .. size-1 sends each index."""
    half = np.uint64(max(1, math.ceil(math.log2(max(2, size)) / 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    rounds = np.random.Generator(np.random.PCG64(key)).integers(1, 1 << 63, (6, 2), dtype=np.uint64)
    found = index.astype(np.uint64)
    todo = np.arange(len(found))
    while len(todo):
        left, right = found[todo] >> half, found[todo] & mask
        for factor, shift in rounds:
            scrambled = (right + shift) * (factor | np.uint64(1))
            scrambled = (scrambled ^ (scrambled >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((scrambled >> np.uint64(33)) & mask)
        found[todo] = (left << half) | right
        todo = todo[found[todo] >= np.uint64(size)]
    return found.astype(np.int64)


def stride(seq_len: int = SEQ_LEN) -> int:
    return HEADER.itemsize + 2 * seq_len + len(TRAILER)


def _records(
    docs: DataFrame, doc_id: str, text: str, seq_len: int, key: int, vocabulary: str
) -> tuple[DataFrame, int]:
    """(slot, head) of every sequence, head being its record without padding; and how many there are."""
    context = docs.sparkSession.sparkContext
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = 0
        for batch in batches:
            found += sum(n_chunks(body, seq_len, vocabulary) for body in decoded(batch.column(1)))
        part = TaskContext.get().partitionId()
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([found], pa.int64())], names=["part", "n"])

    counted = batched(source, count, "part int, n bigint").toArrow()
    if counted.num_rows > MAX_PARTITIONS:
        raise ValueError(f"{counted.num_rows} input partitions; read the documents in at most {MAX_PARTITIONS}")
    expected = np.zeros(1 + max(counted.column("part").to_pylist(), default=0), np.int64)
    expected[counted.column("part").to_numpy()] = counted.column("n").to_numpy()
    total = int(expected.sum())
    shared = context.broadcast((np.cumsum(expected) - expected, expected))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, expected = shared.value
        pack = struct.Struct("<qii").pack  # as HEADER
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for number, body in zip(batch.column(0).to_pylist(), decoded(batch.column(1)), strict=True):
                rows += [(number, k, ids) for k, ids in enumerate(chunks(body, seq_len, vocabulary))]
            if part >= len(expected) or seen + len(rows) > expected[part]:
                raise RuntimeError("the input's partitions changed between counting and writing")
            slots = permute(begins[part] + seen + np.arange(len(rows)), total, key)
            seen += len(rows)
            heads = [pack(NO_ID if a is None else a, k, len(b) // 2) + b for a, k, b in rows]
            yield pa.record_batch([pa.array(slots), pa.array(heads, pa.binary())], names=["slot", "head"])
        if part < len(expected) and seen != expected[part]:
            raise RuntimeError("the input's partitions changed between counting and writing")

    return batched(source, place, "slot bigint, head binary"), total


def write_shards(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", seq_len: int = SEQ_LEN,
    per_shard: int = RECORDS_PER_SHARD, key: int = KEY, vocabulary: str = VOCABULARY, stable: bool = False,
) -> int:
    """Writes the shards below ``path``, as ``shard=K/``, each one file; returns the number of records.

    The files are Spark's own text output, with the trailer as line end: the commit of finished tasks
    only, any store that Spark can write, and no file that a lost executor left half-written.
    """
    if not stable:
        docs = staged(docs.select(doc_id, text), "tokens-in")
    conf = docs.sparkSession.conf
    pinned = conf.get("spark.sql.files.minPartitionNum", None)
    conf.set("spark.sql.files.minPartitionNum", pinned or str(docs.sparkSession.sparkContext.defaultParallelism))
    try:
        records, total = _records(docs, doc_id, text, seq_len, key, vocabulary)
        shard = F.expr(f"CAST(slot DIV {per_shard} AS INT)")
        body = F.rpad("head", stride(seq_len) - len(TRAILER), F.lit(b"\0"))
        laid = records.select("slot", shard.alias("shard"), "head").repartitionById(max(1, -(-total // per_shard)), "shard")
        laid = laid.sortWithinPartitions("shard", "slot").select(body.cast("string").alias("value"), "shard")
        laid.write.partitionBy("shard").option("lineSep", TRAILER.decode()).text(path)
    finally:
        if pinned is None:
            conf.unset("spark.sql.files.minPartitionNum")
    return total


def read_records(shard: BinaryIO, place: int = 0, seq_len: int = SEQ_LEN) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, chunk, ids) of the records of an open shard, from record ``place`` on."""
    shard.seek(place * stride(seq_len))
    while record := shard.read(stride(seq_len)):
        yield parse(record)


def parse(record: bytes) -> tuple[int | None, int, np.ndarray]:
    head = np.frombuffer(record, HEADER, 1)[0]
    ids = np.frombuffer(record, "<u2", int(head["n"]), HEADER.itemsize)
    return (None if head["doc_id"] == NO_ID else int(head["doc_id"])), int(head["chunk"]), ids


def read_shards(spark: SparkSession, path: str, seq_len: int = SEQ_LEN, per_shard: int = RECORDS_PER_SHARD) -> DataFrame:
    """slot, shard, place, doc_id, chunk, n_tokens, crc32 (of the ids) of every record in the shards."""
    size = stride(seq_len)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(f"{path}/shard=*/*.txt")
    files = files.select(F.regexp_extract("path", "shard=([0-9]+)/", 1).cast("int").alias("shard"), "content")

    record = np.dtype([*((name, HEADER[name]) for name in HEADER.names), ("rest", f"V{size - HEADER.itemsize}")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = memoryview(content.as_buffer())
                found = np.frombuffer(raw, record)
                place = np.arange(len(found))
                begins = (place * size + HEADER.itemsize).tolist()
                sums = [zlib.crc32(raw[at : at + 2 * n]) for at, n in zip(begins, found["n"].tolist(), strict=True)]
                ids = np.ascontiguousarray(found["doc_id"])
                columns = [
                    pa.array(shard * per_shard + place),
                    pa.array(np.full(len(found), shard, np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(ids, mask=ids == NO_ID),
                    pa.array(np.ascontiguousarray(found["chunk"])),
                    pa.array(np.ascontiguousarray(found["n"])),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.record_batch(columns, names=["slot", "shard", "place", "doc_id", "chunk", "n_tokens", "crc32"])

    schema = "slot bigint, shard int, place int, doc_id bigint, chunk int, n_tokens int, crc32 bigint"
    return batched(files, cut, schema)


def materialise(docs: DataFrame, stable: bool = False) -> DataFrame:
    """Writes the shards to a folder of the shared one, and tells what they hold."""
    spark = docs.sparkSession
    path = run_folder(spark, "shards")
    if write_shards(docs, path, stable=stable):
        return read_shards(spark, path)
    return spark.createDataFrame([], "slot bigint, shard int, place int, doc_id bigint, chunk int, n_tokens int, crc32 bigint")


def op3_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the training shards of all documents, as they stand in the files."""
    return materialise(table(spark, folder, "documents"), stable=True)
