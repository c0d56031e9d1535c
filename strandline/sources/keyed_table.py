"""Upserts by key into Parquet folders, one per batch.

Rows live in ``batch=<id>/bucket=<b>``, the bucket being a hash of the key. A batch is joined with the
buckets that its keys fall into, and these are written whole into the batch's own folder; a bucket's
rows are those of the last batch that wrote it. Batch ids ascend and one writer hands over one batch
after the other, as a stream does. A batch that comes again is joined with what lay before it and
overwrites its folder with the same rows, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.merge import merge_rows

_BUCKET = "bucket"
#: Rows that lie in even partitions are written as they lie into so many buckets: a task writes a file each.
_FEW_BUCKETS = 8
#: The batch that writes a table's columns before there is a row; those with rows come after it.
_BOOTSTRAP = 0


@dataclass(frozen=True)
class KeyedTable:
    """``buckets`` stays the same for the table's life: pick it so that the buckets one batch touches
    are a small part of the table. A bucket is no unit of work; its rows may be written by many tasks.
    Files are sorted by ``cluster``, so that filters on those columns skip row groups and pages."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 64
    cluster: tuple[str, ...] = ()

    def exists(self) -> bool:
        return bool(self._live())

    def read(self) -> DataFrame:
        live = self._live()
        if not live:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._rows({b: batch for b, (batch, _) in live.items()})

    def live_bytes(self) -> int:
        """The size of the files that a reader of the table reads."""
        return sum(size for _, size in self._live().values())

    def bootstrap(self, rows: DataFrame) -> None:
        """Create the table with the columns of ``rows`` and none of its rows."""
        if not self.exists():
            empty = f"{self.path}/batch={_BOOTSTRAP}/{_BUCKET}=0"
            rows.limit(0).write.mode("overwrite").parquet(empty)

    def upsert(self, updates: DataFrame, batch: int, even: bool = False) -> None:
        """Merge one batch that holds one row per key; ``batch`` counts from 1 and ascends.

        ``even`` says that the rows lie in partitions of like size, each no more than a task can sort:
        for a table of few buckets they are then not shuffled again before they are written.
        """
        if batch <= _BOOTSTRAP:
            raise ValueError("batches count from 1")
        self.bootstrap(updates)
        keyed = updates.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        stored = {b: at for b, (at, _) in self._live(before=batch).items() if at > _BOOTSTRAP}
        if not stored:
            self._write(keyed, batch, even)
            return
        keyed = keyed.persist()  # read for its buckets, then for its rows; computed again where it is lost
        try:
            touched = [row[0] for row in keyed.select(_BUCKET).distinct().collect()]
            old = {b: stored[b] for b in touched if b in stored}
            if old:
                self._write(merge_rows(self._rows(old, bucket=True), keyed, self.keys), batch, even)
            elif touched:
                self._write(keyed, batch, even)
        finally:
            keyed.unpersist()

    def _write(self, rows: DataFrame, batch: int, even: bool) -> None:
        if not (even and self.buckets <= _FEW_BUCKETS):
            # Rebalancing splits buckets above the advisory size and joins small ones.
            rows = rows.hint("rebalance", _BUCKET)
        (
            rows.sortWithinPartitions(_BUCKET, *self.cluster)
            .write.mode("overwrite")
            .option("compression", "zstd")
            .partitionBy(_BUCKET)
            .parquet(f"{self.path}/batch={batch}")
        )

    def _rows(self, batches: dict[int, int], bucket: bool = False) -> DataFrame:
        folders = [f"{self.path}/batch={batch}/{_BUCKET}={b}" for b, batch in sorted(batches.items())]
        rows = self.spark.read.option("basePath", self.path).parquet(*folders).drop("batch")
        return rows if bucket else rows.drop(_BUCKET)

    def _live(self, before: int | None = None) -> dict[int, tuple[int, int]]:
        """By bucket the last batch that wrote it, and its bytes, from one listing; a row per bucket comes back."""
        try:
            files = (
                self.spark.read.format("binaryFile")
                .option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.parquet")
                .load(self.path)
            )
        except AnalysisException:
            return {}
        placed = files.select(
            F.regexp_extract("path", r"/batch=(\d+)/", 1).cast("bigint").alias("batch"),
            F.regexp_extract("path", rf"/{_BUCKET}=(\d+)/", 1).cast("int").alias(_BUCKET),
            "length",
        )
        if before is not None:
            placed = placed.filter(F.col("batch") < before)
        sizes = placed.groupBy(_BUCKET, "batch").agg(F.sum("length").alias("bytes"))
        newest = sizes.groupBy(_BUCKET).agg(F.max(F.struct("batch", "bytes")).alias("last"))
        return {row[0]: (row.last.batch, row.last.bytes) for row in newest.collect()}


def keyed_table(
    spark: SparkSession, path: str, keys: Iterable[str], buckets: int = 64, cluster: Sequence[str] = ()
) -> KeyedTable:
    return KeyedTable(spark, path, tuple(keys), buckets, tuple(cluster))
