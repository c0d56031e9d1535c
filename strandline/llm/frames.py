"""Reading tables, staging results and running batch functions for the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandline.session import run_folder

#: A Python worker holds a few Arrow batches at once; long texts make rows wide, so few rows go in each.
ROWS_PER_BATCH = 512
#: Bytes after which Spark closes an Arrow batch, where the session has not set its own.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")
#: Whether shuffle files go when the query that wrote them has ended, not when the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind."""
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def staged(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared folder and read again: computed once, and safe from lost executors."""
    return staged_parts([frame], label)


def staged_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """Like ``staged``, of frames of one schema (one at least), one after the other: the shuffle files of one go before the next."""
    path = None
    for part in parts:
        spark, schema = part.sparkSession, part.schema
        path = path or run_folder(spark, label)
        with shuffles_removed(spark):
            part.write.mode("append").parquet(path)
    found = spark.read.schema(schema).parquet(path)
    found.staged_in = path
    return found


def emptied(frame: DataFrame) -> None:
    """Takes the rows of a frame that ``staged`` returned off the disk, when nothing reads them any more."""
    path = frame.staged_in
    frame.sparkSession.createDataFrame([], frame.schema).write.mode("overwrite").parquet(path)


def batched(
    frame: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` over batches cut to ``ROWS_PER_BATCH`` rows before ``work`` sees them.

    A batch of an empty table is passed on as it is; ``work`` must cope with no rows. Sessions that
    leave Spark's size of Arrow batches at its default get a smaller one.
    """
    name, default, size = BATCH_BYTES
    if frame.sparkSession.conf.get(name) == default:
        frame.sparkSession.conf.set(name, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS_PER_BATCH):
                    yield batch.slice(start, ROWS_PER_BATCH)

        yield from work(cut())

    return frame.mapInArrow(run, schema)


def raw_text(column: str = "text") -> F.Column:
    """The UTF-8 bytes of a text; null is empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The bytes of a string column of a batch, whether they are UTF-8 or not."""
    return column.cast(pa.large_binary()).to_pylist()


def decoded(column: pa.Array) -> list[str | None]:
    """The texts of a string column of a batch; bytes that are no UTF-8 become U+FFFD."""
    return [None if raw is None else raw.decode("utf-8", "replace") for raw in raw_texts(column)]


def fresh(frame: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``frame`` has, in any letter case."""
    taken = {name.lower() for name in frame.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found
