"""Landing files to append-only Bronze tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from strandline.sources.landing import FILES_PER_BATCH, read_landing


def start_ingest(
    spark: SparkSession,
    source: str,
    folder: str,
    path: str,
    checkpoint: str,
    table: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Append every file not seen before to ``path`` (and catalog ``table``), then stop."""
    writer = (
        read_landing(spark, source, folder, files_per_batch)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .option("path", path)
        .trigger(availableNow=True)
    )
    return writer.toTable(table) if table else writer.start()
