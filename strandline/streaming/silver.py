"""Bronze streams to keyed Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strandline.contracts import LANDED, PROCESSED, SOURCE_FILE, SOURCES
from strandline.operators.cleaning import clean, gate
from strandline.operators.latest import keep_latest
from strandline.sources.keyed_table import KeyedTable


def silver_batch(cleaned: DataFrame, source: str) -> DataFrame:
    """Gate, newest row per key and Silver columns of one cleaned batch.

    Of rows with one key that of the newest file counts, then that of the last path, then the
    columns decide: the same row that would stay if every file were a batch of its own. Rows are
    dealt out by the first key before they are ranked: a sort then holds a partition of the shuffle,
    not whatever the reader hands to a task, the lines of an order, which are alike, travel side by
    side, and the rows come out in even partitions.
    """
    spec = SOURCES[source]
    rows = gate(cleaned, source).select(*spec.columns, PROCESSED, LANDED, SOURCE_FILE)
    newest = keep_latest(rows.repartition(spec.keys[0]), spec.keys, (LANDED, SOURCE_FILE), spec.ties)
    return newest.select(*spec.columns, PROCESSED)


def bronze_rows(spark: SparkSession, source: str, bronze: str, named: bool = False) -> DataFrame:
    """The stream of rows appended to Bronze: a folder, or with ``named`` a table of the catalog."""
    if named:
        return spark.readStream.table(bronze)
    return spark.readStream.schema(SOURCES[source].bronze_schema).parquet(bronze)


def start_refine(
    spark: SparkSession, source: str, bronze: str, table: KeyedTable, checkpoint: str, named: bool = False
) -> StreamingQuery:
    """Merge Bronze rows not seen before into ``table``, then stop.

    A batch that is replayed has the id it had before, which makes its second merge the same as its
    first. A table belongs to one checkpoint.
    """
    schema = SOURCES[source].bronze_schema
    table.bootstrap(silver_batch(clean(spark.createDataFrame([], schema), source), source))

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.upsert(silver_batch(batch, source), batch_id + 1, even=True)

    return (
        clean(bronze_rows(spark, source, bronze, named), source)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_clean(spark: SparkSession, source: str, bronze: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append the cleaned and gated rows of a named Bronze table to a named table, then stop.

    Every arrival is kept, so the table is a history; ``silver_batch`` takes the newest rows from it.
    """
    return (
        gate(clean(bronze_rows(spark, source, bronze, named=True), source), source)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
