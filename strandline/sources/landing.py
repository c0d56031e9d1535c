"""CSV landing folders: what has arrived, and reading it under the source contract."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import INGESTED, LANDED, SOURCE_FILE, SOURCES

# Newest-file checks accept any casing of the suffix, arrival checks only lower case.
ANY_CASE_CSV = "*.[cC][sS][vV]"
FILES_PER_BATCH = 1000


def read_landing(
    spark: SparkSession, source: str, folder: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of new files in ``folder`` with lineage columns.

    The header must name exactly the contract's columns in order; a file with a new, missing
    or moved column stops the stream before any of its rows is stored. Files come oldest first;
    ``files_per_batch`` only says how many a micro-batch takes. Which of two rows wins is decided
    by their files (``LANDED``, then the path), so that it does not depend on where batches end.
    """
    rows = (
        spark.readStream.schema(SOURCES[source].landing_schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return rows.withColumns(
        {
            INGESTED: F.current_timestamp(),
            SOURCE_FILE: F.col("_metadata.file_path"),
            "ingestion_date": F.current_date(),
            LANDED: F.col("_metadata.file_modification_time"),
        }
    )


def _listing(spark: SparkSession, root: str, pattern: str, since: dt.datetime | None = None) -> DataFrame:
    """Files per source folder under ``root``, those changed at or after ``since``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(root)
    )
    if since is not None:
        files = files.filter(F.col("modificationTime") >= F.lit(since))
    # Listings spell the scheme their own way (file:/ for file:///), so it is left out.
    below = re.escape(root.split("://", 1)[-1].rstrip("/"))
    named = files.select(F.regexp_extract("path", f"{below}/([^/]+)/", 1).alias("source"))
    return named.groupBy("source").agg(F.count(F.lit(1)).alias("files"))


def _counted(spark: SparkSession, found: DataFrame, answer: str, files: str) -> DataFrame:
    expected = spark.range(1).select(F.explode(F.lit(list(SOURCES))).alias("source"))
    counted = expected.join(found, "source", "left").withColumn("files", F.coalesce("files", F.lit(0)))
    return counted.select("source", (F.col("files") > 0).alias(answer), F.col("files").alias(files))


def landing_ready(spark: SparkSession, root: str) -> DataFrame:
    """Per source, whether any ``*.csv`` lies in its folder or below it, and how many."""
    return _counted(spark, _listing(spark, root, "*.csv"), "ready", "files")


def landing_fresh(spark: SparkSession, root: str, since: dt.datetime) -> DataFrame:
    """Per source, whether a CSV changed at or after ``since``, and how many."""
    return _counted(spark, _listing(spark, root, ANY_CASE_CSV, since), "fresh", "new_files")


def newest_change(spark: SparkSession, root: str) -> dt.datetime | None:
    """When a CSV below ``root`` changed last."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", ANY_CASE_CSV).option("recursiveFileLookup", True)
    return files.load(root).agg(F.max("modificationTime")).first()[0]
