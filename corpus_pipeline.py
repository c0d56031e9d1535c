"""A training corpus from raw documents, stage by stage.

Each stage takes what the one before it kept, as a table of documents read from files, and returns
the documents it keeps, with the columns of documents; the last writes them in training order and
returns what its shards hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import decontaminate, language, mixing, near, tokens
from strandline.llm.frames import staged, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or explained by no learned language, go."""
    learning = docs.where(~language.held_out())
    model = language.learn(learning)
    return language.keep_known(docs, model, min_score=language.calibrate(learning, model))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near copies the document with the smallest doc_id stays."""
    return near.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.materialise(docs)


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token sequences in training order, in binary shards; what the shards hold."""
    return tokens.materialise(docs, stable=True)


STAGES = [
    ("language", known_language),
    ("near duplicates", near_duplicates),
    ("decontamination", benchmark_free),
    ("mixing", mixed),
    ("training order", training_order),
]

#: Models learned from the corpus, probabilistic candidate search and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
