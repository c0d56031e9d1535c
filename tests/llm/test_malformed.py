"""Texts that are no UTF-8, in every operator that reads texts in Python and in the pipeline's stages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandline.llm import decontaminate, hosts, language, license, near, tokens, urls
from strandline.llm.frames import table

BROKEN = b"caf\xe9 \xff\xfe and the house \xc3"


@pytest.fixture(scope="module")
def broken(spark, tiny):
    docs = table(spark, tiny, "documents")
    bad = F.lit(BROKEN).cast("string")
    return docs.withColumn("text", F.when(F.col("doc_id") % 40 == 3, bad).otherwise(F.col("text")))


def test_operators_read_what_can_be_read(spark, broken):
    n = broken.count()
    model = language.learn(broken)
    assert language.identify(broken, model).count() == n
    assert hosts.judge(broken).count() == n
    assert license.scan_licenses(broken).count() == n
    assert near.classes(broken).count() == n
    one = broken.where("doc_id % 40 = 3").limit(1)
    records = tokens.materialise(one).collect()
    assert [r.doc_id for r in records] == [one.first().doc_id]
    pages = spark.createDataFrame([(1, b"http://a.org/\xff\xfe")], "page_id long, url binary")
    pages = pages.withColumn("url", F.col("url").cast("string"))
    assert urls.decided(pages).count() == 1


def test_stages_pass_them_on(spark, broken, tiny):
    docs = broken
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, tiny), "malformed")
        assert docs.schema == broken.schema, name
    clean = decontaminate.drop_contaminated(broken, table(spark, tiny, "benchmark"))
    raw = clean.where("doc_id % 40 = 3").select(F.col("text").cast("binary").alias("raw")).collect()
    assert raw and {bytes(r.raw) for r in raw} == {BROKEN}


def test_pieces_of_a_long_text_meet_without_a_seam(monkeypatch):
    text = "Straße, die lange   Ordnung 12 des Hauses"
    whole = language.grams(text).tolist()
    for size in range(1, 12):
        monkeypatch.setattr(language, "PIECE", size)
        assert language.grams(text).tolist() == whole
