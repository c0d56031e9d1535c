from __future__ import annotations

import corpus_pipeline
from strandline.llm.decontaminate import find_contained
from strandline.llm.frames import table
from strandline.llm.near import classes


def test_each_stage_does_its_part(spark, tiny):
    docs = given = table(spark, tiny, "documents")
    counts, schema = [docs.count()], docs.schema.simpleString()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, tiny), "test")
        assert docs.schema.simpleString() == schema, name
        counts.append(docs.count())
        if name == "near duplicates":
            found = classes(given).collect()
            assert {r.doc_id for r in docs.collect()} == {r.class_id for r in found} and len({r.class_id for r in found}) < len(found)
        if name == "decontamination":
            assert find_contained(docs, table(spark, tiny, "benchmark")).count() == 0
    assert counts[0] >= counts[1] > counts[2] > counts[3] and len(corpus_pipeline.STAGES) == 5
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, tiny).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert sum(r.chunk == 0 for r in rows) == counts[-1]
