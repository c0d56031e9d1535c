from __future__ import annotations

import random
import zlib

import numpy as np

from strandline.llm.language import MIN_SCORE, UNKNOWN, Filter, calibrate, grams, held_out, identify, keep_known, learn, op9_language


def brute_grams(text):
    points = [0]
    for ch in text.lower():
        point = ord(ch) if ch.isalpha() else 0
        if point or points[-1]:
            points.append(point)
    if points[-1]:
        points.append(0)
    return [(points[k] << 42) | (points[k + 1] << 21) | points[k + 2] for k in range(len(points) - 2)]


def test_grams_equal_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("abÉß日𐐀 .,\n7İ") for _ in range(rng.randint(0, 20)))
        assert grams(text).tolist() == brute_grams(text)


def test_filter_reports_every_member_and_few_others():
    rng = np.random.default_rng(2)
    members = [rng.integers(0, 1 << 62, n, dtype=np.uint64) for n in (3000, 500)] + [np.empty(0, np.uint64)] * 70
    made = Filter.build([f"l{k:02}" for k in range(72)], members)
    assert made.shares(members[0])[0] == 1 and made.shares(members[1])[1] == 1
    assert made.shares(rng.integers(0, 1 << 62, 5000, dtype=np.uint64)).max() < 0.02


def test_held_out_documents_are_told_apart(spark):
    folder = "/root/testdata/sf0.01"
    wanted = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op9_language(spark, folder).collect()
    assert len(rows) == len(wanted)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == wanted[r.doc_id] for r in test) >= 0.98 * len(test) > 100


def test_nulls_letterless_texts_and_clashing_names(spark):
    rows = [(1, "the thing of the thing", "en", 5), (2, "el niño de la niña", "es", None), (None, None, "en", 1), (4, "123 ...", None, 2), (4, "123 ...", None, 2), (5, "", "es", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = learn(docs)
    assert model.languages == ["en", "es"]
    found = identify(docs, model)
    assert found.columns == [*docs.columns, "lang_pred", "_score"]
    assert [r.lang_pred for r in found.collect()] == ["en", "es", UNKNOWN, UNKNOWN, UNKNOWN, UNKNOWN]
    assert [r.doc_id for r in keep_known(docs, model).collect()] == [1, 2]
    empty = learn(docs.limit(0))
    assert empty.languages == [] and {r.lang_pred for r in identify(docs, empty).collect()} == {UNKNOWN}
    assert identify(docs.limit(0), model).count() == 0
    assert [r[0] for r in spark.createDataFrame([(None,)], "doc_id long").select(held_out()).collect()] == [False]


def test_documents_of_a_language_not_learned_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL")
    shares = {}
    for left_out in ("de", "en", "es", "fr"):
        learning = docs.where(~held_out()).where(f"lang <> '{left_out}'")
        model = learn(learning)
        least = calibrate(learning, model)
        test = docs.where(held_out())
        kept = {r.lang: r["count"] for r in keep_known(test, model, min_score=least).groupBy("lang").count().collect()}
        for r in test.groupBy("lang").count().collect():
            shares.setdefault(r.lang == left_out, []).append((kept.get(r.lang, 0), r["count"]))
    foreign, own = (sum(k for k, _ in shares[x]) / sum(n for _, n in shares[x]) for x in (True, False))
    print("kept of languages left out and learned, by language:", shares)
    assert foreign <= 0.05 and own >= 0.99


def test_calibration_without_evidence(spark):
    docs = spark.createDataFrame([("the thing of the thing", "en"), ("el niño de la niña", "es"), (None, "es"), ("1", "en")], "text string, lang string")
    assert (calibrate(docs, learn(docs)) == MIN_SCORE).all()
    assert (calibrate(docs.limit(0), learn(docs.limit(0))) == MIN_SCORE).all()
    one = spark.createDataFrame([("the thing of the thing", "en")] * 200, "text string, lang string")
    assert (calibrate(one, learn(one)) > 0.9).all()
