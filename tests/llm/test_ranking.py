from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from strandline.llm import ranking
from strandline.llm.catalog import oracle_sql, queries
from strandline.llm.ranking import Best, Shard, search

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(upper))


def brute(docs, items, top):
    found = [(doc, terms(text)) for doc, text in docs]
    found = [(doc, words) for doc, words in found if words]
    n_docs, n_terms = len(found), sum(len(words) for _, words in found)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    rows = []
    for item, wanted in asked.items():
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in w for _, w in found) + 1))) for t in wanted}
        scored = []
        for doc, words in found:
            m = 50 + 50 * len(words) * n_docs // n_terms
            score = sum(weights[t] * (10**9 * words.count(t) // (1000 * words.count(t) + 20 * m)) for t in wanted if t in words)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        rows += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top])]
    return sorted(rows, key=str)


def corpus(seed, n_docs=500, n_words=120):
    rng = random.Random(seed)
    words = [f"w{k}" if k % 3 else f"Wörd{k}" for k in range(n_words)]
    text = lambda n: ", ".join(rng.choice(words[: rng.choice([4, 20, n_words])]) for _ in range(n))
    docs = [(None, None), (1, ""), (2, " .,; "), (None, words[0]), (3, words[0]), (4, words[0])]
    docs += [(10 + k, text(rng.choice([1, 3, 20, 60]))) for k in range(n_docs)]
    docs += [docs[-1], docs[-2], (5, " ".join(words) * 40)]
    items = [(k, text(rng.choice([1, 5, 30]))) for k in range(12)] + [(90, None), (91, "nowhere"), (92, ""), (None, words[0]), (3, words[1])]
    return docs, items


@pytest.mark.parametrize("docs_in_shard, block, top, query_bytes", [(4096, 32, 50, 1 << 20), (64, 4, 5, 1 << 20), (64, 2, 3, 40)])
def test_results_are_those_of_scoring_everything(spark, monkeypatch, docs_in_shard, block, top, query_bytes):
    for name, value in (("SHARD_DOCS", docs_in_shard), ("BLOCK", block), ("TOP", top), ("QUERY_BYTES", query_bytes)):
        monkeypatch.setattr(ranking, name, value)
    docs, items = corpus(docs_in_shard + block)
    left = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS item_id", "'x' AS Score").repartition(3)
    found = search(left, spark.createDataFrame(items, ITEMS).selectExpr("*", "2 AS doc_id"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items, top)


def test_blocks_are_skipped_and_nothing_is_lost():
    """A shard of like documents in groups: most are never scored, and the best are the right ones."""
    rng = np.random.default_rng(5)
    sizes = np.full(2000, 20)
    groups = np.repeat(np.arange(20), 100)
    terms = np.concatenate([np.sort(rng.choice(60, 20, replace=False)) + 60 * g for g in groups])
    terms = np.where(rng.random(len(terms)) < 0.2, 3000 + terms % 60, terms)
    pairs = np.unique(np.stack([np.repeat(np.arange(2000), sizes), terms]), axis=1)
    sizes, terms = np.bincount(pairs[0], minlength=2000), pairs[1]
    values = np.where(terms < 3000, rng.integers(500, 1000, len(terms)), rng.integers(1, 50, len(terms)))
    shard = Shard(np.arange(2000), np.zeros(2000, bool), sizes, terms, values)
    members = [np.concatenate([np.arange(60 * g, 60 * g + 30), np.arange(3000, 3060)]) for g in (3, 17)]
    best = Best(2)
    scored = shard.search(members, best)
    owner = np.repeat(np.arange(2000), sizes)
    for item, member in enumerate(members):
        mine = np.isin(terms, member)
        scores = np.bincount(owner[mine], values[mine], minlength=2000).astype(int)
        wanted = sorted(zip(-scores, range(2000)))[: ranking.TOP]
        assert list(zip(-best.found[item][0], best.found[item][1])) == wanted
    assert scored < 0.3 * sum(len(np.unique(owner[np.isin(terms, m)])) for m in members)


def test_blocks_hold_like_documents():
    at = np.repeat(np.arange(64), 3)
    columns = np.concatenate([[0, 1, 2] if k % 2 else [7, 8, 9] for k in range(64)])
    block = Shard._blocked(64, at, columns, np.ones(len(at)), 10)
    assert len(set(block[1::2])) == 1 or set(block[1::2]).isdisjoint(block[::2])


def test_empty_tables(spark):
    docs, items = corpus(3, 20)
    left, right = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    for found in (search(left.limit(0), right), search(left, right.limit(0)), search(left.where("doc_id = 1"), right)):
        assert (found.columns, found.count()) == (["item_id", "rank", "doc_id", "score"], 0)


def test_long_text_and_malformed_bytes(spark):
    long = spark.createDataFrame([(1, "needle " + "hay " * 700_000 + "needle"), (2, "hay")], DOCS)
    broken = spark.sql("SELECT 3L AS doc_id, CAST(X'6E6565646C65FF20686179' AS STRING) AS text")
    found = search(long.unionByName(broken), spark.createDataFrame([(1, "needle")], ITEMS)).collect()
    assert [r.doc_id for r in found] == [1]


def test_query_and_sql_are_registered(spark, tiny):
    from oracle_check import compare, connect

    assert compare(queries()["op11_ranking"](spark, tiny), connect(tiny), oracle_sql()["op11_ranking"]) is None
