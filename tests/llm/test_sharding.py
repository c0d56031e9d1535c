from __future__ import annotations

import random
import zlib

import pytest

from strandline.llm import sharding
from strandline.llm.sharding import DIMENSIONS, HASH_BITS, metadata, shard


def corpus():
    rng = random.Random(6)
    rows = [(k, "x" * int(rng.paretovariate(1.2) * 50), rng.choice(["a", "b", None]), rng.choice(["en", "de"])) for k in range(3000)]
    rows += [(k, "the same text", "a", "en") for k in range(4000, 6000)]
    rows += [(None, None, None, None), (None, "é", None, "en"), (7000, "", "b", None), (7001, "again", "b", "en"), (7001, "again", "b", "en")]
    return rows


def brute(rows, shards):
    """The leaf of every row, by sorting: the cut is the boundary between places nearest to the goal."""
    extent = {}

    def cut(box, first, owed):
        if owed == 1 or not box:
            return {r["tie"]: first for r in box}
        spans = {d: max(r[d] for r in box) - min(r[d] for r in box) for d in DIMENSIONS}
        extent.update({d: max(1, s) for d, s in spans.items()} if not extent else {})
        along = max(DIMENSIONS, key=lambda d: (spans[d] / extent[d], -DIMENSIONS.index(d)))
        box = sorted(box, key=lambda r: (r[along] << HASH_BITS) + r["tie"])
        goal, sums, total = sum(r["size"] for r in box) * (owed // 2) / owed, [0], 0
        for r in box:
            total += r["size"]
            sums.append(total)
        at = min(range(len(sums)), key=lambda k: (abs(sums[k] - goal), -k))
        return cut(box[:at], first, owed // 2) | cut(box[at:], first + owed // 2, owed - owed // 2)

    return cut(rows, 0, shards)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_tree_equals_brute_force(spark, monkeypatch, shards):
    monkeypatch.setattr(sharding, "EXACT", 0.0)
    rows = [r for r in corpus() if r[0] is not None and r[0] != 7001]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    meta = metadata(frame, "doc_id", "text", "source", "lang").collect()
    leaf = brute(meta, shards)
    found = {r.doc_id: r.shard for r in shard(frame, shards).collect()}
    assert found == {r.doc_id: leaf[r.tie] for r in meta}


def test_bytes_slots_and_edges(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = shard(frame.selectExpr("*", "1 AS size", "2 AS node")).collect()
    sizes = {(d, zlib.crc32((t or "").encode())): len((t or "").encode()) + 16 for d, t, *_ in rows}
    assert len(found) == len(rows) and all(sizes[r.doc_id, r.text_crc32] == r.size for r in found)
    total, biggest = sum(r.size for r in found), max(r.size for r in found)
    for k in range(40):
        mine = [r for r in found if r.shard == k]
        assert abs(sum(r.size for r in mine) - total / 40) <= 2 * biggest + 0.01 * total / 40
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
    assert shard(frame.limit(0)).count() == 0
    assert len(shard(frame.limit(3)).collect()) == 3
