from __future__ import annotations

import random

from strandline.llm import decontaminate
from strandline.llm.decontaminate import Block, drop_contaminated, find_contained
from strandline.llm.words import WORD


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute(docs, items):
    found = []
    for doc, text in docs:
        here = shingles(text)
        for item, body in items:
            wanted = shingles(body)
            if wanted and len(wanted & here) >= 0.8 * len(wanted):
                found.append((doc, item, len(wanted), len(wanted & here)))
    return sorted(found, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(rng.choice([3, 5, 6, 12, 40, 90, 400]))) for k in range(40)] + [(90, None), (91, "")]
    items.append((92, items[5][1]))
    docs = [(None, None), (1, ""), (2, "w1 w2")]
    for k in range(120):
        parts = [text(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 2)):
            taken = rng.choice(items)[1] or ""
            taken = taken.split()
            for _ in range(rng.randint(0, 1 + len(taken) // 25)):
                if taken:
                    taken[rng.randrange(len(taken))] = "zz"
            parts += [" ".join(taken).upper(), text(rng.randint(0, 30))]
        docs.append((10 + k, ", ".join(parts)))
    return [*docs, docs[-1]], items


def test_every_containing_pair_is_found(spark, monkeypatch):
    docs, items = corpus(1)
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    wanted = brute(docs, items)
    assert len(wanted) > 20
    for size in (1 << 20, 2000):  # one block, and many
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        found = find_contained(left, right).drop("containment").collect()
        assert sorted(map(tuple, found), key=str) == wanted
    extra = left.selectExpr("*", "1 AS item_id", "'x' AS n_shared")
    bad = {doc for doc, *_ in wanted}
    kept = drop_contaminated(extra, right)
    assert kept.columns == extra.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted([d for d in docs if d[0] not in bad], key=str)


def test_empty_tables(spark):
    docs, items = corpus(2)
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert find_contained(left.limit(0), right).count() == 0
    assert find_contained(left, right.limit(0)).count() == 0
    assert drop_contaminated(left, right.limit(0)).count() == len(docs)


def test_sketch_is_smaller_than_the_item_but_never_misses():
    rng = random.Random(7)
    words = [f"v{k}" for k in range(5000)]
    body = " ".join(rng.choice(words) for _ in range(1000))
    block = Block.build([1], [body.encode()], 0.8)
    assert len(block.hashes) < 0.5 * len(shingles(body))
    assert list(block.candidates(body.encode())) == [0]
    assert list(block.candidates(" ".join(body.split()[:780]).encode())) in ([], [0])
    assert block.contained(" ".join(body.split()[:850]).encode(), 0.8)
