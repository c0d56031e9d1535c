from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from strandline.llm.mixing import materialise, mix


def corpus(seed, sources):
    rng = random.Random(seed)
    rows = [(k, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 60))), rng.choice(sources)) for k in range(2000)]
    rows += [(5000, None, sources[0]), (None, "a\tb\u00a0c\n", None), (5001, "", "zz"), rows[3], rows[3]]
    return rows


def brute_targets(rows):
    size = Counter()
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, clamped = 1.5 * sum(size.values()), set()
    while True:
        left = [s for s in order if s not in clamped]
        rest = total - sum(2 * size[s] for s in clamped)
        target = {s: 2 * size[s] if s in clamped else rest * weight[s] / sum(weight[x] for x in left) for s in order}
        above = {s for s in left if target[s] > 2 * size[s]}
        if not above:
            return size, target
        clamped |= above


@pytest.mark.parametrize("sources", [["a"], ["b", "a", None, "é", "Z"], [f"s{k % 7 if k % 3 else 0}" for k in range(40)]])
def test_targets_and_taken_words(spark, sources):
    rows = corpus(len(sources), sources)
    size, target = brute_targets(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(frame).collect()
    assert len(found) == len(rows) and sorted(map(tuple, found), key=str) == sorted(map(tuple, mix(frame.repartition(7)).collect()), key=str)
    taken, biggest = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6 * (1 + target[r.source])
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= biggest[s] for s in size)


def test_materialised_rows_are_the_taken_ones(spark):
    rows = corpus(9, ["a", "b", "c"])
    frame = spark.createDataFrame([(*r, r[0], "x") for r in rows], "doc_id long, text string, source string, size long, payload string")
    copies = Counter()
    for r in mix(frame).collect():
        copies[r.doc_id] += r.copies if r.size else 1
    out = materialise(frame)
    assert out.columns == frame.columns
    assert Counter(r.doc_id for r in out.collect()) == +copies
    assert mix(frame.limit(0)).count() == 0 and materialise(frame.limit(0)).count() == 0
