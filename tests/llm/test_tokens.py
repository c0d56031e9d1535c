from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest

from strandline.llm.tokens import PIECES, SEQ_LEN, VOCABULARY, _encoding, permute, read_records, read_shards, token_ids, write_shards


def test_permutation_is_one_to_one_and_keyed():
    for size in (1, 2, 3, 17, 64, 1000, 4097):
        found = permute(np.arange(size), size, 5)
        assert sorted(found) == list(range(size))
    assert list(permute(np.arange(1000), 1000, 5)) != list(permute(np.arange(1000), 1000, 6))
    assert list(permute(np.array([7, 3]), 1000, 5)) == [permute(np.arange(1000), 1000, 5)[k] for k in (7, 3)]
    assert permute(np.arange(20_000), 20_000, 5)[:100].std() > 3000


def test_ids_do_not_depend_on_the_short_cut():
    rng = random.Random(8)
    whole = _encoding(VOCABULARY, PIECES)
    bits = ["a", "b'll", " ", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "é", "1", "!", "\x1c", "\x85", " \n", "日本", "²", "_", "\r\n"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        assert token_ids(text) == whole.encode_ordinary(text)


def corpus():
    rng = random.Random(4)
    docs = [(k, " ".join(rng.choice(["the", "Élan", "x1", "\n", "日本"]) for _ in range(rng.randint(0, 400)))) for k in range(60)]
    return [*docs, (None, "no id"), (100, None), (101, ""), docs[0], docs[0]]


@pytest.mark.parametrize("stable", [True, False])
def test_round_trip(spark, tmp_path, stable):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS slot", "'a' AS shard").repartition(3)
    if stable:
        frame.write.parquet(f"{tmp_path}/in")
        frame = spark.read.parquet(f"{tmp_path}/in")
    path = f"{tmp_path}/out"
    total = write_shards(frame, path, seq_len=64, per_shard=16, stable=stable)
    shards = sorted(Path(path).glob("shard=*/*.txt"), key=lambda p: int(p.parent.name[6:]))
    assert [int(p.parent.name[6:]) for p in shards] == list(range(-(-total // 16)))  # one file each, none missing
    records = [r for p in shards for r in read_records(p.open("rb"), seq_len=64)]
    assert len(records) == total
    parts: dict = {}
    for doc, chunk, ids in records:
        parts.setdefault(doc, []).append((chunk, ids.tolist()))
    for doc, text in set(docs):
        times = docs.count((doc, text))
        wanted = token_ids(text or "")
        pieces = [wanted[k : k + 64] for k in range(0, len(wanted), 64)] or [[]]
        assert sorted(parts[doc]) == sorted([(k, p) for k, p in enumerate(pieces)] * times)
    # Reading on from any place gives the same records.
    resumed = list(read_records(shards[0].open("rb"), 5, seq_len=64))
    assert [(d, c, i.tolist()) for d, c, i in resumed] == [(d, c, i.tolist()) for d, c, i in records[5:16]]
    rows = read_shards(spark, path, seq_len=64, per_shard=16).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(total))
    assert [(r.doc_id, r.chunk, r.n_tokens) for r in rows] == [(d, c, len(i)) for d, c, i in records]


def test_empty_table_and_default_length(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert write_shards(empty, f"{tmp_path}/none") == 0
    assert SEQ_LEN % 2 == 0
