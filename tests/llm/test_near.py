from __future__ import annotations

import random

import numpy as np
import pytest

from strandline.llm import frames, near
from strandline.llm.components import components
from strandline.llm.near import _packed, banded_distance, classes, keep_one, order_minhash, similar, sketches, told_apart


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_banded_distance_equals_the_whole_table():
    rng = random.Random(1)
    for _ in range(3000):
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 12))]
        b = [rng.randint(0, 3) for _ in range(rng.randint(0, 12))] if rng.random() < 0.5 else [9 if rng.random() < 0.2 else x for x in a]
        most = rng.randint(0, 8)
        distance = levenshtein(a, b)
        assert banded_distance(a, b, most) == (distance if distance <= most else None)


def test_sketches_answer_to_order():
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    text = " ".join(words).encode()
    half = " ".join(words[150:] + words[:150]).encode()
    edited = " ".join(w if rng.random() > 0.01 else "new" for w in words).encode()
    agree = lambda a, b: (order_minhash(a) == order_minhash(b)).sum()
    assert agree(text, text.upper().replace(b" ", b", ")) == 24
    assert agree(text, edited) > agree(text, half) > 0
    assert similar(_packed(text), _packed(edited), 0.8) and not similar(_packed(text), _packed(half), 0.8)


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(200 + k, 201 + k) for k in range(40)] + [(300, 300 + k) for k in range(60)]
    links += [(7, 7), (None, 3), links[0]]
    root = {}
    find = lambda x: x if root.get(x, x) == x else find(root[x])
    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {x: find(x) for a, b in links if a is not None and a != b for x in (a, b)}
    assert components(frame.limit(0)).count() == 0


def corpus():
    rng = random.Random(4)
    vocabulary = [f"v{k}" for k in range(2000)]
    fresh = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    docs, group = [], {}
    boiler = fresh(40)
    for g in range(25):
        base = fresh(rng.randint(30, 200))
        for _ in range(rng.choice([1, 1, 2, 5, 40 if g == 3 else 3])):
            words = [w if rng.random() > 0.015 else rng.choice(vocabulary) for w in base]
            docs.append(" ".join(words))
            group[docs[-1]] = g
    for k in range(60):  # a long passage in common is no near copy
        docs.append(" ".join(boiler + fresh(60)))
        group[docs[-1]] = 100 + k
    rng.shuffle(docs)
    return docs, group


def test_classes_equal_planted_groups(spark):
    docs, group = corpus()
    rows = [(k + 10, t, "s") for k, t in enumerate(docs)] + [(500, docs[0], "s"), (501, docs[0], "t"), (501, docs[0], "t")]
    rows += [(None, None, None), (600, "", "s"), (601, "Hi. There", "s"), (602, "hi there", "s"), (603, "hi you", "s"), (604, "...", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(5)
    found = classes(frame).collect()
    assert len(found) == len(rows)
    mine = {}
    for r in found:
        mine.setdefault(r.class_id, set()).add(r.doc_id)
    wanted = {}
    for doc, text, _ in rows:
        low = (text or "").lower()
        wanted.setdefault(group.get(text, "hi there" if low in ("hi. there", "hi there") else low), set()).add(doc)
    expected = {min((d for d in docs if d is not None), default=None): docs for docs in wanted.values()}
    assert mine == expected
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_repeated_rows_leave_one(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "y"), (None, "q", "z"), (None, "q", "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, rep string")
    assert sorted(str(r.doc_id) for r in keep_one(frame).collect()) == ["1", "None"]
    assert keep_one(frame.limit(0)).count() == 0 and classes(frame.limit(0)).count() == 0


def edited(rng, words, edits):
    """Substitutions, and of every three edits one insertion or deletion, at random places."""
    words = list(words)
    for k, at in enumerate(sorted(rng.sample(range(len(words)), edits), reverse=True)):
        if k % 3 < 2 or len(words) < 10:
            words[at] = f"x{rng.getrandbits(60)}"
        elif k % 2:
            words.insert(at, f"x{rng.getrandbits(60)}")
        else:
            del words[at]
    return words


def test_candidates_are_found_down_to_the_least_similarity():
    rng = random.Random(6)
    for n, similarity in [(5, 0.8), (10, 0.9), (10, 0.8), (24, 0.8), (26, 0.8), (40, 0.85), (40, 0.8), (200, 0.85), (200, 0.8)]:
        found = 0
        for _ in range(400):
            base = [f"w{rng.getrandbits(60)}" for _ in range(n)]
            pair = [" ".join(words).encode() for words in (base, edited(rng, base, int((1 - similarity) * n + 1e-9)))]
            found += bool(set(sketches(pair[0]).tolist()) & set(sketches(pair[1]).tolist()))
        print(n, similarity, found / 400)
        assert found >= 0.99 * 400, (n, similarity, found)


def test_values_tell_texts_from_their_anchors():
    kmers = lambda low, high: np.arange(low, high, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values = lambda text, *anchors: told_apart(text, np.isin(text, np.concatenate(anchors)))
    passage, anchor, second = kmers(0, 200), kmers(0, 180), kmers(100, 300)
    one, other, far = (np.concatenate([passage, kmers(low, low + 100)]) for low in (1000, 1030, 2000))
    alike = (values(one, anchor, second) == values(other, anchor, second)).sum()
    assert alike > 8 and not (values(one, anchor, second) == values(far, anchor, second)).any()
    # What one anchor lacks of the passage still joins unlike texts; a second anchor takes it away.
    assert (values(one, anchor) == values(far, anchor)).any()
    # Texts that lie in their anchors go on by their sketches.
    assert set(values(kmers(1, 150), passage)) & set(values(kmers(3, 150), passage))
    assert len(told_apart(kmers(1, 150), np.ones(149, bool), inside=True)) == 0 == len(values(kmers(0, 0), passage))


PAIRS = 2000


@pytest.mark.parametrize("passage", [90, 110])
def test_pairs_in_buckets_of_a_common_passage_are_found(spark, passage):
    """Pairs at the least similarity, all texts with the same passage; no other links are made."""
    rng = random.Random(passage)
    token = lambda: f"w{rng.getrandbits(60)}"
    common, n_pairs = [token() for _ in range(passage)], PAIRS
    rows = []
    for k in range(n_pairs):
        base = common + [token() for _ in range(150 - passage)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(edited(rng, base, 30)))]
    rng.shuffle(rows)
    text = dict(rows)
    of = {r.doc_id: r.class_id for r in classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    planted = [k for k in range(n_pairs) if similar(_packed(text[2 * k].encode()), _packed(text[2 * k + 1].encode()), 0.8)]
    found = sum(of[2 * k] == of[2 * k + 1] for k in planted)
    print(passage, found / len(planted))
    assert found >= 0.99 * len(planted) and len(planted) > 0.9 * n_pairs


def linked_and_unlike():
    """Texts with a passage in common, copies of some with a word changed, and equal ones."""
    rng = random.Random(21)
    passage = [f"p{rng.randint(0, 200)}" for _ in range(30)]
    texts = [passage + [f"w{rng.randint(0, 900)}" for _ in range(rng.randint(30, 60))] for _ in range(40)]
    texts += [[*text[:-3], "changed", *text[-2:]] for text in texts[:10]] + texts[:4]
    return [(k, " ".join(text)) for k, text in enumerate(texts)] + [(None, "alone here"), (90, None), (90, None)]


def test_slices_of_pairs_change_no_class(spark, monkeypatch):
    docs = spark.createDataFrame(linked_and_unlike(), "doc_id long, text string")
    told = lambda: sorted(map(tuple, classes(docs).collect()), key=str)
    monkeypatch.setattr(near, "PAIRS_PER_TEXT", 1000)
    whole = told()
    assert {(k, k - 40) for k in range(40, 50)} | {(k, k - 50) for k in range(50, 54)} <= set(whole)
    monkeypatch.setattr(near, "PAIRS_PER_TEXT", 2)
    assert told() == whole


def test_words_are_off_the_disk_when_all_pairs_are_compared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(frames, "run_folder", lambda session, label: f"{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}")
    docs = spark.createDataFrame(linked_and_unlike(), "doc_id long, text string")
    classes(docs).collect()
    bodies = [path for path in tmp_path.iterdir() if path.name.startswith("bodies")]
    assert bodies and all(spark.read.parquet(str(path)).isEmpty() for path in bodies)


def test_only_texts_of_pairs_are_shuffled(spark):
    bodies = spark.createDataFrame([(k, bytes([k])) for k in range(100)], "uid long, words binary")
    wanted = spark.createDataFrame([(3,), (70,), (70,)], "uid long")
    assert {(r.uid, bytes(r.words)) for r in near._among(bodies, near._bitmap(wanted, "uid")).collect()} == {(3, b"\x03"), (70, b"F")}


def test_staging_leaves_no_shuffle_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(frames, "run_folder", lambda session, label: f"{tmp_path}/{label}")
    kept, set_so = spark.conf.get(frames.SHUFFLES_GO), []
    parts = (set_so.append(spark.conf.get(frames.SHUFFLES_GO)) or spark.range(k, k + 1).toDF("n") for k in range(3))
    found = frames.staged_parts(parts, "parts")
    assert sorted(r.n for r in found.collect()) == [0, 1, 2]
    assert set_so == [kept] * 3 and spark.conf.get(frames.SHUFFLES_GO) == kept
    with frames.shuffles_removed(spark):
        assert spark.conf.get(frames.SHUFFLES_GO) == "true"
    frames.emptied(found)
    assert spark.read.parquet(f"{tmp_path}/parts").isEmpty()
