from __future__ import annotations

import random

from strandline.llm.license import PHRASES, Automaton, Scanner, scan_licenses
from strandline.llm.words import WORD


def brute_statistics(words, templates):
    for end in range(1, len(words) + 1):
        yield max(
            (n for n in range(1, end + 1) if any(t[k : k + n] == words[end - n : end] for t in templates for k in range(len(t) - n + 1))),
            default=0,
        )


def test_matching_statistics_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        letters = [b"a", b"b", b"c", b"d"][: rng.randint(2, 4)]
        templates = [[rng.choice(letters) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 4))]
        words = [rng.choice([*letters, b"x"]) for _ in range(30)]
        made = Automaton.build(templates)
        found = list(made.statistics(words))
        assert [run for _, run in found] == list(brute_statistics(words, templates))
        for end, (state, run) in enumerate(found, 1):
            places = {(t, k + run) for t, body in enumerate(templates) for k in range(len(body) - run + 1) if body[k : k + run] == words[end - run : end]}
            assert run == 0 or places <= made.ends[state]


def brute_phrases(text):
    words = WORD.findall((text or "").encode().lower())
    found = []
    for phrase, label in PHRASES.items():
        wanted = phrase.encode().split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(wanted)] == wanted]
    return len(words), sorted(found)


def test_phrases_equal_brute_force():
    rng = random.Random(5)
    pool = "gnu general public license apache mit cc by the x É 2 0".split()
    tool = Scanner()
    for _ in range(400):
        text = rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(pool) for _ in range(rng.randint(0, 40))).title()
        scan = tool.scan(text.encode())
        assert (scan.words, [(a, tool.phrase_labels[p]) for a, p in scan.phrases]) == brute_phrases(text)


def labels(text):
    tool = Scanner()
    return [(tool.template_labels[t], round(c, 2)) for _, _, t, c in tool.scan(text.encode()).spans]


def test_spans_take_the_template_that_fits_best():
    assert labels("x. Licensed under the GNU General Public License, version 3. y") == [("gpl-3.0", 1.0)]
    assert labels("Licensed under the Apache License, Version 2.0.") == [("apache-2.0", 1.0)]
    text = Scanner()
    whole = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of our software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies of the Software."
    )
    found = text.scan(whole.encode()).spans
    assert [text.template_labels[t] for *_, t, _ in found] == ["mit-text"] and found[0][3] > 0.9
    assert labels("the software is of any kind and the list of conditions") == []


def test_rows_with_nulls_clashes_and_repeats(spark):
    rows = [(1, None, "a"), (None, "MIT License", None), (2, "", "b"), (3, "x " * 5000 + "cc-by", "c"), (3, "x " * 5000 + "cc-by", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    found = scan_licenses(docs.select("doc_id", "text", "n_words")).collect()
    assert len(found) == 5
    assert sorted((r.doc_id or 0, r.n_words, [p.label for p in r.phrases]) for r in found) == [
        (0, 2, ["mit"]), (1, 0, []), (2, 0, []), (3, 5002, ["cc-by"]), (3, 5002, ["cc-by"]),
    ]
    assert scan_licenses(docs.limit(0)).count() == 0


def test_phrases_of_one_word():
    found = Scanner({"wtfpl": "wtfpl", "the end": "end"}, {}).scan(b"the wtfpl licence, wtfpl: the end")
    assert [at for at, _ in found.phrases] == [1, 3, 4]
