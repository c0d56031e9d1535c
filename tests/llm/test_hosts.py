from __future__ import annotations

import random
import re
from collections import Counter

from strandline.llm.hosts import host_rates, judge, measure, measures


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    repeated = {p for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) for line in text.split("\n"))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), lines


def test_measures_equal_brute_force():
    rng = random.Random(1)
    bits = ["a", "b", "É日", "#", " ", "\n", "\t", "\x0b", "\x1c", "\u00a0", "x<y", "  "]
    for n in [*range(40)] * 40 + [3000]:
        text = "".join(rng.choice(bits) for _ in range(n))
        assert measures(text.encode()) == brute(text)


def test_host_rates_and_verdicts(spark):
    good, bad = " ".join(f"word{k}" for k in range(60)), "too short"
    rows = []
    for h in range(12):  # usual hosts
        rows += [(None, bad if k % 10 == 0 else good, f"h{h}", 1) for k in range(40)]
    rows += [(1, bad, "farm", 1)] * 30 + [(2, good, "farm", 1)] * 4 + [(3, bad, "new", 1), (4, good, None, 1), (5, None, "h1", 1), (6, "", None, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, rate int")
    rates = {r.host: r for r in host_rates(measure(frame)).collect()}
    assert rates["farm"].rejected and rates["farm"].rate > 0.6
    assert not rates["new"].rejected and rates["new"].rate < 1  # one failed document proves little
    assert not rates["h1"].rejected
    found = judge(frame).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.kept == (not r.base_failed and r.host != "farm")
        assert (r.host_rate is None) == (r.host is None)
    assert judge(frame.limit(0)).count() == 0


def test_hosts_out_of_line_lose_documents_that_pass_the_base_rules(spark):
    plain = [f"word{k}" for k in range(60)]
    signs = " ".join([*plain, "$$$$ %%%%"])  # passes the base rules
    lines = "\n".join([" ".join(plain), *["the same line"] * 2, *["another one"] * 2])
    long = " ".join(f"{'x' * 12}{k}" for k in range(60))
    rows, clean = [], " ".join(plain)
    for h in range(10):
        rows += [(k, signs if k % 10 == 0 else clean, f"h{h}") for k in range(100)]
    for name, body in (("signs", signs), ("lines", lines), ("long", long)):
        rows += [(k, clean if k % 10 == 0 else body, name) for k in range(100)]
    found = judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert not any(r.base_failed for r in found)
    assert {r.host for r in found if not r.kept} == {"signs", "lines", "long"}
    assert all(r.kept == r.host.startswith("h") for r in found)


def test_one_host_is_in_line(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, source string")
    good = " ".join(f"word{k}" for k in range(60))
    alike = judge(spark.createDataFrame([(1, good, "only")], frame.schema)).collect()
    assert alike[0].kept
