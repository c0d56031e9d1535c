from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

from strandline.llm.privacy import GENERALISE, POOLS, PRIOR, REMOVE, op2_privacy, private_spans, sanitise

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def odd_texts():
    rng = random.Random(9)
    bits = ["a", "b.c", "@", "x@y.zz", ".", "-", "+", " ", "1", "255", "256", "007", "4111111111111111", "4111 1111-1111 1111", "(", ")", "+1 407 555 7710", "é", "日", "_", "\n"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(1500)]


def test_entities_equal_brute_force(spark):
    texts = [*odd_texts(), None, "", "9" * 30_000, "a" * 30_000, "1.2.3.4 " * 3000, "+1" + "(" * 5000, "a@b.c " * 400]
    rows = private_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [tuple(s) for s in r.entities] == brute(texts[r.doc_id]), texts[r.doc_id]


def brute_entities(text):
    found = set()
    for start, _, end, kind in brute(text):
        value = text[start:end].lower()
        value = re.sub("[^0-9+]", "", value) if kind in ("card", "phone") else value
        pool = re.search(POOLS[kind], value)
        found |= {f"{kind}:{value}"} | ({f"{kind}~{pool.group()}"} if pool else set())
    return found


def brute_places(text):
    addresses = [m.span() for m in re.finditer(BASE["email"], text)]
    cuts = [0, *(at for span in addresses for at in span), len(text)]
    for low, high in zip(cuts[::2], cuts[1::2], strict=True):
        for m in re.finditer(r"[^\W\d_]{4,}", text[low:high]):
            yield m.group().lower(), low + m.start(), low + m.end()


def brute_terms(docs):
    """By document, its telling terms, from the definition: every entity against every term."""
    n, with_entity, with_term = len(docs), defaultdict(set), defaultdict(set)
    for row, (_, text) in enumerate(docs):
        for entity in brute_entities(text or ""):
            with_entity[entity].add(row)
        for term, *_ in brute_places(text or ""):
            with_term[term].add(row)
    found = defaultdict(dict)
    for entity, named in with_entity.items():
        usual = len(named) / n
        for term, said in with_term.items():
            both = named & said
            if both and usual < 1:
                share = math.log((len(both) + PRIOR * usual) / (len(said) + PRIOR) / usual) / -math.log(usual)
                for row in both if share >= GENERALISE else ():
                    for t, a, b in brute_places(docs[row][1]):
                        if t == term:
                            found[docs[row][0]][a, b] = max(found[docs[row][0]].get((a, b), 0), share)
    return {doc: sorted((a, b, "remove" if s >= REMOVE else "generalise") for (a, b), s in f.items()) for doc, f in found.items()}


def corpus():
    rng = random.Random(2)
    common = ["plain", "words", "stand", "here", "often", "thus"]
    docs = []
    for k in range(300):
        words = [rng.choice(common) for _ in range(rng.randint(5, 30))]
        if k < 6:
            words[2:2] = ["jane.roe@firm.org", "again"]
            words += ["far", "away", "the", "Director", "of", "zuerich"]
        if 50 <= k < 58:  # different people of one domain
            words += [f"p{k}@house.net", "thus", "Gartenhaus"]
        if k % 37 == 0:
            words.append("zuerich")
        if k == 20:
            words += ["call", "+1 407 555 7710", "soon"]
        docs.append((k, " ".join(words)))
    return docs


def test_terms_equal_brute_force(spark):
    docs = corpus()
    wanted = brute_terms(docs)
    assert {a for spans in wanted.values() for *_, a in spans} == {"remove", "generalise"}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = private_spans(frame).collect()
    assert {r.doc_id: [tuple(t) for t in r.terms] for r in rows if r.terms} == wanted
    clean = {r.doc_id: r.text for r in sanitise(frame.selectExpr("*", "'x' AS key", "1 AS spans")).collect()}
    # Words that one document only has tell of it as well, but less surely.
    assert clean[20] == docs[20][1].replace("call +1 407 555 7710 soon", "ca* <phone> so*")
    assert "<email>" in clean[0] and "Director" not in clean[0] and "<term>" in clean[0] and "zu*" in clean[0]
    assert all(clean[k] == docs[k][1] for k in range(6, 300) if k != 20 and not 50 <= k < 58)
    assert all("Gartenhaus" not in clean[k] for k in range(50, 58))  # told by their domain only


def test_given_documents_lose_terms_like_brute_force(spark, tiny):
    frame = spark.read.parquet(f"{tiny}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    found = {r.doc_id: [tuple(t) for t in r.terms] for r in private_spans(frame).collect() if r.terms}
    assert found and found == brute_terms(docs)


def test_many_marks_in_one_address_are_one(spark):
    address = "a." + "9.9.9.9." * 12 + "x@y.org"  # one address that holds twelve others
    docs = [(k, f"see {address} today" if k == 1 else f"nothing here {k}") for k in range(9)]
    clean = {r.doc_id: r.text for r in sanitise(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert "9" not in clean[1] and "org" not in clean[1] and clean[1].startswith("see <email>")


def test_query_digest_and_edges(spark, tmp_path):
    text = "to 1.2.3.4 from a@b.cd"
    rows = [(None, None), (1, text), (1, text), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(op2_privacy(spark, str(tmp_path)).collect(), key=lambda r: (r.doc_id or 0))
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.doc_id, r.n_ip, r.spans) for r in found] == [(None, 0, ""), (1, 1, "ip:3:10,email:16:22"), (1, 1, "ip:3:10,email:16:22"), (2, 0, "")]
    assert found[0].base_sha256 == empty and found[1].base_sha256 == hashlib.sha256(b"ip:3:10,email:16:22").hexdigest()
    assert private_spans(docs.limit(0)).count() == 0
