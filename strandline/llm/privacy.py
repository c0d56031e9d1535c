"""Information-theoretic sanitisation of personal data, with DataFrame operations only.

Protected entities are the e-mail addresses, IP addresses, card and telephone numbers found in the
corpus, and the pools they belong to: an address's domain, a network, an issuer, a number's first
digits. A pool gives evidence where each of its members is rare. What else a document says may give an
entity away when the entity itself is taken out. How strongly term t reveals entity c is estimated from
the whole corpus by documents: the pointwise mutual information log(P(c | t) / P(c)) as a share of the
entity's information -log P(c), where P(c | t) is smoothed by ``PRIOR`` documents that have c as often
as the corpus has. The share comes close to 1 for a term found with that entity only, the more documents
show it. Terms of ``REMOVE`` or more are removed from the documents that name the entity, wherever they
stand; those of ``GENERALISE`` or more are generalised.

Nothing is gathered by entity or term: pair counts, entity counts and the document counts of terms are
grouped sums, combined before they are shuffled, and joined on their keys. A term in so many documents
that no entity could be revealed by it, were it in all of the entity's documents, is left out of the
pairs; this is exact. Terms are counted in all documents, told which by a bitmap of fixed size: it holds
the terms of documents with entities, so only cost depends on how full it is. Places of terms are looked
for in the documents that have a telling one; only spans move, and of such documents the text once.

Nulls and edge cases: a null text is empty and has no span; spans count code points, from 0, end
exclusive; overlapping finds of different kinds are all given. Documents are told apart by doc_id and
text: a repeated row counts as often as it comes and gets the same spans each time. An entity in
every document has no information to reveal. Very long texts are handled in time proportional to their
length, matches in n ** 1.34 of their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import fresh, staged, table

#: Kinds in their order: what a text must contain to be searched at all, and the pattern. Runs are
#: possessive and start at a run's first character, so a search never goes back over a long run.
KINDS = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": (r"[0-9][\x20-]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: A term: a run of at least four letters.
TERM = r"\p{L}{4,}+"
#: What an entity's pool is, by kind: the part of its value that it shares.
POOLS = {"email": "@.*", "ip": r"^[0-9]+\.[0-9]+\.", "card": "^[0-9]{6}", "phone": r"^\+[0-9]{4}"}
#: Documents' worth of the smoothing; shares from which terms are generalised, and removed.
PRIOR, GENERALISE, REMOVE = 2.0, 0.75, 0.9
#: Cells of 64 bits in the bitmap of terms.
CELLS = 1 << 17

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _folded(values: Column, fold: Callable[[Column, Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0), fold)


def _running(values: Column, fold: Callable[[Column, Column], Column] = lambda a, b: a + b, root: int = 3) -> Column:
    """For each number of an array the sum (or ``fold``) of those before it.

    Numbers are taken in blocks of about the cube root of their count, and blocks likewise.
    """

    def with_block(values: Column, block: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(values), block)
        blocks = F.transform(starts, lambda start: _folded(F.slice(values, start, block), fold))
        if root > 2:
            before = _let(blocks, lambda found: _running(found, fold, root - 1))
        else:
            before = _let(blocks, lambda found: F.transform(found, lambda _, k: _folded(F.slice(found, F.lit(1), k), fold)))
        return _let(
            before,
            lambda above: F.transform(
                values,
                lambda _, i: fold(
                    above[F.floor(i / block).cast("int")],
                    _folded(F.slice(values, F.floor(i / block).cast("int") * block + 1, i % block), fold),
                ),
            ),
        )

    def with_values(values: Column) -> Column:
        size = F.ceil(F.pow(F.size(values), F.lit(1 / root))).cast("int")
        return F.when(F.size(values) > 0, _let(size, lambda block: with_block(values, block))).otherwise(F.array().cast("array<int>"))

    return _let(values, with_values)


def _cut(text: Column, pattern: str, body: Callable[[Column, Column, Column], Column]) -> Column:
    """``body`` of the leftmost matches of ``pattern``, what lies between them, and where that starts.

    ``split`` and ``regexp_extract_all`` find the same matches; lengths give the places.
    """

    def located(found: Column, between: Column) -> Column:
        steps = F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda a, b: F.length(a) + F.length(b))
        return _let(_running(steps), lambda starts: body(found, between, starts))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(found, lambda f: _let(F.split(text, pattern, -1), lambda b: located(f, b)))


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>>: the leftmost matches."""

    def placed(found: Column, between: Column, starts: Column) -> Column:
        ends = F.transform(found, lambda value, i: starts[i] + F.length(between[i]) + F.length(value))
        return F.zip_with(
            found, ends, lambda value, end: F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"))
        )

    return _cut(text, pattern, placed)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(value, r"[\x20-]", "")

        def luhn(d: Column) -> Column:
            size = F.length(d)

            def weighed(i: Column) -> Column:  # i counts from the last digit, from 0
                digit = F.substring(d, size - i, F.lit(1)).cast("int")
                twice = digit * 2
                return F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

            summed = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), lambda a, i: a + weighed(i))
            return F.when(size.between(12, 19), summed % 10 == 0).otherwise(F.lit(False))

        return _let(digits, luhn)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _spans(text: Column) -> Column:
    """array<struct<start, rank, end, kind, value>>, in order."""

    def of_kind(rank: int, kind: str, mark: str, pattern: str) -> Column:
        found = F.filter(_matches(text, pattern), lambda m: _valid(kind, m["value"]))
        full = F.transform(
            found,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value")
            ),
        )
        return F.when(text.rlike(mark), full)

    parts = [of_kind(rank, kind, *patterns) for rank, (kind, patterns) in enumerate(KINDS.items())]
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    return F.array_sort(F.concat(*(F.coalesce(p, empty) for p in parts)))


def _places(text: Column) -> Column:
    """array<struct<term, start, end>>: the terms of a text outside its addresses, by place."""

    def outside(_: Column, between: Column, starts: Column) -> Column:
        return F.flatten(
            F.transform(
                between,
                lambda piece, i: F.transform(
                    _matches(piece, TERM),
                    lambda t: F.struct(F.lower(t["value"]).alias("term"), (t["start"] + starts[i]).alias("start"), (t["end"] + starts[i]).alias("end")),
                ),
            )
        )

    return _cut(text, KINDS["email"][1], outside)


def _terms(text: Column) -> Column:
    """array<string>: the different terms of a text outside its addresses; an empty string if there are none."""
    mark, address = KINDS["email"]
    outside = F.when(F.contains(text, F.lit(mark)), F.regexp_replace(text, address, "\n")).otherwise(text)
    found = F.regexp_extract_all(outside, F.lit(TERM), F.lit(0))
    return F.array_distinct(F.split(F.lower(F.array_join(found, " ")), " "))


def _entities(spans: Column) -> Column:
    """array<string>: the different protected entities of a text, and the pools they belong to."""

    def plain(s: Column) -> Column:
        return F.when(s["kind"].isin("card", "phone"), F.regexp_replace(s["value"], "[^0-9+]", "")).otherwise(F.lower(s["value"]))

    def pool(s: Column) -> Column:
        shared = F.lit("")
        for kind, pattern in POOLS.items():
            shared = F.when(s["kind"] == kind, F.regexp_extract(plain(s), pattern, 0)).otherwise(shared)
        return shared

    exact = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], plain(s)))
    pools = F.transform(F.filter(spans, lambda s: pool(s) != ""), lambda s: F.concat_ws("~", s["kind"], pool(s)))
    return F.array_distinct(F.concat(exact, pools))


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def find_entities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, spans, body) of every row of ``docs``; key stands for id and text, body is the text if there are spans."""
    number, body = F.col(doc_id).cast("bigint"), _text(text)
    found = docs.select(number.alias("doc_id"), _key(number, body).alias("key"), _spans(body).alias("spans"), body.alias("body"))
    return found.withColumn("body", F.when(F.size("spans") > 0, F.col("body")))


def _key(number: Column, body: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.coalesce(number.cast("string"), F.lit("-")), F.lit(":"), body).cast("binary")))


def _term_bit(term: str = "term") -> Column:
    return F.expr(f"xxhash64({term}) & {CELLS * 64 - 1}")


def _texts_with(terms: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(term, n_term): in how many documents each of ``terms`` stands, over all documents."""
    cells = terms.select(_term_bit().alias("bit")).groupBy(F.expr("bit div 64").alias("id"))
    cells = cells.agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("bits"))
    dense = docs.sparkSession.range(CELLS).join(cells, "id", "left")
    bitmap = dense.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))).alias("b"))
    bitmap = bitmap.select(F.col("b.bits").alias("bits")).scalar()
    words = docs.select(_terms(_text(text)).alias("words"))
    words = words.select(F.explode("words").alias("term")).withColumn("bit", _term_bit())
    cell = F.get(bitmap, F.expr("CAST(bit DIV 64 AS INT)"))
    likely = words.where(F.call_function("getbit", cell, F.expr("CAST(bit % 64 AS INT)")) == 1)
    return likely.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).join(terms, "term")


def mentions(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, entity, n_entity, term, n_term) per document, its entities and those of its terms that may reveal them.

    A term in n documents reveals GENERALISE of an entity in n_entity of all N documents only if n + PRIOR is
    at most n_entity ** GENERALISE * N ** (1 - GENERALISE) * (1 + PRIOR / N). Terms of a document are first held
    against the largest bound of its entities, without a row per pair.
    """
    everything = float(max(1, found.count()))
    named = found.where(F.size("spans") > 0).select("key", "body", _entities(F.col("spans")).alias("entities")).dropDuplicates(["key"])
    # A repeated row counts as often as it comes.
    times = found.where(F.size("spans") > 0).groupBy("key").agg(F.count(F.lit(1)).alias("times"))
    owned = named.join(times, "key").select("key", "times", F.explode("entities").alias("entity"))
    owned = staged(owned, "owned")
    sizes = owned.groupBy("entity").agg(F.sum("times").alias("n_entity"))
    bound = F.pow("n_entity", F.lit(GENERALISE)) * everything ** (1 - GENERALISE) * (1 + PRIOR / everything) - PRIOR
    owned = staged(owned.join(sizes, "entity").withColumn("most", bound * (1 + 1e-9)), "bounds")
    limits = owned.groupBy("key").agg(F.max("most").alias("limit"))
    said = named.select("key", F.explode(_terms(F.col("body"))).alias("term")).where("term <> ''")
    counts = staged(_texts_with(said.select("term").distinct(), docs, text), "counts")
    most = limits.agg(F.max("limit")).scalar()
    limited = named.select("key", "body").join(limits, "key")
    said = limited.select("key", "limit", F.explode(_terms(F.col("body"))).alias("term")).where("term <> ''")
    rare = said.join(counts.where(F.col("n_term") <= most), "term").where(F.col("n_term") <= F.col("limit"))
    pairs = rare.select("key", "term", "n_term").join(owned, "key").where(F.col("n_term") <= F.col("most"))
    return pairs.select("key", "times", "entity", "n_entity", "term", "n_term")


def disclosures(said: DataFrame, everything: int) -> DataFrame:
    """(entity, term, share) of the pairs where the term reveals ``GENERALISE`` of the entity's information or more."""
    pairs = said.groupBy("entity", "term").agg(
        F.sum("times").alias("n_both"), F.max("n_term").alias("n_term"), F.max("n_entity").alias("n_entity")
    )
    usual = F.col("n_entity") / F.lit(float(max(1, everything)))
    smoothed = (F.col("n_both") + PRIOR * usual) / (F.col("n_term") + PRIOR)
    share = F.when(usual < 1, F.log(smoothed / usual) / -F.log(usual)).otherwise(0.0)
    return pairs.withColumn("share", share).where(F.col("share") >= GENERALISE).select("entity", "term", "share")


def private_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, entities, terms) of every row of ``docs``.

    entities: array<struct<start, rank, end, kind>>; terms: array<struct<start, end, action>> with
    action ``remove`` or ``generalise``.
    """
    found = staged(find_entities(docs, doc_id, text), "entities")
    said = staged(mentions(found, docs, text), "mentions")
    telling = disclosures(said, found.count())
    told = said.select("key", "term", "entity").join(telling, ["entity", "term"])
    action = F.when(F.max("share") >= REMOVE, "remove").otherwise("generalise")
    told = told.groupBy("key", "term").agg(action.alias("action"))
    places = found.where("body IS NOT NULL").select("key", F.explode(_places(F.col("body"))).alias("p")).select("key", "p.*")
    terms = places.join(told, ["key", "term"]).groupBy("key")
    terms = terms.agg(F.sort_array(F.collect_set(F.struct("start", "end", "action"))).alias("terms"))
    rows = found.drop("body").join(terms, "key", "left")
    plain = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return rows.select(
        "doc_id", "key", plain.alias("entities"),
        F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,action:string>>")).alias("terms"),
    )


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every entity replaced by its kind, telling terms removed or cut to their first letters.

    Rows without a span keep their text and are not shuffled by it.
    """
    spans = private_spans(docs, doc_id, text)
    marks = F.concat(
        F.transform("entities", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("<"), s["kind"], F.lit(">")).alias("to"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["action"] == "remove", "<term>").alias("to"))),
    )
    key, told = fresh(docs, "text_key", "told")
    marked = spans.where((F.size("entities") > 0) | (F.size("terms") > 0)).select(
        F.col("key").alias(key), F.array_sort(marks).alias(told)
    ).distinct()
    letters = F.split(_text(text), "")

    def rebuilt(chars: Column) -> Column:
        """What lies before each mark, then the mark; marks that begin within an earlier one add to it."""
        ends = _running(F.transform(F.col(told), lambda m: m["end"]), lambda a, b: F.greatest(a, b))
        parts = F.zip_with(
            F.col(told), ends,
            lambda m, before: F.when(m["start"] < before, F.lit("")).otherwise(
                F.concat(
                    F.array_join(F.slice(chars, before + 1, F.greatest(m["start"] - before, F.lit(0))), ""),
                    F.coalesce(m["to"], F.concat(F.array_join(F.slice(chars, m["start"] + 1, F.lit(2)), ""), F.lit("*"))),
                )
            ),
        )
        last = F.array_max(F.transform(F.col(told), lambda m: m["end"]))
        return F.concat(F.array_join(parts, ""), F.array_join(F.slice(chars, last + 1, F.greatest(F.size(chars) - last, F.lit(0))), ""))

    same = _key(F.col(doc_id).cast("bigint"), _text(text)) == F.col(key)
    clean = F.when(F.col(told).isNotNull(), _let(letters, rebuilt)).otherwise(F.col(text))
    return docs.join(marked, same, "left").withColumn(text, clean).select(*docs.columns)


def op2_privacy(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: the entities by kind, and with them the terms that reveal them."""
    spans = private_spans(table(spark, folder, "documents"))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("entities", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    more = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), s["end"].alias("end"), F.lit("term").alias("kind")))
    return spans.select(
        "doc_id", *(count(kind) for kind in KINDS), F.sha2(told(F.col("entities")).cast("binary"), 256).alias("base_sha256"),
        told(F.array_sort(F.concat("entities", more))).alias("spans"),
    )
