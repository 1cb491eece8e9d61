"""Personal data and the terms that give it away.

Base spans are e-mail addresses, IPv4 addresses, card numbers and phone numbers, found leftmost and without
overlaps per kind; positions follow from the lengths of what stands between the matches. A value found
is a protected entity, and so are all values of a kind together, which lets values that stand in one document
only speak too. Every word of a document that holds an entity, wherever it stands outside of what `BLANKED`
matches, numbers and short ones included, is a term that may disclose it. From the documents that hold the term (n), the entity (n_e) and both (k) of all N,
the share of the entity's information that the term carries is

    PMI(term; entity) / IC(entity) = 1 + log(k / n) / log(N / n_e)

which is 1 when the term stands nowhere but with the entity. A term discloses an entity if the lower
confidence bound of the share (Wilson's bound of k / n at `Z`) is at least `DISCLOSURE`, and the meeting is
no chance: by the Chernoff bound, of the corpus's V terms fewer than `CHANCE` are expected to meet the entity that
often if they did not depend on it. There is no least number of mentions: an entity of few documents needs
terms that stand with it alone.

Disclosing terms are spans of kind "term" in the documents that hold both, outside base spans.
`sanitised` generalises base spans to their kind and removes disclosing terms.

Entities that stand in the same documents meet the same terms as often, so they are counted as one. Entities
that could not pass the chance bound with any term are left out beforehand. Patterns use possessive repetition and
anchored starts, which give the same matches and take linear time on long runs.

Defined results: a null or empty text has no spans; rows equal in doc_id, text, lang and source hold an
entity once and get equal results, N and n count all rows; a null doc_id is a document like any other; an
empty table gives no rows. Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotlake.llm import common

KINDS = ("email", "ip", "card", "phone", "term")
TERM = KINDS.index("term")
# Possessive forms of the contract's patterns. A start inside a run that already failed cannot match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What is blanked before terms are read: matches, of cards those of as many digits as a card has at least.
BLANKED = PATTERNS | {"card": r"[0-9](?:[\x20-]?[0-9]){13,}+"}
# Any match of the pattern has one of these.
GATES = {
    "email": lambda text: text.contains("@"),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda text: text.contains("+"),
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

WORD = TOKEN[:-1]  # a character of a term
DISCLOSURE = 0.7  # share of an entity's information
Z = 1.645  # one-sided confidence of 95 %
CHANCE = 0.05  # terms expected to meet an entity by chance


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.transform(
            F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""),
            lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(
                2 * d.cast("int") - F.when(d.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))),
        ),
        F.lit(0), lambda a, d: a + d,
    )
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = F.char_length(_digits(value))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(kind == "card", F.when(digits.between(14, 19), _luhn(_digits(value))).otherwise(F.lit(False)))
        .otherwise(digits.between(10, 15))
    )


def _positions(found: DataFrame) -> DataFrame:
    """doc_id, _key, kind, start, end, value of matches, from the texts between them, once per distinct row."""
    matches = found.filter(F.size("values") > 0).select("doc_id", "_key", "kind", F.posexplode(F.transform(
        "values",
        lambda value, k: F.struct(value.alias("value"), F.char_length(F.get("gaps", k)).alias("gap")),
    )).alias("nth", "m")).select("doc_id", "_key", "kind", "nth", "m.*")
    # One shuffle of the matches serves all that follows per document.
    placed = matches.repartition("doc_id", "_key").dropDuplicates(["doc_id", "_key", "kind", "nth"])
    order = Window.partitionBy("doc_id", "_key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("value")
    end = F.sum(F.col("gap") + size).over(order)
    return placed.select("*", end.cast("long").alias("end")).select(
        "doc_id", "_key", "kind", (F.col("end") - size).cast("long").alias("start"), "end", "value")


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, _key, kind, start, end, value of every base span, once per distinct row."""
    text = docs.select("doc_id", common.content_key().alias("_key"), common.whole().alias("body"))
    found = F.array(*[
        F.when(gate(F.col("body")), F.struct(
            F.lit(kind).alias("kind"),
            F.split("body", PATTERNS[kind], -1).alias("gaps"),
            F.regexp_extract_all("body", F.lit(PATTERNS[kind]), F.lit(0)).alias("values"),
        )) for kind, gate in GATES.items()
    ])
    per_kind = text.select("doc_id", "_key", F.explode(F.array_compact(found)).alias("f")).select(
        "doc_id", "_key", "f.kind", "f.gaps", "f.values")
    return _positions(per_kind).filter(_valid(F.col("kind"), F.col("value")))


def _gated(docs: DataFrame) -> DataFrame:
    """doc_id, _key, body of the rows that could hold a base span: no text moves to find them."""
    text = docs.select("doc_id", common.content_key().alias("_key"), common.whole().alias("body"))
    return text.filter(reduce(lambda a, b: a | b, [gate(F.col("body")) for gate in GATES.values()]))


def own_terms(docs: DataFrame) -> DataFrame:
    """doc_id, _key, term: the distinct terms, outside of what is blanked, of documents that may hold an entity."""
    masked = F.col("body")
    for kind, gate in GATES.items():
        masked = F.when(gate(F.col("body")), F.regexp_replace(masked, BLANKED[kind], " ")).otherwise(masked)
    terms = F.array_distinct(common.plain_words(masked))
    return _gated(docs).select("doc_id", "_key", F.explode(terms).alias("term")).distinct()


def held_classes(spans: DataFrame, total: int, terms: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, _key, class of the entities a document holds, and class, n_entity.

    A class is what all entities of the same documents, or all of a kind, have in common.
    """
    held = spans.select("doc_id", "_key", "kind", F.xxhash64("kind", "value").alias("entity")).distinct()
    document = (F.xxhash64("doc_id", "_key"), F.xxhash64("_key", "doc_id", F.lit(1)))
    # With fewer documents not even a term that stands with the entity alone is beyond chance.
    possible = F.col("n_entity") * F.log(F.lit(float(max(total, 1))) / F.col("n_entity")) >= math.log(max(terms, 1) / CHANCE)
    entities = held.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_entity"), *[F.bit_xor(h).alias(f"h{k}") for k, h in enumerate(document)]
    ).filter(possible).withColumn("class", F.xxhash64("n_entity", "h0", "h1"))
    kinds = held.select("doc_id", "_key", "kind").distinct().withColumn("class", F.xxhash64("kind"))
    pooled = kinds.groupBy("class").agg(F.count(F.lit(1)).alias("n_entity")).filter(possible)
    members = held.join(entities, "entity").select("doc_id", "_key", "class").unionByName(
        kinds.select("doc_id", "_key", "class").join(F.broadcast(pooled.select("class")), "class").select("doc_id", "_key", "class"))
    sizes = entities.select("class", "n_entity").unionByName(pooled).groupBy("class").agg(F.max("n_entity").alias("n_entity"))
    return members.distinct(), sizes


def disclosure(k: Column, n: Column, n_entity: Column, total: int) -> Column:
    """The lower confidence bound of the share of an entity's information that a term carries."""
    p, z = k / n, Z * Z
    least = (p + z / (2 * n) - Z * F.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)
    return 1 + F.log(least) / F.log(F.lit(float(total)) / n_entity)


def beyond_chance(k: Column, n: Column, n_entity: Column, total: int, terms: int) -> Column:
    """Whether fewer than CHANCE of all terms would meet the entity so often by chance."""
    p, a = n_entity / F.lit(float(total)), k / n
    rest = F.when(k < n, (1 - a) * F.log((1 - a) / (1 - p))).otherwise(F.lit(0.0))
    return (a > p) & (n * (a * F.log(a / p) + rest) >= math.log(max(terms, 1) / CHANCE))


def term_documents(docs: DataFrame) -> DataFrame:
    """term (hash) and n, the documents that hold it, over the whole corpus."""
    return docs.select(F.explode(F.array_distinct(common.plain_words(common.whole()))).alias("w")).groupBy(
        F.xxhash64("w").alias("term")).agg(F.count(F.lit(1)).alias("n"))


def disclosing(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, _key, term: the terms of each document that disclose an entity it holds."""
    corpus = common.settled(term_documents(docs))
    total, terms = docs.count(), corpus.count()
    members, sizes = held_classes(spans, total, terms)
    members, own = common.settled(members), common.settled(own_terms(docs))
    # Documents are joined by one number; equal numbers would have to meet within one document's terms.
    number = F.xxhash64("doc_id", "_key").alias("doc")
    meetings = members.select(number, "class").join(own.select(number, "term"), "doc")
    both = meetings.groupBy("class", "term").agg(F.count(F.lit(1)).alias("k"))
    known = both.join(sizes, "class").withColumn("_term", F.xxhash64("term")).join(
        corpus.withColumnRenamed("term", "_term"), "_term")
    n = F.greatest("n", "k")
    shown = common.settled(known.filter(
        (F.col("n_entity") < total) & beyond_chance(F.col("k"), n, F.col("n_entity"), total, terms)
        & (disclosure(F.col("k"), n, F.col("n_entity"), total) >= DISCLOSURE)).select("class", "term"))
    # Only terms that disclose anything are looked for among a document's own.
    few = own.join(shown.select("term").distinct(), "term", "left_semi").select("doc_id", "_key", number, "term")
    return few.join(members.select(number, "class"), "doc").join(shown, ["class", "term"], "left_semi").select(
        "doc_id", "_key", "term").distinct()


def term_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, _key, start, end of every disclosing term outside base spans."""
    listed = disclosing(docs, spans).groupBy("doc_id", "_key").agg(F.collect_list("term").alias("terms"))
    # Longer terms need not come first: a term ends where no further character of a term follows.
    pattern = F.concat(F.lit(f"(?i)(?<!{WORD})(?:"), F.array_join(F.sort_array("terms"), "|"), F.lit(f")(?!{WORD})"))
    texts = common.join_rows(_gated(docs), listed.select("doc_id", "_key", pattern.alias("pattern")), "inner")
    found = _positions(texts.select(
        "doc_id", "_key", F.lit("term").alias("kind"), F.split("body", F.col("pattern"), F.lit(-1)).alias("gaps"),
        F.regexp_extract_all("body", F.col("pattern"), F.lit(0)).alias("values")))
    # A term that begins before a span and reaches into it, or begins inside of one, is part of it.
    both = found.select("doc_id", "_key", "start", "end", F.lit(False).alias("base")).unionByName(
        spans.select("doc_id", "_key", "start", "end", F.lit(True).alias("base")))
    order = Window.partitionBy("doc_id", "_key").orderBy("start", F.col("base").desc())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("doc_id", "_key").orderBy(
        F.col("start").desc(), F.col("base").desc()).rowsBetween(Window.unboundedPreceding, -1)
    base_end, base_start = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    marked = both.withColumns({"reached": F.max(base_end).over(before), "next": F.min(base_start).over(after)})
    free = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    return marked.filter(~F.col("base") & free).select("doc_id", "_key", "start", "end")


def all_spans(docs: DataFrame) -> DataFrame:
    """doc_id, _key, and spans: sorted (start, nth of kind, end)."""
    spans = common.settled(base_spans(docs))
    terms = term_spans(docs, spans).select("doc_id", "_key", "start", F.lit(TERM).alias("kind"), "end")
    number = F.create_map(*[F.lit(x) for k, name in enumerate(KINDS) for x in (name, k)])[F.col("kind")]
    every = spans.select("doc_id", "_key", "start", number.alias("kind"), "end").unionByName(terms)
    return every.groupBy("doc_id", "_key").agg(F.sort_array(F.collect_set(F.struct("start", "kind", "end"))).alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name in KINDS])
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """One row per document: counts per kind, base spans and all spans as text."""
    spans = all_spans(docs)
    rows = docs.select("doc_id", common.content_key().alias("_key"))
    joined = common.join_rows(rows, spans, "left").select(
        "doc_id", "_key", F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] != TERM)
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return joined.select("doc_id", *counts, _written(base).alias("base"), _written(F.col("spans")).alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """docs, all columns, with base spans generalised to their kind and disclosing terms removed."""
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", common.content_key().alias("_key"))
    joined = common.join_rows(keyed, all_spans(docs), "left")
    marks = F.array(*[F.lit("" if name == "term" else f"<{name.upper()}>") for name in KINDS])
    # What overlaps an earlier span goes with it.
    merged = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(
                F.substring(F.col("_row.text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                F.get(marks, s["kind"])))).otherwise(a["out"]).alias("out")),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col("_row.text"), (a["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    text = F.when(F.col("spans").isNotNull(), merged).otherwise(F.col("_row.text"))
    return joined.select(*[text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])


def query(spark: SparkSession, folder: str) -> DataFrame:
    return find(common.table(spark, folder, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_term")
