"""Spans of personal data beside plain regular expressions; disclosure on planted cases."""

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from ballotlake.llm import common, pii

PLAIN = {
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


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def plain(text):
    found = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        found += [(m.start(), n, m.end(), kind) for m in re.finditer(pattern, text or "") if good(kind, m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def check(spark, docs):
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    for r in docs.collect():
        assert rows[r.doc_id].base == plain(r.text), r.text[:200]
        assert [rows[r.doc_id][f"n_{k}"] for k in PLAIN] == [plain(r.text).count(k + ":") for k in PLAIN]
    return rows


def test_given_documents(spark, sf):
    docs = common.table(spark, sf, "documents")
    check(spark, docs)
    found = {r.doc_id: r for r in pii.query(spark, sf).collect()}
    for r in docs.collect():
        assert found[r.doc_id].base_sha256 == hashlib.sha256(plain(r.text).encode()).hexdigest()


def test_random_texts(spark):
    dice = random.Random(7)
    parts = ["a", "b.c", "@", "@x.yz", ".", "%", "+", "-", " ", "1", "255", "256", "007", "1.2.3.4", "..", "4111 1111 1111 1111",
             "4111111111111111", "+1 (736) 555-2678", "+49 30 1234567", "é", "😀", "a@b.c%d@e.f", "a@b.c.d@e.f", "\n", "0.0.0.0.0", "3" * 15]
    texts = ["".join(dice.choice(parts) for _ in range(dice.randint(0, 30))) for _ in range(1500)]
    texts += ["1" * 3000, "1 " * 3000, "a" * 3000 + "@", "a@" + "b." * 3000 + "c", "+1" + " 2" * 3000, "1." * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn(
        "lang", F.lit("x")).withColumn("source", F.lit("y"))
    check(spark, docs)


def test_very_long_runs(spark):
    """Where the plain patterns take quadratic time or too deep a stack."""
    texts = ["1" * 200_000, "1 " * 200_000, "a" * 200_000 + "@", "a@" + "b." * 100_000 + "c", "+1" + " 2" * 100_000, "1.2.3.4 " * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' as lang", "'y' as source")
    rows = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.find(docs).collect()}
    assert rows == {0: (0, 0, 0, 0), 1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (1, 0, 0, 0), 4: (0, 0, 0, 0), 5: (0, 20_000, 0, 0)}


def test_disclosing_terms(spark):
    filler = "plain common words stand here and there"
    texts = [f"{filler} wizard{k % 3} writes to secret@mail.org about rain {k} {filler}" for k in range(6)]
    texts = [t.replace(f"wizard{k % 3}", "Zanzibar") if k < 4 else t for k, t in enumerate(texts)] + [filler + " about rain"] * 30
    docs = spark.createDataFrame([(k, t, None, "s") for k, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    at = texts[0].index("Zanzibar")
    assert f"term:{at}:{at + 8}" in rows[0].spans.split(",")
    common_at = texts[0].index("common")
    assert f"term:{common_at}" not in rows[0].spans
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert "<EMAIL>" in clean[0] and "Zanzibar" not in clean[0] and "secret" not in clean[0]
    assert clean[10] == texts[10]


def test_numbers_and_short_names_disclose(spark):
    filler = "plain common words stand here and there"
    texts = [f"{filler} Bo order A12B9 customer 40417 writes to secret@mail.org about rain {k} {filler}" for k in range(6)]
    texts += [f"{filler} order and customer writes to about rain"] * 60
    docs = spark.createDataFrame([(k, t, None, "s") for k, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert not any(term in clean[0] for term in ("Bo ", "A12B9", "40417", "secret")) and "order" in clean[0]


def frame(spark, texts):
    return spark.createDataFrame([(k, t, None, "s") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")


def test_terms_far_from_the_entity_are_found(spark):
    filler = "plain common words stand here and there and go on for quite a while so that nothing is near anything else at all in them"
    texts = [f"Zanzibar {filler} {k} {filler} secret@mail.org" for k in range(6)] + [f"{filler} {k} mail" for k in range(80)]
    clean = [r.text for r in pii.sanitised(frame(spark, texts)).orderBy("doc_id").collect()]
    assert not any("Zanzibar" in text or "secret" in text for text in clean[:6])
    assert all("quite a while" in text for text in clean)


def test_terms_in_equal_surroundings_are_found(spark):
    filler = "plain common words stand here and there"
    texts = [f"{filler} Zanzibar secret@mail.org {filler}"] * 50 + [f"{filler} {k}" for k in range(400)]
    rows = pii.find(frame(spark, texts)).collect()
    assert all((r.n_term == 1) == (r.doc_id < 50) for r in rows)


def test_a_kind_is_disclosed_by_what_stands_with_its_values_only(spark):
    filler = "plain common words stand here and there"
    texts = [f"{filler} hotline{'' if k % 2 else ' x'} {k} +49 30 1{k:06d}" for k in range(40)] + [f"{filler} {k}" for k in range(400)]
    rows = {r.doc_id: r for r in pii.find(frame(spark, texts)).collect()}
    at = texts[1].index("hotline")
    assert rows[1].n_phone == 1 and rows[1].spans.split(",")[0] == f"term:{at}:{at + 7}"
    assert all(rows[k].n_term == 0 for k in range(40, 440))


def plain_terms(texts):
    """Terms by document, from the definitions."""
    word = re.compile(pii.TOKEN)
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    tokens = [{lower(w) for w in word.findall(t)} for t in texts]
    held = {}
    own = []
    for k, text in enumerate(texts):
        for kind, pattern in PLAIN.items():
            for m in re.finditer(pattern, text):
                if good(kind, m[0]):
                    held.setdefault((kind, m[0]), set()).add(k)
                    held.setdefault(kind, set()).add(k)
        masked = text
        for pattern in (PLAIN | {"card": r"[0-9]([\x20-]?[0-9]){13,}"}).values():
            masked = re.sub(pattern, " ", masked)
        own.append({lower(w) for w in word.findall(masked)})
    total, vocabulary = len(texts), len(set().union(*tokens))
    found = [set() for _ in texts]
    for documents in held.values():
        for term in set().union(*(own[d] for d in documents)):
            k, n, n_e = sum(term in own[d] for d in documents), sum(term in t for t in tokens), len(documents)
            if not n:
                continue  # what blanking left of a word
            n = max(n, k)
            a, p = k / n, n_e / total
            if n_e == total or a <= p:
                continue
            far = n * (a * math.log(a / p) + ((1 - a) * math.log((1 - a) / (1 - p)) if k < n else 0))
            z = pii.Z**2
            least = (a + z / (2 * n) - pii.Z * math.sqrt(a * (1 - a) / n + z / (4 * n * n))) / (1 + z / n)
            if vocabulary * math.exp(-far) <= pii.CHANCE and 1 + math.log(least) / math.log(total / n_e) >= pii.DISCLOSURE:
                for d in documents:
                    found[d] |= {term} & own[d]
    out = []
    for text, terms in zip(texts, found):
        taken = [(m.start(), m.end()) for kind, pattern in PLAIN.items() for m in re.finditer(pattern, text) if good(kind, m[0])]
        out.append([(m.start(), m.end()) for m in word.finditer(text) if lower(m[0]) in terms
                    and not any(a < m.end() and m.start() < b for a, b in taken)])
    return out


def test_terms_are_those_of_the_definitions(spark):
    dice = random.Random(11)
    vocabulary = [f"w{k}" for k in range(50)] + ["Ärger", "A1", "é2"]
    people = [(f"Name{k}", f"u{k}.name{k}@mail.org", f"10.0.{k}.7", f"order{k}") for k in range(12)]
    texts = []
    for k in range(400):
        words = [dice.choice(vocabulary) for _ in range(dice.randrange(3, 25))]
        if dice.random() < 0.4:
            person = people[min(dice.randrange(20), 11)]
            words[1:1] = [w for w in (*person, "reach", person[0].upper(), "é" + person[0]) if dice.random() < 0.7]
            dice.shuffle(words)
        texts.append(" ".join(words) + dice.choice(["", ".", " 😀"]))
    rows = {r.doc_id: r for r in pii.find(frame(spark, texts)).collect()}
    wanted, number = plain_terms(texts), 0
    for k in range(len(texts)):
        got = [tuple(map(int, s.split(":")[1:])) for s in rows[k].spans.split(",") if s.startswith("term")]
        assert got == wanted[k], texts[k]
        number += len(got)
    assert number > 100


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(None, "me@x.org", None, None), (None, None, None, None), (1, "", "en", "s"), (1, "", "en", "s"),
         (2, "me@x.org and 1.2.3.4", "en", "s"), (2, "me@x.org and 1.2.3.4", "en", "s")],
        "doc_id long, text string, lang string, source string",
    ).withColumn("kind", F.lit(1)).withColumn("spans", F.lit(2)).withColumn("value", F.lit(3))
    rows = sorted((r.doc_id or 0, r.n_email, r.base) for r in pii.find(docs).collect())
    assert rows == [(0, 0, ""), (0, 1, "email:0:8"), (1, 0, ""), (1, 0, ""),
                    (2, 1, "email:0:8,ip:13:20"), (2, 1, "email:0:8,ip:13:20")]
    assert pii.find(docs.limit(0)).count() == 0
    assert pii.sanitised(docs).columns == docs.columns
