"""Hits beside a plain version, in one and in several blocks."""

import hashlib
import random
import re

import pytest

from ballotlake.llm import common
from ballotlake.llm import decontaminate as D


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, size=13):
    windows = {}
    for item, text in items:
        words = tokens(text)
        for k in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[k:k + size]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = tokens(text), set(), set()
        for length in lengths:
            for k in range(len(words) - length + 1):
                owners = windows.get(tuple(words[k:k + length]))
                if owners:
                    hit.update(range(k, k + length))
                    found |= owners
        names = ",".join(sorted(found))
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


def ours(docs, bench, **options):
    rows = D.contamination(docs, bench, **options).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(),
                    r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in rows), key=str)


def test_query_equals_plain_version(spark, sf):
    docs = [(r.doc_id, r.text) for r in common.table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in common.table(spark, sf, "benchmark").collect()]
    found = sorted((tuple(r) for r in D.query(spark, sf).collect()), key=str)
    assert found == plain(docs, items) and any(r[-1] for r in found)


@pytest.mark.parametrize("block", [7, 100_000])
def test_random_texts(spark, block):
    dice = random.Random(11)
    vocabulary = ["the", "of", "Ä", "x1", "rare", "Word", "b", "c", "ß", "99"]
    text = lambda n: dice.choice([" ", "-", "\n"]).join(dice.choice(vocabulary) for _ in range(n))
    items = [(dice.choice([None, k, 3]), text(dice.choice([0, 1, 2, 5, 13, 14, 20]))) for k in range(25)] + [(77, None), (78, "... !")]
    docs = []
    for k in range(120):
        parts = [text(dice.randint(0, 25)) for _ in range(3)]
        parts.insert(dice.randint(0, 3), dice.choice(items)[1] or "")
        docs.append((k, " ".join(parts)))
    docs += [(200, None), (201, ""), (202, "the")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'l' as lang", "'s' as source")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert ours(frame, bench, size=5, block_size=block) == plain(docs, items, 5)


@pytest.mark.parametrize("block", [3, 40, 100_000])
def test_the_corpus_is_read_twice_for_any_benchmark(spark, tmp_path, block):
    text = " ".join(f"word{k}" for k in range(100))
    spark.createDataFrame([(k, text) for k in range(50)], "doc_id long, text string").selectExpr("*", "'l' as lang", "'s' as source").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    windows = D.windows(spark.createDataFrame([(1, text), (2, "word5 word6 word7")], "item_id long, text string"))[0]
    counts = D.rare_first(windows, docs, block)
    near = D._near(docs, common.settled(counts), 13, windows.count() <= block)
    plans = [df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet") for df in (counts, near)]
    assert plans == [1, 1]
    bench = spark.createDataFrame([(1, text), (2, "word5 word6 word7")], "item_id long, text string")
    assert {tuple(r) for r in D.contamination(docs, bench, block_size=block).select("n_words", "n_hit").collect()} == {(100, 100)}


def test_edge_cases(spark, odd_docs, tmp_path):
    bench = spark.createDataFrame([(1, "plain words stand here one after the other so that there is enough of them"), (None, "no id HERE"), (2, None)],
                                  "item_id long, text string").selectExpr("*", "1 as tokens", "2 as window", "3 as spot")
    rows = {(r.doc_id, r.n_words): r for r in D.contamination(odd_docs, bench).collect()}
    assert rows[(1, 23)]["items"] == ["1"] and rows[(None, 3)]["items"] == [""] and rows[(2, 0)].n_hit == 0
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = D.stage(spark, odd_docs, str(tmp_path))
    assert clean.columns == odd_docs.columns
    assert sorted((r.doc_id or 0) for r in clean.collect()) == [0, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert D.contamination(odd_docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert D.contamination(odd_docs.limit(0), bench).count() == 0
