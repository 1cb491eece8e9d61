"""Lines on many sites beside a plain version."""

import random

import pytest
from pyspark.sql import functions as F

from ballotlake.llm import line_spread as L


def plain(rows, sites):
    where, keeper = {}, {}
    for doc, text, source in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\n\x0b\x0c\r"):
                where.setdefault(line, set()).update({source} - {None})
                if doc is not None:
                    keeper[line] = min(keeper.get(line, doc), doc)
    gone = {line for line, found in where.items() if len(found) >= sites}
    out = []
    for doc, text, source in rows:
        if text is None:
            out.append((doc, None, 0))
            continue
        lines = text.split("\n")
        left = [x for x in lines if x not in gone or keeper.get(x) == doc]
        out.append((doc, "\n".join(left), len(lines) - len(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("sites", [2, 4, 9])
def test_against_plain_version(spark, sites):
    dice = random.Random(sites)
    lines = [f"line {k}" for k in range(25)] + ["", "  ", "all over the place"]
    rows = []
    for doc in range(300):
        text = "\n".join(dice.choice(lines) if dice.random() < 0.5 else f"own {doc} {dice.random()}" for _ in range(dice.randint(0, 6)))
        source = dice.choice([None, *[f"s{k}" for k in range(1 + doc % 12)]])
        rows.append((doc, text if dice.random() < 0.95 else None, source))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = L.remove_spread_lines(frame, sites)
    assert sorted(((r.doc_id, r.text, r._removed) for r in found.collect()), key=str) == plain(rows, sites)


def test_lines_joined_by_shuffling(spark):
    rows = [(doc, f"all over the place\nown {doc}\nline {doc % 7}", f"s{doc % 13}") for doc in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = L.remove_spread_lines(frame, 4, few=0)
    assert sorted(((r.doc_id, r.text, r._removed) for r in found.collect()), key=str) == plain(rows, 4)


@pytest.mark.parametrize("sites, wanted", [(1, 3), (2, 3), (5, 3), (9, 5), (19, 10), (20, 10), (5000, 10)])
def test_threshold_follows_the_number_of_sites(spark, sites, wanted):
    frame = spark.range(sites * 3).select(F.concat(F.lit("s"), F.col("id") % sites).alias("source"))
    assert L.threshold(frame.unionByName(spark.createDataFrame([(None,)], "source string"))) == wanted


def test_nine_sites_lose_their_footer_line(spark):
    rows = [(doc, f"text of {doc}\nAll rights are with somebody", f"s{doc % 9}") for doc in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert L.remove_spread_lines(frame).agg(F.sum("_removed")).first()[0] == 899


def test_edge_cases(spark, odd_docs):
    more = odd_docs.unionByName(odd_docs.withColumn("source", F.lit("z")).withColumn("doc_id", F.col("doc_id") + 100))
    cut = L.stage(spark, more, "")
    assert cut.columns == more.drop("_removed").columns and cut.count() == more.count()
    removed = L.remove_spread_lines(more.drop("_removed"), 2)
    rows = {r.doc_id: r for r in removed.collect() if r.doc_id is not None}
    assert rows[1]._removed == 0 and rows[101]._removed == 1 and rows[101].text == "" and rows[101].n_chars == 0
    assert rows[107].text == "" and rows[102].text is None
    assert L.remove_spread_lines(odd_docs.limit(0)).count() == 0
