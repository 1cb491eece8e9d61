"""The pipeline beside plain versions of its stages, on a small corpus with odd rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import test_decontaminate
import test_line_spread
import test_mixing
import test_quality_rules
import test_simhash_pivots
from ballotlake.llm import line_spread, mixing


def written(spark, folder, docs, benchmark=(), labels=()):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def corpus():
    dice = random.Random(12)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(dice.choice(vocabulary) for _ in range(n))
    items = [(k, text(30)) for k in range(6)] + [(6, None), (7, "")]
    rows = []
    for k in range(240):
        lines = [text(dice.randrange(15, 40)) for _ in range(dice.randrange(1, 4))]
        if k % 3 == 0:
            lines.append("This footer stands on many sites and says nothing at all")
        if k % 17 == 0:
            lines.insert(0, items[k % 6][1])
        rows.append((k, "\n".join(lines), dice.choice(["en", "de", None]), f"s{k % 8}" if k % 5 else "hot"))
    rows += [(300 + k, rows[k][1], "en", f"s{k % 9}") for k in range(0, 40, 3)]  # copies
    rows += [(400 + k, rows[k][1] + " last", "en", "hot") for k in range(0, 20, 7)]
    rows += [(500, None, "en", "s1"), (501, "", None, None), (502, "too short", "en", None), (503, "again " * 60, "en", "s2"),
             (None, text(50), "en", "s3"), (504, text(60), None, None)]
    return rows, items


def plain(rows, items):
    """The stages one after the other; documents as (doc_id, text, lang, source). No labels, so only the base rules reject."""
    rows = [r for r in rows if not test_quality_rules.plain(r[1])["base_failed"]]
    sites = len({r[3] for r in rows} - {None})
    limit = max(line_spread.FLOOR, min(line_spread.SITES, -(-sites // 2)))
    cut = test_line_spread.plain([(r[0], r[1], r[3]) for r in rows], limit)
    texts = {doc: text for doc, text, _ in cut}
    rows = [(r[0], texts[r[0]], r[2], r[3]) for r in rows]
    groups = test_simhash_pivots.plain_components([(r[0], test_simhash_pivots.plain_print(r[1])) for r in rows])
    rows = [r for r, group in zip(rows, groups) if group == r[0]]
    dirty = {r[0] for r in test_decontaminate.plain([(r[0], r[1]) for r in rows], items) if r[-1]}
    return [r for r in rows if r[0] not in dirty]


def test_result_is_that_of_plain_stages(spark, tmp_path):
    rows, items = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    names = ("size", "taken", "line", "fp", "_key", "words", "kept", "target", "slot", "sites")
    folder = written(spark, tmp_path, docs.withColumns({name: F.lit(3) for name in names}), items)
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    left = plain(rows, items)
    assert 0 < len(left) < len(rows) - 20 and set(found) == {r[0] for r in left}
    sizes = {}
    for doc, text, _, source in left:
        assert found[doc].size == len(text.split())
        sizes[source] = sizes.get(source, 0) + len(text.split())
    targets, taken = test_mixing.plain_targets(sizes), dict.fromkeys(sizes, 0)
    for doc, _, _, source in left:
        assert found[doc].source_size == sizes[source] and found[doc].target == pytest.approx(targets[source])
        assert found[doc].taken <= mixing.MOST * found[doc].size
        taken[source] += found[doc].taken
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= 20


@pytest.mark.parametrize("what", ["no documents", "nothing but odd rows", "no benchmark"])
def test_odd_tables(spark, tmp_path, odd_docs, what):
    docs = odd_docs.limit(0) if what == "no documents" else odd_docs
    if what == "nothing but odd rows":
        docs = docs.filter("coalesce(doc_id, 2) in (2, 3, 4)")
    items = [] if what == "no benchmark" else [(1, None), (None, "")]
    rows = corpus_pipeline.run(spark, written(spark, tmp_path, docs, items)).collect()
    wanted = {1, 5} if what == "no benchmark" else set()
    assert {r.doc_id for r in rows} == wanted and len(rows) == len(wanted)


def test_only_the_last_folder_stays(spark, tmp_path, monkeypatch):
    made = []
    scratch = corpus_pipeline.scratch
    monkeypatch.setattr(corpus_pipeline, "scratch", lambda s, name: made.append(scratch(s, name)) or made[-1])
    rows, items = corpus()
    docs = spark.createDataFrame(rows[:60], "doc_id long, text string, lang string, source string")
    corpus_pipeline.run(spark, written(spark, tmp_path, docs, items)).collect()
    there = []
    for folder in made:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        there.append(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))
    assert there == [False] * 4 + [True]
