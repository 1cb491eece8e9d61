"""Code lengths beside a plain version of the method; accuracy on held-out documents."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ballotlake.llm import common
from ballotlake.llm import language_ppm as P


def model_of(texts):
    rows = []
    for lang, body in texts:
        values, counts = np.unique(P.grams(np.frombuffer(P.encoded(body), np.uint8)), return_counts=True)
        rows += [(lang, int(v), int(c)) for v, c in zip(values, counts)]
    return P.build(rows)


def plain_bits(texts, lang, text):
    """Context trees as dictionaries, byte after byte."""
    trees = {}
    for name, body in texts:
        data = P.encoded(body)
        for at in range(P.ORDER, len(data)):
            if name == lang:
                for order in range(P.ORDER + 1):
                    tree = trees.setdefault(data[at - order:at], {})
                    tree[data[at]] = tree.get(data[at], 0) + 1
    total, data = 0.0, P.encoded(text)
    for at in range(P.ORDER, len(data)):
        bits = 0.0
        for order in range(P.ORDER, -1, -1):
            tree = trees.get(data[at - order:at], {})
            if not tree:
                continue
            size = sum(tree.values()) + len(tree)
            if data[at] in tree:
                bits -= math.log2(tree[data[at]] / size)
                break
            bits -= math.log2(len(tree) / size)
        else:
            bits += 8
        total += bits
    return total


def test_code_lengths_are_exact():
    dice = random.Random(1)
    text = lambda letters, n: "".join(dice.choice(letters) for _ in range(n))
    texts = [("a", text("abcé ", 400)), ("b", text("bcd\n ", 300)), ("c", "zz")]
    model = model_of(texts)
    for sample in ("abc é", text("abcd ", 50), "bcd", "z", "abz"):
        (bits,) = P.code_lengths(model, [sample])
        for k, lang in enumerate(model.languages):
            assert bits[k] == pytest.approx(plain_bits(texts, lang, sample), rel=1e-4)


def test_pieces_add_up(monkeypatch):
    model = model_of([("a", "the cat sat on the mat " * 20), ("b", "le chat est sur le tapis " * 20)])
    text = "the cat is on the tapis " * 50
    whole = P.code_lengths(model, [text, "le chat", "", text + "x"])
    alone = np.concatenate([P.code_lengths(model, [t]) for t in (text, "le chat", "", text + "x")])
    assert whole == pytest.approx(alone, rel=1e-9)
    monkeypatch.setattr(P, "CHUNK", 64)
    assert P.code_lengths(model, [text, "le chat", "", text + "x"]) == pytest.approx(whole, rel=1e-9)


def test_any_number_of_contexts_and_all_byte_values(monkeypatch):
    """More than 30,000 contexts of three bytes; texts of all 256 values, as bytes of Latin-1."""
    monkeypatch.setattr(P, "encoded", lambda text: b"\n" * P.ORDER + text.encode("latin-1"))
    dice = random.Random(3)
    body = lambda n: "".join(chr(dice.randrange(256)) for _ in range(n))
    texts = [("a", body(30_000)), ("b", body(9_000)), ("c", "".join(map(chr, range(256))) * 3)]
    model = model_of(texts)
    assert len(set(model.escape[3].code)) > 30_000 and len(set(model.seen[0].code)) == 256
    samples = [texts[0][1][500:700] + body(100), body(200), "".join(map(chr, range(256)))]
    found = P.code_lengths(model, samples)
    for row, sample in zip(found, samples):
        for k, lang in enumerate(model.languages):
            assert row[k] == pytest.approx(plain_bits(texts, lang, sample), rel=1e-5)


def test_forty_languages_stay_small():
    dice = np.random.default_rng(5)
    parts = []
    for lang in range(40):
        letters = dice.choice(256, 40, replace=False)
        syllables = dice.choice(letters, (400, 4)).astype(np.uint8)
        size = dice.integers(1, 5, 400)
        order = dice.zipf(1.3, 500_000) % 400
        data = syllables[order][np.arange(4) < size[order][:, None]]  # 1.2 MB, syllable after syllable
        values, counts = np.unique(P.grams(np.append(np.full(3, 10, np.uint8), data)), return_counts=True)
        parts.append(pa.table({"lang": [f"l{lang}"] * len(values), "gram": values.astype(np.int64), "n": counts}))
    model = P.build(pa.concat_tables(parts))
    assert len(model.languages) == 40 and model.size < 100e6 and len(set(model.seen[3].code)) > 500_000


@pytest.mark.parametrize("text, letter", [("²", False), ("½ ① Ⅷ", False), ("12_3", False), ("☃😀", False), ("ª", True), ("é", True), ("字", True), ("ʰ", True), ("ก็", True), ("็", False), ("x", True)])
def test_letters(spark, text, letter):
    assert P.has_letter(text) == letter


def test_texts_without_letters_are_undetermined(spark):
    frame = spark.createDataFrame([(k, t, "en") for k, t in enumerate(["²½", "Ⅷ ①", "some words", "12"])], "doc_id long, text string, lang string")
    model = model_of([("en", "some words here")])
    assert [r.lang_pred for r in P.predict(frame, model).orderBy("doc_id").collect()] == ["und", "und", "en", "und"]


def test_ties_go_to_the_first_language():
    model = model_of([("b", "same text"), ("a", "same text")])
    (bits,) = P.code_lengths(model, ["same"])
    assert bits[0] == bits[1] and model.languages[int(bits.argmin())] == "a"


def test_held_out_accuracy(spark, sf):
    truth = {r.doc_id: r for r in common.table(spark, sf, "documents").collect()}
    rows = P.query(spark, sf).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1}
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in held if len(truth[r.doc_id].text or "") > 20)
    assert right >= 0.98 * sum(len(truth[r.doc_id].text or "") > 20 for r in held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_teach_nothing(spark):
    rows = [(d, "aaa bbb", "train" if zlib.crc32(str(d).encode()) % 3 != 1 else "held") for d in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in P.predict(frame, P.train(frame)).collect()} == {"train"}


def test_edge_cases(spark, odd_docs):
    rows = P.predict(odd_docs, P.train(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4)} == {"und"}
    assert all(r.lang_pred != "und" for r in rows if r.doc_id in (1, 5, 6, 9))
    assert P.train(odd_docs.limit(0)) is None
    assert {r.lang_pred for r in P.predict(odd_docs, None).collect()} == {"und"}
    assert P.predict(odd_docs.limit(0), None).count() == 0
