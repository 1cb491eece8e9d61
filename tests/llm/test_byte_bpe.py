"""Pieces, merges and ids beside the tokenizers' library; round trips."""

import random

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken

from ballotlake.llm import byte_bpe as B
from ballotlake.llm import common

PATH = public.path(B.VOCABULARY)
# What the pattern treats in a way of its own, and neighbours of it.
BITS = ["'", "'s", "'re", "'ll", "'ve", "'d", "v", "e", "l", "s", "t", "R", "'S", " ", "  ", "\n", "\t", " ", "　", " ",
        "a", "é", "日", "1", "²", "Ⅷ", "½", "!", "!!", "_", "😀", "é", "​", "\x00", "\x1c", "\x85", "ก", "ǅ", "\U00010d40", "\U00013460"]


@pytest.fixture(scope="module")
def words():
    with open(PATH, "rb") as file:
        return B.Vocabulary(file.read())


@pytest.fixture(scope="module")
def library(words):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=words.rank, special_tokens={})


def check(texts, words, library):
    for text, (ids, offsets) in zip(texts, B.encode_texts([t.encode() for t in texts], words), strict=True):
        numbers = np.frombuffer(ids, "<u4").tolist()
        assert numbers == library.encode_ordinary(text), text[:80]
        lengths = [len(library.decode_single_token_bytes(n)) for n in numbers]
        assert np.frombuffer(offsets, "<u4").tolist() == [sum(lengths[:k]) for k in range(min(len(lengths), 200))] + \
            np.frombuffer(offsets, "<u4").tolist()[200:]
        assert B.decode_ids(ids, offsets, words) == text.encode()


def test_ids_of_random_texts(words, library):
    dice = random.Random(1)
    check(["".join(dice.choice(BITS) for _ in range(dice.randrange(0, 16))) for _ in range(6000)], words, library)


def test_long_pieces_and_long_texts(words, library):
    dice = random.Random(2)
    texts = ["a" * 5000, " " * 3000 + "x", "'" * 999 + "s", "xyz" * 50_000, "".join(dice.choice(BITS) for _ in range(100_000))]
    check(texts, words, library)


def test_windows_hand_on_their_state(words, library, monkeypatch):
    dice = random.Random(3)
    texts = ["".join(dice.choice(BITS) for _ in range(300)) for _ in range(60)] + [""]
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(B, "WINDOW", size)
        check(texts[:4] if size < 7 else texts, words, library)


def test_scan_composes_in_order():
    dice = np.random.default_rng(4)
    for count in (0, 1, 63, 64, 65, 1000, 4097):
        own = B.OF_SYMBOL[dice.integers(0, 16, count)]
        got, state = B.scan(own), np.arange(8)
        for k in range(count):
            state = B.RESULTS[own[k]][state]
            assert (B.RESULTS[got[k]] == state).all()


def test_product_table_is_associative():
    table = B.PRODUCT
    assert (table[table[:, :, None], np.arange(len(table))] == table[np.arange(len(table))[:, None, None], table]).all()


def test_classes_are_those_of_the_library():
    single = {bytes([b]): b for b in range(256)}
    for prefix, kind in ((b"a", B.LETTER), (b"1", B.NUMBER), (b"!", B.OTHER)):
        ranks = single | {prefix + bytes([b]): 256 + b for b in range(256)}
        probe = tiktoken.Encoding("probe", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for code in [*range(0xD800), *range(0xE000, 0x20000)]:
            text = prefix.decode() + chr(code)
            assert (len(probe.encode_ordinary(text)) < len(text.encode())) == (B.classes()[code] == kind), hex(code)


def test_both_ways_of_merging_agree(words):
    dice = random.Random(6)
    for _ in range(2000):
        piece = bytes(dice.choice(b"abetionsr \xc3\xa9") for _ in range(dice.randrange(1, 60)))
        if piece not in words.rank:
            assert words.merge(piece) == words.merge_long(piece)


def test_cache_is_bounded(words, library, monkeypatch):
    monkeypatch.setattr(B, "CACHED", len(words.packed) + 10)
    check([" ".join(f"qz{k}xv" for k in range(500))], words, library)
    assert len(words.cache) <= len(words.packed) + 10


def test_query(spark, sf, library):
    import hashlib

    docs = {r.doc_id: (r.text or "") for r in common.table(spark, sf, "documents").collect()}
    rows = B.query(spark, sf).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def test_edge_cases(spark, odd_docs):
    texts = sorted((r.text or "") for r in odd_docs.collect())
    both = B.decode(B.encode(odd_docs, PATH), PATH)
    rows = both.collect()
    assert sorted(bytes(r.decoded).decode() for r in rows) == texts
    assert all(len(r.ids) == len(r.offsets) and r.n_bytes == len(r.decoded) for r in rows)
    assert {len(r.ids) for r in rows if r.doc_id in (2, 3)} == {0}
    assert sorted(map(tuple, B.round_trip(odd_docs, PATH).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert B.encode(odd_docs.limit(0), PATH).count() == 0
