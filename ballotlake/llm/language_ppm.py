"""Language identification by prediction by partial matching over bytes.

For each language a tree of byte contexts up to length `ORDER` is counted on labelled documents and then
frozen. A byte's code length is that of its longest context seen in training: seen there, count over
count plus distinct; not seen, an escape (distinct over the same total) and the next shorter context, down
to equal chances for all 256 bytes. The language with the shortest code for the whole text wins; the score
is its share of the probability.

The trees are sparse: for every length the contexts seen, and the contexts with a byte, are sorted numbers,
each with the languages that have it and their code lengths. Nothing that was seen is dropped, and the model
grows with what was seen, not with languages times contexts. Texts are scored many at a time: the distinct
runs of `ORDER` + 1 bytes in them are looked up once, and every text adds up the lengths of its own.

The training sample is bounded: of each language the `SAMPLE` documents with the smallest hash of
doc_id, counted in Spark. Every text is predicted whole.

Defined results: a null text or one without a letter is `und` with score 0, as are all texts when nothing
could be learned; rows without doc_id or lang teach nothing and are not held out; equal texts get equal
predictions; ties go to the first language by name; an empty table gives no rows. Further columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotlake.llm import common

ORDER = 3  # bytes of context
SAMPLE = 400  # documents per language
FOLD, HELD = 3, 1
CHUNK = 1 << 20  # bytes times languages scored at a time
_ASCII_LETTER = re.compile("[A-Za-z]")


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLD))


def encoded(text: str) -> bytes:
    """What is counted and scored: lower-cased, as UTF-8, after a line start."""
    return b"\n" * ORDER + text.lower().encode("utf-8", "surrogatepass")


def grams(data: np.ndarray) -> np.ndarray:
    """Every byte with its ORDER predecessors, as one number."""
    wide = data.astype(np.uint32)
    total = wide[ORDER:].copy()
    for back in range(1, ORDER + 1):
        total |= wide[ORDER - back:len(data) - back] << np.uint32(8 * back)
    return total


def learned(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """lang, gram, n over the sample of labelled documents outside the held-out fold."""
    train = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != HELD)).select(
        "lang", "text", F.xxhash64("doc_id").alias("draw"))
    # At most `sample` narrow rows per task and language leave their task.
    order = Window.partitionBy("lang").orderBy("draw")
    limits = train.select("lang", "draw").select("*", F.row_number().over(order).alias("nth")).filter(
        F.col("nth") <= sample).groupBy("lang").agg(F.max("draw").alias("last"))
    known = {row["lang"]: row["last"] for row in limits.collect()}  # a row per language
    if not known:
        return docs.sparkSession.createDataFrame([], "lang string, gram long, n long")
    last = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    chosen = train.filter(F.col("draw") <= last[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found.setdefault(lang, []).append(grams(np.frombuffer(encoded(text), np.uint8)))
            for lang, parts in found.items():
                values, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values, pa.int64()), pa.array(counts, pa.int64())],
                    ["lang", "gram", "n"])

    return chosen.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def has_letter(text: str) -> bool:
    """Whether a character is of a Unicode letter category."""
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, set(text)))


@dataclass
class Sparse:
    """Codes in order, as often as languages have them, with a language and a length each."""

    code: np.ndarray
    lang: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, code: np.ndarray, lang: np.ndarray, bits: np.ndarray) -> Sparse:
        """Of entries sorted by code."""
        return cls(code.astype(np.uint32), lang.astype(np.min_scalar_type(lang.max(initial=0))), bits.astype(np.float32))

    def entries(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in codes, languages and lengths of all entries of the codes."""
        low = np.searchsorted(self.code, codes)
        size = np.searchsorted(self.code, codes, "right") - low
        before = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(low - before, size)
        return np.repeat(np.arange(len(codes)), size), self.lang[place], self.bits[place]


@dataclass
class Model:
    languages: list[str]
    seen: list[Sparse]  # by length of the context: context and byte, code length
    escape: list[Sparse]  # by length of the context: context, length of the escape

    @property
    def size(self) -> int:
        """Bytes of all tables."""
        return sum(a.nbytes for part in (*self.seen, *self.escape) for a in (part.code, part.lang, part.bits))

    def lengths(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Code x language: bits of the last byte of each code after the `order` bytes before it."""
        codes = codes.astype(np.uint32)
        if order < 0:
            return np.full((len(codes), len(self.languages)), 8.0)
        shorter, inverse = np.unique(codes & np.uint32((1 << 8 * order) - 1), return_inverse=True)
        out = self.lengths(shorter, order - 1)[inverse]
        place, lang, bits = self.escape[order].entries(codes >> np.uint32(8))
        out[place, lang] += bits
        place, lang, bits = self.seen[order].entries(codes)
        out[place, lang] = bits
        return out


def _sums(code: np.ndarray, lang: np.ndarray, count: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of counts by (code, language), sorted: the codes, languages and sums."""
    both, place = np.unique(code.astype(np.int64) * languages + lang, return_inverse=True)
    return both // languages, both % languages, np.bincount(place, count)


def build(rows: pa.Table | list[tuple[str, int, int]]) -> Model | None:
    """The frozen model from (lang, gram, n)."""
    if not isinstance(rows, pa.Table):
        rows = pa.table({name: [row[k] for row in rows] for k, name in enumerate(("lang", "gram", "n"))})
    if not rows.num_rows:
        return None
    languages = sorted(rows.column("lang").unique().to_pylist())
    lang = pc.index_in(rows.column("lang"), pa.array(languages)).to_numpy().astype(np.int64)
    gram, count = (rows.column(name).to_numpy().astype(np.int64) for name in ("gram", "n"))
    # A gram has its last byte lowest, the byte before it next, and so on.
    seen, escape = [], []
    for order in range(ORDER + 1):
        code, langs, sums = _sums(gram & ((1 << 8 * (order + 1)) - 1), lang, count, len(languages))
        context, owner, total = _sums(code >> 8, langs, sums, len(languages))
        distinct = _sums(code >> 8, langs, np.ones(len(code)), len(languages))[2]
        mine = np.searchsorted(context * len(languages) + owner, (code >> 8) * len(languages) + langs)
        seen.append(Sparse.of(code, langs, -np.log2(sums / (total + distinct)[mine])))
        escape.append(Sparse.of(context, owner, -np.log2(distinct / (total + distinct))))
    return Model(languages, seen, escape)


def code_lengths(model: Model, texts: list[str]) -> np.ndarray:
    """Text x language: bits of the whole text."""
    total = np.zeros((len(texts), len(model.languages)))
    step = max(1, CHUNK // len(model.languages))
    waiting: list[tuple[int, np.ndarray]] = []
    size = 0

    def add() -> None:
        """The pieces that wait, each of one text."""
        distinct, inverse = np.unique(np.concatenate([part for _, part in waiting]), return_inverse=True)
        starts = np.cumsum([0, *(len(part) for _, part in waiting)])[:-1]
        np.add.at(total, [text for text, _ in waiting], np.add.reduceat(model.lengths(distinct)[inverse], starts, axis=0))

    for number, text in enumerate(texts):
        codes = grams(np.frombuffer(encoded(text), np.uint8))
        for low in range(0, len(codes), step):
            waiting.append((number, codes[low:low + step]))
            size += len(waiting[-1][1])
            if size >= step:
                add()
                waiting, size = [], 0
    if waiting:
        add()
    return total


def _gathered(column: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    """Rows whose text has a letter, with the texts, in lists of about CHUNK characters."""
    rows, texts, size = [], [], 0
    for row, value in enumerate(column):
        text = value.as_py()
        if text is None or not has_letter(text):
            continue
        rows.append(row)
        texts.append(text)
        size += len(text)
        if size >= CHUNK:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            names, scores = ["und"] * batch.num_rows, [0.0] * batch.num_rows
            for rows, texts in _gathered(batch.column("text")) if own else ():
                bits = code_lengths(own, texts)
                best = bits.argmin(axis=1)
                shares = 1.0 / np.exp2(np.maximum(bits[np.arange(len(rows)), best][:, None] - bits, -1000.0)).sum(axis=1)
                for row, lang, share in zip(rows, best.tolist(), shares.tolist()):
                    names[row], scores[row] = own.languages[lang], share
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(fold() == HELD, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), held, F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def train(docs: DataFrame) -> Model | None:
    """The model of the sample: what comes to the driver are the sample's runs of bytes and their counts."""
    return build(learned(docs).toArrow())


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    return predict(docs, train(docs))
