"""Byte-level BPE: whole texts to token ids and back, by the ranks of a public vocabulary.

Texts are cut into pieces before anything is merged. A piece is a contraction ('s 't 're 've 'm 'll 'd), a
run of letters, of digits or of other characters, each with the one space before it, or white space, of
which the last character is left to what follows. No regular expression does it: every character gets
its class from an array over all code points, a class and the neighbours make it one of eight symbols,
and each symbol is a function from state to state of a small automaton. The functions that compositions
of these reach are few; they are numbered, and composing two is one look-up in a square table. So the
functions of many characters are composed by a prefix scan over arrays, block beside block, and the state
before every character, with it every place where a piece begins, falls out of the scan.

A piece that is a token is that token; any other starts as its bytes, and the neighbours whose join has the
lowest rank are joined, the first of equal ones first, until no join is a token. Results are kept per
worker for short pieces, up to `CACHED` of them. With the ids, the byte offset of every token is returned;
decoding writes each token's bytes at its offset.

Defined results: a null text counts as empty, and an empty one has no tokens; doc_ids may be null or
repeat, every row has its own result; texts of any length are read in windows; an empty table gives no
rows. Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlake.llm.common import table, whole

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WINDOW = 1 << 20  # characters scanned, tokens decoded at a time
GATHER = 1 << 20  # bytes of texts taken together
CACHED, SHORT = 1 << 18, 64  # pieces kept per worker, bytes of the longest

# Classes of characters.
OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)
# Symbols: the classes (white space followed by white space or the end), a blank other than the space before
# something else, a space before something else, and apostrophes that begin a contraction of one or two letters.
L, N, O, W, END, PREFIX, ONE, TWO = range(8)
# States: nothing open, an open run of letters, digits, others or blanks, a space that waits, two or one
# letters of a contraction to come.
SHUT, IN_L, IN_N, IN_O, IN_W, WAIT, LEFT2, LEFT1 = range(8)
# White space as the tokenizers' library knows it; fixed values.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters and digits of Unicode 16, which the library knows and Python 3.13's tables do not; fixed values.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_DIGITS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
              (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, by [state, symbol]."""
    after, begins = np.zeros((8, 8), np.uint8), np.ones((8, 8), bool)
    for state in range(8):
        for symbol, run in ((L, IN_L), (N, IN_N), (O, IN_O), (W, IN_W)):
            after[state, symbol] = run
            begins[state, symbol] = state != run and (state != WAIT or symbol == W)
        after[state, END], after[state, PREFIX] = SHUT, WAIT
        for symbol, left in ((ONE, LEFT1), (TWO, LEFT2)):
            joins = state in (IN_O, WAIT)
            after[state, symbol] = IN_O if joins else left
            begins[state, symbol] = not joins
    after[LEFT2, L], after[LEFT1, L] = LEFT1, SHUT
    begins[LEFT2, L] = begins[LEFT1, L] = False
    return after, begins


AFTER, BEGINS = _automaton()


def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The functions that compositions of symbols reach: results [function, state], the product table
    [first, second], and the function of each symbol; the second eight symbols forget what came before."""
    gens = [tuple(AFTER[:, s].tolist()) for s in range(8)] + [(int(AFTER[SHUT, s]),) * 8 for s in range(8)]
    number: dict[tuple, int] = {}
    todo = list(dict.fromkeys(gens))
    while todo:
        for f in todo:
            number[f] = len(number)
        todo = list(dict.fromkeys(h for f in number for g in gens if (h := tuple(g[s] for s in f)) not in number))
    results = np.array(list(number), np.uint8)
    product = np.array([[number[tuple(g[s] for s in f)] for g in number] for f in number], np.uint8)
    return results, product, np.array([number[g] for g in gens], np.uint8)


RESULTS, PRODUCT, OF_SYMBOL = _functions()


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point, and of the one behind the last, which stands for the end of a text."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
                      np.uint8, sys.maxunicode + 1)
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_DIGITS, NUMBER)):
        for low, high in ranges:
            out[low:high + 1] = kind
    out[WHITE] = BLANK
    out[0x20] = SPACE
    return np.append(out, np.uint8(BLANK))


def symbols(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The symbol of every code point but the last two, which are there to be looked at; `first` marks
    where texts begin. Symbols at first places are those that forget."""
    here, limit = len(codes) - 2, sys.maxunicode + 1
    next1 = np.where(first[1:here + 1], limit, codes[1:here + 1])
    kind, ahead = classes()[codes[:here]], classes()[next1]
    out = np.array([O, L, N, W, W], np.uint8)[kind]
    before_more = ahead < SPACE
    out[(kind == BLANK) & before_more] = END
    out[(kind == SPACE) & before_more] = PREFIX
    marks = np.flatnonzero(codes[:here] == ord("'"))
    one, two = next1[marks], np.where(first[marks + 2], limit, codes[marks + 2])
    out[marks[np.isin(one, [ord(c) for c in "stmd"])]] = ONE
    pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    out[marks[pairs]] = TWO
    return out + 8 * first[:here].astype(np.uint8)


def scan(functions: np.ndarray) -> np.ndarray:
    """Entry i is the composition of functions 0 to i."""
    count = len(functions)
    if count <= 64:
        out = functions.copy()
        for k in range(1, count):
            out[k] = PRODUCT[out[k - 1], out[k]]
        return out
    step = min(int(count**0.5), 1024)
    blocks = count // step
    grid = np.ascontiguousarray(functions[:blocks * step].reshape(blocks, step).T)
    flat, width = PRODUCT.ravel(), np.intp(len(PRODUCT))
    for k in range(1, step):  # every block a step further
        grid[k] = flat.take(grid[k - 1] * width + grid[k])
    sums = scan(grid[-1])
    grid[:, 1:] = flat.take(sums[:-1] * width + grid[:, 1:])
    done = np.ascontiguousarray(grid.T).ravel()
    rest = scan(functions[blocks * step:])
    return np.concatenate([done, flat.take(sums[-1] * width + rest)])


def piece_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where pieces begin in the code points of texts put together; `first` marks where texts begin."""
    limit = sys.maxunicode + 1
    state, found = SHUT, []
    for low in range(0, len(codes), WINDOW):
        part, marks = codes[low:low + WINDOW + 2], first[low:low + WINDOW + 2]
        short = max(0, low + WINDOW + 2 - len(codes))
        part = np.append(part, np.full(short, limit, part.dtype))[:min(WINDOW, len(codes) - low) + 2]
        marks = np.append(marks, np.ones(short, bool))[:len(part)]
        own = symbols(part, marks)
        after = RESULTS[scan(OF_SYMBOL[own]), state]
        before = np.append(np.uint8(state), after[:-1])
        before[marks[:len(own)]] = SHUT
        found.append(np.flatnonzero(BEGINS[before, own & 7]) + low)
        state = int(after[-1])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


class Vocabulary:
    """Ranks of tokens, their bytes end to end, and the pieces merged lately, tokens among them."""

    def __init__(self, content: bytes) -> None:
        pairs = [line.split() for line in content.splitlines() if line]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.rank.values()) + 1
        tokens = [b""] * size
        for token, rank in self.rank.items():
            tokens[rank] = token
        self.length = np.array([len(token) for token in tokens], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in self.rank.items()}
        self.cache = dict(self.packed)

    def ids(self, piece: bytes) -> bytes:
        """The ids of a piece, packed as little-endian unsigned 32-bit numbers."""
        if len(piece) > SHORT:
            return self.packed.get(piece) or b"".join(map(self.packed.__getitem__, self.merge_long(piece)))
        if len(self.cache) >= CACHED:
            self.cache.clear()
            self.cache.update(self.packed)
        packed = self.cache[piece] = b"".join(map(self.packed.__getitem__, self.merge(piece)))
        return packed

    def merge(self, piece: bytes) -> list[bytes]:
        """Neighbours joined, the pair of lowest rank first, the first of equal ones: the parts that remain."""
        get, none, size = self.rank.get, len(self.length), len(piece)
        cuts = list(range(size + 1))
        ranks = [get(piece[k:k + 2], none) for k in range(size - 1)]
        while ranks and (lowest := min(ranks)) < none:
            k = ranks.index(lowest)
            del ranks[k], cuts[k + 1]
            if k < len(ranks):
                ranks[k] = get(piece[cuts[k]:cuts[k + 2]], none)
            if k:
                ranks[k - 1] = get(piece[cuts[k - 1]:cuts[k + 1]], none)
        return [piece[low:high] for low, high in zip(cuts, cuts[1:])]

    def merge_long(self, piece: bytes) -> list[bytes]:
        """The same by a queue, for pieces of any length; a join counts only while its parts are as they were."""
        rank, size = self.rank, len(piece)
        end = list(range(1, size + 1))  # of the part that begins here; 0 for none
        back = list(range(-1, size))  # where the part before the one that begins here begins
        queue = [(rank[two], k, k + 2) for k in range(size - 1) if (two := piece[k:k + 2]) in rank]
        heapq.heapify(queue)
        while queue:
            _, low, high = heapq.heappop(queue)
            middle = end[low]
            if not middle or middle >= size or end[middle] != high:
                continue
            end[low], end[middle] = high, 0
            if high < size:
                back[high] = low
                if (join := piece[low:end[high]]) in rank:
                    heapq.heappush(queue, (rank[join], low, end[high]))
            if low and (join := piece[back[low]:high]) in rank:
                heapq.heappush(queue, (rank[join], back[low], high))
        return [piece[low:high] for low, high in enumerate(end) if high]


@lru_cache(1)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def encode_texts(texts: list[bytes], words: Vocabulary) -> list[tuple[bytes, bytes]]:
    """Ids and the byte offset of each token, both packed as unsigned 32-bit numbers, of UTF-8 texts."""
    data = b"".join(texts)
    raw = np.frombuffer(data, np.uint8)
    codes = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    places = np.arange(len(raw)) if len(codes) == len(raw) else np.flatnonzero((raw & 0xC0) != 0x80)
    edges = np.cumsum([0, *map(len, texts)])
    first = np.zeros(len(codes) + 2, bool)
    first[np.searchsorted(places, edges[:-1][np.diff(edges) > 0])] = True
    starts = places[piece_starts(codes, first[:len(codes)])]
    cache, ids = words.cache, words.ids
    found: list[bytes] = []
    counts = [np.zeros(0, np.int64)]
    for low in range(0, len(starts), WINDOW):
        cuts = starts[low:low + WINDOW + 1].tolist()
        if low + WINDOW >= len(starts):
            cuts.append(len(data))
        packed = [cache.get(piece) or ids(piece) for piece in map(data.__getitem__, map(slice, cuts, cuts[1:]))]
        counts.append(np.fromiter(map(len, packed), np.int64, len(packed)) // 4)
        found.append(b"".join(packed))
    every = b"".join(found)
    length = words.length[np.frombuffer(every, "<u4")]
    offsets = np.cumsum(length) - length
    before = np.append(0, np.cumsum(np.concatenate(counts)))  # tokens before each piece
    limits = before[np.searchsorted(starts, edges)].tolist()
    return [(every[4 * a:4 * b], (offsets[a:b] - edge).astype("<u4").tobytes())
            for a, b, edge in zip(limits, limits[1:], edges.tolist())]


def decode_ids(ids: bytes, offsets: bytes, words: Vocabulary) -> bytes:
    """Each token's bytes at its offset."""
    tokens, at = np.frombuffer(ids, "<u4"), np.frombuffer(offsets, "<u4").astype(np.int64)
    if not len(tokens):
        return b""
    out = np.zeros(int(at[-1] + words.length[tokens[-1]]), np.uint8)
    for low in range(0, len(tokens), WINDOW):
        part, first = tokens[low:low + WINDOW], at[low:low + WINDOW]
        length = words.length[part]
        within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(first, length) + within] = words.bytes[np.repeat(words.start[part], length) + within]
    return out.tobytes()


COLUMNS = {"doc_id": "long", "n_bytes": "long", "ids": "binary", "offsets": "binary", "decoded": "binary"}


def _gathered(column: pa.Array) -> Iterator[list[bytes]]:
    """A column's values in order, in lists of about GATHER bytes."""
    some, size = [], 0
    for value in column:
        some.append(value.as_py())
        size += len(some[-1])
        if size >= GATHER:
            yield some
            some, size = [], 0
    if some:
        yield some


def _content(path: str) -> bytes:
    with open(path, "rb") as file:  # the vocabulary, not the data
        return file.read()


def _batch(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), list(COLUMNS)[:len(columns)])


def _schema(columns: int) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in list(COLUMNS.items())[:columns])


def _encoded(docs: DataFrame, path: str, key: str, text: str, decoded: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(_content(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shared.value)
        for batch in batches:
            row = 0
            for some in _gathered(batch.column("body")):
                both = encode_texts(some, words)
                columns = [batch.column("doc_id").slice(row, len(some)), pa.array([len(x) for x in some], pa.int64()),
                           pa.array([x for x, _ in both], pa.binary()), pa.array([y for _, y in both], pa.binary())]
                if decoded:
                    columns.append(pa.array([decode_ids(x, y, words) for x, y in both], pa.binary()))
                yield _batch(*columns)
                row += len(some)

    bodies = docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).cast("binary").alias("body"))
    return bodies.mapInArrow(run, _schema(4 + decoded))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, ids and offsets (both packed as little-endian unsigned 32-bit numbers)."""
    return _encoded(docs, path, key, text, False)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """encode() and decode() in one pass, so that ids and offsets go through one worker only."""
    return _encoded(docs, path, key, text, True)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of encode() and `decoded`, the bytes of the text."""
    shared = encoded.sparkSession.sparkContext.broadcast(_content(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shared.value)
        for batch in batches:
            row = 0
            for some in _gathered(batch.column("ids")):
                part = batch.slice(row, len(some))
                texts = [decode_ids(ids, at.as_py(), words) for ids, at in zip(some, part.column("offsets"))]
                yield _batch(*part.columns, pa.array(texts, pa.binary()))
                row += len(some)

    return encoded.select(*list(COLUMNS)[:4]).mapInArrow(run, _schema(5))


def query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    both = round_trip(table(spark, folder, "documents"), path)
    return both.select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
