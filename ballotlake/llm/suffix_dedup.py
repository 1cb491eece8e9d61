"""Removal of long byte strings that also start in a document with a smaller doc_id.

A byte goes when it is covered by `MATCH` bytes that also start in an earlier document. Windows of `MATCH`
bytes are compared exactly, with suffix arrays over everything that could repeat:

1. Anchors. In every window the gram of `GRAM` bytes with the smallest hash is its anchor, so equal
   windows have equal anchors, and each window has one. Anchors found in two different texts at least are
   worth looking at; all other windows are unique.
2. Pieces. The bytes of each such anchor's windows go to the shard of the anchor's hash. Equal pieces are
   one piece there, and an anchor with a single piece is settled by that.
3. Suffix arrays. A shard's pieces are sorted by induced sorting and their common prefixes computed, about `SLICE`
   bytes of whole anchors at a time; windows next to each other in suffix order that share `MATCH` bytes or
   more are equal, and the smallest doc_id among them decides.
4. Hot anchors, seen in more than `HOT` texts of one batch or `MANY` in all, are dealt out to several shards; the
   windows that are a shard's first ones meet once more, dealt by a hash of their bytes, and the smallest
   doc_id over all shards decides.
5. The windows to remove become spans per text, which are cut out.

Texts are told apart by a number of theirs; copies of a text other than the first lose all of it at once. The
number is a 64-bit hash; where two texts with different SHA-256 share one (about n^2 / 2^65 pairs), theirs are
hashed anew, so that no text is taken for another. Rows travel as packed arrays, one for each shard and
batch, so that anchors cost a few bytes each; there are more shards than reduce tasks where a shard would
get more than `SHARD` bytes of text. So what a worker holds does not grow with the corpus or the size of its tasks.

Defined results: a null text is empty; texts shorter than `MATCH` bytes keep everything; rows with the same
doc_id do not remove anything from each other; a null doc_id counts as larger than all others, and such
rows keep what they share only with each other; an empty table gives no rows. Further columns of the input
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlake.llm import common
from ballotlake.llm.suffixes import repeats_previous, suffix_array

MATCH = 50  # bytes
GRAM = 20  # bytes
HOT = 64  # texts of a batch that share an anchor
MANY = 1 << 12  # texts of all batches that share an anchor
SPREAD = 64  # shards a hot anchor is dealt to
SHARD = 16 << 20  # bytes of text for each shard, at most
FLUSH = 8 << 20  # bytes of text whose anchors travel together
SLICE = 2 << 20  # bytes of pieces sorted together
LOT = 1 << 18  # windows of hot anchors packed together
LOAD = 2 << 20  # bytes that go to a worker or come from it together
LAST = (1 << 63) - 1  # stands for a null doc_id
STEP = 1 << 16  # bytes hashed at a time
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_RIGHTMOST = np.uint64(0xFFFFFFFF) - np.arange(STEP + 4096, dtype=np.uint64)
ANCHOR = np.dtype([("code", "<u8"), ("text", "<i8"), ("low", "<u4"), ("number", "u1"), ("hot", "u1")])
SPAN = np.dtype([("text", "<i8"), ("low", "<u4"), ("high", "<u4")])
WINDOW = np.dtype([("one", "<u8"), ("two", "<u8"), ("doc", "<i8"), ("text", "<i8"), ("low", "<u4")])


def _pack(rows: np.ndarray) -> bytes:
    """Column after column, compressed."""
    columns = b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names)
    return zstandard.ZstdCompressor(level=1).compress(len(rows).to_bytes(8, "little") + columns)


def _unpacked(packed: list[bytes], kind: np.dtype) -> tuple[np.ndarray, list[int]]:
    """The rows of all packs, and how many each has."""
    raws = [zstandard.ZstdDecompressor().decompress(data) for data in packed]
    numbers = [int.from_bytes(raw[:8], "little") for raw in raws]
    rows, at = np.empty(sum(numbers), kind), [8] * len(raws)
    for name in kind.names:
        ends = [low + kind[name].itemsize * number for low, number in zip(at, numbers)]
        rows[name] = np.frombuffer(b"".join([raw[low:high] for raw, low, high in zip(raws, at, ends)]), kind[name])
        at = ends
    return rows, numbers


def _unpack(data: bytes, kind: np.dtype) -> np.ndarray:
    return _unpacked([data], kind)[0]


def _rows(group: pa.Table, kind: np.dtype) -> np.ndarray:
    """The rows of a shard, unpacked pack by pack."""
    packed = [data.as_buffer() for data in group.column("data")]
    ends = np.cumsum([(zstandard.frame_content_size(data) - 8) // kind.itemsize for data in packed], dtype=np.int64)
    rows, low = np.empty(int(ends[-1]) if len(ends) else 0, kind), 0
    for data, high in zip(packed, ends.tolist()):
        rows[low:high] = _unpack(data, kind)
        low = high
    return rows


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every run of `gram` bytes, from hashes of runs of powers of two."""
    hashes, length = data.astype(np.uint64) * _ODD[0] + _ODD[1], 1
    level, parts = 0, []
    rest = gram
    while rest:
        if rest & 1:
            parts.append((hashes, length))
        rest >>= 1
        if rest:
            wider = hashes[:-length] * _ODD[level % 5]
            wider += hashes[length:]
            hashes, length, level = wider, length * 2, level + 1
    count, at = len(data) - gram + 1, 0
    total = np.zeros(count, np.uint64)
    for part, size in parts:
        total = (total ^ (total >> np.uint64(31))) * _ODD[2] + part[at:at + count]
        at += size
    total ^= total >> np.uint64(33)
    total *= _ODD[3]
    return total ^ (total >> np.uint64(29))


def _inside(lengths: np.ndarray, size: int) -> np.ndarray:
    """Of texts one after another: the places from which `size` bytes are of one text."""
    number = np.maximum(lengths - size + 1, 0)
    starts = np.cumsum(lengths) - lengths
    return np.arange(number.sum()) + np.repeat(starts - (np.cumsum(number) - number), number)


def _anchors_of(data: np.ndarray, lengths: np.ndarray, match: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts one after another: hash of each anchor, place of the first window it stands for, and how many windows."""
    reach = match - gram + 1
    hashes = _gram_hashes(data, gram)
    # The smallest upper half of the hash wins; of equal ones the rightmost.
    key = hashes & np.uint64(0xFFFFFFFF00000000)
    key |= _RIGHTMOST[:len(key)]
    length = 1
    while 2 * length <= reach:
        key = np.minimum(key[:-length], key[length:])
        length *= 2
    if length < reach:
        key = np.minimum(key[:length - reach], key[reach - length:])
    windows = _inside(lengths, match)
    places = (np.uint64(0xFFFFFFFF) - (key[windows] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    # An anchor lies in one text, so windows of two texts never have the same.
    first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    return hashes[places[first]], windows[first], np.diff(first, append=len(places))


def _parts(texts: list[bytes], match: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(number of the text, first byte, bytes) of all windows, about STEP bytes at a time."""
    parts, size = [], 0
    for k, text in enumerate(texts):
        for base in range(0, len(text) - match + 1, STEP):
            part = text[base:base + STEP + match - 1]
            if parts and size + len(part) > STEP + match - 1:
                yield parts
                parts, size = [], 0
            parts.append((k, base, part))
            size += len(part)
    if parts:
        yield parts


def text_anchors(texts: list[bytes], match: int = MATCH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Number of the text, hash of each anchor, the first window it stands for, and how many windows."""
    found = []
    for parts in _parts(texts, match):
        lengths = np.fromiter((len(part) for _, _, part in parts), np.int64, len(parts))
        codes, lows, numbers = _anchors_of(np.frombuffer(b"".join(part for _, _, part in parts), np.uint8), lengths, match, gram)
        starts = np.cumsum(lengths) - lengths
        nth = np.searchsorted(starts, lows, side="right") - 1
        bases = np.array([base for _, base, _ in parts])
        found.append((np.array([k for k, _, _ in parts])[nth], codes, lows - starts[nth] + bases[nth], numbers))
    if not found:
        return tuple(np.empty(0, kind) for kind in (np.int64, np.uint64, np.int64, np.int64))
    return tuple(map(np.concatenate, zip(*found)))


def anchors(text: bytes, match: int = MATCH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor, the first window it stands for, and how many windows."""
    return text_anchors([text], match, gram)[1:]


def _frequent(codes: np.ndarray, least: int) -> np.ndarray:
    """Which of the codes are there `least` times or more."""
    order = np.argsort(codes)
    ordered = codes[order]
    edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(codes) else np.empty(0, int)
    number = np.diff(edges, append=len(codes))
    often = np.zeros(len(codes), bool)
    often[order[np.repeat(number >= least, number)]] = True
    return often


def _loads(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about LOAD bytes."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(cell) for cell in row if isinstance(cell, bytes))
        if size > LOAD:
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), schema.types)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), schema.types)], schema=schema)


def _dealt(rows: np.ndarray, shards: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packed row for each shard."""
    # Small numbers are sorted digit by digit.
    order = np.argsort(shards.astype(np.uint16) if shards.max(initial=0) < 1 << 16 else shards, kind="stable")
    rows, shards = rows[order], shards[order]
    if len(shards):
        edges = np.flatnonzero(np.append(True, shards[1:] != shards[:-1]))
        yield from _loads(
            ((int(shards[low]), _pack(rows[low:high])) for low, high in zip(edges, np.append(edges[1:], len(shards)))),
            _DEALT)


_DEALT = pa.schema([("shard", pa.int32()), ("data", pa.binary())])
_NOTHING = _DEALT.empty_table()


def _by_key(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys.astype(np.uint64) % np.uint64(shards)).astype(np.int32)


def _shard(codes: np.ndarray, shards: int) -> np.ndarray:
    return ((codes >> np.uint64(7)) % np.uint64(shards)).astype(np.int32)


def _spread(rows: np.ndarray) -> np.ndarray:
    """Codes by which hot anchors are dealt: several for each anchor."""
    part = rows["text"].astype(np.uint64) % np.uint64(SPREAD) * _ODD[4]
    return np.where(rows["hot"] > 0, rows["code"] + part, rows["code"])


def _all_anchors(shards: int, match: int, gram: int):
    """Texts to anchors, dealt by their hash. hot: 0 an anchor, 1 evidence of a hot one, 2 a hot one known to be shared."""

    def flush(texts: list[bytes], keys: list[int]) -> Iterator[pa.RecordBatch]:
        owner, codes, lows, numbers = text_anchors(texts, match, gram)
        rows = np.zeros(len(codes), ANCHOR)
        rows["code"], rows["text"], rows["low"], rows["number"] = codes, np.array(keys, np.int64)[owner], lows, numbers
        often = _frequent(codes, HOT + 1)
        if often.any():
            # Anchors in more than HOT texts are among those with more than HOT rows.
            many, rows = rows[often], rows[~often]
            many = many[np.lexsort((many["text"], many["code"]))]
            new_code = np.append(True, many["code"][1:] != many["code"][:-1])
            new_pair = new_code | np.append(True, many["text"][1:] != many["text"][:-1])
            group = np.cumsum(new_code) - 1
            hot = np.bincount(group, new_pair)[group] > HOT
            nth = np.cumsum(new_pair)
            nth = nth - nth[np.flatnonzero(new_code)][group]
            evidence = many[hot & new_pair & (nth < 2)]
            evidence["hot"] = 1
            known = many[hot]
            known["hot"] = 2
            yield from _dealt(known, _shard(_spread(known), shards))
            rows = np.concatenate([rows, many[~hot], evidence])
        yield from _dealt(rows, _shard(rows["code"], shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, keys, size = [], [], 0
        for batch in batches:
            for key, body in zip(batch.column("text_key").to_pylist(), batch.column("body").cast(pa.binary())):
                texts.append(body.as_py())
                keys.append(key)
                size += len(texts[-1])
                if size > FLUSH:
                    yield from flush(texts, keys)
                    texts, keys, size = [], [], 0
        if texts:
            yield from flush(texts, keys)

    return run


def _shared_anchors(shards: int):
    """A shard's anchors to those found in two texts or more, dealt by text."""

    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group, ANCHOR)
        known, rows = rows[rows["hot"] == 2], rows[rows["hot"] < 2]
        rows = rows[_frequent(np.ascontiguousarray(rows["code"]), 2)]
        rows = rows[np.lexsort((rows["low"], rows["text"], rows["code"]))]
        if len(rows):
            new_code = np.append(True, rows["code"][1:] != rows["code"][:-1])
            new_pair = new_code | np.append(True, rows["text"][1:] != rows["text"][:-1])
            code = np.cumsum(new_code) - 1
            texts = np.bincount(code, new_pair)
            shared = texts > 1
            hot = (np.bincount(code, rows["hot"] == 1) > 0) | (texts > MANY)
            single = (rows["hot"] == 0) & shared[code]
            rows["hot"] = hot[code]
            # Copies of a text bring the same anchors again.
            again = ~new_pair & np.append(False, rows["low"][1:] == rows["low"][:-1])
            rows = rows[single & ~again]
        known["hot"] = 1
        rows = np.concatenate([rows, known])
        return pa.Table.from_batches(list(_dealt(rows, _by_key(rows["text"], shards))), _NOTHING.schema)

    return run


def _by_text(kind: np.dtype):
    """A shard's rows to one row for each text."""

    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group, kind)
        names = ["text", *(name for name in kind.names if name != "text")]
        rows = rows[np.lexsort([rows[name] for name in reversed(names)])]
        new = np.zeros(max(len(rows) - 1, 0), bool)
        for name in names:
            new |= rows[name][1:] != rows[name][:-1]
        rows = rows[np.append(True, new)[:len(rows)]]
        edges = np.flatnonzero(np.append(True, rows["text"][1:] != rows["text"][:-1])[:len(rows)])
        ends = np.append(edges[1:], len(rows))
        return pa.table({
            "text_key": pa.array(rows["text"][edges], pa.int64()),
            "data": pa.array([_pack(rows[a:b]) for a, b in zip(edges, ends)], pa.binary()),
        })

    return run


def _pieces(shards: int, match: int):
    """Texts with their shared anchors to the anchors' bytes, dealt by the anchors' hash; equal bytes travel once."""
    schema = _DEALT.append(pa.field("bodies", pa.binary()))

    def flush(texts: list[bytes], firsts: list[int], found: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
        rows, numbers = _unpacked(found, ANCHOR)
        owner = np.repeat(np.arange(len(texts)), numbers)
        dealt = _shard(_spread(rows), shards)
        order = np.argsort(dealt, kind="stable")
        rows, owner, dealt = rows[order], owner[order], dealt[order]
        packed = np.zeros(len(rows), PIECE)
        for name in ("code", "text", "low", "number", "hot"):
            packed[name] = rows[name]
        packed["doc"] = np.array(firsts, np.int64)[owner]
        lows = rows["low"].astype(np.int64)
        highs = lows + rows["number"] - 1 + match
        edges = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1]))
        for start, end in zip(edges.tolist(), np.append(edges[1:], len(dealt)).tolist()):
            pieces: dict[bytes, int] = {}
            places = zip(owner[start:end].tolist(), lows[start:end].tolist(), highs[start:end].tolist())
            packed["piece"][start:end] = [pieces.setdefault(texts[k][low:high], len(pieces)) for k, low, high in places]
            sizes = np.fromiter(map(len, pieces), np.uint32, len(pieces))
            body = zstandard.ZstdCompressor(level=1).compress(
                len(sizes).to_bytes(8, "little") + sizes.tobytes() + b"".join(pieces))
            yield int(dealt[start]), _pack(packed[start:end]), body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, firsts, found, size = [], [], [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("first", "data")]
            for first, data, body in zip(*(c.to_pylist() for c in columns), batch.column("body").cast(pa.binary())):
                texts.append(body.as_py())
                firsts.append(first)
                found.append(data)
                size += len(texts[-1])
                if size > FLUSH:
                    yield from _loads(flush(texts, firsts, found), schema)
                    texts, firsts, found, size = [], [], [], 0
        if texts:
            yield from _loads(flush(texts, firsts, found), schema)

    return run


PIECE = np.dtype([("code", "<u8"), ("text", "<i8"), ("doc", "<i8"), ("low", "<u4"), ("number", "u1"), ("hot", "u1"), ("piece", "<u4")])


def _all_pieces(group: pa.Table) -> tuple[np.ndarray, bytearray, np.ndarray]:
    """A shard's rows, their pieces numbered through; the bytes of all pieces, and how many each has."""
    rows, bodies, sizes, at, before = _rows(group, PIECE), bytearray(), [np.empty(0, np.int64)], 0, 0
    for data, packed in zip(group.column("data"), group.column("bodies")):
        raw = zstandard.ZstdDecompressor().decompress(packed.as_buffer())
        number = int.from_bytes(raw[:8], "little")
        high = at + (zstandard.frame_content_size(data.as_buffer()) - 8) // PIECE.itemsize
        rows["piece"][at:high] += np.uint32(before)
        sizes.append(np.frombuffer(raw, np.uint32, number, 8).astype(np.int64))
        bodies += memoryview(raw)[8 + 4 * number:]
        at, before = high, before + number
    return rows, bodies, np.concatenate(sizes)


def _slices(rows: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and pieces in parts of about SLICE bytes. An anchor's pieces stay together, but for those of hot ones."""
    codes, hot = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), bool)
    codes[rows["piece"]] = rows["code"]
    hot[rows["piece"]] = rows["hot"] > 0
    order = np.argsort(codes, kind="stable")
    codes, hot = codes[order], hot[order]
    ends = np.flatnonzero(np.append((codes[1:] != codes[:-1]) | hot[1:], True)) + 1
    reached = np.cumsum(sizes[order])[ends - 1]
    part, parts, low, k = np.empty(len(sizes), np.int32), [], 0, 0
    while low < len(order):
        most = SLICE + (reached[k - 1] if k else 0)
        k = max(k + 1, int(np.searchsorted(reached, most, "right")))
        part[order[low:ends[k - 1]]] = len(parts)
        # As they came: with the pieces of an anchor side by side, sorting took a quarter longer.
        parts.append(np.sort(order[low:ends[k - 1]]))
        low = ends[k - 1]
    of_rows = part[rows["piece"]]
    by_part = np.argsort(of_rows, kind="stable")
    row_ends = np.cumsum(np.bincount(of_rows, minlength=len(parts)))
    for pieces, start, end in zip(parts, np.append(0, row_ends), row_ends):
        yield rows[by_part[start:end]], pieces


def _removed(rows: np.ndarray, body: list[bytes], match: int) -> tuple[np.ndarray, np.ndarray]:
    """The spans that these rows show to be repeated, and the windows of hot anchors that are the first ones here."""
    first = np.full(len(body), LAST, np.int64)
    np.minimum.at(first, rows["piece"], rows["doc"])
    code_of = np.zeros(len(body), np.uint64)
    code_of[rows["piece"]] = rows["code"]
    # Only anchors with several pieces can have equal windows in different pieces.
    _, place, number = np.unique(code_of, return_inverse=True, return_counts=True)
    pieces = offsets = gone = lows = highs = np.empty(0, np.int64)  # windows to remove, and their runs
    several = np.flatnonzero(number[place] > 1)
    if len(several):
        lengths = np.fromiter((len(body[k]) for k in several.tolist()), np.int64, len(several))
        symbols = np.frombuffer(b"".join(body[k] + b"\n" for k in several.tolist()), np.uint8).astype(np.uint16) + 2
        starts_of = np.cumsum(lengths + 1) - (lengths + 1)
        symbols[starts_of + lengths] = 1
        edge = np.zeros(len(symbols) + 1, np.int32)
        np.add.at(edge, starts_of, 1)
        np.add.at(edge, starts_of + lengths - match + 1, -1)
        array = suffix_array(symbols)
        order, same = repeats_previous(symbols, array, np.cumsum(edge[:-1]) > 0, match)
        which = np.repeat(np.arange(len(several), dtype=np.int32), lengths + 1)[order]
        docs = first[several[which]]
        heads = np.flatnonzero(~same)
        smallest = np.minimum.reduceat(docs, heads)[np.cumsum(~same) - 1]
        late = smallest < docs
        pieces, offsets = several[which[late]], order[late] - starts_of[which[late]]
        by_place = np.lexsort((offsets, pieces))
        pieces, offsets = pieces[by_place], offsets[by_place]
        new = np.append(True, (pieces[1:] != pieces[:-1]) | (offsets[1:] > offsets[:-1] + match))[:len(pieces)]
        last = np.append(new[1:], True)[:len(pieces)]
        gone, lows, highs = pieces[new], offsets[new], offsets[last] + match
    copy = rows["doc"] > first[rows["piece"]]
    all_gone = rows[copy]
    whole = np.zeros(len(all_gone), SPAN)
    whole["text"], whole["low"] = all_gone["text"], all_gone["low"]
    whole["high"] = all_gone["low"] + all_gone["number"] - 1 + match
    own_rows = rows[~copy]
    nth, base, text = _matched(gone, own_rows)
    some = np.zeros(len(nth), SPAN)
    some["text"], some["low"], some["high"] = text, base + lows[nth], base + highs[nth]
    return np.concatenate([whole, some]), _first_windows(own_rows, body, pieces, offsets, match)


def _matched(pieces: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every row beside all entries of its piece, in a sorted list of pieces: the entry, the row's first byte and its text."""
    start = np.searchsorted(pieces, rows["piece"])
    runs = np.searchsorted(pieces, rows["piece"], side="right") - start
    nth = np.arange(runs.sum()) + np.repeat(start - (np.cumsum(runs) - runs), runs)
    return nth, np.repeat(rows["low"], runs).astype(np.int64), np.repeat(rows["text"], runs)


def _first_windows(rows: np.ndarray, body: list[bytes], pieces: np.ndarray, offsets: np.ndarray, match: int) -> np.ndarray:
    """The windows of the hot rows among these but those (pieces, offsets) that go in any case."""
    rows = rows[rows["hot"] > 0]
    hot = np.unique(rows["piece"]).astype(np.int64)
    number = np.fromiter((len(body[k]) - match + 1 for k in hot.tolist()), np.int64, len(hot))
    before = np.cumsum(number) - number
    left = np.ones(int(number.sum()), bool)
    among = np.isin(pieces, hot)
    left[before[np.searchsorted(hot, pieces[among])] + offsets[among]] = False
    owner = np.repeat(hot, number)[left]
    offset = (np.arange(len(left)) - np.repeat(before, number))[left]
    digests = bytearray()
    for piece, k in zip(owner.tolist(), offset.tolist()):
        digests += hashlib.blake2b(body[piece][k:k + match], digest_size=16).digest()
    one, two = np.frombuffer(bytes(digests), "<u8").reshape(-1, 2).T
    nth, base, text = _matched(owner, rows)
    windows = np.zeros(len(nth), WINDOW)
    windows["one"], windows["two"], windows["text"], windows["low"] = one[nth], two[nth], text, base + offset[nth]
    first = np.zeros(len(body), np.int64)
    first[rows["piece"]] = rows["doc"]  # rows with a larger one are copies
    windows["doc"] = first[owner[nth]]
    return windows


def _repeats(shards: int, match: int):
    """A shard's pieces to the spans to remove, and the windows of hot anchors, which other shards may know as well."""

    def run(group: pa.Table) -> pa.Table:
        rows, bodies, sizes = _all_pieces(group)
        ends = np.cumsum(sizes)
        spans, windows, out, own = [np.empty(0, SPAN)], [], [], np.empty(len(sizes), np.uint32)

        def deal(kind: int, rows: np.ndarray, keys: np.ndarray) -> None:
            for batch in _dealt(rows, _by_key(keys, shards)):
                out.append(pa.Table.from_batches([batch]).append_column("kind", pa.array([kind] * len(batch), pa.int32())))

        with memoryview(bodies) as view:
            for part, pieces in _slices(rows, sizes):
                body: dict[bytes, int] = {}
                high = ends[pieces]
                places = zip((high - sizes[pieces]).tolist(), high.tolist())
                own[pieces] = [body.setdefault(view[a:b].tobytes(), len(body)) for a, b in places]
                part["piece"] = own[part["piece"]]
                some, hot = _removed(part, list(body), match)
                spans.append(some)
                windows.append(hot)
                if sum(map(len, windows)) > LOT:
                    hot = np.concatenate(windows)
                    deal(1, hot, hot["one"])
                    windows = []
        if windows:
            hot = np.concatenate(windows)
            deal(1, hot, hot["one"])
        whole = np.concatenate(spans)
        deal(0, whole, whole["text"])
        return pa.concat_tables([_NOTHING.append_column("kind", pa.array([], pa.int32())), *out])

    return run


def _known_before(shards: int, match: int):
    """A shard's windows to the spans of those that a smaller doc_id has."""

    def run(group: pa.Table) -> pa.Table:
        rows = _rows(group, WINDOW)
        rows = rows[np.lexsort((rows["doc"], rows["two"], rows["one"]))]
        new = np.append(True, (rows["one"][1:] != rows["one"][:-1]) | (rows["two"][1:] != rows["two"][:-1]))
        smallest = rows["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
        late = rows[smallest < rows["doc"]]
        spans = np.zeros(len(late), SPAN)
        spans["text"], spans["low"], spans["high"] = late["text"], late["low"], late["low"] + match
        return pa.Table.from_batches(list(_dealt(spans, _by_key(spans["text"], shards))), _NOTHING.schema)

    return run


def _cut():
    """Texts and their spans to what is left, as digest columns."""
    schema = pa.schema([("text_key", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def left(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, bytes]]:
        for key, body, data in zip(batch.column("text_key").to_pylist(), batch.column("body").cast(pa.binary()), batch.column("data")):
            text, rows = body.as_py(), _unpack(data.as_py(), SPAN)
            kept, spans, removed, at = [], 0, 0, 0
            for low, high in zip(rows["low"].tolist(), rows["high"].tolist()):
                if low > at or not spans:
                    kept.append(text[at:low])
                    spans += 1
                    at = low
                if high > at:
                    removed += high - at
                    at = high
            kept.append(text[at:])
            yield key, removed, spans, b"".join(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _loads(left(batch), schema)

    return run


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What is computed in here goes to the workers in batches of LOAD bytes."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(LOAD))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def _hashed(body: Column, turn: int) -> Column:
    return F.xxhash64(body, F.octet_length(body)) if not turn else F.xxhash64(body, F.octet_length(body), F.lit(turn))


def _numbered(docs: DataFrame, body: Column) -> tuple[Column, DataFrame]:
    """The number of a text, different for different texts, and the rows with it."""
    key, turn = _hashed(body, 0), 0
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("number")
    while True:
        rows = common.settled(docs.select(
            "doc_id", key.alias("text_key"), number, F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("sha256")))
        digests = rows.groupBy("text_key").agg(F.min("sha256").alias("a"), F.max("sha256").alias("b"))
        shared = [r["text_key"] for r in digests.filter("a <> b").select("text_key").collect()]  # next to none
        if not shared:
            return key, rows
        turn += 1
        key = F.when(key.isin(shared), _hashed(body, turn)).otherwise(key)


def cut_texts(docs: DataFrame, match: int = MATCH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, text_key, first, n_bytes, sha256) and the changed first texts (text_key, n_removed, n_spans, kept).

    A row whose doc_id is beyond `first`, the smallest with its text, is a copy.
    """
    body = common.whole()
    key, rows = _numbered(docs, body)
    key = key.alias("text_key")
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("number")
    # Packed rows go from every shard to every shard, so there are as many as reduce tasks, and more only for memory.
    size = rows.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD))
    first = rows.groupBy("text_key").agg(F.min("number").alias("first"))
    texts = docs.select(key, number, body.alias("body")).filter(F.octet_length("body") >= match)
    dealt = "shard int, data binary"
    found = texts.select("text_key", "body").mapInArrow(_all_anchors(shards, match, gram), dealt)
    shared = found.groupBy("shard").applyInArrow(_shared_anchors(shards), dealt)
    with _small_batches(docs.sparkSession):
        per_text = common.settled(shared.groupBy("shard").applyInArrow(_by_text(ANCHOR), "text_key long, data binary"))
    asked = per_text.join(first, "text_key").withColumnRenamed("first", "number").hint("shuffle_hash")
    with_text = texts.join(asked, ["text_key", "number"]).select("text_key", F.col("number").alias("first"), "data", "body")
    with _small_batches(docs.sparkSession):
        repeats = common.settled(
            with_text.mapInArrow(_pieces(shards, match), dealt + ", bodies binary")
            .groupBy("shard").applyInArrow(_repeats(shards, match), dealt + ", kind int"))
    hot = repeats.filter("kind = 1").drop("kind").groupBy("shard").applyInArrow(_known_before(shards, match), dealt)
    spans = repeats.filter("kind = 0").drop("kind").unionByName(hot).groupBy("shard").applyInArrow(
        _by_text(SPAN), "text_key long, data binary")
    with _small_batches(docs.sparkSession):
        spans = common.settled(spans)
    wanted = spans.join(first, "text_key").withColumnRenamed("first", "number").hint("shuffle_hash")
    changed = texts.join(wanted, ["text_key", "number"]).select("text_key", "data", "body").mapInArrow(
        _cut(), "text_key long, n_removed long, n_spans long, kept binary")
    return rows.join(first, "text_key"), changed


def deduplicated(docs: DataFrame, match: int = MATCH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows, changed = cut_texts(docs, match, gram)
    digests = changed.select("text_key", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256")).groupBy(
        "text_key").agg(*[F.first(c).alias(c) for c in ("n_removed", "n_spans", "cut_sha256")])
    with _small_batches(docs.sparkSession):
        digests = common.settled(digests)
    joined = rows.join(digests, "text_key", "left")
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    copy = (number > F.col("first")) & (F.col("n_bytes") >= match)
    return joined.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", "sha256")).alias("kept_sha256"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicated(common.table(spark, folder, "documents"))
