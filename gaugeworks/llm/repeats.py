"""Candidates for repeated windows: what the two substring operators share.

A window of a text is a run of units (words or bytes). Each window is marked by the least hash of the
short seeds inside it, so equal windows have equal marks. A run of windows with one mark is a piece.
Only pieces whose mark occurs in another piece can hold repeated windows; there are about a seventh as
many marks as words.

Texts are dealt over blocks by a hash of id and text. A block tells each bucket of marks which ones it
has, four bytes each; the bucket answers with a bit per mark: does another block have it. A mark that
a third of all texts share is thus one entry per block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 6 << 20  # text of a block
LAST = (1 << 63) - 1  # a null id comes after all others
U = np.uint64
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_VALUE = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = U(0x9E3779B97F4A7C15)
_BACK = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A scramble of 64-bit numbers that loses nothing."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, _BACK)):
            _powers[k] = np.concatenate([[U(1)], np.cumprod(np.full(n, b, np.uint64))])
    return _powers[0], _powers[1]


def rolling(units: np.ndarray, width: int, by: int) -> np.ndarray:
    """A hash of each ``width`` consecutive units; as many values as units, the last ones meaningless."""
    parts, size, h, out, done = width, 1, units, None, 0
    factor = by
    while parts:
        if parts & 1:
            if out is None:
                out = h.copy()
            else:
                out[: len(out) - done] = out[: len(out) - done] * U(factor) + h[done:]
            done += size
        parts >>= 1
        if parts:
            nxt = h * U(factor)
            nxt[: len(h) - size] += h[size:]
            h, size, factor = nxt, size * 2, factor * factor % (1 << 64)
    return out


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, as far as there are that many."""
    out, size = x.copy(), 1
    while size < width:
        step = min(size, width - size)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        size += step
    return out


@dataclass
class Units:
    """The texts of a block laid end to end. ``first`` and ``count`` of each text's units."""

    values: np.ndarray
    first: np.ndarray
    count: np.ndarray
    starts: np.ndarray | None = None  # of words, as bytes of the block
    ends: np.ndarray | None = None


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_binary(texts.type) else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[:1] if len(offsets) else np.zeros(1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_units(texts: pa.Array) -> Units:
    data, offsets = _bytes(texts)
    return Units(_VALUE[data], offsets[:-1], np.diff(offsets))


def word_units(texts: pa.Array) -> Units:
    """Words, hashed by their bytes and length."""
    data, offsets = _bytes(texts)
    inside = ~_GAP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]]))
    end = inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = _power(len(data) + 1)
    sums = np.concatenate([[U(0)], np.cumsum(_VALUE[data] * up[: len(data)])])
    values = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    first = np.searchsorted(starts, offsets)
    return Units(values, first[:-1], np.diff(first), starts, ends)


@dataclass
class Pieces:
    """Runs of windows with one mark, in order. ``text``: number of the text in the block."""

    mark: np.ndarray
    start: np.ndarray  # unit of the block
    n: np.ndarray  # windows
    text: np.ndarray


def pieces(units: Units, width: int, seed: int) -> Pieces:
    n = len(units.values)
    if n < width:
        none = np.zeros(0, np.int64)
        return Pieces(none.astype(np.uint64), none, none, none)
    mark = least(mix(rolling(units.values, seed, 0xD1342543DE82EF95)), width - seed + 1)
    whole = np.zeros(n + 1, np.int8)
    has = units.count >= width
    np.add.at(whole, units.first[has], 1)
    np.add.at(whole, (units.first + units.count - width + 1)[has], -1)
    whole = np.cumsum(whole[:-1], dtype=np.int8).astype(bool)
    new = whole.copy()
    new[1:] &= (mark[1:] != mark[:-1]) | ~whole[:-1]
    stop = whole.copy()
    stop[:-1] &= (mark[1:] != mark[:-1]) | ~whole[1:]
    # Texts of fewer units than a window have none; between two others lie units that start none.
    start = np.flatnonzero(new)
    size = np.flatnonzero(stop) + 1 - start
    holds = np.flatnonzero(has)
    text = holds[np.searchsorted(units.first[holds], start, "right") - 1]
    return Pieces(mark[start], start, size, text)


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind the last of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def covered(n: int, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Mask of ``n`` units that lie in one of the ranges."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, start, 1)
    np.add.at(delta, start + size, -1)
    return np.cumsum(delta[:-1]) > 0


@dataclass
class Layout:
    """How many blocks and buckets (a power of two) the texts are dealt over."""

    blocks: int
    bits: int

    @classmethod
    def of(cls, docs: DataFrame, text: str, block: int = BLOCK_BYTES) -> Layout:
        size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        blocks = max(8, math.ceil(size / block))
        return cls(blocks, min(24, max(4, math.ceil(math.log2(blocks)))))


def dealt(docs: DataFrame, layout: Layout, id: str, text: str, *more) -> DataFrame:
    """(block, doc, twin, body, more...): whole texts by block. Equal rows share doc and twin."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(body).alias("twin"), body.alias("body"), *more)
    return rows.withColumn("block", F.pmod(F.xxhash64("doc", "twin"), F.lit(layout.blocks)).cast("int"))


def sorted_block(table: pa.Table) -> tuple[pa.Table, pa.Array]:
    """The rows of a block in an order that does not depend on how they came, and their texts."""
    table = table.sort_by([("doc", "ascending"), ("twin", "ascending")])
    body = table.column("body").combine_chunks()
    return table, body.chunk(0) if isinstance(body, pa.ChunkedArray) else body


def _cuts(marks: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """The buckets that sorted marks fall into, each with its range."""
    bucket = (marks >> U(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(marks) else np.zeros(0, np.int64)
    return list(zip(bucket[first].tolist(), first.tolist(), np.append(first[1:], len(marks)).tolist()))


_SHORT = U((1 << 32) - 1)


def _short(marks: np.ndarray, bits: int) -> np.ndarray:
    """Marks of one bucket as 32-bit numbers; there are as many buckets as blocks, so few of a bucket agree by chance."""
    return (marks >> U(32 - bits)) & _SHORT


TOLD = "bucket int, block int, marks binary"
ANSWER = "block int, bucket int, bits binary, frequent binary"
FREQUENT = 128  # kinds of pieces that blocks tell of a mark, of 256, from which its pieces are cut finer


def told(marks: np.ndarray, block: int, bits: int, kinds: np.ndarray | None = None) -> pa.Table:
    """What a block says of its distinct sorted marks: one row for each bucket, four bytes a mark.

    A fifth is what kind of pieces the block has of a mark, if ``kinds`` are given.
    """
    out = []
    for bucket, a, b in _cuts(marks, bits):
        short, first = np.unique(_short(marks[a:b], bits), return_index=True)
        entry = np.ascontiguousarray(short).view(np.uint8).reshape(-1, 8)[:, :4]
        if kinds is not None:
            entry = np.column_stack([entry, kinds[a:b][first]])
        out.append((bucket, block, entry.tobytes()))
    columns = list(zip(*out)) or [(), (), ()]
    return pa.table({"bucket": pa.array(columns[0], pa.int32()), "block": pa.array(columns[1], pa.int32()), "marks": pa.array(columns[2], pa.binary())})


def _answer(frame: pd.DataFrame, most: int, width: int) -> pd.DataFrame:
    parts = []
    for data in frame["marks"]:
        wide = np.zeros((len(data) // width, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
        parts.append(wide.view(np.uint64)[:, 0])
    own = [p & _SHORT for p in parts]
    every = np.sort(np.concatenate(own))
    again = np.unique(every[1:][every[1:] == every[:-1]])
    # Marks of many kinds; without kinds those that many blocks told.
    kinds = every
    if width > 4:
        kinds = np.sort(np.concatenate(parts))
        kinds = np.sort(kinds[np.concatenate([[True], kinds[1:] != kinds[:-1]])] & _SHORT) if len(kinds) else kinds
    often = np.unique(kinds[most - 1 :][kinds[most - 1 :] == kinds[: max(0, len(kinds) - most + 1)]])
    marked = lambda known: [np.packbits(np.isin(p, known, assume_unique=True)).tobytes() for p in own]
    return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "bits": marked(again), "frequent": marked(often)})


def answered(rows: DataFrame, most: int = FREQUENT, width: int = 4) -> DataFrame:
    """Which of the marks ``told`` by a block other blocks told, too (bits), and which are of very many kinds (frequent)."""
    return rows.groupBy("bucket").applyInPandas(lambda frame: _answer(frame, most, width), ANSWER)


def _kinds(units: Units, own: Pieces, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct marks of a block's pieces, and for each a byte by what its pieces hold."""
    whole = rolling(units.values, width, 0xE7037ED1A0B428DB)
    held = mix(whole[own.start] + whole[own.start + own.n - 1] * U(3) + own.n.astype(np.uint64))
    order = np.argsort(own.mark, kind="stable")
    marks, held = own.mark[order], held[order]
    first = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]])) if len(marks) else np.zeros(0, np.int64)
    return marks[first], (np.minimum.reduceat(held, first) & U(255)).astype(np.uint8) if len(first) else np.zeros(0, np.uint8)


def shared_marks(rows: DataFrame, layout: Layout, units, width: int, seed: int, most: int | None = None) -> DataFrame:
    """The answers for the marks of all pieces; frequent ones are told given ``most``, the kinds of pieces they need."""
    def tell(table: pa.Table) -> pa.Table:
        _, texts = sorted_block(table)
        laid = units(texts)
        own = pieces(laid, width, seed)
        marks, kinds = (np.unique(own.mark), None) if most is None else _kinds(laid, own, width)
        return told(marks, table.column("block")[0].as_py(), layout.bits, kinds)

    told_ = rows.groupBy("block").applyInArrow(tell, TOLD)
    return answered(told_) if most is None else answered(told_, most, 5)


def elsewhere(marks: np.ndarray, replies: pa.Table, layout: Layout, answer: str = "bits") -> np.ndarray:
    """Which of a block's distinct sorted marks other blocks have (or very many), by the answers it got.

    ``marks`` are all those the block told. They are compared by part of their bits, so a few more may
    be among those found.
    """
    out = np.zeros(len(marks), bool)
    bits = dict(zip(replies.column("bucket").to_pylist(), replies.column(answer).to_pylist()))
    for bucket, a, b in _cuts(marks, layout.bits):
        if bucket in bits:
            short, where = np.unique(_short(marks[a:b], layout.bits), return_inverse=True)
            out[a:b] = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(short)).astype(bool)[where]
    return out


def repeated(marks: np.ndarray, replies: pa.Table, layout: Layout) -> np.ndarray:
    """Which marks of a block occur twice or more, here or elsewhere."""
    distinct, inverse, count = np.unique(marks, return_inverse=True, return_counts=True)
    return ((count > 1) | elsewhere(distinct, replies, layout))[inverse]


def frequent(marks: np.ndarray, replies: pa.Table, layout: Layout) -> np.ndarray:
    """Which marks of a block very many blocks have."""
    distinct, inverse = np.unique(marks, return_inverse=True)
    return elsewhere(distinct, replies, layout, "frequent")[inverse]


def candidates(own: Pieces, replies: pa.Table, layout: Layout) -> np.ndarray:
    """Which pieces of a block have a mark that another piece has too, here or elsewhere."""
    return repeated(own.mark, replies, layout)
