"""Periodic runs of words, by string synchronising sets.

A run is a longest stretch of words in which words a smallest period q apart are equal and which is at
least two periods long. Texts are searched whole; several are laid end to end with a number of its own
after each, which no run can hold.

* Small periods are read off directly: for each q the stretches of words that equal the word q further.
* For scale t = ``FIRST``, 2 ``FIRST``, ... a hash chooses positions by the words around them alone: i is
  chosen if the least hash of the t-word windows that begin in i .. i + t begins at i or i + t. Windows in
  regions of a period of at most t / 3, known from the scales before, are left out; there the smaller
  period was found already. Equal surroundings of 2t words are thus chosen alike, and wherever no position
  is chosen in t places, the text has such a small period. So every run with a period of 3t - 1 or more
  holds two chosen positions a period apart with equal surroundings.
* Positions with equal surroundings 3t - 1 to 6t - 2 apart propose their distance as a period. As the
  surroundings have no period of t / 3, at most 18 of them fit in.
* A proposal is stretched to both sides by prefix hashes and a binary search, then compared word by
  word; one whose hashes misled is stretched anew by comparing words. Of runs with equal bounds the one with the smallest
  period stays.

Work and memory follow the words of the texts laid together (``WORDS`` together, or one longer text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.repeats import least, mix

WORDS = 1 << 19  # words searched at a time
LEAST = 12  # words of a run
FIRST = 4  # the smallest scale
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_NO_HASH = U((1 << 64) - 1)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind the last of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


class _Text:
    """Words as numbers, with prefix hashes."""

    def __init__(self, words: np.ndarray):
        self.words, self.n = words, len(words)
        self.up = np.concatenate([[U(1)], np.cumprod(np.full(self.n, _BASE, np.uint64))])
        self.down = np.concatenate([[U(1)], np.cumprod(np.full(self.n, _INVERSE, np.uint64))])
        self.sums = np.concatenate([[U(0)], np.cumsum(mix(words.astype(np.uint64) + U(1)) * self.up[:-1])])

    def windows(self, at: np.ndarray | slice, width: int) -> np.ndarray:
        """A hash of the ``width`` words from each position."""
        if isinstance(at, slice):
            m = max(0, self.n - width + 1)
            return mix((self.sums[width : width + m] - self.sums[:m]) * self.down[:m])
        return mix((self.sums[at + width] - self.sums[at]) * self.down[at])

    def alike(self, at: np.ndarray, q: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from ``at`` seem equal to those ``q`` further."""
        return (self.sums[at + size] - self.sums[at]) * self.up[q] == self.sums[at + q + size] - self.sums[at + q]

    def stretched(self, at: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and behind the last word of the stretch with period ``q`` that ``at`` and ``at + q`` lie in."""
        right = _most(lambda size: self.alike(at, q, size), self.n - at - q)
        left = _most(lambda size: self.alike(at - size, q, size), at)
        return at - left, at + q + right


def _most(holds, limit: np.ndarray) -> np.ndarray:
    """The largest size up to ``limit`` for which ``holds``, given that it holds up to some size only."""
    low, high = np.zeros_like(limit), limit.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        ok = holds(middle)
        low, high = np.where(ok, middle, low), np.where(ok, high, middle - 1)
    return low


def _by_words(words: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """As ``stretched``, of one position and word by word."""
    differ = words[:-q] != words[q:]
    before, after = np.flatnonzero(differ[:at]), np.flatnonzero(differ[at:])
    return (int(before[-1]) + 1 if len(before) else 0), (at + int(after[0]) + q if len(after) else len(words))


def _checked(text: _Text, at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """(start, end, period) of the stretches that the proposals lie in, compared word by word."""
    start, end = text.stretched(at, q)
    # Proposals of one run have equal bounds and periods; one of them is compared.
    distinct, which = np.unique(np.stack([start, end, q], axis=1), axis=0, return_inverse=True)
    wrong = np.array([not np.array_equal(text.words[a : b - p], text.words[a + p : b]) for a, b, p in distinct.tolist()], bool)
    mended = [(*_by_words(text.words, int(at[k]), int(q[k])), int(q[k])) for k in np.flatnonzero(wrong[which.ravel()])]
    return np.concatenate([distinct[~wrong], np.array(mended, np.int64).reshape(-1, 3)])


def _chosen(text: _Text, t: int, regions: np.ndarray) -> np.ndarray:
    """The positions chosen at scale ``t``; ``regions`` has (start, end, period) of the runs known so far."""
    hashes = text.windows(slice(None), t)
    small = regions[(3 * regions[:, 2] <= t) & (regions[:, 1] - regions[:, 0] >= t)]
    inside = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(inside, small[:, 0], 1)
    np.add.at(inside, small[:, 1] - t + 1, -1)
    hashes[np.cumsum(inside[:-1]) > 0] = _NO_HASH
    m = text.n - 2 * t + 1
    lowest = least(hashes, t + 1)[:m]
    return np.flatnonzero((lowest < _NO_HASH) & ((lowest == hashes[:m]) | (lowest == hashes[t : t + m])))


def _proposed(text: _Text, t: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of chosen positions with equal surroundings, 3t - 1 to 6t - 2 apart."""
    around = text.windows(chosen, 2 * t)
    order = np.argsort(around, kind="stable")
    chosen, around = chosen[order], around[order]
    at, apart = [], []
    for lag in range(1, len(chosen)):
        distance = chosen[lag:] - chosen[:-lag]
        near = (around[lag:] == around[:-lag]) & (distance <= 6 * t - 2)
        if not near.any():
            break
        near = np.flatnonzero(near & (distance >= 3 * t - 1))
        at.append(chosen[near])
        apart.append(distance[near])
    return (np.concatenate(at), np.concatenate(apart)) if at else (chosen[:0], chosen[:0])


def runs(words: np.ndarray, longest: int | None = None) -> np.ndarray:
    """(start, end, period) of all runs of at least two periods, sorted; periods up to ``longest``."""
    n = len(words)
    longest = n // 2 if longest is None else min(longest, n // 2)
    found = [np.zeros((0, 3), np.int64)]
    for q in range(1, min(longest, 3 * FIRST - 2) + 1):
        a, b = _stretches(words[:-q] == words[q:])
        keep = b - a >= q
        found.append(np.stack([a[keep], b[keep] + q, np.full(keep.sum(), q)], axis=1))
    known = _smallest(np.concatenate(found))
    text, t = None, FIRST
    while 3 * t - 1 <= longest:
        text = text or _Text(words)
        at, q = _proposed(text, t, _chosen(text, t, known))
        if len(at):
            new = _checked(text, at, q)
            known = _smallest(np.concatenate([known, new[new[:, 1] - new[:, 0] >= 2 * new[:, 2]]]))
        t *= 2
    return known


def _smallest(found: np.ndarray) -> np.ndarray:
    """Runs once, each with its smallest period, in order of start and period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _laid(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of texts as numbers, each text followed by a number of its own, and where texts begin."""
    sizes = np.array([len(x) for x in lists], np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    out = np.zeros(int((sizes + 1).sum()), np.int64)
    codes = pc.dictionary_encode(pa.array([w for x in lists for w in x], pa.large_binary()))
    own = np.ones(len(out), bool)
    own[first + sizes] = False
    out[own] = codes.indices.to_numpy()
    out[first + sizes] = len(codes.dictionary) + np.arange(len(sizes))
    return out, first


def _groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    first = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield first, k
            first, total = k, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least_words: int = LEAST, together: int = WORDS) -> DataFrame:
    """(id, n_words, runs, kept) of every row.

    ``runs``: (start, length, period) of each run of ``least_words`` words or more, in order of start and
    period, counted in words from 0. ``kept``: the words no run holds after its first period, joined by
    single spaces. A null text has no words. Ids may be null or repeat: each row is taken by itself. An
    empty table gives an empty result. Other columns are not looked at.
    """
    rows = docs.select(F.col(id), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_body"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def of_group(ids: pa.Array, lists: list[list[bytes]]) -> pa.RecordBatch:
        words, first = _laid(lists)
        found = runs(words, max(map(len, lists), default=0) // 2)
        found = found[found[:, 1] - found[:, 0] >= least_words]
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, found[:, 0] + found[:, 2], 1)
        np.add.at(gone, found[:, 1], -1)
        gone = np.cumsum(gone) > 0
        kept = []
        for at, own in zip(first.tolist(), lists):
            drop = gone[at : at + len(own)]
            kept.append(b" ".join(w for w, d in zip(own, drop.tolist()) if not d) if drop.any() else b" ".join(own))
        owner = np.searchsorted(first, found[:, 0], "right") - 1
        offsets = np.searchsorted(owner, np.arange(len(lists) + 1))
        columns = [found[:, 0] - first[owner], found[:, 1] - found[:, 0], found[:, 2]]
        items = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(run))
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)
        sizes = pa.array([len(x) for x in lists], pa.int64())
        texts = pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())
        return pa.RecordBatch.from_arrays([ids, sizes, listed, texts], names=[id, "n_words", "runs", "kept"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Splitting bytes cuts at the space and at the bytes from tab to carriage return.
            lists = [t.as_py().split() for t in batch.column(1)]
            for a, b in _groups([len(x) for x in lists], together):
                yield of_group(batch.column(0)[a:b], lists[a:b])

    item = T.StructType([T.StructField(f.name, T.LongType()) for f in run])
    schema = rows.select(id).schema.add("n_words", "long").add("runs", T.ArrayType(item)).add("kept", "string")
    return rows.mapInArrow(search, schema)
