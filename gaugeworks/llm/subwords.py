"""Encoding and decoding with SentencePiece models of pair merges, by rounds of merges in numpy.

The distinct words of a batch (a word begins at each space) are laid end to end in one flat array of
symbols. In each round the pair of neighbours with the best score is found for every word by a segmented
minimum, all its occurrences in the word are merged at once from the left, and the array is compacted;
words without a known pair leave. A text's ids are those of its words in order.

Merging all occurrences at once equals merging one after the other only if no pair the new piece can be
part of scores as well as the piece itself. Pieces for which one does, and pieces that share a score with
another (runs of spaces), are merged once per word and round, the leftmost first. Words that are still
open after ``ROUNDS`` rounds are finished one merge at a time from a heap, which gives the same ids.

Models: pair merges with byte fallback and no change of characters, as ``load`` checks. The tables made
of the model are as large as its vocabulary and are broadcast.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
ROUNDS = 64
FLUSH = 1 << 22  # characters encoded at a time
WORD = re.compile(" +[^ ]*")
NONE = np.int64(1 << 40)
CODES = 0x110000
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_BYTES = "gaugeworks_each_byte"
codecs.register_error(UNKNOWN_BYTES, lambda e: ("�" * (e.end - e.start), e.end))


@dataclass
class Vocabulary:
    """Symbols below ``size`` are pieces; ``size`` + c is the character c where it is no piece."""

    size: int
    chars: np.ndarray  # code points that are pieces, sorted
    char_symbols: np.ndarray
    touching: np.ndarray  # pairs of code points that stand side by side in a piece, sorted
    pairs: np.ndarray  # (left, right) symbols that make a piece, sorted
    merged: np.ndarray  # the piece
    rank: np.ndarray  # of the piece, equal scores equal
    single: np.ndarray  # pieces merged one at a time
    bytes_: np.ndarray  # pieces of single bytes
    surface: np.ndarray  # what pieces say, end to end
    offsets: np.ndarray
    opens: np.ndarray  # pieces that begin with a space

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.chars, codes), len(self.chars) - 1)
        return np.where(self.chars[at] == codes, self.char_symbols[at], self.size + codes)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the piece each pair makes (NONE without), and the piece."""
        key = left * (self.size + CODES) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        to = self.merged[at]
        return np.where(self.pairs[at] == key, self.rank[to], NONE), to


def load(path: str) -> Vocabulary:
    """The vocabulary of a model file. ValueError for models of another kind than described above."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    trainer, normal = model.trainer_spec, model.normalizer_spec
    kinds = [p.type for p in model.pieces]
    plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and normal.escape_whitespaces and not normal.remove_extra_whitespaces
    if trainer.model_type != trainer.BPE or not trainer.byte_fallback or not plain or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("only pair merges with byte fallback and unchanged characters are supported")
    pieces = [p.piece for p in model.pieces]
    n = len(pieces)
    score = np.array([p.score for p in model.pieces])
    rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)
    normals = {p: i for i, p in enumerate(pieces) if kinds[i] == NORMAL}
    if SPACE not in normals or any(SPACE in p.lstrip(SPACE) for p in normals):
        raise ValueError("a space may only begin a piece")

    def symbol(part: str) -> int | None:
        return normals.get(part, n + ord(part) if len(part) == 1 else None)

    made, touching = {}, set()
    for piece, i in normals.items():
        for k in range(1, len(piece)):
            touching.add(ord(piece[k - 1]) * CODES + ord(piece[k]))
            left, right = symbol(piece[:k]), symbol(piece[k:])
            if left is not None and right is not None:
                made[left * (n + CODES) + right] = (i, left, right)
    keys = np.array(sorted(made), np.int64)
    merged = np.array([made[k][0] for k in keys.tolist()], np.int64)
    single = np.zeros(n, bool)
    for to, left, right in made.values():
        for part in (left, right):
            if part < n and rank[to] <= rank[part]:
                single[part] = True
    mine = np.array(sorted(normals.values()))
    _, inverse, count = np.unique(rank[mine], return_inverse=True, return_counts=True)
    single[mine[count[inverse] > 1]] = True
    chars = sorted((ord(p), i) for p, i in normals.items() if len(p) == 1)
    bytes_ = np.zeros(256, np.int64)
    surface = []
    for i, p in enumerate(pieces):
        if kinds[i] == BYTE:
            bytes_[int(p[3:5], 16)] = i
            surface.append(bytes([int(p[3:5], 16)]))
        elif kinds[i] == CONTROL:
            surface.append(b"")
        else:
            surface.append((trainer.unk_surface if kinds[i] == UNKNOWN else p.replace(SPACE, " ")).encode())
    return Vocabulary(
        n, np.array([c for c, _ in chars], np.int64), np.array([i for _, i in chars], np.int64), np.array(sorted(touching), np.int64),
        keys, merged, rank, single, bytes_, np.frombuffer(b"".join(surface), np.uint8),
        np.concatenate([[0], np.cumsum([len(s) for s in surface])]), np.array([kinds[i] == NORMAL and p.startswith(SPACE) for i, p in enumerate(pieces)]),
    )


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The members of all ranges, one range after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def merge_rounds(v: Vocabulary, symbols: np.ndarray, owner: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after all merges with the word each belongs to. ``owner`` ascends."""
    done = []
    change = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
    rank, to = v.pair(symbols, np.append(symbols[1:], 0)) if len(symbols) else (symbols, symbols)
    rank[change] = NONE
    for _ in range(rounds):
        if not len(symbols):
            break
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(symbols))))
        still = best < NONE
        if not still.all():
            done.append((symbols[~still], owner[~still]))
            symbols, owner, rank, to, best = symbols[still], owner[still], rank[still], to[still], best[still]
        at = np.flatnonzero(rank == best)
        if not len(at):
            continue
        # Of occurrences that overlap every other one, from the left.
        begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
        place = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
        leftmost = np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])
        at = at[(place % 2 == 0) & (leftmost | ~v.single[to[at]])]
        symbols[at] = to[at]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, owner, rank, to = symbols[keep], owner[keep], rank[keep], to[keep]
        # Only pairs that a new piece is part of have changed.
        at -= np.arange(len(at))
        look = np.concatenate([at, at[at > 0] - 1])
        look = look[look < len(symbols) - 1]
        rank[at[at == len(symbols) - 1]] = NONE
        rank[look], to[look] = v.pair(symbols[look], symbols[look + 1])
        rank[look[owner[look] != owner[look + 1]]] = NONE
    for word in np.unique(owner):
        rest = np.array(merge_in_turn(v, symbols[owner == word]), np.int64)
        done.append((rest, np.full(len(rest), word)))
    if not done:
        return symbols, owner
    symbols, owner = (np.concatenate(c) for c in zip(*done))
    order = np.argsort(owner, kind="stable")
    return symbols[order], owner[order]


def merge_in_turn(v: Vocabulary, symbols: np.ndarray) -> list[int]:
    """All merges of one word in their order: best score first, then leftmost."""
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def find(a: int, b: int) -> tuple[int, int]:
        if (a, b) not in known:
            rank, to = v.pair(np.array([a]), np.array([b]))
            known[a, b] = int(rank[0]), int(to[0])
        return known[a, b]

    s = symbols.tolist()
    n = len(s)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < n:
            rank, to = find(s[i], s[after[i]])
            if rank < NONE:
                heapq.heappush(heap, (rank, i, to, s[i], s[after[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, to, a, b = heapq.heappop(heap)
        j = after[i]
        if s[i] != a or j >= n or s[j] != b:
            continue
        s[i], s[j] = to, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [x for x in s if x >= 0]


def encode_words(v: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of words that begin with spaces."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    codes[codes == 32] = ord(SPACE)
    size = np.fromiter(map(len, words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), size)
    # No piece spans two characters that stand side by side in none: what lies between such cuts is on its own.
    key = codes[:-1] * CODES + codes[1:]
    at = np.minimum(np.searchsorted(v.touching, key), len(v.touching) - 1)
    cut = (v.touching[at] != key) | (word[1:] != word[:-1])
    part = np.concatenate([np.zeros(min(1, len(codes)), np.int64), np.cumsum(cut)])
    of = word[np.flatnonzero(np.concatenate([np.ones(min(1, len(codes)), bool), cut]))]
    symbols, part = merge_rounds(v, v.symbols(codes), part)
    word = of[part] if len(part) else word
    # Characters that are no piece become their bytes.
    rare = np.flatnonzero(symbols >= v.size)
    lengths = np.ones(len(symbols), np.int64)
    distinct, inverse = np.unique(symbols[rare] - v.size, return_inverse=True)
    spelled = [chr(c).encode() for c in distinct.tolist()]
    lengths[rare] = np.fromiter(map(len, spelled), np.int64, len(spelled))[inverse]
    ids = np.repeat(symbols, lengths)
    starts = np.cumsum(lengths) - lengths
    flat = np.frombuffer(b"".join(spelled), np.uint8)
    begin = np.cumsum([0] + [len(s) for s in spelled])[:-1]
    ids[spread(starts[rare], lengths[rare])] = v.bytes_[flat[spread(begin[inverse], lengths[rare])]] if len(rare) else 0
    counts = np.bincount(word, lengths, len(words)).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(counts)])


class Encoder(dict):
    """Numbers of words met so far with their ids; at most ``most`` words are kept from one call to the next."""

    def __init__(self, vocabulary: Vocabulary, most: int = 300_000):
        super().__init__()
        self.vocabulary, self.most = vocabulary, most
        self.clear()

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def clear(self) -> None:
        super().clear()
        self.new: list[str] = []
        self.ids, self.offsets = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of texts; each distinct word is encoded once."""
        if len(self) > self.most:
            self.clear()
        rows = [list(map(self.__getitem__, WORD.findall(" " + t.replace(SPACE, " ")))) if t else [] for t in texts]
        if self.new:
            ids, offsets = encode_words(self.vocabulary, self.new)
            self.ids, self.offsets = np.concatenate([self.ids, ids]), np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
            self.new = []
        word = np.fromiter(chain.from_iterable(rows), np.int64, sum(map(len, rows)))
        size = np.diff(self.offsets)[word]
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.ids[spread(self.offsets[word], size)], ends[np.cumsum([0] + [len(r) for r in rows])]


def decode(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of lists of ids: pieces end to end, without the space put before the first."""
    size = v.offsets[ids + 1] - v.offsets[ids]
    start = v.offsets[ids].copy()
    # The first id of a list that says anything loses its leading space.
    heard = np.flatnonzero(size > 0)
    at = np.searchsorted(heard, offsets[:-1])
    first = heard[np.minimum(at, len(heard) - 1)][(at < len(heard))] if len(heard) else heard
    first = first[first < offsets[1:][at < len(heard)]] if len(heard) else first
    first = first[v.opens[ids[first]]]
    start[first] += 1
    size[first] -= 1
    said = v.surface[spread(start, size)].tobytes()
    ends = np.concatenate([[0], np.cumsum(size)])[offsets]
    return [said[a:b].decode("utf-8", UNKNOWN_BYTES) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def _groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``most``; a larger row is alone."""
    first = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield first, k
            first, total = k, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def encoded(docs: DataFrame, vocabulary: Vocabulary, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids) of every row, without ids for begin and end.

    A null text has no ids, as an empty one. Bytes that are no UTF-8 count as U+FFFD each. Ids may be null
    or repeat; an empty table gives an empty result. Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            body = batch.column(1)
            for a, b in _groups([len(t.as_buffer()) for t in body], FLUSH):
                texts = [t.as_py().decode("utf-8", UNKNOWN_BYTES) for t in body[a:b]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], _lists(*encoder.encode(texts))], names=[id, "ids"])

    return rows.mapInArrow(run, rows.select(id).schema.add("ids", T.ArrayType(T.IntegerType())))


def decoded(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids as the column ``to`` in the place of ``ids``; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    at = rows.columns.index(ids)
    left = rows.drop(ids)
    names = [*left.columns, to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            others = [c for k, c in enumerate(batch.columns) if k != at]
            for a, b in _groups([len(x) if x.is_valid else 0 for x in lists], FLUSH // 2):
                part = lists[a:b]
                sizes = np.array([len(x) if x.is_valid else 0 for x in part])
                texts = decode(shared.value, part.flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]))
                said = pa.array([t if x.is_valid else None for t, x in zip(texts, part)], pa.string())
                yield pa.RecordBatch.from_arrays([c[a:b] for c in others] + [said], names=names)

    return rows.mapInArrow(run, left.schema.add(to, "string"))
