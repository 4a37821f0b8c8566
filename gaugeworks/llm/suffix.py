"""Removal of byte strings that an earlier document has, by suffix arrays of shards.

Pieces of text that cannot hold a shared string of 50 bytes are put aside first (``repeats``). The others
are sorted by their mark, equal pieces of a block once, so that equal strings meet; a task reads its pieces
as a stream and treats whole marks together, about ``TOGETHER`` bytes at a time. Such a shard puts its equal
pieces together; those that differ but have a mark in common are laid end to end, and it

* sorts the suffixes of its pieces by induced sorting: suffixes are classified as smaller or larger
  than their right neighbour, substrings between leftmost-smaller positions are sorted and named, the
  sequence of names is sorted recursively, and the order of all suffixes is induced from that of the
  leftmost-smaller ones in one pass from the left and one from the right. The passes go through the
  buckets of first characters in numpy, a bucket at a time (names are written as two digits, so that
  there are few buckets);
* computes for each position the common prefix with its predecessor in the suffix array, in text order
  (the permuted array), as far as the window;
* takes for each group of equal windows the smallest document.

Blocks get back, for each of their pieces, the runs of windows an earlier document has.

A mark of which blocks tell ``FREQUENT`` kinds of pieces stands in many different surroundings: at the edge of
a common phrase. Its pieces are cut into strips of ``STRIP`` windows by where the marking seed lies in them, and a strip is dealt by the
bytes all its windows share. Strips within the phrase are equal and are put together before they leave
their block; those across its edge share all but five bytes with those they meet, so few differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.repeats import FREQUENT, LAST, Layout, byte_units, candidates, covered, dealt, frequent, mix, pieces, rolling, shared_marks, sorted_block

WIDTH, SEED = 50, 18
STRIP = 6  # windows
TOGETHER = 2 << 20  # bytes of pieces treated at a time, and those of the last mark among them
BLOCK_BYTES = 4 << 20
SHORT = 1 << 18  # sequences of names that are sorted directly
U = np.uint64


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour (the end is smallest of all)."""
    change = np.flatnonzero(s[1:] != s[:-1])
    ends = np.append(change, len(s) - 1)
    smaller = np.append(s[change] < s[change + 1], False)
    return np.repeat(smaller, np.diff(np.concatenate([[-1], ends])))


def _ranked(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order by character that keeps ties, rank within the character, and the characters with counts."""
    order = np.argsort(c, kind="stable")
    c = c[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    count = np.diff(np.append(first, len(c)))
    return order, np.arange(len(c)) - np.repeat(first, count), c[first], count


def _induced(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """All positions in suffix order, given the leftmost-smaller ones in order."""
    n = len(s)
    sizes = np.bincount(s, minlength=sigma)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    head, tail = begin[:-1].copy(), begin[1:].copy()  # of the larger and the smaller suffixes of a bucket
    out = np.empty(n, np.int32)
    used = np.flatnonzero(sizes).tolist()
    by_char = lms[np.argsort(s[lms], kind="stable")]
    cut = np.searchsorted(s[by_char], np.arange(sigma + 1))

    def place(at: np.ndarray, kind: bool) -> None:
        """The left neighbours of ``at`` that are of one kind go to the next places of their buckets."""
        at = at[at > 0] - 1
        at = at[small[at] == kind]
        if not len(at):
            return
        order, rank, chars, count = _ranked(s[at])
        if kind:
            out[np.repeat(tail[chars], count) - 1 - rank] = at[order]
            tail[chars] -= count
        else:
            out[np.repeat(head[chars], count) + rank] = at[order]
            head[chars] += count

    last = s[n - 1]
    out[head[last]] = n - 1
    head[last] += 1
    for c in used:
        done = begin[c]
        while done < head[c]:
            part, done = out[done : head[c]].copy(), head[c]
            place(part, False)
        if cut[c] < cut[c + 1]:
            place(by_char[cut[c] : cut[c + 1]], False)
    for c in reversed(used):
        done = begin[c + 1]
        while done > tail[c]:
            part, done = out[tail[c] : done][::-1].copy(), tail[c]
            place(part, True)
        if begin[c] < head[c]:
            place(out[begin[c] : head[c]][::-1], True)
    return out


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffix order of a short sequence by doubling of sorted prefixes."""
    rank, step = np.unique(s, return_inverse=True)[1].astype(np.int64) + 1, 1
    while True:
        after = np.zeros(len(s), np.int64)
        after[: len(s) - step] = rank[step:] if step < len(s) else 0
        values, rank = np.unique(rank * (len(s) + 2) + after, return_inverse=True)
        rank += 1
        if len(values) == len(s):
            return np.argsort(rank).astype(np.int32)
        step *= 2


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Suffixes of ``s`` (integers below ``sigma``) in order; an end comes before everything."""
    n = len(s)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small = _types(s)
    at = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    if not len(at):
        return _induced(s, small, at, sigma)
    # Substrings up to the next leftmost-smaller position, sorted by inducing from the unsorted ones.
    rough = _induced(s, small, at, sigma)
    is_start = np.zeros(n, bool)
    is_start[at] = True
    order = rough[is_start[rough]]
    length = np.zeros(n, np.int32)
    length[at] = np.append(np.diff(at) + 1, n - at[-1] + 1)  # the last one ends with the end
    a, b = order[:-1], order[1:]
    same = (length[a] == length[b]) & (a != at[-1]) & (b != at[-1])
    left = np.flatnonzero(same)
    step = 0
    while len(left):
        left = left[length[a[left]] > step]
        bad = s[a[left] + step] != s[b[left] + step]
        same[left[bad]] = False
        left = left[~bad]
        step += 1
    names = np.zeros(n, np.int64)
    names[order] = np.concatenate([[0], np.cumsum(~same)])
    count = int(names[order[-1]]) + 1
    if count < len(at) <= SHORT:
        order = at[_doubled(names[at])]
    elif count < len(at):
        # The recursion: names as two digits each, so that buckets stay few.
        base = int(np.ceil(np.sqrt(count)))
        digits = np.empty(2 * len(at), np.int32)
        digits[::2], digits[1::2] = names[at] // base, names[at] % base
        sub = suffix_array(digits, base)
        order = at[sub[sub % 2 == 0] // 2]
    return _induced(s, small, order, sigma)


def permuted_prefixes(s: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each position the common prefix with its predecessor in suffix order, counted up to ``most``.

    The first suffix has 0. Symbols are below 511.
    """
    # Seven symbols of nine bits in a word; beyond the end lies one that no text has.
    padded = np.concatenate([s, np.full(most + 7, 511)]).astype(np.int64)
    words = padded[: len(s) + most].copy()
    for k in range(1, 7):
        words |= padded[k : k + len(s) + most] << (9 * k)
    out = np.zeros(len(s), np.int32)
    a, b = order[1:].astype(np.int64), order[:-1].astype(np.int64)
    for step in range(0, most, 7):
        differ = words[a + step] ^ words[b + step]
        equal = differ == 0
        out[a] += np.where(equal, 7, np.bitwise_count((differ & -differ) - 1) // 9).astype(np.int32)
        a, b = a[equal], b[equal]
    return np.minimum(out, most)


def earliest(texts: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, window, document) of every window of every piece: the smallest document that has it."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int32) + 1
    start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    joined[start + sizes] = 0  # between pieces
    windows = sizes - WIDTH + 1
    piece = np.repeat(np.arange(len(texts)), windows)
    nth = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = start[piece] + nth
    order = suffix_array(joined, 257)
    prefix = permuted_prefixes(joined, order, WIDTH)
    owner = np.full(len(joined), -1, np.int64)
    owner[at] = piece
    valid = order[owner[order] >= 0]
    # Suffixes with a common window are neighbours; a break lies where the prefix is shorter.
    group = np.cumsum(prefix[order] < WIDTH)[owner[order] >= 0]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(docs[owner[valid]], first) if len(first) else np.zeros(0, np.int64)
    found = np.empty(len(joined), np.int64)
    found[valid] = np.repeat(least, np.diff(np.append(first, len(valid))))
    return piece, nth, found[at]


def _competing(texts: pa.Array, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``earliest``, sorting only runs of windows that seem to occur twice, equal runs once.

    Copies that differ here and there have the same runs between the differences.
    """
    units = byte_units(texts)
    windows = units.count - WIDTH + 1
    piece = np.repeat(np.arange(len(texts)), windows)
    nth = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    least = docs[piece]
    if not len(piece):
        return piece, nth, least
    hashes = rolling(units.values, WIDTH, 0xE7037ED1A0B428DB)[units.first[piece] + nth]
    _, inverse, count = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    new = twice & ((nth == 0) | ~np.concatenate([[False], twice[:-1]]))
    first, run = np.flatnonzero(new), np.cumsum(new)[twice] - 1
    size = np.bincount(run, minlength=len(first))
    raw = b"".join(t.as_py() for t in texts)
    contents, number = _numbered(raw, units.first[piece[first]] + nth[first], size)
    owner = np.full(len(contents), LAST, np.int64)
    np.minimum.at(owner, number, docs[piece[first]])
    _, _, found = earliest(contents, owner)
    begin = np.cumsum([0] + [len(t) - WIDTH + 1 for t in contents])
    least[twice] = found[begin[number[run]] + np.flatnonzero(twice) - first[run]]
    return piece, nth, least


def _strips(units, mark: np.ndarray, start: np.ndarray, n: np.ndarray, text: np.ndarray):
    """Pieces cut where the marking seed's place in the window enters another strip, marked by what a strip's windows share."""
    row = np.repeat(np.arange(len(n)), n)
    at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    seeds = mix(rolling(units.values, SEED, 0xD1342543DE82EF95))
    place = np.full(len(at), -1, np.int64)
    for j in range(WIDTH - SEED + 1):
        place[(place < 0) & (seeds[at + j] == mark[row])] = j
    strip, seed = place // STRIP, at + place
    new = np.ones(len(at), bool)
    new[1:] = (row[1:] != row[:-1]) | (strip[1:] != strip[:-1]) | (seed[1:] != seed[:-1])
    first = np.flatnonzero(new)
    common = rolling(units.values, WIDTH - STRIP + 1, 0xA0761D6478BD642F)[seed[first] - STRIP * strip[first]]
    return mix(common + strip[first].astype(np.uint64)), at[first], np.diff(np.append(first, len(at))), text[row[first]]


def _block_pieces(table: pa.Table, replies: pa.Table, layout: Layout):
    """The sorted texts of a block and its candidate pieces."""
    table, texts = sorted_block(table)
    units = byte_units(texts)
    doc = table.column("doc").to_numpy()
    own = pieces(units, WIDTH, SEED)
    keep = candidates(own, replies, layout) if len(own.start) else np.zeros(0, bool)
    often = frequent(own.mark, replies, layout)[keep] if len(own.start) else keep
    mark, start, n, text = own.mark[keep], own.start[keep], own.n[keep], own.text[keep]
    if often.any():
        cut = _strips(units, mark[often], start[often], n[often], text[often])
        mark, start, n, text = (np.concatenate([whole[~often], part]) for whole, part in zip((mark, start, n, text), cut))
    return table, texts, units, doc, mark, start, n, text


_PIECES = "mark int, block int, doc long, most long, nth int, piece binary"
_NO_PIECES = pa.table({"mark": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), "doc": pa.array([], pa.int64()), "most": pa.array([], pa.int64()), "nth": pa.array([], pa.int32()), "piece": pa.array([], pa.binary())})


def _numbered(raw: bytes, start: np.ndarray, n: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct contents of pieces in order of first occurrence, and the number of each piece."""
    numbers: dict[bytes, int] = {}
    number = np.fromiter((numbers.setdefault(raw[a : a + k + WIDTH - 1], len(numbers)) for a, k in zip(start.tolist(), n.tolist())), np.int64, len(start))
    return list(numbers), number


def _told(table: pa.Table, replies: pa.Table, layout: Layout) -> pa.Table:
    if not table.num_rows:
        return _NO_PIECES
    block = table.column("block")[0].as_py()
    _, texts, units, doc, mark, start, n, text = _block_pieces(table, replies, layout)
    if not len(start):
        return _NO_PIECES
    raw = b"".join(t.as_py() for t in texts)
    contents, number = _numbered(raw, start, n)
    least, most = np.full(len(contents), LAST, np.int64), np.full(len(contents), -LAST, np.int64)
    np.minimum.at(least, number, doc[text])
    np.maximum.at(most, number, doc[text])
    first = np.full(len(contents), len(start), np.int64)
    np.minimum.at(first, number, np.arange(len(start)))
    short = (mark[first] >> U(32)).astype(np.uint32).view(np.int32)  # marks that collide are treated together
    return pa.table({
        "mark": pa.array(short, pa.int32()), "block": pa.array(np.full(len(contents), block), pa.int32()), "doc": pa.array(least, pa.int64()),
        "most": pa.array(most, pa.int64()), "nth": pa.array(np.arange(len(contents)), pa.int32()), "piece": pa.array(contents, pa.binary()),
    })


_FOUND = "block int, nth int, start int, n int, doc long"


def _shard(table: pa.Table) -> pa.RecordBatch:
    """For each piece of each block the runs of windows with the smallest document that has them.

    The pieces are all those of their marks.
    """
    codes = table.column("piece").combine_chunks()
    codes = (codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes).dictionary_encode()
    number, contents = codes.indices.to_numpy(), codes.dictionary
    docs = np.full(len(contents), LAST, np.int64)
    np.minimum.at(docs, number, table.column("doc").to_numpy())
    marks = np.empty(len(contents), np.int64)
    marks[number] = table.column("mark").to_numpy()
    # A piece that is the only one with its mark shares windows with no other: its copies are all there is.
    _, inverse, count = np.unique(marks, return_inverse=True, return_counts=True)
    alone = np.flatnonzero(count[inverse] == 1)
    several = np.flatnonzero(count[inverse] > 1)
    piece, nth, least = _competing(contents.take(pa.array(several)), docs[several])
    new = np.ones(len(piece), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (least[1:] != least[:-1])
    at = np.flatnonzero(new)
    run_piece = np.concatenate([several[piece[at]], alone])
    order = np.argsort(run_piece, kind="stable")
    run_piece = run_piece[order]
    run_start = np.concatenate([nth[at], np.zeros(len(alone), np.int64)])[order]
    windows = pc.binary_length(contents).to_numpy(zero_copy_only=False)[alone].astype(np.int64) - WIDTH + 1
    run_n = np.concatenate([np.diff(np.append(at, len(piece))), windows])[order]
    run_doc = np.concatenate([least[at], docs[alone]])[order]
    lo, hi = np.searchsorted(run_piece, number), np.searchsorted(run_piece, number, "right")
    row = np.repeat(np.arange(len(number)), hi - lo)
    run = np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[row]
    # Nothing to say where no document of the block comes later.
    tell = run_doc[run] < table.column("most").to_numpy()[row]
    row, run = row[tell], run[tell]
    return pa.RecordBatch.from_arrays([
        pa.array(table.column("block").to_numpy()[row], pa.int32()), pa.array(table.column("nth").to_numpy()[row], pa.int32()),
        pa.array(run_start[run], pa.int32()), pa.array(run_n[run], pa.int32()), pa.array(run_doc[run], pa.int64()),
    ], names=["block", "nth", "start", "n", "doc"])


def _shards(batches: Iterator[pa.RecordBatch], together: int) -> Iterator[pa.RecordBatch]:
    """Pieces in order of their marks, treated whole marks at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < together:
            continue
        table = pa.Table.from_batches(held)
        marks = table.column("mark").to_numpy()
        cut = int(np.searchsorted(marks, marks[-1]))  # the last mark may go on
        held, size = [table.slice(cut).combine_chunks().to_batches()[0]], table.slice(cut).nbytes
        if cut:
            yield _shard(table.slice(0, cut))
    if held:
        yield _shard(pa.Table.from_batches(held))


def removed(docs: DataFrame, id: str = "doc_id", text: str = "text", frequent_from: int = FREQUENT, together: int = TOGETHER) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; ``kept`` are the bytes left.

    A null text is empty. A null id comes after all ids; rows with equal ids are one document, none of
    which is earlier. An empty table gives an empty result. Other columns are not looked at. Marks of
    ``frequent_from`` kinds of pieces are dealt by strips, which changes no result.
    """
    layout = Layout.of(docs, text, BLOCK_BYTES)
    rows = dealt(docs, layout, id, text, F.col(id).isNull().alias("nameless"))
    texts = rows.groupBy("block")
    marks = shared_marks(rows, layout, byte_units, WIDTH, SEED, frequent_from)
    told = texts.cogroup(marks.groupBy("block")).applyInArrow(
        lambda t, r: _told(t, r, layout), _PIECES
    )
    found = told.repartition("mark").sortWithinPartitions("mark").mapInArrow(lambda batches: _shards(batches, together), _FOUND)
    # Both answers come back to the block: which marks are shared, and which windows are to go.
    none = lambda kind: F.lit(None).cast(kind)
    answers = marks.select("block", "bucket", "bits", "frequent", none("int").alias("nth"), none("int").alias("start"), none("int").alias("n"), none("long").alias("doc")).union(
        found.select("block", none("int"), none("binary"), none("binary"), "nth", "start", "n", "doc")
    )

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        replies = answers.filter(pc.is_valid(answers.column("bucket")))
        runs = answers.filter(pc.is_valid(answers.column("nth")))
        table, bodies, units, doc, mark, start, n, text = _block_pieces(table, replies, layout)
        gone = np.zeros(len(units.values), bool)
        if runs.num_rows and len(start):
            raw = b"".join(t.as_py() for t in bodies)
            _, number = _numbered(raw, start, n)
            runs = runs.sort_by("nth")
            nth = runs.column("nth").to_numpy()
            lo, hi = np.searchsorted(nth, number), np.searchsorted(nth, number, "right")
            row = np.repeat(np.arange(len(number)), hi - lo)
            run = np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[row]
            later = runs.column("doc").to_numpy()[run] < doc[text[row]]
            row, run = row[later], run[later]
            gone = covered(len(gone), start[row] + runs.column("start").to_numpy()[run], runs.column("n").to_numpy()[run] + WIDTH - 1)
        out = [[], [], [], [], [], []]
        for k, body in enumerate(bodies):
            body, mask = np.frombuffer(body.as_py(), np.uint8), gone[units.first[k] : units.first[k] + units.count[k]]
            kept = body[~mask].tobytes()
            spans = int((mask[1:] & ~mask[:-1]).sum() + mask[0]) if len(mask) else 0
            nameless = table.column("nameless")[k].as_py()
            for column, value in zip(out, (None if nameless else int(doc[k]), len(body), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)):
                column.append(value)
        return pa.table([pa.array(v, t) for v, t in zip(out, types)], names=names)

    done = texts.cogroup(answers.groupBy("block")).applyInArrow(finish, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return done.withColumnRenamed("doc", id)
