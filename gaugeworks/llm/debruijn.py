"""Removal of repeated passages of words, by compaction of a De Bruijn graph.

The edges of the graph are windows of 20 words, its nodes the 19 words two successive windows share. A
word goes if a window over it also starts earlier, in an earlier document or before in its own.

* Pieces of text that cannot hold a repeated window are put aside first (``repeats``). The remaining
  ones are paths of successive edges. Equal paths are compacted by a join on their content: all
  occurrences but the first are repeated as a whole.
* Only the first occurrence of each path is opened into edges, from its source coordinates. Grouping
  edges gives the coordinates of each edge's first occurrence; the join back tells which edges of a
  path were seen before. These go to the block of their text, where successive ones are compacted into
  one span.
* Edges are told apart by 128 bits over the 64-bit hashes of their words; coordinates (document, start)
  lead every span back to its text, where the words are removed. The words of a span are not compared
  with those of its first occurrence, and degrees of nodes are not computed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.repeats import TOLD, Layout, Pieces, answered, candidates, covered, dealt, mix, pieces, repeated, rolling, shared_marks, sorted_block, told, word_units
from gaugeworks.llm.shared import fresh

WIDTH, SEED = 20, 8
_ONE, _TWO = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB


def _edges(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window, from the words' hashes."""
    return mix(rolling(values, WIDTH, _ONE)), mix(rolling(mix(values + np.uint64(_TWO)), WIDTH, _TWO))


def _sums(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[np.uint64(0)], np.cumsum(x)])


def _columns(**values) -> pa.Table:
    return pa.table({k: pa.array(v.view(np.int64) if v.dtype == np.uint64 else v) for k, v in values.items()})


def _opened(table: pa.Table):
    table, texts = sorted_block(table)
    return table, texts, word_units(texts), table.column("doc").to_numpy(), table.column("twin").to_numpy()


def _paths(table: pa.Table, replies: pa.Table, layout: Layout) -> pa.Table:
    """Candidate paths of a block: two hashes, number of edges, and coordinates."""
    if not table.num_rows:
        return _NO_PATHS
    block = table.column("block")[0].as_py()
    _, _, units, doc, twin = _opened(table)
    own = pieces(units, WIDTH, SEED)
    if not len(own.start):
        return _NO_PATHS
    one, two = _edges(units.values)
    keep = candidates(own, replies, layout)
    # Windows that repeat within the block, such as those of one word said over and over.
    whole = np.repeat(own.start, own.n) + np.arange(own.n.sum()) - np.repeat(np.cumsum(own.n) - own.n, own.n)
    hashes = np.sort(one[whole])
    twice = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])
    if len(twice):
        at = np.minimum(np.searchsorted(twice, one[whole]), len(twice) - 1)
        piece = np.repeat(np.arange(len(own.n)), own.n)
        keep[piece[twice[at] == one[whole]]] = True
    own = Pieces(own.mark[keep], own.start[keep], own.n[keep], own.text[keep])
    n = own.n.astype(np.uint64)
    # A path is told apart by its edges in order: sums weighted by position, and its length.
    up = np.arange(len(one), dtype=np.uint64)
    s1, s2, w1, w2 = _sums(one), _sums(two), _sums(one * up), _sums(two * up)
    a, b, first = own.start, own.start + own.n, own.start.astype(np.uint64)
    path = lambda s, w, k: mix((w[b] - w[a]) - first * (s[b] - s[a]) + mix(s[b] - s[a] + n + np.uint64(k)))
    return _columns(
        p1=path(s1, w1, 1), p2=path(s2, w2, 2), n=own.n.astype(np.int32), block=np.full(len(a), block, np.int32),
        doc=doc[own.text], twin=twin[own.text], start=(a - units.first[own.text]).astype(np.int32),
    )


_NO_PATHS = pa.table({"p1": pa.array([], pa.int64()), "p2": pa.array([], pa.int64()), "n": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), "doc": pa.array([], pa.int64()), "twin": pa.array([], pa.int64()), "start": pa.array([], pa.int32())})
_NO_EDGES = pa.table({"e1": pa.array([], pa.int64()), "e2": pa.array([], pa.int64()), "doc": pa.array([], pa.int64()), "twin": pa.array([], pa.int64()), "start": pa.array([], pa.int32()), "block": pa.array([], pa.int32())})


def _locate(doc: np.ndarray, twin: np.ndarray, spans: pa.Table) -> np.ndarray:
    """The first text of the block with the coordinates of each span."""
    place = {}
    for k in range(len(doc) - 1, -1, -1):
        place[doc[k], twin[k]] = k
    return np.fromiter((place[d, t] for d, t in zip(spans.column("doc").to_numpy(), spans.column("twin").to_numpy())), np.int64, spans.num_rows)


def _edges_of(table: pa.Table, paths: pa.Table):
    """Both hashes, text and start of every edge of the given paths of a block."""
    _, _, units, doc, twin = _opened(table)
    one, two = _edges(units.values)
    text, start, n = _locate(doc, twin, paths), paths.column("start").to_numpy(), paths.column("n").to_numpy()
    row = np.repeat(np.arange(len(n)), n)
    at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    text = text[row]
    here = units.first[text] + at
    return one[here], two[here], doc[text], twin[text], at.astype(np.int32)


def _edges_told(table: pa.Table, paths: pa.Table, layout: Layout) -> pa.Table:
    if not table.num_rows or not paths.num_rows:
        return told(np.zeros(0, np.uint64), 0, layout.bits)
    return told(np.unique(_edges_of(table, paths)[0]), table.column("block")[0].as_py(), layout.bits)


def _edge_rows(table: pa.Table, given: pa.Table, layout: Layout) -> pa.Table:
    """The edges of a block's paths that occur twice or more."""
    paths = given.filter(pc.is_valid(given.column("n")))
    if not table.num_rows or not paths.num_rows:
        return _NO_EDGES
    one, two, doc, twin, start = _edges_of(table, paths)
    keep = repeated(one, given.filter(pc.is_valid(given.column("bucket"))), layout)
    block = np.full(int(keep.sum()), table.column("block")[0].as_py(), np.int32)
    return _columns(e1=one[keep], e2=two[keep], doc=doc[keep], twin=twin[keep], start=start[keep], block=block)


def _spans(docs: DataFrame, rows: DataFrame, layout: Layout) -> DataFrame:
    """(block, doc, twin, start, n): runs of windows that also start earlier."""
    # ``rows`` are grouped by block again and again over one shuffle of the texts.
    texts = rows.groupBy("block")
    marks = shared_marks(rows, layout, word_units, WIDTH, SEED)
    paths = texts.cogroup(marks.groupBy("block")).applyInArrow(
        lambda t, r: _paths(t, r, layout), "p1 long, p2 long, n int, block int, doc long, twin long, start int"
    )
    place = F.struct("doc", "twin", "start", "block")
    first = paths.groupBy("p1", "p2").agg(F.min(place).alias("first"), F.min("n").alias("n"))
    # Whole paths seen before. The first occurrence is among them only by its own coordinates.
    again = paths.join(first.drop("n"), ["p1", "p2"]).where(F.struct("doc", "twin", "start") != F.struct("first.doc", "first.twin", "first.start"))
    again = again.select("block", "doc", "twin", "start", "n")
    sources = first.select(F.col("first.block").alias("block"), F.col("first.doc").alias("doc"), F.col("first.twin").alias("twin"), F.col("first.start").alias("start"), "n")
    # Edges that occur once are put aside as pieces were: most stand beside a changed word.
    once = answered(texts.cogroup(sources.groupBy("block")).applyInArrow(lambda t, p: _edges_told(t, p, layout), TOLD))
    none = lambda kind: F.lit(None).cast(kind)
    given = sources.select("block", "doc", "twin", "start", "n", none("int").alias("bucket"), none("binary").alias("bits")).union(
        once.select("block", none("long"), none("long"), none("int"), none("int"), "bucket", "bits")
    )
    edges = texts.cogroup(given.groupBy("block")).applyInArrow(lambda t, g: _edge_rows(t, g, layout), "e1 long, e2 long, doc long, twin long, start int, block int")
    seen = edges.groupBy("e1", "e2").agg(F.min(F.struct("doc", "twin", "start")).alias("first"))
    later = edges.join(seen, ["e1", "e2"]).where(F.struct("doc", "twin", "start") != F.col("first"))
    # Runs of these are put together where their text lies.
    return again.union(later.select("block", "doc", "twin", "start", F.lit(1).alias("n")))


def removed(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept_text, keep...) of every row.

    ``kept_text`` is the text itself if nothing was removed, else the kept words joined by one space.
    A null text has no words and stays null. A null id comes after all ids. Rows with equal id and text
    are one document and lose the same words; of rows with one id but different texts one order, by a
    hash of the text, decides which is earlier. An empty table gives an empty result.
    """
    layout = Layout.of(docs, text)
    names = [f"_keep{k}" for k in range(len(keep))]
    rows = dealt(docs, layout, id, text, F.col(text).isNull().alias("missing"), F.col(id).isNull().alias("nameless"), *[F.col(c).alias(n) for c, n in zip(keep, names)])
    spans = _spans(docs, rows, layout)
    schema = rows.select(*names).schema.add("doc", "long").add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string").add("kept_text", "string")

    def finish(table: pa.Table, spans: pa.Table) -> pa.Table:
        table, texts, units, doc, twin = _opened(table) if table.num_rows else (table, None, None, None, None)
        out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
        if table.num_rows:
            gone = np.zeros(len(units.values), bool)
            if spans.num_rows:
                at = units.first[_locate(doc, twin, spans)] + spans.column("start").to_numpy()
                gone = covered(len(gone), at, spans.column("n").to_numpy() + WIDTH - 1)
            missing = table.column("missing").to_pylist()
            lead = 0
            base = np.cumsum([0] + [len(t.as_py()) for t in texts])
            for k, body in enumerate(texts):
                # Equal rows stand side by side; the first of them has the spans.
                lead = lead if k and doc[k] == doc[lead] and twin[k] == twin[lead] else k
                body, f, n = body.as_py(), units.first[k], units.count[k]
                mask = gone[units.first[lead] : units.first[lead] + n]
                a, b = units.starts[f : f + n][~mask] - base[k], units.ends[f : f + n][~mask] - base[k]
                kept = b" ".join([body[x:y] for x, y in zip(a.tolist(), b.tolist())])
                lost = int(mask.sum())
                out["n_words"].append(int(n))
                out["n_removed"].append(lost)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept_text"].append(None if missing[k] else (kept if lost else body).decode())
        types = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept_text": pa.string()}
        doc_ids = pa.array([None if m else d for d, m in zip(table.column("doc").to_pylist(), table.column("nameless").to_pylist())], pa.int64())
        return pa.table({**{n: table.column(n) for n in names}, "doc": doc_ids, **{k: pa.array(v, types[k]) for k, v in out.items()}})

    done = rows.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(finish, schema)
    return done.select(F.col("doc").alias(id), "n_words", "n_removed", "kept_sha256", "kept_text", *[F.col(n).alias(c) for c, n in zip(keep, names)])


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with the words of repeated windows removed and ``length`` made to fit, same columns."""
    rest = [c for c in docs.columns if c not in (id, text)]
    (filler,) = fresh(docs, "_none")
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"), F.struct(*rest, F.lit(0).alias(filler)).alias("_rest"))
    out = removed(rows, "_id", "_text", ("_rest",))
    value = {c: F.col("_rest")[c] for c in rest} | {id: F.col("_id"), text: F.col("kept_text")}
    if length in rest:
        value[length] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema[length].dataType)).otherwise(value[length])
    return out.select(*[value[c].alias(c) for c in docs.columns])
