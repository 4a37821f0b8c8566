"""SimHash fingerprints and near-duplicate groups by a binary trie self-join.

A fingerprint is a path of 64 bits in a binary trie. Two tries are traversed together: a pair of
nodes carries the number of bits in which their paths differ and is dropped as soon as that number
exceeds the error budget. The top of the traversal is a Spark shuffle, the rest numpy over the rows
of a task:

* Within three differing bits one of four 16-bit blocks is equal. Each distinct fingerprint is sent
  to four tries, one per block rotated to the top, keyed by that block (no error there).
* A key with more than ``split`` fingerprints is cut into pairs of nodes a few levels further down;
  only pairs within the budget exist, so no key needs to fit into one task.
* In a task, node pairs of all keys descend level by level in bounded chunks. Links found are
  reduced to a star per connected group at once, so a dense group gives no quadratic output.

Groups are then the connected components of those stars (alternating large and small stars, each
round checkpointed).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.shared import fresh, saved

BUDGET = 3  # bits; four blocks leave one of them equal
SPLIT = 200_000  # fingerprints of one key that a task takes
FLUSH = 400_000  # rows a task joins at a time, rounded up to whole keys
CHUNK = 1 << 17  # node pairs expanded at a time
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """64 majority bits of the XXH64 hashes of all ``width``-word shingles, repeats included."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1 :].tolist())), np.uint64, len(starts)
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns but the text, with its ``fp`` (long). A null or wordless text has fp 0."""
    rest = [c for c in docs.columns if c not in (text, "fp")]
    (body,) = fresh(docs, "_bytes")
    schema = docs.select(*rest).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(body)], np.uint64).view(np.int64)
            columns = [batch.column(c) for c in rest] + [pa.array(fps, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "fp"])

    return docs.select(*rest, F.col(text).cast("binary").alias(body)).mapInArrow(run, schema)


def node_pairs(fp: np.ndarray, roots: np.ndarray, bits: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints that differ in at most ``budget`` bits.

    ``roots`` has rows (a0, a1, b0, b1, differing): two ranges of ``fp``, each sorted by its lowest
    ``bits`` bits, or one range twice. Pairs of nodes that are small are compared directly.
    """
    ones: dict[int, np.ndarray] = {}
    stack = [(bits - 1, roots)] if len(roots) else []
    while stack:
        bit, pairs = stack.pop()
        if len(pairs) > CHUNK:
            stack += [(bit, pairs[CHUNK:])]
            pairs = pairs[:CHUNK]
        a0, a1, b0, b1, differing = pairs.T
        small = ((a1 - a0) * (b1 - b0) <= 64) | (bit < 0)
        if small.any():
            yield from _compared(fp, pairs[small], budget)
            a0, a1, b0, b1, differing = pairs[~small].T
        if not len(a0):
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        count = ones[bit]
        am, bm = a1 - (count[a1] - count[a0]), b1 - (count[b1] - count[b0])
        own = a0 == b0
        children = np.concatenate([
            np.stack([a0, am, b0, bm, differing], 1),
            np.stack([am, a1, bm, b1, differing], 1),
            np.stack([a0, am, bm, b1, differing + 1], 1),
            np.stack([am, a1, b0, bm, differing + 1], 1)[~own],
        ])
        alive = (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3]) & (children[:, 4] <= budget)
        alive &= (children[:, 0] != children[:, 2]) | (children[:, 1] - children[:, 0] > 1)
        if alive.any():
            stack.append((bit - 1, children[alive]))


def _compared(fp: np.ndarray, pairs: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(1 << 20, int(sizes.sum()) + (1 << 20), 1 << 20), "right")
    for lo, hi in zip([0, *cuts[:-1].tolist()], [*cuts[:-1].tolist(), len(pairs)]):
        part, size = pairs[lo:hi], sizes[lo:hi]
        if not len(part):
            continue
        row = np.repeat(np.arange(len(part)), size)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        wide = (part[:, 3] - part[:, 2])[row]
        i, j = part[row, 0] + nth // wide, part[row, 2] + nth % wide
        near = (np.bitwise_count(fp[i] ^ fp[j]) <= budget) & ((part[row, 0] != part[row, 2]) | (i < j))
        if near.any():
            yield i[near], j[near]


def stars(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` elements the smallest element that ``links`` connect it with."""
    parent = np.arange(n)
    for u, v in links:
        while True:
            pu, pv = parent[u], parent[v]
            differ = pu != pv
            if not differ.any():
                break
            u, v, pu, pv = u[differ], v[differ], pu[differ], pv[differ]
            np.minimum.at(parent, np.maximum(pu, pv), np.minimum(pu, pv))
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
    return parent


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star links of a task's rows (key, lo, hi, side, turned), sorted by these columns."""
    names = ["key", "lo", "hi", "side", "turned"]

    def flush(key, lo, hi, side, turned):
        fp = turned.view(np.uint64)
        new = np.ones(len(fp), bool)
        new[1:] = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(fp))
        ones = np.concatenate([[0], np.cumsum(side)])
        middle = end - (ones[end] - ones[start])
        cross = lo[start] != hi[start]
        # The descent starts above the levels of the cut and counts the bits that differ there itself.
        spent = np.zeros(len(start), np.int64)
        roots = np.where(
            cross[:, None],
            np.stack([start, middle, middle, end, spent], 1),
            np.stack([start, end, start, end, spent], 1),
        )
        live = (roots[:, 0] < roots[:, 1]) & (roots[:, 2] < roots[:, 3]) & (cross | (end - start > 1))
        group = stars(len(fp), node_pairs(fp, roots[live], 48, BUDGET))
        linked = np.flatnonzero(group != np.arange(len(fp)))
        if len(linked):
            turn = (key >> 16).astype(np.uint64) * np.uint64(16)
            back = np.where(turn == 0, fp, (fp >> turn) | (fp << ((np.uint64(64) - turn) & np.uint64(63)))).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(back[linked], pa.int64()), pa.array(back[group[linked]], pa.int64())], names=["u", "v"]
            )

    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
        rows += batch.num_rows
        if rows >= FLUSH:
            columns = [np.concatenate(c) for c in zip(*held)]
            last = np.flatnonzero(np.any([c != c[-1] for c in columns[:3]], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from flush(*(c[:cut] for c in columns))
            held, rows = [[c[cut:] for c in columns]], rows - cut
    if rows:
        yield from flush(*(np.concatenate(c) for c in zip(*held)))


def near_links(distinct: DataFrame, split: int = SPLIT) -> DataFrame:
    """Links (u, v) that connect all of the distinct ``fp`` within three bits of each other."""
    fp = F.col("fp")
    turns = [F.struct(F.lit(b).alias("turn"), (F.shiftleft(fp, 16 * b).bitwiseOR(F.shiftrightunsigned(fp, 64 - 16 * b)) if b else fp).alias("turned")) for b in range(4)]
    spread = distinct.select(F.inline(F.array(*turns)))
    spread = spread.select((F.shiftleft(F.col("turn").cast("long"), 16).bitwiseOR(F.shiftrightunsigned("turned", 48))).alias("key"), "turned")
    counted = spread.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("key")))
    # Levels under the key at which it is cut, none for most keys.
    depth = F.when(F.col("size") > split, F.least(F.lit(12), F.ceil(F.log2(F.col("size") / split)).cast("int") + 1)).otherwise(F.lit(0))
    node = F.when(F.col("depth") > 0, F.expr("shiftrightunsigned(shiftleft(turned, 16), 64 - depth)")).otherwise(F.lit(0).cast("long"))
    masks = F.expr(f"filter(sequence(0L, shiftleft(1L, depth) - 1), m -> bit_count(m) <= {BUDGET})")
    paired = counted.withColumn("depth", depth).withColumn("node", node).withColumn("other", F.explode(F.transform(masks, lambda m: F.col("node").bitwiseXOR(m))))
    paired = paired.select(
        "key", F.least("node", "other").alias("lo"), F.greatest("node", "other").alias("hi"),
        (F.col("node") > F.col("other")).cast("long").alias("side"), "turned",
    )
    # Unsigned order of the low 48 bits, so that each node is a range of rows.
    placed = paired.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "side", F.col("turned").bitwiseAND((1 << 48) - 1))
    return placed.mapInArrow(_joined, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(u, v): each linked node and the smallest node of its component, but for that node itself."""
    edges = saved(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen or state[0] == 0:
            return edges
        seen = state
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = saved(small.union(low.select("u", F.col("m").alias("v"))).distinct())


def _grouped(docs: DataFrame, id: str, text: str, split: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(_id, fp) of every row, (fp, root) of every fingerprint, and (root, component_id, lead) of every group.

    ``lead`` is the smallest fingerprint that the smallest id of the group has, or of a group of null ids.
    """
    marked = saved(fingerprints(docs.select(F.col(id).alias("_id"), F.col(text).alias("text"))))
    distinct = marked.groupBy("fp").agg(F.min("_id").alias("first"))
    root = components(near_links(distinct.select("fp"), split)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    placed = distinct.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min(F.struct(F.col("first").isNull(), F.col("first"), F.col("fp"))).alias("_least"))
    return marked, placed.select("fp", "root"), least.select("root", F.col("_least.first").alias("component_id"), F.col("_least.fp").alias("lead"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", split: int = SPLIT) -> DataFrame:
    """(id, fp, component_id) of every row: the smallest id reachable over fingerprints within three bits.

    Null and wordless texts have fingerprint 0 and are linked like any other. Rows with a null id take
    part; a component of such rows only has a null component_id. Repeated rows come back repeated. An
    empty table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    marked, placed, least = _grouped(docs, id, text, split)
    groups = placed.join(least, "root").select("fp", "component_id")
    return marked.join(groups, "fp").select(F.col("_id").alias(id), "fp", "component_id")


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that lead their near-duplicate group: its smallest id, with one fingerprint.

    Rows that repeat an id and its fingerprint are one document and stay together. Of a group of null
    ids one row stays, the first by text and other columns. Columns are those of ``docs``.
    """
    leads = saved(_grouped(docs, id, text, SPLIT)[2].select(F.col("component_id").alias("_key"), F.col("lead").alias("fp")))

    def marked(part):  # with the whole row beside the fingerprint
        return fingerprints(part.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias("text"))).withColumn("_key", F.col("_row")[id])

    known = marked(docs.where(F.col(id).isNotNull())).join(leads.where("_key IS NOT NULL"), ["fp", "_key"], "left_semi")
    order = [F.col("_row")[text], *[F.col("_row")[c] for c, kind in docs.dtypes if c != text and not kind.startswith(("map", "variant"))]]
    # A rank filter: each task sends one row per fingerprint.
    single = marked(docs.where(F.col(id).isNull())).withColumn("_nth", F.row_number().over(Window.partitionBy("fp").orderBy(*order))).where("_nth = 1")
    nameless = single.join(leads.where("_key IS NULL").select("fp"), "fp", "left_semi")
    return known.select("_row.*").union(nameless.select("_row.*"))
