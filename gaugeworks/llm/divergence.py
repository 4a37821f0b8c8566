"""Audit of how the sources of a language differ in their words, over a transducer of kept terms.

1. Terms of all texts are counted by the documents of their language that hold them; those of at least
   ``MIN_DOCS`` documents are kept and dealt over sorted ranges of bounded size. Each range becomes a
   minimal acyclic transducer (``transducer``), whose terms have lexicographic ordinals in their language.
2. Texts stream through the transducers, which recount kept terms by ordinal for each (language, source).
   Transducers are broadcast in blocks of at most ``MEMORY`` bytes, one block at a time; there is one block
   unless the vocabulary is larger. A word goes to the one range it can be in.
3. Smoothed shares ``p = 1 + floor(10**9 * (count + 2) / (N + 2 V))`` are compared: two sources over all kept
   terms (part ``pair``), and a source with its whole language term by term (part ``term``, the first ten).

Ordinals are cut into strips of ``STRIP``. Counts of one strip travel in one row, as places in the strip and
their counts, and are added up one strip at a time. The pairs of a term are never written out: the sources of
a language are cut into tiles of ``TILE``; a task has the shares of two tiles over one strip as dense numbers
and adds up their pairs, so its size is bounded and one row per pair and strip leaves it. Likewise a tile's
strip is compared with the strip of the whole language, and only the first ten of each source leave it.
Everything is integer arithmetic; counts may be as large as a long.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.shared import saved
from gaugeworks.llm.transducer import Transducer, build

MIN_DOCS = 10
TOP = 10
MEMORY = 64 << 20  # bytes of transducers in one broadcast
RANGE_TERMS = 50_000  # terms of one transducer, about
STRIP, TILE = 2048, 256
PENDING = 1 << 20  # entries counted in a task before they are handed on
HELD = 8 << 20  # bytes of texts that a task counts at once, about
# Letters of a term are all bytes from 0x80 and the Latin letters, of which capitals become small.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _words(bodies: pa.LargeBinaryArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Lower-case words of texts one after the other, empty ones among them, and how many come before each text."""
    ends = np.frombuffer(bodies.buffers()[1], np.int64)[bodies.offset : bodies.offset + len(bodies) + 1]
    data = bytes(memoryview(bodies.buffers()[2] or b"")[ends[0] : ends[-1]]).translate(_LETTERS)
    texts = pa.LargeStringArray.from_buffers(len(bodies), pa.py_buffer(ends - ends[0]), pa.py_buffer(data))
    split = pc.ascii_split_whitespace(texts)
    return split.values, split.offsets.to_numpy()


def _held(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Batches put together until their last column, the texts, has ``most`` bytes."""
    some, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        some.append(batch)
        size += batch.column(batch.num_columns - 1).nbytes
        if size > most:
            yield pa.Table.from_batches(some)
            some, size = [], 0
    if some:
        yield pa.Table.from_batches(some)


def _grouped(table: pa.Table) -> Iterator[tuple[tuple[str, ...], int, int, pa.LargeStringArray, np.ndarray]]:
    """Texts by the columns before them: (group, first and last text, words, words before each text)."""
    *names, body = table.column_names
    table = table.set_column(len(names), body, table.column(body).cast(pa.large_binary())).sort_by([(c, "ascending") for c in names])
    bodies = pa.concat_arrays(table.column(body).chunks)
    groups = list(zip(*(table.column(c).to_pylist() for c in names)))
    starts = [k for k, g in enumerate(groups) if not k or g != groups[k - 1]]
    words, before = _words(bodies)
    for a, b in zip(starts, [*starts[1:], len(groups)]):
        yield groups[a], a, b, words, before


def _rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(empty(lang).alias("lang"), empty(source).alias("source"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))


def _names(terms: pa.Array) -> pa.Array:
    """Terms as text; bytes that are none are replaced."""
    try:
        return terms.cast(pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in terms.cast(pa.binary()).to_pylist()], pa.string())


def _document_counts(rows: DataFrame, most: int, held: int) -> DataFrame:
    """(lang, term, n): documents of each language that hold a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
        pending = 0

        def told() -> Iterator[pa.RecordBatch]:
            for lang, parts in found.items():
                codes = pa.concat_arrays([terms for terms, _ in parts]).dictionary_encode()
                n = np.zeros(len(codes.dictionary), np.int64)
                np.add.at(n, codes.indices.to_numpy(), np.concatenate([k for _, k in parts]))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), _names(codes.dictionary), pa.array(n)], names=["lang", "term", "n"])
            found.clear()

        for table in _held(batches, held):
            for (lang,), a, b, words, before in _grouped(table):
                codes = words[before[a] : before[b]].dictionary_encode()
                different, which = codes.dictionary, codes.indices.to_numpy()
                if not len(different):
                    continue
                text = np.repeat(np.arange(b - a), np.diff(before[a : b + 1]))
                once = np.sort(text * len(different) + which)
                once = once[np.diff(once, prepend=-1) != 0] % len(different)
                terms = pc.not_equal(different, "")
                found.setdefault(lang, []).append((different.filter(terms), np.bincount(once, minlength=len(different))[terms.to_numpy(zero_copy_only=False)]))
                pending += len(different)
            if pending > most:
                yield from told()
                pending = 0
        yield from told()

    return rows.select("lang", "body").mapInArrow(count, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))


def vocabulary(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_docs: int = MIN_DOCS, range_terms: int = RANGE_TERMS, pending: int = PENDING, held: int = HELD,
) -> DataFrame:
    """(lang, part, term, ordinal, first, terms): kept terms with their places in their language.

    Terms of one (lang, part) are a sorted range of ``terms`` terms, the first with the ordinal ``first``.
    The result is stored.
    """
    kept = saved(_document_counts(_rows(docs, text, lang, lang), pending, held).where(F.col("n") >= min_docs).select("lang", "term"))
    parts = kept.count() // range_terms + 1
    ranged = saved(kept.repartitionByRange(parts, "lang", "term").withColumn("part", F.spark_partition_id()))
    # One row for each range: ranges are as many as the vocabulary needs transducers.
    sizes = ranged.groupBy("lang", "part").agg(F.count("*").alias("terms"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("first", F.coalesce(F.sum("terms").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy("term")) - 1
    numbered = ranged.withColumn("place", place).join(sizes, ["lang", "part"])
    return saved(numbered.select("lang", "part", "term", (F.col("first") + F.col("place")).alias("ordinal"), "first", "terms"))


_ARRAYS = {"key": np.int64, "target": np.int64, "before": np.int64, "final": bool}


def transducers(terms: DataFrame) -> DataFrame:
    """(lang, part, first, terms, size, key, target, before, final): the transducer of each range. Stored."""

    def make(table: pa.Table) -> pa.Table:
        table = table.sort_by("ordinal")
        made = build(t.encode() for t in table.column("term").to_pylist())
        arrays = {name: [getattr(made, name).tobytes()] for name in _ARRAYS}
        head = {c: table.column(c).slice(0, 1) for c in ("lang", "part", "first", "terms")}
        return pa.table({**head, "size": [made.nbytes], **{k: pa.array(v, pa.binary()) for k, v in arrays.items()}})

    schema = "lang string, part int, first long, terms long, size long, key binary, target binary, before binary, final binary"
    return saved(terms.groupBy("lang", "part").applyInArrow(make, schema))


def _blocks(made: DataFrame, memory: int) -> Iterator[list[tuple[str, int, Transducer]]]:
    """Transducers in blocks of at most ``memory`` bytes, or one larger transducer; one block is held at a time."""
    sizes = made.select("lang", "part", "size").orderBy("lang", "part").toLocalIterator()
    block, total = [], 0

    def fetched(keys):
        few = made.where(F.struct("lang", "part").isin([F.struct(F.lit(a), F.lit(b)) for a, b in keys]))
        return [
            (r["lang"], r["first"], Transducer(*(np.frombuffer(r[name], kind) for name, kind in _ARRAYS.items()), r["terms"]))
            for r in few.collect()
        ]

    for row in sizes:
        if block and total + row["size"] > memory:
            yield fetched(block)
            block, total = [], 0
        block.append((row["lang"], row["part"]))
        total += row["size"]
    if block:
        yield fetched(block)


def _ordinals(words: pa.LargeStringArray, ranges: list[tuple[int, Transducer]]) -> np.ndarray:
    """Ordinals of distinct words in their language, -1 for those that are no terms. Ranges lie in order."""
    out = np.full(len(words), -1, np.int64)
    order = pc.array_sort_indices(words)
    ordered = words.take(order).cast(pa.large_binary())
    ends, order = np.frombuffer(ordered.buffers()[1], np.int64)[: len(words) + 1], order.to_numpy()
    data = np.frombuffer(ordered.buffers()[2] or b"", np.uint8)
    cuts = [bisect_left(range(len(words)), made.least(), key=lambda k: ordered[k].as_py()) for _, made in ranges]
    for (first, made), a, b in zip(ranges, cuts, [*cuts[1:], len(words)]):
        got = made.places(data, ends[a:b], np.diff(ends[a : b + 1]))
        out[order[a:b]] = np.where(got >= 0, got + first, -1)
    return out


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.BinaryArray:
    """The bytes of ``values``, cut at ``bounds``."""
    ends = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


_PLACE, _COUNT = np.int32, np.int64  # of the numbers in the columns places and counts
_PACKED = "strip long, places binary, counts binary, times long"


def _recounted(rows: DataFrame, block: list[tuple[str, int, Transducer]], most: int, held: int, strip: int) -> DataFrame:
    """(lang, source, strip, places, counts, times) of the terms of one block of transducers."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, list[tuple[int, Transducer]]] = {}
        for lang, first, made in sorted(shared.value, key=lambda x: x[:2]):
            by_lang.setdefault(lang, []).append((first, made))
        found: dict[tuple[str, str], list[tuple[np.ndarray, np.ndarray]]] = {}
        pending = 0

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), parts in found.items():
                ordinal, count = (np.concatenate(x) for x in zip(*parts))
                if len(parts) > 1:
                    order = np.argsort(ordinal, kind="stable")
                    ordinal, count = ordinal[order], count[order]
                    new = np.flatnonzero(np.diff(ordinal, prepend=-1))
                    ordinal, count = ordinal[new], np.add.reduceat(count, new)
                new = np.flatnonzero(np.diff(ordinal // strip, prepend=-1))
                bounds = np.append(new, len(ordinal))
                names = [pa.array([x] * len(new), pa.string()) for x in (lang, source)]
                packed = [pa.array(ordinal[new] // strip), _binary((ordinal % strip).astype(_PLACE), bounds), _binary(count, bounds), pa.array(np.add.reduceat(count, new))]
                yield pa.RecordBatch.from_arrays([*names, *packed], names=["lang", "source", "strip", "places", "counts", "times"])
            found.clear()

        for table in _held(batches, held):
            by_source: dict[str, list[tuple[str, int, int]]] = {}
            for (lang, source), a, b, words, before in _grouped(table):
                if lang in by_lang and before[a] < before[b]:
                    by_source.setdefault(lang, []).append((source, before[a], before[b]))
            for lang, groups in by_source.items():
                start = groups[0][1]  # the words of a language lie together
                codes = words[start : groups[-1][2]].dictionary_encode()
                places = _ordinals(codes.dictionary, by_lang[lang])[codes.indices.to_numpy()]
                for source, a, b in groups:
                    mine = places[a - start : b - start]
                    mine = mine[mine >= 0]
                    if len(mine):
                        ordinal, count = np.unique(mine, return_counts=True)
                        found.setdefault((lang, source), []).append((ordinal, count.astype(_COUNT)))
                        pending += len(ordinal)
            if pending > most:
                yield from told()
                pending = 0
        yield from told()

    return _added(rows.mapInArrow(stream, f"lang string, source string, {_PACKED}"), ["lang", "source"], strip)


def _added(packed: DataFrame, keys: list[str], strip: int) -> DataFrame:
    """One row for each of ``keys`` and strip: counts added up, in a stream that has one strip at a time."""
    schema = pa.schema([*((c, pa.string()) for c in keys), ("strip", pa.int64()), ("places", pa.binary()), ("counts", pa.binary()), ("times", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, last, out = np.zeros(strip, _COUNT), None, []

        def row():
            places = np.flatnonzero(dense)
            return *last, places.astype(_PLACE).tobytes(), dense[places].tobytes(), int(dense.sum())

        def told():
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *key, places, counts, _ in zip(*columns):
                if key != last:
                    if last is not None:
                        out.append(row())
                    if len(out) >= 256:
                        yield told()
                        out.clear()
                    last = key
                    dense[:] = 0
                dense[np.frombuffer(places, _PLACE)] += np.frombuffer(counts, _COUNT)
        if last is not None:
            out.append(row())
            yield told()

    keys = [*keys, "strip"]
    ordered = packed.select(*keys, "places", "counts", "times").repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(add, ", ".join(f"{c} string" for c in keys[:-1]) + f", {_PACKED}")


def recounted(
    docs: DataFrame, made: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    memory: int = MEMORY, pending: int = PENDING, held: int = HELD, strip: int = STRIP,
) -> DataFrame:
    """(lang, source, strip, places, counts, times): occurrences of kept terms, streamed through the transducers ``made``.

    ``places`` are those of the terms in their strip, from 0, as int32; ``counts`` their occurrences as int64; ``times``
    all of these. Terms that do not occur are left out. Transducers of another block have rows of their own. Stored.
    """
    rows = _rows(docs, text, lang, source)
    out = None
    for block in _blocks(made, memory):
        part = saved(_recounted(rows, block, pending, held, strip))
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], f"lang string, source string, {_PACKED}")


def _share(count, total, terms):
    """1 + floor(10**9 (count + 2) / (N + 2 V)), which is 10**9 + 1 at most; decimals hold the product."""
    over = (count + F.lit(2)).cast("decimal(20,0)") * F.lit(10**9).cast("decimal(11,0)")
    under = total.cast("decimal(20,0)") + terms.cast("decimal(20,0)") * F.lit(2).cast("decimal(1,0)")
    return F.lit(1).cast("long") + F.call_function("div", over, under)


def _shares(counts: bytes, total: int, terms: int) -> np.ndarray:
    """``_share`` of the counts of one row."""
    count, under = np.frombuffer(counts, _COUNT), total + 2 * terms
    if count.max(initial=0) < 9 * 10**9:
        return 1 + (count + 2) * 10**9 // under
    return np.array([1 + (c + 2) * 10**9 // under for c in count.tolist()], np.int64)


def _pair_sums(table: pa.Table, tile: int) -> pa.Table:
    """Sums of divergences over one strip of terms between the sources of two tiles."""
    one = lambda c: table.column(c)[0].as_py()
    lang, left, right, width = one("lang"), one("left"), one("right"), one("width")
    nth, none = (table.column(c).to_numpy() for c in ("nth", "none"))
    numbers, which = np.unique(nth, return_inverse=True)
    dense = np.empty((len(numbers), width), np.int64)
    dense[which] = none[:, None]
    said = table.select(["places", "counts", "N", "V"]).to_pydict()
    for k, places, *row in zip(which.tolist(), *said.values()):
        if places is not None:
            dense[k, np.frombuffer(places, _PLACE)] = _shares(*row)
    a, b, value = [], [], []
    ours, theirs = np.flatnonzero(numbers // tile == left), np.flatnonzero(numbers // tile == right)
    for k in ours.tolist():
        others = theirs[theirs > k]
        if len(others):
            apart, both = dense[others] - dense[k], dense[others] + dense[k]
            sums = (apart * apart // both).sum(axis=1)
            a.append(np.full(len(others), numbers[k]))
            b.append(numbers[others])
            value.append(sums)
    a, b, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, value))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "value": pa.array(value, pa.int64())})


def _above(table: pa.Table, whole: pa.Table, strip: int, top: int) -> pa.Table:
    """The first terms of each source of a tile in one strip, against the language ``whole``."""
    language = np.zeros(strip, np.int64)
    for places, *row in zip(*whole.select(["places", "counts", "N", "V"]).to_pydict().values()):
        language[np.frombuffer(places, _PLACE)] = _shares(*row)
    out = {"lang": [], "source": [], "ordinal": [], "value": []}
    for lang, source, at, places, *row in zip(*table.select(["lang", "source", "strip", "places", "counts", "N", "V"]).to_pydict().values()):
        place, p = np.frombuffer(places, _PLACE), _shares(*row)
        q = language[place]
        place, p, q = (x[p > q] for x in (place, p, q))
        value = (p - q) * (p - q) // (p + q)
        # Places ascend, so terms of one value stay in order.
        first = np.argsort(-value, kind="stable")[:top]
        out["lang"] += [lang] * len(first)
        out["source"] += [source] * len(first)
        out["ordinal"] += (place[first].astype(np.int64) + at * strip).tolist()
        out["value"] += value[first].tolist()
    return pa.table(out, schema=pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("value", pa.int64())]))


def audited(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    min_docs: int = MIN_DOCS, top: int = TOP, memory: int = MEMORY, range_terms: int = RANGE_TERMS, strip: int = STRIP, tile: int = TILE, pending: int = PENDING, held: int = HELD,
) -> DataFrame:
    """(lang, source, part, item, value, rank) as described above.

    Null texts, languages and sources count as empty ones. Every (language, source) that occurs has a row in
    part ``pair`` for each other source of its language, with the value 0 where the language keeps no term.
    Ties go to the item that comes first in byte order. Rows may repeat: each counts. An empty table gives an
    empty result. Other columns are not looked at.
    """
    terms = vocabulary(docs, text, lang, min_docs, range_terms, pending, held)
    counts = recounted(docs, transducers(terms), text, lang, source, memory, pending, held, strip)
    groups = _rows(docs, text, lang, source).select("lang", "source").distinct()
    kept = terms.groupBy("lang").agg(F.count("*").alias("V"))
    totals = counts.groupBy("lang", "source").agg(F.sum("times").alias("N"))
    # One row for each group, numbered within its language.
    groups = groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").na.fill(0, ["N", "V"])
    groups = saved(groups.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1))
    return _pairs(counts, groups, strip, tile).unionByName(_distinctive(counts, groups, terms, top, strip, tile))


def _pairs(counts: DataFrame, groups: DataFrame, strip: int, tile: int) -> DataFrame:
    """Part ``pair``: every two sources of a language over all kept terms."""
    tiles = groups.groupBy("lang").agg((F.floor(F.max("nth") / tile)).alias("last"))
    strips = F.sequence(F.lit(0).cast("long"), F.floor((F.col("V") - 1) / strip))
    nothing = F.lit(None).cast("binary")
    # The share of a term that a source does not say is the same in all its strips.
    groups = groups.withColumn("none", F.when(F.col("V") > 0, _share(F.lit(0).cast("long"), F.col("N"), F.col("V"))))
    heads = groups.where("V > 0").withColumn("strip", F.explode(strips)).select("lang", "strip", "nth", nothing.alias("places"), nothing.alias("counts"), "N", "V", "none")
    said = counts.join(groups, ["lang", "source"]).select("lang", "strip", "nth", "places", "counts", "N", "V", "none")
    mine = F.floor(F.col("nth") / tile)
    tiled = heads.union(said).join(tiles, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    tiled = tiled.select(
        "lang", "strip", F.least(mine, "other").alias("left"), F.greatest(mine, F.col("other")).alias("right"), "nth", "places", "counts", "N", "V", "none",
        F.least(F.lit(strip), F.col("V") - F.col("strip") * strip).cast("int").alias("width"),
    )
    sums = tiled.groupBy("lang", "strip", "left", "right").applyInArrow(lambda t: _pair_sums(t, tile), "lang string, a long, b long, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.union(sums.select("lang", "b", "a", "value"))
    names = groups.select("lang", "nth", "source")
    # Every pair of the result, which has that many rows; values are missing only without kept terms.
    pairs = names.alias("x").join(names.alias("y"), "lang").where("x.nth <> y.nth")
    pairs = pairs.select("lang", F.col("x.nth").alias("a"), F.col("y.nth").alias("b"), F.col("x.source").alias("source"), F.col("y.source").alias("item"))
    pairs = pairs.join(both, ["lang", "a", "b"], "left").withColumn("value", F.coalesce("value", F.lit(0)).cast("long"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "b"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", place.alias("rank"))


def _distinctive(counts: DataFrame, groups: DataFrame, terms: DataFrame, top: int, strip: int, tile: int) -> DataFrame:
    """Part ``term``: the terms a source says more than its language does."""
    key = ["lang", "strip", "tile"]
    own = counts.join(groups, ["lang", "source"]).withColumn("tile", F.floor(F.col("nth") / tile))
    langs = groups.groupBy("lang").agg(F.sum("N").alias("N"), F.max("V").alias("V"), F.floor(F.max("nth") / tile).alias("last"))
    whole = _added(counts, ["lang"], strip).join(langs, "lang").withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    both = own.select(*key, "source", "places", "counts", "N", "V").groupBy(*key).cogroup(whole.select(*key, "places", "counts", "N", "V").groupBy(*key))
    first = both.applyInArrow(lambda a, b: _above(a, b, strip, top), "lang string, source string, ordinal long, value long")
    # Ordinals are in byte order of the terms and settle ties; names are joined to what is left.
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))
    first = first.withColumn("rank", place).where(F.col("rank") <= top)
    return first.join(terms.select("lang", "ordinal", "term"), ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
