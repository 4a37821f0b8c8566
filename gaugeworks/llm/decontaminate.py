"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Texts are normalised to lower-case words joined by single spaces; each window of 13 consecutive item
words is a pattern. A document is scanned once. Each hit is mapped back from the normalised text to
words and to offsets in the original.

The automaton is built from at most ``block`` bytes of patterns, so its size in a worker is bounded. More
patterns are dealt over blocks by their hash; each block is a pass of its own over the rows, whose running
result is stored in the shared folder in between, so that one automaton is alive at a time. Patterns and
the items that have them are put together by Spark; the driver holds one block of them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.shared import fresh
from gaugeworks.session import settled

WIDTH = 13
BLOCK = 16 << 20
_WORD = np.array([48 <= c <= 57 or 97 <= c <= 122 or 65 <= c <= 90 or c >= 128 for c in range(256)])
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if _WORD[c] else 32 for c in range(256))

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
OUTPUT = [
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("hit_bytes", T.ArrayType(SPAN)),
]


def windows(text: bytes | None, width: int = WIDTH) -> list[bytes]:
    """Each run of ``width`` words of an item, or all of its words if it has fewer."""
    words = (text or b"").translate(_FOLD).split()
    return [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []


def patterns(items: DataFrame, id: str, text: str) -> DataFrame:
    """(pattern, ids, size): each window of the items once, as latin-1 text, with the ids of its items in order."""
    rows = items.select(F.col(id).cast("string").alias("item"), F.col(text).cast("binary").alias("body"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, body in zip(batch.column(0), batch.column(1)):
                own = sorted(set(windows(body.as_py())))
                for at in range(0, len(own), 4096):
                    part = [f" {w.decode('latin-1')} " for w in own[at : at + 4096]]
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(part), pa.string()), pa.array(part, pa.string())], names=["item", "pattern"])

    found = rows.mapInArrow(cut, "item string, pattern string").groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("ids"))
    size = F.length("pattern") + 16 + F.aggregate("ids", F.lit(0), lambda n, i: n + F.length(i) + 8)
    return found.withColumn("size", size.cast("long"))


def _blocks(found: DataFrame, block: int) -> Iterator[dict[str, list[str]]]:
    """Patterns with the ids of their items, in blocks of at most ``block`` bytes as far as one hash value allows."""
    total = found.agg(F.sum("size")).first()[0] or 0
    n = -(-total // block)
    while n > 1:
        largest = found.groupBy(F.pmod(F.xxhash64("pattern"), F.lit(n)).alias("b")).agg(F.sum("size").alias("s"), F.count("*").alias("c"))
        if not largest.where((F.col("s") > block) & (F.col("c") > 1)).head(1):
            break
        n += -(-n // 4)
    for b in range(n):
        rows = found.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == b).select("pattern", "ids").collect()
        if rows:
            yield {r["pattern"]: r["ids"] for r in rows}


_built: dict[str, object] = {}


def _automaton(key: str, patterns: dict[str, list[str]]):
    """One automaton at a time is kept per worker process."""
    if key not in _built:
        machine = ahocorasick.Automaton()
        machine.add_word("\n", (0, []))  # in no normalised text; an automaton may not be empty
        for pattern, ids in patterns.items():
            machine.add_word(pattern, (pattern.count(" ") - 1, ids))
        machine.make_automaton()
        _built.clear()
        _built[key] = machine
    return _built[key]


def scan(text: bytes | None, machine) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, runs of hit words (first, behind the last), items found."""
    words = (text or b"").translate(_FOLD).split()
    if not words:
        return 0, [], set()
    plain = " " + b" ".join(words).decode("latin-1") + " "
    found: set[str] = set()
    runs: list[tuple[int, int]] = []
    ends = None
    for at, (n, ids) in machine.iter(plain):
        if ends is None:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        stop = int(np.searchsorted(ends, at)) + 1
        found.update(ids)
        if runs and stop - n <= runs[-1][1]:
            first = stop - n
            while runs and first <= runs[-1][1]:
                first = min(first, runs.pop()[0])
            runs.append((first, stop))
        else:
            runs.append((stop - n, stop))
    return len(words), runs, found


def _spans(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Byte offsets in the original of runs of words."""
    inside = _WORD[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return [{"start": int(edge[2 * a]), "end": int(edge[2 * b - 1])} for a, b in runs]


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """All rows and columns of ``docs`` with the hits of ``items`` in their ``text``.

    Adds n_words, n_hit (words inside an occurrence of an item window), n_items, items_sha256 (of the
    comma-joined sorted ids), contaminated (n_hit > 0 and at least 5 % of the words), item_ids and
    hit_bytes (runs of hit words as UTF-8 offsets in the original text); columns of these names are
    replaced. A null or wordless text has no words and no hit, a null item none either; items with a
    null id count for hits but not as items. Repeated rows and items change nothing. Without items
    nothing is contaminated.
    """
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in {f.name for f in OUTPUT}]
    schema = T.StructType([f for f in docs.select(*rest).schema] + OUTPUT)
    runs_, ids_ = fresh(docs, "_runs", "_ids")
    state = [T.StructField(runs_, T.ArrayType(T.LongType())), T.StructField(ids_, T.ArrayType(T.StringType()))]
    rows = docs.select(*rest, F.lit(None).cast("array<long>").alias(runs_), F.lit(None).cast("array<string>").alias(ids_))

    def step(patterns, key: str):
        shared = spark.sparkContext.broadcast(patterns)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machine = _automaton(key, shared.value)
            for batch in batches:
                texts = batch.column(text).cast(pa.binary())
                new = {f.name: [] for f in [*OUTPUT, *state]}
                for body, runs, ids in zip(texts, batch.column(runs_).to_pylist(), batch.column(ids_).to_pylist()):
                    body = body.as_py()
                    n, more, found = scan(body, machine)
                    runs = _merged(list(zip((runs or [])[::2], (runs or [])[1::2])) + more)
                    items = sorted({*(ids or []), *found})
                    hit = sum(b - a for a, b in runs)
                    values = {
                        "n_words": n, "n_hit": hit, "n_items": len(items),
                        "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(),
                        "contaminated": hit > 0 and 20 * hit >= n, "item_ids": items,
                        "hit_bytes": _spans(body, runs) if runs else [], runs_: [x for r in runs for x in r], ids_: items,
                    }
                    for name, value in values.items():
                        new[name].append(value)
                types = {**_ARROW, runs_: pa.list_(pa.int64()), ids_: pa.list_(pa.string())}
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in rest] + [pa.array(v, types[k]) for k, v in new.items()], names=[*rest, *new]
                )

        return run

    token = uuid.uuid4().hex
    found = settled(patterns(items, item_id, item_text), "patterns")
    none: dict[str, list[str]] = {}
    for n, block_ in enumerate(_blocks(found, block)):
        if n:
            rows = settled(rows, "contamination")
        rows = rows.select(*rest, runs_, ids_).mapInArrow(step(block_, f"{token}-{n}"), T.StructType([*schema, *state]))
        none = block_
    if not none:
        rows = rows.select(*rest, runs_, ids_).mapInArrow(step(none, f"{token}-none"), T.StructType([*schema, *state]))
    return rows.select(*[f.name for f in schema])


_ARROW = {
    "n_words": pa.int64(), "n_hit": pa.int64(), "n_items": pa.int64(), "items_sha256": pa.string(), "contaminated": pa.bool_(),
    "item_ids": pa.list_(pa.string()), "hit_bytes": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
}


def clean(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    rated = contamination(docs.select(F.struct(*docs.columns).alias("_row"), F.col(kw.pop("text", "text")).alias("text")), items, **kw)
    return rated.where(~F.col("contaminated")).select("_row.*")
