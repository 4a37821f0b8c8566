"""Language identification by prediction by partial matching over bytes.

For each language a tree of byte contexts up to ``ORDER`` bytes long is learned: how often each byte
follows each context. A byte's probability comes from the longest context; a byte not seen there costs
an escape (distinct / (total + distinct)) and is looked up one byte shorter, in the end among 256
equal bytes. With the statistics frozen, the code length of a text is the exact sum over its bytes;
the language with the shortest code is predicted.

The trees are learned from at most ``PER_LANGUAGE`` texts of each language (a documented bound, chosen
by a hash of the id), so the model's size does not follow the corpus. All texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.session import settled

ORDER = 3
PER_LANGUAGE = 600
STEP = 1 << 20  # bytes scored at a time
_PAD = b"\n" * ORDER


def _grams(text: bytes) -> np.ndarray:
    """Each byte with the three before it, as one number."""
    b = np.frombuffer(_PAD + text, np.uint8).astype(np.uint32)
    return b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]


@dataclass
class Model:
    """Code lengths in bits. Columns are languages in ``names``."""

    names: list[str]
    grams: np.ndarray  # known (context of 3, byte), sorted
    gram_bits: np.ndarray
    contexts: np.ndarray  # known contexts of 3, sorted
    escapes: np.ndarray  # bits to leave them
    tri: np.ndarray  # known (context of 2, byte), sorted
    tri_bits: np.ndarray
    pair_escapes: np.ndarray  # bits to leave each context of 2
    pair_bits: np.ndarray  # (context of 1, byte)

    def bits(self, grams: np.ndarray) -> np.ndarray:
        out = np.empty((len(grams), len(self.names)), np.float32)
        known, at = _find(self.grams, grams)
        out[known] = self.gram_bits[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            g = grams[new]
            cost = np.zeros((len(g), len(self.names)), np.float32)
            seen, at = _find(self.contexts, g >> 8)
            cost[seen] += self.escapes[at[seen]]
            tri = g & 0xFFFFFF
            seen, at = _find(self.tri, tri)
            cost[seen] += self.tri_bits[at[seen]]
            rest = tri[~seen]
            cost[~seen] += self.pair_escapes[rest >> 8] + self.pair_bits[rest & 0xFFFF]
            out[new] = cost
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(texts), len(self.names)))
        for k, text in enumerate(texts):
            for at in range(0, len(text), STEP):
                # The bytes before a later piece are its context.
                piece = _grams(text[at : at + STEP]) if at == 0 else _grams(text[at - ORDER : at + STEP])[ORDER:]
                out[k] += self.bits(piece).sum(axis=0, dtype=np.float64)
        return out


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys, at


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """A model from, for each language, its distinct grams and their counts."""
    names = sorted(counts)
    every = [np.unique(np.concatenate([(counts[n][0] & mask) for n in names]).astype(np.uint32)) for mask in (0xFFFFFFFF, 0xFFFFFF)]
    contexts = np.unique(every[0] >> 8)
    shape = lambda n: np.zeros((n, len(names)), np.float32)
    m = Model(names, every[0], shape(len(every[0])), contexts, shape(len(contexts)), every[1], shape(len(every[1])), shape(1 << 16), shape(1 << 16))

    def level(grams, n, mask):
        """Distinct (context, byte) of one order, counts, and by context: total and distinct."""
        keys, inverse = np.unique(grams & mask, return_inverse=True)
        count = np.bincount(inverse, n, len(keys))
        ctx, inv = np.unique(keys >> 8, return_inverse=True)
        return keys, count, ctx, np.bincount(inv, count, len(ctx)), np.bincount(inv, minlength=len(ctx)).astype(float), inv

    for j, name in enumerate(names):
        grams, n = counts[name][0].astype(np.uint32), counts[name][1].astype(float)
        # Orders 0 and 1 have all their bytes in a table.
        keys, count, _, total, distinct, _ = level(grams, n, 0xFF)
        bits = np.full(256, np.log2((total[0] + distinct[0]) / distinct[0]) + 8)
        bits[keys] = np.log2((total[0] + distinct[0]) / count)
        pair = np.tile(bits, 256)
        keys, count, ctx, total, distinct, inv = level(grams, n, 0xFFFF)
        leave = np.zeros(256)
        leave[ctx] = np.log2((total + distinct) / distinct)
        pair += np.repeat(leave, 256)
        pair[keys] = np.log2((total + distinct)[inv] / count)
        m.pair_bits[:, j] = pair
        # Order 2: known ones of any language; those new to this language escape.
        keys, count, ctx, total, distinct, inv = level(grams, n, 0xFFFFFF)
        m.pair_escapes[ctx, j] = np.log2((total + distinct) / distinct)
        tri = m.pair_escapes[m.tri >> 8, j] + pair[m.tri & 0xFFFF]
        tri[np.searchsorted(m.tri, keys)] = np.log2((total + distinct)[inv] / count)
        m.tri_bits[:, j] = tri
        keys, count, ctx, total, distinct, inv = level(grams, n, 0xFFFFFFFF)
        m.escapes[np.searchsorted(m.contexts, ctx), j] = np.log2((total + distinct) / distinct)
        full = m.escapes[np.searchsorted(m.contexts, m.grams >> 8), j] + tri[np.searchsorted(m.tri, m.grams & 0xFFFFFF)]
        full[np.searchsorted(m.grams, keys)] = np.log2((total + distinct)[inv] / count)
        m.gram_bits[:, j] = full
    return m


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """The model of ``docs``, from at most ``per_language`` rows of each language; None without any.

    Rows with a null or empty text or a null language teach nothing.
    """
    rows = docs.where(F.col(lang).isNotNull() & (F.octet_length(text) > 0)).select(F.col(lang).alias("_lang"), F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text"))
    rows = rows.withColumn("_hash", F.xxhash64("_id"))
    nth = lambda *order: F.row_number().over(Window.partitionBy("_lang").orderBy(*order))
    # Hashes are ranked without their texts; the last one taken bounds what texts are looked at.
    ranked = rows.select("_lang", "_hash").withColumn("_nth", nth("_hash")).where(F.col("_nth") <= per_language)
    # One row per language, settled: the planner knows how few they are and leaves the texts where they lie.
    bounds = settled(ranked.groupBy(F.col("_lang").alias("_of")).agg(F.max("_hash").alias("_most")), "bounds")
    few = rows.join(bounds, (F.col("_lang") == F.col("_of")) & (F.col("_hash") <= F.col("_most")))
    # More only where ids repeat.
    chosen = few.withColumn("_nth", nth("_hash", F.xxhash64("_text"))).where(F.col("_nth") <= per_language).select("_lang", "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for name, body in zip(batch.column("_lang").to_pylist(), batch.column("_text")):
                texts.setdefault(name, []).append(_grams(body.as_py()))
            for name, grams in texts.items():
                keys, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"]
                )

    grams = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = grams.toPandas()
    return build({name: (g["gram"].to_numpy(), g["n"].to_numpy()) for name, g in table.groupby("lang")}) if len(table) else None


def identified(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row; only ``text`` is looked at.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned. The score is the
    probability of the predicted language if all are as likely beforehand. Equal code lengths go to the
    first language in order.
    """
    rows = docs.select(F.col(id), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters"), F.col(text).cast("binary").alias("_text"))
    if model is None:
        return rows.select(id, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            letters = batch.column("_letters").to_numpy(zero_copy_only=False)
            bits = m.lengths([t.as_py() if ok else b"" for t, ok in zip(batch.column("_text"), letters)])
            best = bits.argmin(axis=1)
            more = bits - bits[np.arange(len(bits)), best][:, None]
            score = np.where(letters, 1 / np.exp2(-np.minimum(more, 1000)).sum(axis=1), 0.0)
            names = [m.names[b] if ok else "und" for b, ok in zip(best, letters)]
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(names, pa.string()), pa.array(score)], names=[id, "lang_pred", "score"])

    return rows.mapInArrow(run, rows.select(id).schema.add("lang_pred", "string").add("score", "double"))
