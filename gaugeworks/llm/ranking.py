"""Quality scores by Bradley-Terry ranking of preference pairs.

A good text is preferred to a bad one. The probability that one text is preferred to another is the
logistic function of the difference of their scores, and a score is linear in the traits of a text; the
weights minimise the logistic loss on the trait differences of pairs. The decision threshold is the
quantile of scores that leaves as large a share below it as there are bad labels.

Traits are Spark expressions over whole texts. Weights and threshold are learned from all labelled texts
and all pairs of a good and a bad one. Pairs are not listed: a text meets the texts of the other label by
``BINS`` ranges of their scores, each by its number, mean, variance and sum of traits, so a round reads the
labelled rows twice. What this neglects is of the third order in the width of a range.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.rules import traits
from gaugeworks.session import settled

BINS = 4096  # ranges of scores, between the least and the greatest that weights allow
MOST = 6.0  # standard deviations; traits further off count as this far
CUT = 0.7  # the score that stands for the threshold


def _features() -> list[Column]:
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    closed = share("n_closed", "n_words")
    return [
        share("n_symbols", "word_chars"), share("n_marked", "n_words"), share("n_repeat_words", "n_words"), share("n_dup_lines", "n_lines"),
        share("n_upper", "word_chars"), share("n_distinct", "n_words"), closed, closed * closed, F.log1p(F.col("n_words").cast("double")),
        F.least(share("word_chars", "n_words"), F.lit(40.0)), (F.col("n_symbols") > 0).cast("double"), (F.col("n_dup_lines") > 0).cast("double"),
        F.log1p(F.col("n_lines").cast("double")), F.least(F.lit(1.0), 4 * share("n_marked", "n_words")), F.least(F.lit(1.0), 3 * share("n_repeat_words", "n_words")),
    ]


def featured(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(_id, f): the traits of each text as numbers."""
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    return traits(rows, "_text").select("_id", F.array(*_features()).alias("f"))


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float


@dataclass
class Bins:
    """Texts of one label by ranges of their scores: number, mean and variance of scores, sums of traits."""

    n: np.ndarray
    mean: np.ndarray
    variance: np.ndarray
    total: np.ndarray


def _slopes(z: np.ndarray, y: np.ndarray, w: np.ndarray, bins: dict[int, Bins]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of slope and curve of the logistic loss that rows give, over all pairs with the other label's ``bins``."""
    k = z.shape[1]
    slope, curve = np.zeros(k), np.zeros((k, k))
    for label, sign in ((1, 1.0), (0, -1.0)):
        own, other = z[y == label], bins[1 - label]
        for rows in (own[at : at + 512] for at in range(0, len(own), 512)):
            # How likely the bad text of a pair is preferred; h and h * (1 - 2 * p) are the derivatives.
            p = 1 / (1 + np.exp(-np.clip(sign * (other.mean - (rows @ w)[:, None]), -500, 500)))
            h = p * (1 - p)
            slope -= sign * ((p + other.variance / 2 * h * (1 - 2 * p)) @ other.n) @ rows
            curve += (rows * (h @ other.n)[:, None]).T @ rows
            if label == 1:
                cross = rows.T @ (h @ other.total)
                curve -= cross + cross.T
    return slope, curve


def _descended(k: int, pairs: int, slopes: Callable, penalty: float, rounds: int) -> np.ndarray:
    """The weights of ``k`` traits by Newton steps; ``slopes`` gives sums over all ``pairs``."""
    w = np.zeros(k)
    for _ in range(rounds):
        slope, curve = slopes(w)
        step = np.linalg.solve(curve / pairs + penalty * np.eye(k), slope / pairs + penalty * w)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 60) -> Ranking:
    """The ranking of a few rows of traits ``x`` and labels ``y`` (1 preferred to 0), pair by pair."""
    mean, scale = x.mean(0), np.where(np.ptp(x, 0) > 0, x.std(0), 1.0)
    z = np.clip((x - mean) / scale, -MOST, MOST)
    alone = lambda rows, w: Bins(np.ones(len(rows)), rows @ w, np.zeros(len(rows)), rows)
    w = _descended(z.shape[1], int((y == 1).sum() * (y == 0).sum()), lambda w: _slopes(z, y, w, {v: alone(z[y == v], w) for v in (0, 1)}), penalty, rounds)
    return Ranking(mean, scale, w, float(np.quantile(z @ w, np.mean(y == 0))))


def _weighed(k: int, w: np.ndarray) -> Column:
    return sum((F.col(f"z{i}") * float(w[i]) for i in range(1, k)), F.col("z0") * float(w[0]))


def _binned(rows: DataFrame, k: int, w: np.ndarray) -> dict[int, Bins]:
    """The bins of each label; ``rows`` have y and the traits z0, z1, ..."""
    most = MOST * float(np.abs(w).sum()) or 1.0
    width = 2 * most / BINS
    placed = rows.withColumn("s", _weighed(k, w)).withColumn("bin", F.floor((F.col("s") + most) / width))
    off = F.col("s") - ((F.col("bin") + 0.5) * width - most)
    sums = placed.groupBy("y", "bin").agg(F.count("*"), F.sum(off), F.sum(off * off), *[F.sum(f"z{i}") for i in range(k)])
    found = np.array(sorted(map(tuple, sums.collect())), dtype=float)
    out = {}
    for label in (0, 1):
        own = found[found[:, 0] == label]
        n, shift = own[:, 2], own[:, 3] / own[:, 2]
        out[label] = Bins(n, (own[:, 1] + 0.5) * width - most + shift, np.maximum(own[:, 4] / n - shift * shift, 0.0), own[:, 5:])
    return out


def _summed(rows: DataFrame, k: int, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sums of ``_slopes`` over all rows; a task returns one row."""
    bins = _binned(rows, k, w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = np.zeros(k + k * k)
        for batch in batches:
            y, *z = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            slope, curve = _slopes(np.column_stack(z), y, w, bins)
            all_ += np.concatenate([slope, curve.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([all_.tolist()], pa.list_(pa.float64()))], names=["sums"])

    parts = rows.select("y", *[f"z{i}" for i in range(k)]).mapInArrow(run, "sums array<double>").collect()
    sums = np.array([math.fsum(v) for v in zip(*(r.sums for r in parts))])
    return sums[:k], sums[k:].reshape(k, k)


def _ranked(scores: DataFrame, k: int) -> float:
    """The value with ``k`` before it in the order of the column ``s``, by counting ever smaller ranges."""
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    while low < high:
        place = F.least(F.floor((F.col("s") - low) / ((high - low) / BINS)), F.lit(BINS - 1))
        within = scores.where(F.col("s").between(low, high)).groupBy(place.alias("place"))
        for _, n, low, high in sorted(map(tuple, within.agg(F.count("*"), F.min("s"), F.max("s")).collect())):
            if k < n:
                break
            k -= n
    return low


def learned(rows: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality", penalty: float = 1e-3, rounds: int = 60) -> Ranking | None:
    """``learn`` from ``rows`` that ``featured`` gives."""
    known = labels.where(F.col(id).isNotNull() & F.col(label).isin(0, 1)).select(F.col(id).alias("_label_id"), F.col(label).cast("int").alias("y"))
    taught = settled(rows.join(known, F.col("_id") == F.col("_label_id")).select("y", "f"), "taught")
    k = len(_features())
    value = lambda i: F.get("f", F.lit(i))
    stats = taught.agg(F.count("*"), F.sum("y"), *[a(value(i)) for a in (F.avg, F.stddev_pop, F.min, F.max) for i in range(k)]).first()
    n, good = stats[0], stats[1] or 0
    if good == 0 or good == n:
        return None
    # Sums differ in their last digits by the order in which tasks end; rounding levels that.
    level = lambda v: np.array([float(f"{x:.12g}") for x in v])
    mean, spread, least, greatest = (np.array(stats[2 + a * k : 2 + (a + 1) * k], dtype=float) for a in range(4))
    mean, scale = level(mean), level(np.where(greatest > least, spread, 1.0))
    clipped = lambda i: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), (value(i) - float(mean[i])) / float(scale[i])))
    z = settled(taught.select("y", *[clipped(i).alias(f"z{i}") for i in range(k)]), "taught")
    w = np.round(_descended(k, good * (n - good), lambda w: _summed(z, k, w), penalty, rounds), 9)
    scores, at = z.select(_weighed(k, w).alias("s")), (n - 1) * ((n - good) / n)
    below, above = _ranked(scores, math.floor(at)), _ranked(scores, math.ceil(at))
    return Ranking(mean, scale, w, below + (above - below) * (at - math.floor(at)))


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality") -> Ranking | None:
    """A ranking from all labelled rows, None unless there are both labels.

    Rows with a null id or label teach nothing; an id labelled twice counts twice.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(id).alias("_label_id")).distinct()
    own = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(known, F.col("_id") == F.col("_label_id"), "left_semi")
    return learned(featured(own, "_id", "_text"), labels, id, label)


def scored(docs: DataFrame, model: Ranking | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, predicted) of every row; a score of 0.7 stands for the threshold.

    Null, empty and blank texts are scored by their traits, all zero. Without a model scores are 0.5.
    """
    return rated(featured(docs, id, text), model, id)


def rated(rows: DataFrame, model: Ranking | None, id: str = "doc_id") -> DataFrame:
    """``scored`` for ``rows`` that ``featured`` gives."""
    if model is None:
        return rows.select(F.col("_id").alias(id), F.lit(0.5).alias("score"), F.lit(0).alias("predicted"))
    raw = F.lit(math.log(CUT / (1 - CUT)) - model.threshold)
    for k, (m, s, w) in enumerate(zip(model.mean, model.scale, model.weights)):
        z = F.greatest(F.lit(-MOST), F.least(F.lit(MOST), (F.get("f", F.lit(k)) - float(m)) / float(s)))
        raw = raw + z * float(w)
    out = rows.withColumn("score", 1 / (1 + F.exp(-raw)))
    return out.select(F.col("_id").alias(id), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
