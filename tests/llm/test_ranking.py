"""Held-out accuracy and order of Bradley-Terry scores."""

from collections import Counter

import numpy as np
from helpers import SF, corpus, empty

from gaugeworks.llm import queries, ranking


def test_held_out_labels(spark):
    sf = SF.replace("0.001", "0.01")
    got = queries.QUERIES["op9_quality_ranking"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.93
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_weights_order_preferences():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 4))
    true = np.array([2.0, -1.0, 0.0, 0.5])
    y = (x @ true + rng.logistic(size=2000) > 0).astype(int)
    model = ranking.fit(x, y)
    w = model.weights / model.weights[0] * 2
    assert np.allclose(w, true, atol=0.35)
    below = ((np.clip((x - model.mean) / model.scale, -6, 6) @ model.weights) < model.threshold).mean()
    assert abs(below - (y == 0).mean()) < 0.01


def test_odd_rows(spark, documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (1004, 0), (None, 1), (3, None), (5, 7), (9, 1), (99999, 0)], "doc_id long, quality int")
    model = ranking.learn(documents, labels)
    got = ranking.scored(documents, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in corpus())
    assert all(0 <= r.score <= 1 for r in got)
    assert ranking.learn(documents, labels.where("quality = 1")) is None
    assert ranking.learn(empty(spark), labels) is None
    assert {r.score for r in ranking.scored(documents, None).collect()} == {0.5}
    assert ranking.scored(empty(spark), model).count() == 0


def plain_features(text):
    """The traits a score is made of, from the text alone."""
    import math
    import re

    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    joined, spaced = "".join(w), " ".join(w)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {t for t, n in Counter(windows).items() if n > 1}
    repeats = len({j for i, t in enumerate(windows) if t in often for j in (i, i + 1, i + 2)})
    symbols, duplicate = len(re.findall(r"[#*$%&|<>]", joined)), len(lines) - len(set(lines))
    share = lambda a, b: a / b if b else 0.0
    marked = share(len(re.findall(r"[#*$%&|<>][^ ]*", spaced)), len(w))
    closed = share(len(re.findall(r"[.,;:?!](?: |$)", spaced)), len(w))
    return [
        share(symbols, len(joined)), marked, share(repeats, len(w)), share(duplicate, len(lines)), share(len(re.findall("[A-Z]", joined)), len(joined)),
        share(len(set(w)), len(w)), closed, closed * closed, math.log1p(len(w)), min(40.0, share(len(joined), len(w))), float(symbols > 0), float(duplicate > 0),
        math.log1p(len(lines)), min(1.0, 4 * marked), min(1.0, 3 * share(repeats, len(w))),
    ]


def test_query_against_plain_features(spark):
    """Which rows teach, which are held out, and every score, from the tables alone."""
    import zlib

    part = lambda i: zlib.crc32(str(i).encode()) % 4
    docs = {r.doc_id: plain_features(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    known = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if part(r.doc_id) != 2 and r.quality in (0, 1) and r.doc_id in docs]
    x, y = np.array([docs[i] for i, _ in known]), np.array([q for _, q in known])
    order = np.lexsort(np.column_stack([x, y]).T)
    model = ranking.fit(x[order], y[order])
    got = {r.doc_id: r for r in queries.QUERIES["op9_quality_ranking"](spark, SF).collect()}
    assert set(got) == set(docs)
    for i, f in docs.items():
        z = np.clip((np.array(f) - model.mean) / model.scale, -6, 6) @ model.weights - model.threshold
        want = 1 / (1 + np.exp(-(z + np.log(ranking.CUT / (1 - ranking.CUT)))))
        assert abs(got[i].score - want) < 1e-6 and got[i].held_out == (part(i) == 2)
        assert got[i].predicted == (got[i].score >= ranking.CUT)


def test_all_labelled_rows_teach(spark):
    """Means, weights and threshold of more rows than a sample would hold, against all pairs one by one."""
    def text(i):
        return " ".join(["ab", "Cde.", "#x", "y,", "zz"][(i * 7 + j * j * (i % 11)) % 5] for j in range(1 + i % 13)) + ("\nzz" * (i % 3))

    rows = [(i, text(i), 0 if i % 400 == 7 or i % 3001 == 11 else 1) for i in range(22_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(4).cache()
    model = ranking.learn(table.select("doc_id", "text"), table.select("doc_id", "quality"))
    traits = {t: plain_features(t) for t in {r[1] for r in rows}}
    want = ranking.fit(np.array([traits[t] for _, t, _ in rows]), np.array([q for *_, q in rows]))
    table.unpersist()
    assert np.allclose(model.mean, want.mean, rtol=1e-9) and np.allclose(model.scale, want.scale, rtol=1e-9)
    assert np.allclose(model.weights, want.weights, atol=1e-6) and abs(model.threshold - want.threshold) < 1e-5


def test_ranked_values(spark):
    values = [0.0, -3.5, 1e-9, 1e-9, 1e-9, 7.0, 7.0, -1e6, 1e6, 2.0, 2.0 + 1e-15]
    scores = spark.createDataFrame([(v,) for v in values], "s double")
    assert [ranking._ranked(scores, k) for k in range(len(values))] == sorted(values)
