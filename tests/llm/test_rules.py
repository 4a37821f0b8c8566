"""Traits against plain Python, the estimation against labels."""

import re
from collections import Counter

import pytest
from helpers import SF, corpus, empty, words
from pyspark.sql import functions as F

from gaugeworks.llm import rules


def plain(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {t for t, n in Counter(windows).items() if n > 1}
    covered = {j for i, t in enumerate(windows) if t in often for j in (i, i + 1, i + 2)}
    lines = [s for s in (text or "").split("\n") if words(s)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_traits(documents):
    got = rules.rated(documents).select("doc_id", *rules.TRAITS, "base_failed").collect()
    assert Counter(tuple(r) for r in got) == Counter((r[0], *plain(r[1])) for r in corpus())


def test_verdicts(spark, documents):
    kept = rules.accepted(documents)
    assert kept.columns == documents.columns
    rated = rules.rated(documents)
    assert kept.count() == rated.where("kept").count()
    assert rated.where("kept and base_failed").count() == 0
    assert rated.where("quality < 0 or quality > 1 or quality is null").count() == 0


def test_estimation_separates_labelled_texts(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet").withColumnRenamed("quality", "label")
    rated = rules.rated(docs).join(labels, "doc_id").where("not base_failed")
    got = {(r.label, r.kept): r.n for r in rated.groupBy("label", "kept").agg(F.count("*").alias("n")).collect()}
    assert got[1, True] / (got[1, True] + got.get((1, False), 0)) > 0.97
    assert got.get((0, False), 0) / (got.get((0, False), 0) + got.get((0, True), 0)) > 0.9


def test_empty(spark):
    assert rules.rated(empty(spark)).count() == 0
    assert rules.accepted(empty(spark)).count() == 0


def test_estimation_on_a_known_mixture(spark):
    """Votes drawn with known accuracies: the estimated odds are close to the true ones."""
    import random

    rnd = random.Random(5)
    rows = []
    for _ in range(4000):
        good = rnd.random() < 0.8
        rows.append(tuple((1 if good else -1) * (1 if rnd.random() < 0.85 else -1) for _ in rules.RULES))
    model = rules.fit(spark.createDataFrame(rows, ", ".join(f"vote_{r} int" for r in rules.RULES)))
    for rule in rules.RULES:
        assert model[rule][2] == pytest.approx(1.73, abs=0.35)
        assert model[rule][0] == pytest.approx(-1.73, abs=0.35)
