"""Code lengths against a direct walk of the context trees; held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import SF, corpus, empty

from gaugeworks.llm import language, queries


def plain_bits(train, text):
    """Escape from the longest context downwards, straight from counts."""
    seen = [defaultdict(Counter) for _ in range(4)]
    for t in train:
        t = b"\n\n\n" + t
        for i in range(3, len(t)):
            for k in range(4):
                seen[k][t[i - k : i]][t[i]] += 1
    total, t = 0.0, b"\n\n\n" + text
    for i in range(3, len(t)):
        for k in range(3, -1, -1):
            counts = seen[k].get(t[i - k : i])
            if counts is None:
                continue
            n, d = sum(counts.values()), len(counts)
            if t[i] in counts:
                total += math.log2((n + d) / counts[t[i]])
                break
            total += math.log2((n + d) / d)
        else:
            total += 8
    return total


def test_code_lengths(monkeypatch):
    train = {"a": [b"the cat sat on the mat", b"then"], "b": ["le chat était là".encode(), b"ele"], "c": [b"x"]}
    counts = {}
    for name, texts in train.items():
        counts[name] = np.unique(np.concatenate([language._grams(t) for t in texts]), return_counts=True)
    model = language.build(counts)
    texts = [b"", b"the chat", b"zzz", "là-bas était".encode(), b"then the cat", bytes(range(256))]
    want = [[plain_bits(train[n], t) for n in model.names] for t in texts]
    assert model.lengths(texts) == pytest.approx(np.array(want), rel=1e-4, abs=1e-3)
    monkeypatch.setattr(language, "STEP", 7)
    assert model.lengths(texts) == pytest.approx(np.array(want), rel=1e-4, abs=1e-3)


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    got = queries.QUERIES["op4_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, documents):
    model = language.learn(documents)
    got = language.identified(documents, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in corpus())
    pred = {r.doc_id: r for r in got if r.doc_id}
    assert all(pred[i].lang_pred == "und" and pred[i].score == 0 for i in (1001, 1002, 1003))
    assert language.learn(empty(spark)) is None
    assert {r.lang_pred for r in language.identified(documents, None).collect()} == {"und"}
    assert language.identified(empty(spark), model).count() == 0


def test_query_against_a_direct_walk(spark):
    """What is learned, what is held out, what is predicted and the score, from the tables alone."""
    import re
    import zlib

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    part = lambda r: zlib.crc32(str(r.doc_id).encode()) % 3
    seen = defaultdict(lambda: [defaultdict(Counter) for _ in range(4)])
    for r in docs:
        if part(r) != 1 and r.lang is not None and r.text:
            t = b"\n\n\n" + r.text.encode()
            for k, own in enumerate(seen[r.lang]):
                for i in range(3, len(t)):
                    own[t[i - k : i]][t[i]] += 1

    def bits(own, text):
        total, t = 0.0, b"\n\n\n" + text
        for i in range(3, len(t)):
            for k in range(3, -1, -1):
                counts = own[k].get(t[i - k : i])
                if counts is None:
                    continue
                n, d = sums[id(counts)], len(counts)
                if t[i] in counts:
                    total += math.log2((n + d) / counts[t[i]])
                    break
                total += math.log2((n + d) / d)
            else:
                total += 8
        return total

    sums = {id(c): sum(c.values()) for own in seen.values() for k in own for c in k.values()}
    got = {r.doc_id: r for r in queries.QUERIES["op4_language"](spark, SF).collect()}
    assert set(got) == {r.doc_id for r in docs} and sum(r.held_out for r in got.values()) == sum(part(r) == 1 for r in docs)
    for r in sorted(docs, key=lambda r: len(r.text or ""))[:140]:
        row = got[r.doc_id]
        assert row.held_out == (part(r) == 1)
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        length = {name: bits(own, r.text.encode()) for name, own in seen.items()}
        best = min(length.values())
        assert length[row.lang_pred] - best < 1e-2
        assert row.score == pytest.approx(1 / sum(2 ** -(x - best) for x in length.values()), abs=1e-3)
