"""Suffix arrays against sorted suffixes, removed bytes against a table of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from helpers import SCHEMA, corpus, empty

from gaugeworks.llm import suffix


@pytest.mark.parametrize("short", [1, 7, 1 << 18])
def test_suffix_arrays(monkeypatch, short):
    monkeypatch.setattr(suffix, "SHORT", short)
    rng = np.random.default_rng(short)
    for t in range(150):
        n, sigma = int(rng.integers(0, 300)), int(rng.integers(1, 6))
        s = rng.integers(0, sigma, n).astype(np.int32)
        if t % 3 == 0:
            s = np.concatenate([s[:60]] * 4 + [s])
        v, order = s.tolist(), suffix.suffix_array(s, sigma)
        assert order.tolist() == sorted(range(len(v)), key=lambda i: v[i:])
        prefix = suffix.permuted_prefixes(s, order, 50) if len(v) else []
        for b, a in zip(order[:-1], order[1:]):
            k = 0
            while k < 50 and max(a, b) + k < len(v) and v[a + k] == v[b + k]:
                k += 1
            assert prefix[a] == k


def plain(rows):
    """A byte goes if a window over it starts in a document with a smaller id."""
    first = {}
    docs = [(r[0] if r[0] is not None else 1 << 70, (r[1] or "").encode()) for r in rows]
    for doc, b in docs:
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            first[w] = min(first.get(w, doc), doc)
    out = []
    for (doc, b), r in zip(docs, rows):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < doc:
                gone[i : i + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((r[0], len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return Counter(out)


def check(frame, rows, frequent_from=suffix.FREQUENT, together=suffix.TOGETHER):
    got = suffix.removed(frame, frequent_from=frequent_from, together=together).collect()
    want = plain(rows)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got) == want
    assert sum(r.n_removed for r in got) > 0


def test_documents(documents):
    check(documents, corpus())


def test_frequent_marks_are_dealt_by_strips(spark):
    """A phrase in more kinds of surroundings than a frequent mark needs."""
    rng = np.random.default_rng(9)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    phrase, rows = word(60), []
    for k in range(900):
        body = word(int(rng.integers(0, 30))) + phrase[int(rng.integers(0, 3)) : int(rng.integers(51, 61))] + word(int(rng.integers(0, 30)))
        rows.append((k, body, "en", "s", len(body), 7, "x", "y", "z"))
    frame = spark.createDataFrame(rows, SCHEMA)
    layout = suffix.Layout(150, 8)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffix.Layout, "of", classmethod(lambda cls, *a: layout))
        answers = suffix.shared_marks(suffix.dealt(frame, layout, "doc_id", "text"), layout, suffix.byte_units, 50, 18, 64)
        assert any(any(r.frequent) for r in answers.collect())
        for together in (1, 5000, suffix.TOGETHER):
            check(frame, [r[:5] for r in rows], 64, together)


def test_every_mark_by_strips(spark, documents):
    """Marks of two kinds count as frequent: whole texts go through strips."""
    layout = suffix.Layout(12, 5)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffix.Layout, "of", classmethod(lambda cls, *a: layout))
        check(documents, corpus(), 2, 20_000)


def test_small_alphabets(spark):
    rng = np.random.default_rng(6)
    shared = bytes(rng.integers(97, 123, 300).astype(np.uint8)).decode()
    rows = []
    for k in range(100):
        n = int(rng.integers(0, 200))
        body = "".join("ab"[x] for x in rng.integers(0, 2, n)) if k % 3 else "é" * n + "\0" * (n % 70)
        if k % 4 == 0:
            cut = int(rng.integers(0, 200))
            body += "".join(chr(0x1F600 + int(x)) for x in rng.integers(0, 9, 5)) + shared[cut : cut + 90] + body[:70]
        rows.append((k // 2 if k > 90 else k, body, "en", "s", len(body), 7, "x", "y", "z"))
    check(spark.createDataFrame(rows, SCHEMA), [r[:5] for r in rows])


def test_empty(spark):
    assert suffix.removed(empty(spark)).count() == 0
