"""Removed words against a table of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from helpers import SCHEMA, corpus, empty, words

from gaugeworks.llm import debruijn, repeats


def plain(rows):
    """Windows in order of (id, text): rows alike in both are one document."""
    docs = sorted({(r[0] is None, r[0] or 0, repeats_twin(r[1]), r[1] or "") for r in rows})
    first, out = {}, {}
    for k, (none, doc, twin, text) in enumerate(docs):
        w = words(text)
        gone = set()
        for i in range(len(w) - 19):
            win = tuple(w[i : i + 20])
            if first.setdefault(win, (k, i)) != (k, i):
                gone.update(range(i, i + 20))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out[None if none else doc, text] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept)
    return out


def repeats_twin(text):
    import xxhash

    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def check(frame, rows):
    want = plain(rows)
    got = debruijn.removed(frame, keep=("lang",)).collect()
    expect = Counter((r[0], r[2], *want[r[0], r[1] or ""][:3]) for r in rows)
    assert Counter((r.doc_id, r.lang, r.n_words, r.n_removed, r.kept_sha256) for r in got) == expect
    return got, want


def test_documents(documents):
    got, want = check(documents, corpus())
    assert sum(r.n_removed for r in got) > 1000
    for r in got:
        if r.n_removed:
            assert r.kept_text in {" ".join(v[3]) for (d, _), v in want.items() if d == r.doc_id}


@pytest.mark.parametrize("seed", [1, 2])
def test_small_alphabets(spark, seed):
    """Texts of few different words, full of overlapping repeats, and planted passages."""
    rng = np.random.default_rng(seed)
    passage = " ".join(f"w{k}" for k in rng.integers(0, 1000, 70))
    rows = []
    for k in range(120):
        n = int(rng.integers(0, 90))
        body = " ".join("ab"[x] for x in rng.integers(0, 2, n)) if k % 3 else " ".join(["x"] * n + ["y"] * (n % 4))
        if k % 4 == 0:
            cut = int(rng.integers(0, 30))
            body += " " + " ".join(passage.split()[cut : cut + 45]) + " \n" + body[:40]
        rows.append((k, body, "en", "s", len(body), 7, "x", "y", "z"))
    check(spark.createDataFrame(rows, SCHEMA), [r[:5] for r in rows])


def test_same_columns(spark, documents):
    out = debruijn.without_repeats(documents)
    assert out.columns == documents.columns and out.count() == len(corpus())
    assert {r.n_chars == len(r.text) for r in out.where("text is not null and doc_id < 1000").collect()} == {True}
    assert debruijn.removed(empty(spark)).count() == 0


def test_rolling_and_least():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 64, 200, dtype=np.uint64)
    for width in (1, 2, 3, 8, 13, 18, 20, 33, 50):
        got = repeats.rolling(x, width, 0xD1342543DE82EF95)
        for i in range(0, 200 - width, 17):
            h = 0
            for v in x[i : i + width]:
                h = (h * 0xD1342543DE82EF95 + int(v)) % (1 << 64)
            assert int(got[i]) == h
        assert (repeats.least(x, width)[: 201 - width] == [x[i : i + width].min() for i in range(201 - width)]).all()
