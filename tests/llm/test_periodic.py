"""Periodic runs against a search that tries every period at every word."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import SF, corpus, empty, words

from gaugeworks.llm import periodic as p
from gaugeworks.llm import queries


def every_run(w, shortest=0):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(shortest, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, q, b) for (a, b), q in found.items())


def listed(found):
    return [(int(a), int(q), int(b)) for a, b, q in found]


def texts():
    pick = random.Random(3)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    thue = [bin(i).count("1") % 2 for i in range(512)]
    out = [[], [1], [1, 1], list(range(50)), [4] * 300, fib[-1], thue, thue * 2, ([0] * 70 + [1]) * 3, list(range(80)) * 5 + [9] * 200 + list(range(80)) * 3]
    for _ in range(250):
        w = [pick.randrange(pick.choice([1, 2, 3, 50])) for _ in range(pick.randint(0, 150))]
        for _ in range(pick.randint(0, 3)):
            size = pick.randint(1, 60)
            u = [pick.randrange(pick.choice([1, 2, 3, 100])) for _ in range(size)] * 6
            r = u[: pick.randint(2 * size, 6 * size)]
            if pick.random() < 0.3:
                r[pick.randrange(len(r))] = 7
            at = pick.randint(0, len(w))
            w[at:at] = r
        out.append(w)
    return out


def test_all_runs():
    for w in texts():
        assert listed(p.runs(np.array(w, np.int64))) == every_run(w)


def test_hashes_that_mislead(monkeypatch):
    # Hashes that call everything equal propose nonsense; comparing words still leaves true runs only.
    monkeypatch.setattr(p._Text, "alike", lambda self, at, q, size: np.ones(len(at), bool))
    for w in texts()[:80]:
        found = listed(p.runs(np.array(w, np.int64)))
        assert set(found) <= set(every_run(w)) and found == every_run(w)


def test_texts_side_by_side():
    lists = [[str(x).encode() for x in w] for w in texts()]
    laid, first = p._laid(lists)
    found = listed(p.runs(laid, max(map(len, lists)) // 2))
    want = [(a + f, q, b + f) for f, w in zip(first.tolist(), texts()) for a, q, b in every_run(w)]
    assert found == want


def answer(w):
    found = every_run(w, 12)
    gone = {i for a, q, b in found for i in range(a + q, b)}
    return len(w), [(a, b - a, q) for a, q, b in found], " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("most", [50, p.WORDS])
def test_rows(spark, documents, most):
    rows = documents.selectExpr("doc_id", "text", "key AS runs", "n_words", "fp AS kept", "size AS _body")
    found = p.periodic_runs(rows, together=most)
    assert found.columns == ["doc_id", "n_words", "runs", "kept"]
    few = [r for r in corpus() if len(words(r[1])) < 1500]
    ids = {r[0] for r in few}
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept) for r in found.collect() if r.doc_id in ids), key=repr)
    assert got == sorted(((r[0], *answer(words(r[1]))) for r in few), key=repr)
    assert p.periodic_runs(empty(spark)).count() == 0


def planted(doc, text):
    w, h = words(text), zlib.crc32(str(doc).encode())
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    q = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % q] for i in range(a, n)]


def test_query(spark):
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op11_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        w = planted(r.doc_id, r.text)
        if len(w) < 1500:
            _, found, kept = answer(w)
            top = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else None
            best = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
            assert got[r.doc_id] == (len(found), *best, digest("".join(f"{a},{b},{c}\n" for a, b, c in found)), digest(kept))
