"""SimHash groups against a comparison of all pairs."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import corpus, empty, words

from gaugeworks.llm import simhash


def plain_fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(pairs):
    """Smallest id reachable per fingerprint, comparing all with all."""
    fps = sorted({fp for _, fp in pairs})
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for doc, fp in pairs:
        r = find(fp)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return {fp: least.get(find(fp)) for fp in fps}


def test_documents_against_all_pairs(documents):
    pairs = [(r[0], plain_fingerprint(r[1])) for r in corpus()]
    groups = plain_groups(pairs)
    got = simhash.near_duplicates(documents).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == Counter((d, f, groups[f]) for d, f in pairs)


def near_fingerprints(n, seed=1):
    """Random fingerprints, chains and dense groups of neighbours, and blocks at their borders."""
    rnd = random.Random(seed)
    fps = {rnd.getrandbits(64) for _ in range(n)} | {0, (1 << 64) - 1, 1 << 63, 7, 8}
    base = rnd.getrandbits(64)
    for _ in range(n):
        fps.add(base ^ sum({1 << rnd.randrange(64) for _ in range(rnd.randrange(4))}))
        base ^= 1 << rnd.randrange(64) if rnd.random() < 0.3 else 0
    for f in list(fps)[: n // 4]:
        fps.add(f ^ sum({1 << rnd.randrange(64) for _ in range(rnd.choice((2, 3, 4)))}))
    return sorted(fps)


@pytest.mark.parametrize("split", [200_000, 3])
def test_links_connect_the_same_groups(spark, split):
    fps = near_fingerprints(400)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = [(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in simhash.near_links(frame, split).collect()]
    want = plain_groups([(i, f) for i, f in enumerate(fps)])
    number = {f: i for i, f in enumerate(fps)}
    parent = simhash.stars(len(fps), iter([(np.array([number[a] for a, _ in links]), np.array([number[b] for _, b in links]))]))
    assert {f: int(parent[i]) for f, i in number.items()} == want


def code_words():
    """1,024 words of 15 bits, any two of which differ in four bits at least."""
    checks = [w for w in range(1 << 15) if w.bit_count() % 2 == 0 and not w & 1]
    out = []
    for w in checks:
        bits, syndrome = w, 0
        while bits:
            syndrome ^= (bits & -bits).bit_length()
            bits &= bits - 1
        if syndrome == 0:
            out.append(w)
    return out


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def test_links_of_a_cut_key_with_a_bit_in_each_other_block(spark):
    """Only the key that is cut finds these pairs, and far more than 64 of them stand below each cut."""
    far = 1 << 47 | 1 << 31 | 1 << 15
    fps = [0xABCD << 48 | w for w in code_words()]
    assert len(fps) >= 512
    frame = spark.createDataFrame([(signed(f ^ m),) for f in fps for m in (0, far)], "fp long")
    got = {frozenset((r.u & (1 << 64) - 1, r.v & (1 << 64) - 1)) for r in simhash.near_links(frame, 200).collect()}
    assert got == {frozenset((f, f ^ far)) for f in fps}


@pytest.mark.parametrize("mask", [0b0001, 0b0011, 0b1010, 0b0111, 0b1101])
def test_roots_that_differ_within_the_cut(mask):
    """A root four levels under the key whose sides differ there in one to three bits."""
    rest = 3 - mask.bit_count()
    far = mask << 44 | sum(1 << b for b in (31, 30)[:rest])
    sides = [[w for w in code_words()], [w ^ far for w in code_words()]]
    rows = [(0, 0, mask, side, fp) for side in (0, 1) for fp in sorted(sides[side])]
    names = ["key", "lo", "hi", "side", "turned"]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
    got = {frozenset(x.values()) for b in simhash._joined(iter([batch])) for x in b.to_pylist()}
    assert got == {frozenset((w, w ^ far)) for w in sides[0]}


def test_chunks_do_not_change_links(monkeypatch):
    fps = np.array(near_fingerprints(300, 2), np.uint64)
    root = np.array([[0, len(fps), 0, len(fps), 0]])
    whole = {(int(i), int(j)) for a, b in simhash.node_pairs(fps, root, 64, 3) for i, j in zip(a, b)}
    assert whole == {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3}
    monkeypatch.setattr(simhash, "CHUNK", 5)
    assert whole == {(int(i), int(j)) for a, b in simhash.node_pairs(fps, root, 64, 3) for i, j in zip(a, b)}


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(205, 90)]
    got = {r.u: r.v for r in simhash.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 90, **{200 + i: 90 for i in range(30)}}


def test_one_document_of_each_group_stays(spark, documents):
    kept = simhash.deduplicated(documents)
    assert kept.columns == documents.columns
    groups = plain_groups([(r[0], plain_fingerprint(r[1])) for r in corpus()])
    want = Counter(r[0] for r in corpus() if groups[plain_fingerprint(r[1])] == r[0])
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.deduplicated(empty(spark)).count() == 0


def test_null_and_repeated_ids_leave_one_document_of_each_group(spark):
    a, b, c = "alpha beta gamma delta", "one two three four five", "red green blue white black"
    data = [(None, a, "x"), (None, a, "y"), (None, b, "x"), (3, b, "x"), (None, b, "y"), (5, c, "x"), (5, b, "z"), (5, c, "x"), (9, c, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, fp string")
    got = Counter(map(tuple, simhash.deduplicated(docs).collect()))
    assert got == Counter([(None, a, "x"), (3, b, "x"), (5, c, "x"), (5, c, "x")])
