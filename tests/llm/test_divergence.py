"""The source audit against plain counting, and its transducers against sorted lists."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, corpus, empty

from gaugeworks.llm import divergence, queries, transducer


def test_transducer():
    pick = random.Random(4)
    terms = {"".join(pick.choice("abcé") for _ in range(pick.randint(1, 7))).encode() for _ in range(3000)} | {b""}
    terms = sorted(terms)
    made = transducer.build(terms)
    assert made.ordinals(terms).tolist() == list(range(len(terms)))
    others = [t + x for t in terms for x in (b"a", b"\xff", b"z")]
    place = {t: k for k, t in enumerate(terms)}
    assert made.ordinals(others).tolist() == [place.get(t, -1) for t in others]
    assert transducer.build([]).ordinals([b"a", b""]).tolist() == [-1, -1]
    for wrong in ([b"b", b"a"], [b"a", b"a"]):
        with pytest.raises(ValueError):
            transducer.build(wrong)


def test_transducer_is_minimal():
    # As many states as there are different sets of endings.
    pick = random.Random(6)
    terms = sorted({"".join(pick.choice("ab") for _ in range(pick.randint(1, 8))).encode() for _ in range(150)})
    starts = {t[:k] for t in terms for k in range(len(t) + 1)}
    endings = {frozenset(t[len(s):] for t in terms if t.startswith(s)) for s in starts}
    assert len(transducer.build(terms).final) == len(endings)


def plain(rows, min_docs=10, top=10):
    said, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups.add((lang, source))
        said[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        share = {}
        for name in [*sources, None]:
            count = said[lang, name] if name is not None else sum((said[lang, s] for s in sources), Counter())
            total = sum(count[t] for t in kept)
            share[name] = {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}
        value = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(-sum(value(share[s][t], share[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-value(share[s][t], share[None][t]), t.encode()) for t in kept if said[lang, s][t] and share[s][t] > share[None][t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(items)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_rows(spark, documents):
    rows = documents.selectExpr("doc_id", "text", "lang", "source", "key AS term", "n_words AS n", "fp AS nth", "size AS ordinal", "n_chars AS part")
    assert result(divergence.audited(rows)) == plain(corpus())


def test_small_blocks_strips_and_tiles(spark, documents):
    few = divergence.audited(documents, min_docs=5, top=3, memory=60_000, range_terms=150, strip=64, tile=3, pending=500)
    assert result(few) == plain(corpus(), 5, 3)


def test_no_terms_and_no_rows(spark):
    few = spark.createDataFrame([(1, "a b", "en", "x"), (2, None, "en", "y"), (3, "", None, None), (3, "", None, None)], "doc_id long, text string, lang string, source string")
    assert result(divergence.audited(few)) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert divergence.audited(empty(spark)).count() == 0


def test_large_counts(spark):
    counts = spark.sql("SELECT 4000000000000L AS count, 9000000000000000L AS n, 10L AS v")
    share = divergence._share(counts["count"], counts["n"], counts["v"])
    assert counts.select(share.alias("p")).first().p == 1 + 10**9 * (4 * 10**12 + 2) // (9 * 10**15 + 20)


def test_counts_travel_in_strips(spark, documents):
    # One row for a strip of a source, however many tasks, held texts and ranges of terms say it.
    terms = divergence.vocabulary(documents, min_docs=5, range_terms=150, pending=500, held=3000)
    counts = divergence.recounted(documents.repartition(7), divergence.transducers(terms), pending=500, held=3000, strip=64).collect()
    assert len(counts) == len({(r.lang, r.source, r.strip) for r in counts})
    names = {(r.lang, r.ordinal): r.term for r in terms.collect()}
    said = Counter()
    for _, text, lang, source, *_ in corpus():
        for term in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            said[lang or "", source or "", term] += 1
    known = {(lang, term) for (lang, _), term in names.items()}
    found = {}
    for r in counts:
        places, times = np.frombuffer(r.places, np.int32), np.frombuffer(r.counts, np.int64)
        assert times.sum() == r.times and places.max() < 64
        found |= {(r.lang, r.source, names[r.lang, r.strip * 64 + k]): n for k, n in zip(places.tolist(), times.tolist(), strict=True)}
    assert found == {k: n for k, n in said.items() if (k[0], k[2]) in known}


def test_ranges_of_terms():
    pick = random.Random(8)
    terms = sorted({"".join(pick.choice("abé") for _ in range(pick.randint(1, 6))).encode() for _ in range(400)})[1:]
    ranges = [(k, transducer.build(terms[k : k + 37])) for k in range(0, len(terms), 37)]
    assert [made.least() for _, made in ranges] == terms[::37]
    place = {t: k for k, t in enumerate(terms)}
    words = list({*terms, b"", b"a", b"zz", *(t + b"x" for t in terms)})
    pick.shuffle(words)
    got = divergence._ordinals(pa.array([w.decode() for w in words], pa.large_string()), ranges)
    assert got.tolist() == [place.get(w, -1) for w in words]


def test_shares_of_any_count():
    for counts, n, v in (([0, 1, 7], 8, 3), ([9 * 10**9 - 1, 5], 10**10, 4), ([4 * 10**12, 3, 8 * 10**15], 9 * 10**15, 10)):
        got = divergence._shares(np.array(counts, np.int64).tobytes(), n, v)
        assert got.tolist() == [1 + 10**9 * (c + 2) // (n + 2 * v) for c in counts]


def test_bytes_that_are_no_text(spark):
    texts = spark.sql("SELECT id AS doc_id, cast(if(id < 12, X'61FF2062', X'63') AS string) AS text, 'en' AS lang FROM range(30)")
    assert {r.term for r in divergence.vocabulary(texts).collect()} == {"a\ufffd", "b", "c"}


def test_query(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(queries.QUERIES["op13_divergence"](spark, SF)) == plain(rows)
