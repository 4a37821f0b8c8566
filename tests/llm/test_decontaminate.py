"""Contamination against a plain search of every window."""

import hashlib
import random
import re

from helpers import SF, corpus, empty

from gaugeworks.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


_windows = {}


def plain(text, items):
    known = _windows.get(id(items))
    if known is None:
        known = _windows[id(items)] = ({}, items)
        for item, body in items:
            iw = norm(body)
            for k in range(max(1, len(iw) - 12) if iw else 0):
                known[0].setdefault(tuple(iw[k : k + 13]), set()).add(item)
    w, hit, found = norm(text), set(), set()
    for n in {len(win) for win in known[0]}:
        for i in range(len(w) - n + 1):
            ids = known[0].get(tuple(w[i : i + n]))
            if ids is not None:
                hit.update(range(i, i + n))
                found.update(str(x) for x in ids if x is not None)
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


def items():
    rows = corpus()
    rnd = random.Random(3)
    made = [(i, " ".join(norm(rows[rnd.randrange(200)][1])[5 : 5 + rnd.choice((4, 13, 20, 40))]).upper()) for i in range(30)]
    return made + [(100, None), (101, ""), (102, "..."), (None, "Es-un_café"), (103, "one"), (103, "one"), (104, "a b c a b c a b c a b c a b c"), (9, "A, b")]


def test_against_plain_search(spark, documents):
    for block, its in ((decontaminate.BLOCK, items()), (400, items()[:2] + items()[30:])):  # one automaton, or several in turn
        frame = spark.createDataFrame(its, "item_id long, text string")
        want = sorted(((r[0],) + plain(r[1], its) for r in corpus()), key=repr)
        got = decontaminate.contamination(documents, frame, block=block)
        assert got.columns[: len(documents.columns) - 1] == [c for c in documents.columns if c != "n_words"]
        rows = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
        assert sorted((tuple(r) for r in rows), key=repr) == want


def test_offsets_point_at_the_hit_words_of_the_original(spark):
    text = "Zéro; ONE two--three, été FOUR! five"
    frame = spark.createDataFrame([(1, "two three été four")], "item_id long, text string")
    row = decontaminate.contamination(spark.createDataFrame([(5, text)], "doc_id long, text string"), frame).first()
    (span,) = row.hit_bytes
    assert text.encode()[span.start : span.end].decode() == "two--three, été FOUR"


def test_nothing_to_find(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(documents, none)
    assert got.count() == len(corpus()) and got.where("contaminated or n_hit > 0").count() == 0
    assert decontaminate.contamination(empty(spark), none).count() == 0
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    kept = decontaminate.clean(documents, bench)
    its = [(r.item_id, r.text) for r in bench.collect()]
    assert kept.columns == documents.columns
    assert kept.count() == sum(not plain(r[1], its)[4] for r in corpus())
