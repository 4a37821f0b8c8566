"""Each stage of the pipeline against plain versions of its decisions."""

from collections import Counter

import corpus_pipeline
from helpers import SF, empty, words
from test_debruijn import plain as plain_passages
from test_decontaminate import plain as plain_contamination
from test_mixing import plain_targets
from test_simhash import plain_fingerprint, plain_groups

from gaugeworks.llm import rules
from gaugeworks.llm.shared import DOCUMENTS


def test_stages(spark, documents, tmp_path):
    docs, names = documents, [n for n, _ in corpus_pipeline.STAGES]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        seen[name] = (docs.select(*DOCUMENTS).collect(), spark.read.parquet(f"{tmp_path}/{name}"))
        docs = seen[name][1]
        assert docs.columns == (DOCUMENTS if name != names[-1] else ["doc_id", "source", "size", "source_size", "target", "taken"])
    before, after = seen["quality_rules"]
    kept = {(r.doc_id, r.n_words) for r in rules.rated(documents).where("kept").collect()}
    assert Counter(map(tuple, after.collect())) == Counter(tuple(r) for r in before if (r.doc_id, len(words(r.text))) in kept)
    before, after = seen["near_duplicates"]
    groups = plain_groups([(r.doc_id, plain_fingerprint(r.text)) for r in before])
    assert Counter(map(tuple, after.collect())) == Counter(tuple(r) for r in before if groups[plain_fingerprint(r.text)] == r.doc_id)
    before, after = seen["substring_dedup"]
    want = plain_passages([tuple(r) for r in before])
    text = {k: v[3] for k, v in want.items() if v[1]}
    expect = [(r.doc_id, " ".join(text[r.doc_id, r.text]) if (r.doc_id, r.text) in text else r.text) for r in before]
    assert Counter((r.doc_id, r.text) for r in after.collect()) == Counter(expect) and text
    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert Counter(map(tuple, after.collect())) == Counter(tuple(r) for r in before if not plain_contamination(r.text, items)[4])
    before, after = seen["mixing"]
    rows = after.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    assert {r.source: round(r.target, 6) for r in rows} == {s: round(t, 6) for s, t in plain_targets(sizes).items()}
    assert len(rows) == len(before)


def test_whole_run_and_empty(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert 100 < len(rows) < 200 and sum(r.taken for r in rows) > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SF).count() == 0
