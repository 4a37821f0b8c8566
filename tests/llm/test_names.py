"""Extra columns may have the names the operators use for themselves."""

from collections import Counter

import pytest
from helpers import corpus
from pyspark.sql import functions as F

from gaugeworks.llm import chat, debruijn, decontaminate, divergence, mixing, ranking, rules, simhash, warc

NAMES = [
    "_words", "_lines", "_sorted", "_again", "_bytes", "_runs", "_ids", "_none", "_row", "_text", "_id", "_nth", "_key", "_source", "_lang", "_hash",
    "_body", "_rest", "block", "doc", "twin", "body", "mark", "bucket", "rank", "start", "size", "fine", "quality", "kept", "fp", "lang_pred", "score",
    "taken", "target", "_page", "_url", "_payload", "_order", "_first", "term", "ordinal", "count", "n", "N", "V", "nth", "value", "part",
]


@pytest.fixture(scope="module")
def clashing(spark):
    docs = spark.createDataFrame([r for r in corpus() if len(r[1] or "") < 3000][:80], "doc_id long, text string, lang string, source string, n_chars long")
    names = [n for k, n in enumerate(NAMES) if n.lower() not in {m.lower() for m in NAMES[:k]}]
    return docs, docs.select("*", *[F.lit(f"x{k}").alias(n) for k, n in enumerate(names)])


def result(df, *columns):
    return Counter(map(repr, df.select(*columns).collect()))


CASES = {
    "traits": lambda d: rules.traits(d).select("doc_id", *rules.TRAITS, "base_failed"),
    "accepted": lambda d: rules.accepted(d).select("doc_id", "text", "lang"),
    "without_repeats": lambda d: debruijn.without_repeats(d).select("doc_id", "text", "n_chars"),
    "mixed": lambda d: mixing.mixed(d).select("doc_id", "taken", "target"),
    "contamination": lambda d: decontaminate.contamination(d, d.where("doc_id < 5").select(F.col("doc_id").alias("item_id"), "text")).select("doc_id", "n_hit"),
    "fingerprints": lambda d: simhash.fingerprints(d).select("doc_id", "fp"),
    "deduplicated": lambda d: simhash.deduplicated(d).select("doc_id", "text"),
    "divergence": lambda d: divergence.audited(d, min_docs=3).select("lang", "source", "part", "item", "value", "rank"),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_clashing_names(clashing, name):
    plain, more = clashing
    assert result(CASES[name](more), "*") == result(CASES[name](plain), "*")


@pytest.mark.parametrize("operator", [rules.traits, simhash.fingerprints, debruijn.without_repeats, simhash.deduplicated])
def test_extra_columns_stay(clashing, operator):
    _, more = clashing
    out = operator(more)
    for name in ("_words", "_bytes", "_runs", "_none", "_row", "_text"):
        assert out.select(name).distinct().count() == 1


def test_clashing_names_of_turns_and_pages(spark, tmp_path):
    turns = spark.createDataFrame([(1, 0, "user", "a [x"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    turns = turns.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    more = turns.select("*", *[F.lit("x").alias(n) for n in ("_parts", "_n", "_position", "_before", "_seen", "_turns")])
    assert result(chat.formatted_turns(more), "formatted", "mask_start") == result(chat.formatted_turns(turns), "formatted", "mask_start")
    assert result(chat.read_back(chat.conversations(chat.formatted_turns(more))), "*") == result(chat.read_back(chat.conversations(chat.formatted_turns(turns))), "*")
    pages = spark.createDataFrame([(1, "u", "h"), (2, "v", "h")], "page_id long, url string, html string")
    clash = pages.select("*", *[F.lit("x").alias(n) for n in ("_page", "_url", "_payload", "_key", "_order", "_first", "_shard")])
    warc.write(clash, str(tmp_path / "w"))
    assert warc.read(spark, str(tmp_path / "w")).count() == 2


def test_clashing_names_of_labels(clashing, spark):
    plain, more = clashing
    labels = plain.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).where("doc_id is not null")
    clash = labels.select("*", F.lit("x").alias("text"), F.lit("x").alias("_id"), F.lit("x").alias("n_words"))
    few = lambda m: result(ranking.scored(plain, m), "doc_id", "predicted")
    assert few(ranking.learn(more, clash)) == few(ranking.learn(plain, labels))
