"""Quality rules as weak supervision: votes, estimated accuracies, posterior probability.

Each rule looks at one trait of a text and votes good (1), bad (-1) or abstains (0). Nobody says how
far a rule can be trusted: expectation-maximisation estimates for each rule how it votes on good and
on bad texts, from how the rules agree. The posterior probability of "good" given all votes replaces
the demand that every rule be passed.

Everything runs in Spark expressions. Traits need no shuffle: a text is handled within its row. The
estimation sees only how often each combination of votes occurs, at most 3 ** len(RULES) rows whatever
the size of the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.shared import fresh, saved
from gaugeworks.session import settled

GAP = r"[\x20\x09-\x0D]+"
TRAITS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ROUNDS = 50


def traits(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the counts the rules use and ``base_failed``.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word equal to an
    earlier line), n_repeat_words (words in three-word windows that occur twice or more), n_lines (with
    a word), n_distinct (different words), n_upper (capital letters A to Z), n_closed (words that end
    a clause), n_marked (words with a symbol). A null, empty or blank text has zeros. Columns of these names are replaced.
    """
    own = [*TRAITS, "n_lines", "n_distinct", "n_upper", "n_closed", "n_marked", "base_failed"]
    rest = [c for c in docs.columns if c not in own]
    words, lines, sorted_, again_ = fresh(docs, "_words", "_lines", "_sorted", "_again")
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(
        *[F.col(c) for c in rest], F.array_remove(F.split(body, GAP), "").alias(words),
        F.filter(F.split(body, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias(lines),
    )
    # Three-word windows in text order of their words, equal ones side by side.
    w = F.col(words)
    windows = F.when(
        F.size(w) >= 3,
        F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i")),
        )),
    )
    df = df.withColumn(sorted_, windows)
    s = F.col(sorted_)
    t = lambda j: F.get(s, j)["t"]  # noqa: E731  null beyond the ends
    again = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: t(j).eqNullSafe(t(j - 1)) | t(j).eqNullSafe(t(j + 1))),
        lambda j: F.get(s, j)["i"],
    )
    df = df.withColumn(again_, F.when(s.isNotNull(), F.sort_array(again)))
    covered = F.aggregate(
        again_, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"],
    )
    joined, spaced = F.concat_ws("", words), F.concat_ws(" ", words)
    df = df.select(
        *rest, F.size(w).cast("long").alias("n_words"), F.length(joined).cast("long").alias("word_chars"),
        F.regexp_count(joined, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"), F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        F.regexp_count(joined, F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count(spaced, F.lit("[.,;:?!](?: |$)")).cast("long").alias("n_closed"),
        F.regexp_count(spaced, F.lit(r"[#*$%&|<>][^ ]*")).cast("long").alias("n_marked"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def _share(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def _rules() -> dict[str, Column]:
    symbols, repeats = _share("n_symbols", "word_chars"), _share("n_repeat_words", "n_words")
    lines, upper = _share("n_dup_lines", "n_lines"), _share("n_upper", "word_chars")
    length, variety = _share("word_chars", "n_words"), _share("n_distinct", "n_words")
    closed = _share("n_closed", "n_words")
    return {
        "symbols": _vote(symbols, symbols < 0.01, symbols > 0.05),
        "marked": _vote(_share("n_marked", "n_words"), F.lit(False), _share("n_marked", "n_words") > 0.2),
        "repeats": _vote(repeats, repeats < 0.2, repeats > 0.3),
        "lines": _vote(lines, (lines < 0.2) & (F.col("n_lines") > 1), lines > 0.5),
        "upper": _vote(upper, upper < 0.1, upper > 0.3),
        "length": _vote(length, (length > 3) & (length < 9), (length < 2) | (length > 15)),
        "variety": _vote(variety, (variety > 0.3) & (F.col("n_words") > 100), variety < 0.05),
        "clauses": _vote(closed, (closed > 0.04) & (closed < 0.4), (closed < 0.01) | (closed > 0.7)),
    }


RULES = ["symbols", "marked", "repeats", "lines", "upper", "length", "variety", "clauses"]


def votes(rated: DataFrame) -> DataFrame:
    """``rated`` (with traits) and a column ``vote_<rule>`` of -1, 0 or 1 for each rule."""
    return rated.withColumns({f"vote_{name}": vote for name, vote in _rules().items()})


def fit(voted: DataFrame) -> dict[str, list[float]]:
    """Log odds of good for each rule's bad vote, abstention and good vote, and for the ``prior``.

    The class of a text is hidden; for each class a rule votes bad, abstains or votes good with
    probabilities of its own, so its accuracy on good and on bad texts may differ. All rows count, as
    counts of vote combinations. The start takes a text with a bad vote for bad, which also settles
    which class is which. Each probability has one added vote, so none is 0; without rows all odds
    are even.
    """
    names = [f"vote_{r}" for r in RULES]
    patterns = sorted(tuple(r) for r in voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect())
    good = [0.05 if min(vote) < 0 else 0.95 for *vote, _ in patterns]
    model = {}
    for _ in range(ROUNDS):
        texts = [1.0, 1.0]
        cast = [[[1.0] * 3 for _ in names] for _ in texts]  # by class, rule and vote + 1
        for (*vote, n), p in zip(patterns, good):
            for k, share in enumerate((1 - p, p)):
                texts[k] += n * share
                for counts, v in zip(cast[k], vote):
                    counts[v + 1] += n * share
        model = {"prior": [math.log(texts[1] / texts[0])]}
        for rule, bad, fine in zip(RULES, *cast):
            model[rule] = [math.log(f / sum(fine) * sum(bad) / b) for f, b in zip(fine, bad)]
        good = [_posterior(vote, model) for *vote, _ in patterns]
    return model


def _posterior(vote, model) -> float:
    z = model["prior"][0] + sum(model[rule][v + 1] for rule, v in zip(RULES, vote))
    return 1 / (1 + math.exp(-max(-700.0, z)))


def judged(voted: DataFrame, model: dict[str, list[float]], threshold: float = 0.5) -> DataFrame:
    """``voted`` with ``quality`` (posterior probability of good) and ``kept``."""
    z = F.lit(model["prior"][0])
    for rule in RULES:
        bad, none, good = model[rule]
        z = z + F.when(F.col(f"vote_{rule}") < 0, bad).when(F.col(f"vote_{rule}") > 0, good).otherwise(none)
    rated = voted.withColumn("quality", 1 / (1 + F.exp(-z)))
    return rated.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def rated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, traits, votes, base_failed, quality and kept, without the text.

    A null or empty text fails the base rules. Ties, repeated rows and null ids are rated like any
    row; an empty table gives an empty result.
    """
    voted = saved(votes(traits(docs.select(F.col(id), F.col(text).alias("_text")), "_text").drop("_text")))
    return judged(voted, fit(voted))


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Rows are stored with their votes in the shared folder once, so that traits are computed once: the
    estimation reads the votes, the decision votes and rows.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text"))
    names = [f"vote_{r}" for r in RULES]
    voted = settled(votes(traits(rows, "_text")).select("_row", "base_failed", *names), "votes")
    return judged(voted, fit(voted)).where("kept").select("_row.*")
