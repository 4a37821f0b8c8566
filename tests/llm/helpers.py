"""A small corpus with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import re

import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, n_words string, fp string, size string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus():
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rows = [(int(r.doc_id), r.text, r.lang, r.source, int(r.n_chars)) for r in docs.itertuples()]
    long = " ".join(r[1] for r in rows[:40])
    rows += [
        (1001, None, "en", "src1", None), (1002, "", None, None, 0), (1003, " \t\n\x0b ", "en", None, 5), (1004, long, "de", "src0", len(long)),
        (1004, long, "de", "src0", len(long)), (None, rows[3][1], "en", "src2", 1), (None, None, None, None, None), (1005, "one", "xx", "src3", 3),
        (1006, "one two\x85three \x1c four ß🙂 a b a b a b a b a b", "en", "src3", 20), (1007, "😀" * 40 + " " + "é" * 70, "fr", "src4", 110),
        (1008, "a b c " * 60, "en", "src5", 360), (1009, "a b c " * 60 + "d e f", "en", "src5", 365), (1010, "😀" * 40 + "!" + "é" * 70, "fr", "src4", 110),
    ]
    return rows


@pytest.fixture(scope="session")
def documents(spark):
    rows = [(*r, 7, "x", "y", "z") for r in corpus()]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
