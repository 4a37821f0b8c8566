"""Encoding and decoding against the SentencePiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import SF, corpus, empty
from sentencepiece import sentencepiece_model_pb2 as proto

from gaugeworks.llm import queries
from gaugeworks.llm import subwords as s

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return s.load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts():
    pick = random.Random(5)
    texts = ["", " ", "  a  b ", "▁x ▁", "é🙂", "a\x00b", "　x", "a" * 700, "ab" * 400, " " * 700, " " * 15 + "x", "\n" * 50, "\x85  ", "中文没有空格" * 90, "<s>a</s><unk>"]
    texts += [" " * k + "the" * (k % 3) for k in range(120)]
    texts += ["".join(pick.choice("ab \n") for _ in range(pick.randint(1, 60))) for _ in range(400)]
    texts += ["".join(chr(pick.choice([pick.randint(0, 127), pick.randint(128, 0x2FFF), pick.randint(0x1F300, 0x1F700)])) for _ in range(30)) for _ in range(400)]
    texts += ["".join(pick.choice(["the", "ing", "er", "in", "tion", " ", "s", "aa", "lll"]) for _ in range(60)) for _ in range(400)]
    return texts


def lists(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def test_ids_and_texts(vocabulary, library):
    texts = odd_texts()
    ids, offsets = s.Encoder(vocabulary).encode(texts)
    want = library.encode(texts)
    assert lists(ids, offsets) == want
    assert s.decode(vocabulary, ids, offsets) == [library.decode(x) for x in want]


def test_words_kept_between_calls(vocabulary, library):
    texts, encoder, small = odd_texts(), s.Encoder(vocabulary), s.Encoder(vocabulary, most=3)
    for text in texts[:150] + texts[:150]:
        for e in (encoder, small):
            assert lists(*e.encode([text, ""])) == [library.encode(text), []]


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_words_finished_one_merge_at_a_time(vocabulary, rounds, monkeypatch):
    texts = odd_texts()[:200]
    want = lists(*s.Encoder(vocabulary).encode(texts))
    whole = s.merge_rounds
    monkeypatch.setattr(s, "merge_rounds", lambda v, x, o: whole(v, x, o, rounds))
    assert lists(*s.Encoder(vocabulary).encode(texts)) == want


def test_any_ids_decode_alike(vocabulary, library):
    pick = random.Random(2)
    rows = [[pick.randrange(32000) if pick.random() < 0.6 else pick.randrange(300) for _ in range(pick.randint(0, 12))] for _ in range(2000)]
    offsets = np.cumsum([0] + [len(r) for r in rows])
    assert s.decode(vocabulary, np.array(sum(rows, [])), offsets) == [library.decode(r) for r in rows]


def test_other_models_are_refused(tmp_path):
    model = proto.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        s.load(str(path))


def test_rows(spark, documents, vocabulary, library):
    rows = documents.selectExpr("doc_id", "text", "n_chars", "key AS ids", "fp AS decoded", "size AS _body")
    found = s.encoded(rows, vocabulary)
    assert found.columns == ["doc_id", "ids"]
    got = sorted(((r.doc_id, list(r.ids)) for r in found.collect()), key=repr)
    assert got == sorted(((r[0], library.encode(r[1] or "")) for r in corpus()), key=repr)
    back = s.decoded(found.selectExpr("ids", "doc_id", "size(ids) AS n"), vocabulary)
    assert back.columns == ["doc_id", "n", "decoded"]
    said = sorted(((r.doc_id, r.decoded) for r in back.collect()), key=repr)
    assert said == sorted(((r[0], r[1] or "") for r in corpus()), key=repr)


def test_null_ids_broken_bytes_and_no_rows(spark, vocabulary):
    none = spark.sql("SELECT 1L AS doc_id, CAST(NULL AS array<int>) AS ids")
    assert [r.decoded for r in s.decoded(none, vocabulary).collect()] == [None]
    broken = spark.sql("SELECT 1L AS doc_id, CAST(X'61E28062' AS STRING) AS text")
    assert s.decoded(s.encoded(broken, vocabulary), vocabulary).first().decoded == "a��b"
    found = s.encoded(empty(spark), vocabulary)
    assert found.count() == 0 and s.decoded(found, vocabulary).count() == 0


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {d: (len(i), digest(",".join(map(str, i))), digest(library.decode(i))) for d, i in ((d, library.encode(t or "")) for d, t in texts.items())}
    assert {r[0]: tuple(r)[1:] for r in queries.QUERIES["op12_sentencepiece"](spark, SF).collect()} == want
