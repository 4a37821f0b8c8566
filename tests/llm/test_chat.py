"""Formatting read back exactly; placeholders, token counts and masks."""

import random
import re

import duckdb
import pytest
from helpers import SF
from pyspark.sql import functions as F

from gaugeworks.llm import chat, queries

TURNS = "conv_id long, turn long, role string, text string, parts string"


def formatted(rows):
    turns = chat.formatted_turns(rows.withColumn("parts", chat.text_part(F.col("text"))))
    return chat.conversations(turns)


def test_every_text_comes_back(spark):
    rnd = random.Random(4)
    bits = ["\\", "<", "[", "\\l", "\\b", "\\\\", "</s>", "<s>", "[ROLE]", "[/ROLE]", "[image 1]", "a", "\n", "é", "😀", "$1", ">", "]", "\\0", ""]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rnd.randrange(1, 6)):
            text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(12)))
            rows.append((conv, turn, rnd.choice(["user", "assistant", "system", None, "\\0", "a<[b"]), rnd.choice([text, text, None]), "x"))
    rows += [(5, None, "user", "no turn", "x"), (6, 0, "user", "tie", "x"), (6, 0, "user", "tie", "x")]
    by = {}
    for conv, turn, role, text, _ in rows:
        by.setdefault(conv, []).append((turn is not None, turn, role is not None, role, text or ""))
    examples = formatted(spark.createDataFrame(rows, TURNS))
    got = {r.conv_id: r for r in chat.read_back(examples).collect()}
    assert set(got) == set(by)
    for conv, turns in by.items():
        r = got[conv]
        key = lambda t: t[:3] + (t[3] or "",)  # noqa: E731  equal turns may stand in either order
        turns = sorted(turns, key=key)
        assert r.roles == [t[3] for t in turns]
        assert sorted(zip([key(t) for t in turns], r.texts)) == sorted((key(t), t[4]) for t in turns)
        assert r.learned == "".join(t for t, role in zip(r.texts, r.roles) if role == "assistant")
        assert r.formatted.count("</s>") == r.formatted.count("<s>") == len(turns)


def test_parts_become_placeholders(spark):
    part = f"array<{chat.PART}>"
    rows = [
        (1, 0, "user", [("text", "see <this>", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), ("audio", None, "b.wav", None, None, 2.5, None)]),
        (1, 1, "assistant", [("document", None, "c.pdf", None, None, None, 3), ("text", None, None, None, None, None, None), (None, "ok", None, None, None, None, None)]),
        (1, 2, "user", None), (2, 0, "user", [("image", None, None, None, None, None, None)]),
    ]
    out = {(r.conv_id, r.turn): r for r in chat.formatted_turns(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {part}")).collect()}
    assert out[1, 0].formatted == "<s>[ROLE]user[/ROLE]see \\lthis>[image 1][audio 2]</s>"
    assert [tuple(a) for a in out[1, 0].attachments] == [("image", "a.png", 4, 1), ("audio", "b.wav", 63, 2)]
    assert out[1, 1].formatted == "<s>[ROLE]assistant[/ROLE][document 3]ok</s>" and out[1, 1].attachment_tokens == 1536
    assert out[1, 1].formatted[out[1, 1].mask_start :][: out[1, 1].mask_length] == "[document 3]ok"
    assert out[1, 2].formatted == "<s>[ROLE]user[/ROLE]</s>" and out[1, 2].mask_length == 0
    assert [tuple(a) for a in out[2, 0].attachments] == [("image", None, 0, 1)]


@pytest.mark.parametrize("sf", [SF, SF.replace("0.001", "0.01")])
def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    cur = con.execute(queries.SQL["op7_chat"])
    names = [d[0] for d in cur.description]
    want = sorted(cur.fetchall())
    got = sorted(tuple(r[n] for n in names) for r in queries.QUERIES["op7_chat"](spark, sf).collect())
    assert got == want


def test_empty(spark):
    assert formatted(spark.createDataFrame([], TURNS)).count() == 0
    assert re.fullmatch(chat.TURN, "<s>[ROLE]x[/ROLE]y</s>")
