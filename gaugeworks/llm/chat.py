"""Chat formatting of turns made of typed content parts.

A part is text, an image, audio or a document. Text is escaped; other parts become placeholders,
numbered in order within their conversation, with a reference to the attachment and the number of
tokens it expands to. Each turn is written as

    <s>[ROLE]role[/ROLE]text</s>

Escaping leaves no ``<`` or ``[`` in a text, so no control string can occur in it: backslash, ``<``
and ``[`` become ``\\\\``, ``\\l`` and ``\\b``. A null role is written ``\\0``.

The loss mask covers the content of assistant turns and is given per turn, as start and length in
code points of that turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.shared import fresh

PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 512  # pixels a token is wide, tokens a second, tokens a page
LEARNED = "assistant"
TURN = r"<s>\[ROLE\]([^<\[]*)\[/ROLE\]([^<]*)</s>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescape(text: Column) -> Column:
    """The inverse of ``escape``; doubled backslashes wait as ``<``, which an escaped text does not have."""
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("<")), F.lit("\\b"), F.lit("["))
    return F.translate(F.replace(plain, F.lit("\\l"), F.lit("\\")), "<\\", "\\<")


def text_part(text: Column) -> Column:
    """A content list with one text part."""
    return F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    ))


def _tokens(p: Column) -> Column:
    n = F.when(p["type"] == "image", F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH))
    n = n.when(p["type"] == "audio", F.ceil(p["seconds"] * AUDIO_RATE)).when(p["type"] == "document", p["pages"].cast("long") * PAGE_TOKENS)
    return F.coalesce(n, F.lit(0)).cast("long")


def formatted_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per turn with its ``formatted`` text, loss mask, attachments and expanded tokens.

    ``parts`` is an array of ``PART``. Adds position (in the conversation), formatted, mask_start and mask_length (length 0 outside
    assistant turns), attachments (array of type, ref, tokens and number, in order) and
    attachment_tokens; columns of these names are replaced. A null or unknown part type is taken as
    text, null texts and lists are empty. Turns with equal numbers are ordered by role and content;
    repeated rows come back repeated, a null conversation is one conversation.
    """
    new = ["position", "formatted", "mask_start", "mask_length", "attachments", "attachment_tokens"]
    own = [c for c in rows.columns if c not in new]
    content_, files_, place, earlier, seen_ = fresh(rows, "_parts", "_n", "_position", "_before", "_seen")
    content = F.coalesce(F.col(parts), F.expr(f"cast(array() as array<{PART}>)"))
    df = rows.select(*own, content.alias(content_))
    is_file = lambda p: p["type"].isin("image", "audio", "document")
    df = df.withColumn(files_, F.size(F.filter(content_, lambda p: F.coalesce(is_file(p), F.lit(False)))))
    order = [F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(), F.to_json(content_)]
    ordered = Window.partitionBy(conv).orderBy(*order)
    before = F.sum(files_).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumns({place: F.row_number().over(ordered), earlier: F.coalesce(before, F.lit(0))})
    # The visitor: parts in order, with the attachments seen so far.
    entry = "struct<type: string, ref: string, tokens: bigint, number: bigint>"
    start = F.struct(F.lit("").alias("out"), F.expr(f"cast(array() as array<{entry}>)").alias("files"))

    def visit(seen: Column, p: Column) -> Column:
        number = F.col(earlier) + F.size(seen["files"]) + 1
        mark = F.concat(F.lit("["), p["type"], F.lit(" "), number.cast("string"), F.lit("]"))
        file = F.struct(p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens"), number.cast("long").alias("number"))
        return F.when(F.coalesce(is_file(p), F.lit(False)), F.struct(
            F.concat(seen["out"], mark).alias("out"), F.concat(seen["files"], F.array(file)).alias("files"),
        )).otherwise(F.struct(
            F.concat(seen["out"], escape(F.coalesce(p["text"], F.lit("")))).alias("out"), seen["files"].alias("files"),
        ))

    df = df.withColumn(seen_, F.aggregate(content_, start, visit))
    head = F.concat(F.lit("<s>[ROLE]"), F.coalesce(escape(F.col(role)), F.lit("\\0")), F.lit("[/ROLE]"))
    body = F.col(seen_)["out"]
    return df.select(
        *own, F.col(place).alias("position"), F.concat(head, body, F.lit("</s>")).alias("formatted"), F.length(head).alias("mask_start"),
        F.when(F.col(role) == LEARNED, F.length(body)).otherwise(0).alias("mask_length"),
        F.col(seen_)["files"].alias("attachments"),
        F.aggregate(F.col(seen_)["files"], F.lit(0).cast("long"), lambda n, f: n + f["tokens"]).alias("attachment_tokens"),
    )


def conversations(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation: ``formatted`` and ``mask`` (start and length for each turn), in order.

    A conversation is one training example and one row here; nothing else is gathered by it.
    """
    parts = F.array_sort(F.collect_list(F.struct("position", "formatted", "mask_start", "mask_length")))
    df = turns.groupBy(conv).agg(parts.alias("_turns"))
    return df.select(
        conv, F.concat_ws("", F.transform("_turns", lambda t: t["formatted"])).alias("formatted"),
        F.transform("_turns", lambda t: F.struct(t["mask_start"].alias("start"), t["mask_length"].alias("length"))).alias("mask"),
    )


def read_back(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, roles, texts, learned): turns parsed from ``formatted``, and the unescaped text under the mask.

    Placeholders of attachments stay in the texts.
    """
    part = lambda group: F.regexp_extract_all("formatted", F.lit(TURN), F.lit(group))
    named = lambda r: F.when(r == "\\0", F.lit(None)).otherwise(unescape(r))
    pieces = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(0))
    df = examples.select(conv, "formatted", "mask", part(1).alias("_roles"), part(2).alias("_texts"), pieces.alias("_pieces"))
    under = F.zip_with("_pieces", "mask", lambda p, m: unescape(F.substr(p, m["start"] + 1, m["length"])))
    return df.select(
        conv, "formatted", F.transform("_roles", named).alias("roles"), F.transform("_texts", unescape).alias("texts"),
        F.concat_ws("", under).alias("learned"),
    )
