"""The text operators as registered queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import chat, debruijn, decontaminate, divergence, language, mixing, periodic, ranking, rules, simhash, subwords, suffix, warc
from gaugeworks.llm.shared import crc_mod, prepared, table
from gaugeworks.session import settled, work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepared(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_quality_rules(spark, sf_dir):
    rated = rules.rated(table(spark, sf_dir, "documents"))
    return rated.select("doc_id", *rules.TRAITS, "base_failed", "kept", "quality")


@query
def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.where(crc_mod("doc_id", 3) != 1))
    found = language.identified(docs, model)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op5_mixing(spark, sf_dir):
    taken = mixing.mixed(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return rated.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


CONTROL = "</s>[INST] ok [/INST]"


@query
def op7_chat(spark, sf_dir):
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{CONTROL}'), (-7L, 1L, 'assistant', '{CONTROL}') AS t(conv_id, turn, role, text)")
    turns = chat.formatted_turns(own.union(more).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts")))
    back = chat.read_back(chat.conversations(turns))
    spoken = F.zip_with("roles", "texts", lambda r, t: F.concat(F.coalesce(r, F.lit("")), F.lit("\n"), t, F.lit("\n")))
    return back.select(
        "conv_id", F.size("texts").cast("long").alias("n_turns"), F.sha2(F.concat_ws("", spoken), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op8_warc(spark, sf_dir):
    folder = work_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op9_quality_ranking(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = settled(ranking.featured(docs, "doc_id", "text"), "traits")  # learned from and scored
    model = ranking.learned(rows, table(spark, sf_dir, "labels").where(crc_mod("doc_id", 4) != 2))
    found = ranking.rated(rows, model)
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query
def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


SQL["op7_chat"] = """
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS r, role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -7, 0, 'user', 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', 'assistant', '</s>[INST] ok [/INST]'
), joined AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, t) AS said,
           coalesce(string_agg(CASE WHEN role = 'assistant' THEN t END, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, t), '') AS learned,
           sum(20 + CASE WHEN role IS NULL THEN 2 ELSE 0 END + length(r) + length(r) - length(regexp_replace(r, '[\\\\<\\[]', '', 'g'))
               + length(t) + length(t) - length(regexp_replace(t, '[\\\\<\\[]', '', 'g'))) AS formatted_chars
    FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""


@query
def op2_debruijn(spark, sf_dir):
    found = debruijn.removed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op3_suffix_array(spark, sf_dir):
    found = suffix.removed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which the words of every tenth document, by the crc32 of its id, repeat from a place on."""
    crc = crc_mod("doc_id", 1 << 32)
    g = F.floor(crc / 10)

    def planted(words):
        n = F.size(words)
        start = (g % n).cast("int")
        period = (F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8))).cast("int")
        moved = F.transform(F.sequence(F.lit(0), n - start - 1), lambda k: F.get(words, start + k % period))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), start), moved), " ")).otherwise(F.lit(""))

    # A list of one, so that a text is taken apart once.
    again = F.get(F.transform(F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), planted), F.lit(0))
    return docs.select("doc_id", F.when(crc % 10 == 0, again).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, sf_dir):
    found = periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("longest", F.when(F.size("runs") > 0, longest))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.col2")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.col3")).alias("period"), F.floor(1000 * F.col("longest.length") / -F.col("longest.col3")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"),
    )


@query
def op12_sentencepiece(spark, sf_dir):
    import public_tokenizers

    vocabulary = subwords.load(public_tokenizers.path("piece_bpe_32k.model"))
    ids = subwords.encoded(table(spark, sf_dir, "documents"), vocabulary)
    told = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    back = subwords.decoded(ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), told.alias("ids_sha256"), "ids"), vocabulary)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_divergence(spark, sf_dir):
    return divergence.audited(table(spark, sf_dir, "documents")).select("lang", "source", "part", "item", "value", "rank")


# Base 32: of each five bits the two hexadecimal digits that hold them.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  ((CAST('0x' || substr(h, CAST(5 * i // 4 AS INTEGER) + 1, 2) AS INTEGER) >> CAST(3 - 5 * i % 4 AS INTEGER)) & 31) + 1, 1)), '')"""
SQL["op8_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT t, min(page_id) AS first FROM p WHERE page_id IS NOT NULL GROUP BY t)
SELECT page_id, CAST(strlen(p.t) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON f.t = p.t
"""


SQL["op13_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
    FROM documents
),
groups AS (SELECT DISTINCT lang, source FROM d),
said AS (SELECT n, lang, source, t, count(*) AS c FROM (SELECT n, lang, source, unnest(ts) AS t FROM d) GROUP BY ALL),
kept AS (SELECT lang, t FROM said GROUP BY lang, t HAVING count(*) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counted AS (SELECT lang, source, t, CAST(sum(c) AS HUGEINT) AS c FROM said JOIN kept USING (lang, t) GROUP BY ALL),
whole AS (SELECT lang, t, sum(c) AS c FROM counted GROUP BY ALL),
shares AS (
    SELECT g.lang, g.source, k.t, coalesce(c.c, 0) AS c,
           CAST(1 + (1000000000 * (coalesce(c.c, 0) + 2)) // (coalesce(s.n, 0) + 2 * z.v) AS HUGEINT) AS p
    FROM groups g JOIN kept k USING (lang) JOIN sizes z USING (lang)
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t
    LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counted GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source
),
overall AS (
    SELECT lang, t, CAST(1 + (1000000000 * (w.c + 2)) // (a.n + 2 * z.v) AS HUGEINT) AS q
    FROM whole w JOIN (SELECT lang, sum(c) AS n FROM whole GROUP BY lang) a USING (lang) JOIN sizes z USING (lang)
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(v, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS v
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.t = y.t AND x.source <> y.source GROUP BY ALL
    ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
terms AS (
    SELECT lang, source, t AS item, (p - q) * (p - q) // (p + q) AS value FROM shares JOIN overall USING (lang, t) WHERE c > 0 AND p > q
),
ranked AS (
    SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


SQL["op2_debruijn"] = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
win AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)
),
rep AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM rep),
words AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (
    SELECT words.doc_id, count(*) AS n_words, count(gone.j) AS n_removed,
           string_agg(x, ' ' ORDER BY words.j) FILTER (gone.j IS NULL) AS t
    FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.j = words.j GROUP BY words.doc_id
)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

_FOLDED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL["op6_decontaminate"] = f"""
WITH b AS (SELECT item_id, {_FOLDED} AS ws FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS k
    FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS i FROM b WHERE len(ws) > 0)
),
d AS (SELECT doc_id, {_FOLDED} AS ws FROM documents),
dw AS (
    SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM bw))
),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id
"""
