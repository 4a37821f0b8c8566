"""Time columns and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions import timecols
from gaugeworks.operators import columns
from gaugeworks.sources import reports
from gaugeworks.workload import adapters as a
from gaugeworks.workload.registry import query

ZONE = "America/Sao_Paulo"
_LOCAL = f"timezone('{ZONE}', timezone('UTC', o_orderdate))"
_OFF = f"CAST(epoch({_LOCAL} - o_orderdate) / 60 AS INTEGER)"


def _off(sep: str) -> str:
    return f"(CASE WHEN {_OFF} < 0 THEN '-' ELSE '+' END || lpad(CAST(abs({_OFF}) // 60 AS VARCHAR), 2, '0') || '{sep}' || lpad(CAST(abs({_OFF}) % 60 AS VARCHAR), 2, '0'))"


@query(
    "local_time_columns",
    f"""SELECT o_orderkey AS id, o_orderdate AS dia_utc, {_LOCAL} AS dia,
  strftime({_LOCAL}, '%Y-%m-%d %H:%M:%S.%g') || ' ' || {_off('')} AS dia_original, {_off('')} AS utc_offset, {_off(':')} AS offset_colon
FROM orders""",
)
def local_time_columns(spark, sf):
    rows = a.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("dia_utc"))
    return columns.add_time_columns(rows).withColumn("offset_colon", timecols.offset_text_colon(F.col("dia_utc")))


@query(
    "original_text",
    "SELECT event_id AS id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S.%g') || ' -0300' AS dia_original FROM events",
)
def original_text(spark, sf):
    return a.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), timecols.original_text(F.col("ts")).alias("dia_original")
    )


@query(
    "naive_zone_to_utc",
    "SELECT event_id AS id, ts AS as_utc, ts + INTERVAL 3 HOUR AS as_fixed, ts + INTERVAL 3 HOUR AS as_local FROM events",
)
def naive_zone_to_utc(spark, sf):
    ts = F.col("ts")
    return a.table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        timecols.to_utc(ts).alias("as_utc"),
        timecols.to_utc(ts, "-03:00").alias("as_fixed"),
        timecols.to_utc(ts, ZONE).alias("as_local"),
    )


@query(
    "truncated_times",
    """SELECT event_id AS id, date_trunc('minute', ts) AS minuto, date_trunc('day', ts) AS dia, date_trunc('week', ts) AS semana,
  date_trunc('month', ts) AS mes, date_trunc('year', ts) AS ano, strftime(ts, '%Y-%m') AS ano_mes FROM events""",
)
def truncated_times(spark, sf):
    ts = F.col("ts")
    # date_trunc gives a zoned type; trunc keeps wall-clock values.
    return a.table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        timecols.trunc("minute", ts).alias("minuto"), timecols.trunc("dia", ts).alias("dia"),
        timecols.trunc("semana", ts).alias("semana"), timecols.trunc("mes", ts).alias("mes"),
        timecols.trunc("year", ts).alias("ano"), timecols.month_key(ts).alias("ano_mes"),
    )


@query(
    "parse_offset_text",
    """SELECT event_id AS id, CASE event_type WHEN 'click' THEN date_trunc('millisecond', ts) + INTERVAL 3 HOUR
  WHEN 'view' THEN date_trunc('second', ts) + INTERVAL 2 HOUR WHEN 'purchase' THEN ts - INTERVAL 330 MINUTE
  WHEN 'signup' THEN CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
    WHEN 2 THEN date_trunc('minute', ts) + INTERVAL 3 HOUR ELSE date_trunc('day', ts) END END AS utc FROM events""",
)
def parse_offset_text(spark, sf):
    """Seven spellings of the event time and one that is not a time."""
    ts, kind = F.col("ts"), F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" -0300")))
        .when(kind == "view", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-02:00")))
        .when(kind == "purchase", F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" +05:30")))
        .when(kind != "signup", F.col("props"))
        .when(F.col("event_id") % 4 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 4 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_id") % 4 == 2, F.date_format(ts, "yyyy-MM-dd HH:mm'-03'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd"))
    )
    return a.table(spark, sf, "events").select(F.col("event_id").alias("id"), timecols.parse_text_utc(text).alias("utc"))



@query(
    "local_to_utc_dst",
    f"""SELECT id, w AS local, CASE
  WHEN timezone('{ZONE}', timezone('UTC', u)) <> w THEN date_trunc('hour', u)
  WHEN timezone('{ZONE}', timezone('UTC', u + INTERVAL 1 HOUR)) = w OR timezone('{ZONE}', timezone('UTC', u - INTERVAL 1 HOUR)) = w THEN NULL
  ELSE u END AS utc
FROM (SELECT id, w, timezone('UTC', timezone('{ZONE}', w)) AS u FROM (
  SELECT o_orderkey AS id, o_orderdate AS w FROM orders UNION ALL SELECT o_orderkey, o_orderdate + INTERVAL 1410 MINUTE FROM orders))""",
)
def local_to_utc_dst(spark, sf):
    """Midnights (skipped when summer time starts) and 23:30s (repeated when it ends)."""
    rows = a.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("local"))
    both = rows.unionByName(rows.withColumn("local", timecols.shift(F.col("local"), mins=1410)))
    return both.withColumn("utc", timecols.local_to_utc(F.col("local")))


def report_lines(spark, sf):
    """Events written as report lines of every kind the layout knows."""
    kind, v = F.col("event_type"), F.col("value")
    day = F.date_format("ts", "dd/MM/yyyy  HH:mm:ss")
    number = v.cast("string")
    six = F.concat_ws("   ", F.when(kind == "error", "ND").otherwise(number), F.lit("180,5"), number, F.lit("ND"), F.lit("1013.2"), F.lit("80"))
    line = (
        F.when(kind == "signup", F.concat(day, F.lit(" HBV "), six))
        .when(kind == "purchase", F.concat(day, F.lit(" 1 2 3 4 5")))
        .when(kind == "view", F.concat(F.lit("  "), day, F.lit("  "), F.replace(six, F.lit("."), F.lit(","))))
        .otherwise(F.concat(day, F.lit(" "), six))
    )
    return a.table(spark, sf, "events").select(line.alias("linha"), F.concat(F.lit("estacao_"), "user_id", F.lit("_Met.txt")).alias("arquivo"))


REPORT = """SELECT date_trunc('second', ts) AS ts_site, date_trunc('second', ts) + INTERVAL 3 HOUR AS ts_utc,
  CASE WHEN event_type <> 'error' THEN value END AS chuva, 180.5 AS dirvento, value AS velvento,
  CAST(NULL AS DOUBLE) AS temperatura, 1013.2 AS pressao, 80.0 AS umidade, 'estacao_' || user_id || '_Met.txt' AS arquivo
FROM events WHERE event_type <> 'purchase'"""


@query("report_parse", f"SELECT * REPLACE (CAST(dirvento AS DOUBLE) AS dirvento, CAST(pressao AS DOUBLE) AS pressao, CAST(umidade AS DOUBLE) AS umidade) FROM ({REPORT})")
def report_parse(spark, sf):
    return reports.parse_report(report_lines(spark, sf))


@query(
    "report_last_wins",
    f"""SELECT ts_utc, arquivo, chuva, velvento FROM ({REPORT})
QUALIFY row_number() OVER (PARTITION BY regexp_replace(arquivo, '_Met.txt$', ''), ts_utc ORDER BY arquivo DESC, chuva DESC NULLS LAST, velvento DESC) = 1""",
)
def report_last_wins(spark, sf):
    parsed = reports.parse_report(report_lines(spark, sf))
    parsed = parsed.withColumn("estacao", F.regexp_replace("arquivo", r"_Met\.txt$", ""))
    return reports.last_report_wins(parsed).select("ts_utc", "arquivo", "chuva", "velvento")
