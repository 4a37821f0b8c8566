"""Reconciliation and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions import timecols
from gaugeworks.operators import compare, contracts, dedupe, matching, ranking
from gaugeworks.schema import RAIN_METRICS
from gaugeworks.workload import adapters as a
from gaugeworks.workload.facts import rain_sql
from gaugeworks.workload.registry import query
from gaugeworks.workload.sync import MOMENTS

KEY = ["dia", "estacao_id"]
RAIN = rain_sql(RAIN_METRICS)
# A copy with missing and extra keys, a stale column, a lost value and noise below the tolerance.
FAULTY = f"""SELECT CASE WHEN h01 = 0.0 THEN dia + INTERVAL 12 HOUR ELSE dia END AS dia, m05,
  CASE WHEN m15 = 0.07 THEN m10 + 0.00005 ELSE m10 END AS m10, m15, h01, h04,
  CASE WHEN m15 = 0.02 THEN NULL ELSE h24 END AS h24, CASE WHEN m15 = 0.05 THEN h96 + 0.2 ELSE h96 END AS h96, estacao, estacao_id
FROM ({RAIN}) WHERE h01 <> 0.08"""


def faulty(rows):
    m15, h01 = F.col("m15"), F.col("h01")
    return rows.filter(h01 != 0.08).withColumns({
        "dia": F.when(h01 == 0.0, timecols.shift(F.col("dia"), hours=12)).otherwise(F.col("dia")),
        "m10": F.when(m15 == 0.07, F.col("m10") + 0.00005).otherwise(F.col("m10")),
        "h24": F.when(m15 == 0.02, F.lit(None)).otherwise(F.col("h24")),
        "h96": F.when(m15 == 0.05, F.col("h96") + 0.2).otherwise(F.col("h96")),
    })


def _diff(m: str, tol: float, src: str = "s", dst: str = "d") -> str:
    return f"(({src}.{m} IS NULL) <> ({dst}.{m} IS NULL) OR coalesce(abs({src}.{m} - {dst}.{m}) > {tol}, FALSE))"


def _differing(tol: float) -> str:
    parts = ", ".join(f"CASE WHEN {_diff(m, tol)} THEN '{m}' END" for m in RAIN_METRICS)
    return f"concat_ws(',', {parts})"


_JOIN = f"FROM ({RAIN}) s FULL JOIN ({FAULTY}) d ON s.dia = d.dia AND s.estacao_id = d.estacao_id"
_STATUS = f"CASE WHEN d.dia IS NULL THEN 'missing' WHEN s.dia IS NULL THEN 'extra' WHEN {_differing(0.0001)} <> '' THEN 'different' ELSE 'ok' END"
_PAIRS = ", ".join(f"s.{m} AS {m}_src, d.{m} AS {m}_dst" for m in RAIN_METRICS)
RECONCILED = f"""SELECT coalesce(s.dia, d.dia) AS dia, coalesce(s.estacao_id, d.estacao_id) AS estacao_id, {_PAIRS}, {_STATUS} AS status,
  CASE WHEN s.dia IS NULL OR d.dia IS NULL THEN '' ELSE {_differing(0.0001)} END AS differing {_JOIN}"""


def _compared(spark, sf):
    rows = a.rain_rows(spark, sf)
    return compare.reconcile(rows, faulty(rows), KEY, RAIN_METRICS)


def as_text(df, column: str):
    return df.withColumn(column, F.array_join(column, ","))


@query("reconcile_keys", RECONCILED)
def reconcile_keys(spark, sf):
    return as_text(_compared(spark, sf), "differing")


@query("reconcile_totals", f"SELECT status, count(*) AS total FROM ({RECONCILED}) GROUP BY status")
def reconcile_totals(spark, sf):
    return compare.status_totals(_compared(spark, sf))


@query(
    "reconcile_source_rows",
    f"SELECT dia, estacao_id, status, differing FROM ({RECONCILED}) WHERE status <> 'extra'",
)
def reconcile_source_rows(spark, sf):
    rows = a.rain_rows(spark, sf)
    found = compare.reconcile(rows, faulty(rows), KEY, RAIN_METRICS, how="left")
    return as_text(found, "differing").select(*KEY, "status", "differing")


@query(
    "divergent_columns",
    f"""SELECT campo, count(*) AS total FROM (SELECT unnest(string_split(differing, ',')) AS campo FROM ({RECONCILED}) WHERE differing <> '')
GROUP BY campo""",
)
def divergent_columns(spark, sf):
    rows = _compared(spark, sf).select(F.explode("differing").alias("campo"))
    return rows.groupBy("campo").agg(F.count(F.lit(1)).alias("total"))


_EXACT = " OR ".join(f"s.{m} IS DISTINCT FROM d.{m}" for m in RAIN_METRICS)


@query(
    "reconcile_exact",
    f"""SELECT coalesce(s.dia, d.dia) AS dia, coalesce(s.estacao_id, d.estacao_id) AS estacao_id,
  CASE WHEN d.dia IS NULL THEN 'missing' WHEN s.dia IS NULL THEN 'extra' WHEN {_EXACT} THEN 'different' ELSE 'ok' END AS status {_JOIN}""",
)
def reconcile_exact(spark, sf):
    rows = a.rain_rows(spark, sf)
    return compare.reconcile_exact(rows, faulty(rows), KEY, RAIN_METRICS).select(*KEY, "status")


@query(
    "key_sets",
    f"""SELECT coalesce(s.dia, d.dia) AS dia, coalesce(s.estacao_id, d.estacao_id) AS estacao_id,
  CASE WHEN d.dia IS NULL THEN 'left_only' WHEN s.dia IS NULL THEN 'right_only' ELSE 'both' END AS side {_JOIN}""",
)
def key_sets(spark, sf):
    rows = a.rain_rows(spark, sf)
    return compare.key_sets(rows, faulty(rows), KEY)


@query("presence_totals", f"SELECT CASE WHEN d.dia IS NULL THEN 'left_only' WHEN s.dia IS NULL THEN 'right_only' ELSE 'both' END AS side, count(*) AS total {_JOIN} GROUP BY 1")
def presence_totals(spark, sf):
    rows = a.rain_rows(spark, sf)
    return compare.presence_totals(rows, faulty(rows), KEY)


_INNER = f"FROM ({RAIN}) s JOIN ({FAULTY}) d ON s.dia = d.dia AND s.estacao_id = d.estacao_id"


@query(
    "reconcile_metrics",
    " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, max(abs(s.{m} - d.{m})) AS max_diff, count(s.{m} - d.{m}) AS comparable,
  count(*) FILTER (WHERE abs(s.{m} - d.{m}) > 0.05) AS over_tolerance {_INNER}""" for m in RAIN_METRICS
    ),
)
def reconcile_metrics(spark, sf):
    rows = a.rain_rows(spark, sf)
    return compare.metric_summary(rows, faulty(rows), KEY, RAIN_METRICS)


@query(
    "worst_examples",
    f"""SELECT s.dia, s.estacao_id, 'h96' AS metric, s.h96 AS site_value, d.h96 AS ref_value,
  row_number() OVER (ORDER BY s.h96, s.dia, s.estacao_id) AS position {_INNER} AND abs(s.h96 - d.h96) > 0.05 QUALIFY position <= 10""",
)
def worst_examples(spark, sf):
    """Only h96 is off by more than the tolerance."""
    rows = a.rain_rows(spark, sf)
    found = compare.worst_examples(rows, faulty(rows), KEY, RAIN_METRICS)
    return found.withColumn("position", F.col("position").cast("bigint"))


@query(
    "examples_by_status",
    f"""SELECT dia, estacao_id, status, row_number() OVER (PARTITION BY status ORDER BY dia, estacao_id) AS position
FROM ({RECONCILED}) QUALIFY position <= 5""",
)
def examples_by_status(spark, sf):
    found = compare.examples_by_status(_compared(spark, sf).select(*KEY, "status"), KEY)
    return found.withColumn("position", F.col("position").cast("bigint"))


@query(
    "record_compare_long",
    " UNION ALL ".join(
        f"""SELECT s.dia, s.estacao_id, '{m}' AS campo, s.{m} AS origem, d.{m} AS destino, s.{m} IS NOT DISTINCT FROM d.{m} AS equal_exact,
  NOT {_diff(m, 0.0001)} AS equal_tolerant, abs(s.{m} - d.{m}) AS difference,
  CASE WHEN NOT {_diff(m, 0.0001)} THEN 'ok' ELSE 'different' END AS status {_INNER}""" for m in RAIN_METRICS
    ),
)
def record_compare_long(spark, sf):
    rows = a.rain_rows(spark, sf)
    return compare.long_form(rows, faulty(rows), KEY, RAIN_METRICS)


# A copy whose times are off by a different amount per event type.
_SHIFT = {"click": 400_000, "view": 30_000_000, "purchase": 1_500_000_000, "signup": 3_540_000_000}
_DRIFT_SQL = " ".join(f"WHEN '{k}' THEN {v}" for k, v in _SHIFT.items())
DRIFTED = f"""SELECT * FROM (
  SELECT id AS id_dst, dia + to_microseconds(CAST(CASE event_type {_DRIFT_SQL} END AS BIGINT)) AS dia_dst, estacao_id,
         CASE WHEN event_type = 'view' THEN value + 1 ELSE value END AS value_dst
  FROM ({MOMENTS}) WHERE event_type <> 'error')
QUALIFY row_number() OVER (PARTITION BY dia_dst, estacao_id ORDER BY id_dst DESC) = 1"""
UNIQUE = f"SELECT * FROM ({MOMENTS}) QUALIFY row_number() OVER (PARTITION BY dia, estacao_id ORDER BY id DESC) = 1"


def unique_moments(spark, sf):
    return dedupe.latest_by_id(a.moments(spark, sf), KEY, "id")


def drifted(spark, sf):
    kind = F.col("event_type")
    micros = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in _SHIFT.items()])
    moved = F.col("dia") + F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)"))
    rows = a.moments(spark, sf).filter(kind != "error").select(
        F.col("id").alias("id_dst"), moved.alias("dia_dst"), "estacao_id",
        F.when(kind == "view", F.col("value") + 1).otherwise(F.col("value")).alias("value_dst"),
    )
    return dedupe.latest_by_id(rows, ["dia_dst", "estacao_id"], "id_dst")


def _match_sql(lower: str, upper: str, order: str) -> str:
    return f"""SELECT s.id, s.dia, s.estacao_id, s.value, s.event_type, d.dia_dst AS match_ts, d.id_dst, d.value_dst
FROM ({UNIQUE}) s LEFT JOIN ({DRIFTED}) d
  ON d.estacao_id = s.estacao_id AND d.dia_dst BETWEEN s.dia - {lower} AND s.dia + {upper}
QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY {order}) = 1"""


PAYLOAD = ["id_dst", "value_dst"]


@query("interval_match_1s", _match_sql("INTERVAL 1 SECOND", "INTERVAL 1 SECOND", "abs(epoch_us(d.dia_dst) - epoch_us(s.dia)), d.dia_dst"))
def interval_match_1s(spark, sf):
    return matching.within_seconds(unique_moments(spark, sf), drifted(spark, sf), "estacao_id", "dia", "dia_dst", PAYLOAD)


@query("first_in_hour", _match_sql("INTERVAL 1 HOUR", "INTERVAL 1 HOUR", "d.dia_dst, d.id_dst DESC"))
def first_in_hour(spark, sf):
    return matching.first_in_window(unique_moments(spark, sf), drifted(spark, sf), "estacao_id", "dia", "dia_dst", PAYLOAD)


@query("nearest_hour", _match_sql("INTERVAL 1 HOUR", "INTERVAL 1 HOUR", "abs(epoch_us(d.dia_dst) - epoch_us(s.dia)), d.dia_dst"))
def nearest_hour(spark, sf):
    return matching.asof(unique_moments(spark, sf), drifted(spark, sf), "estacao_id", "dia", "dia_dst", PAYLOAD, 3600)


# Distance by minute first; inside the own minute by exact time, elsewhere its first row.
_MINUTES = "abs(epoch_us(date_trunc('minute', d.dia_dst)) - epoch_us(date_trunc('minute', s.dia)))"
NEAREST = f"""SELECT s.id, s.dia, s.estacao_id, s.value, s.event_type, d.dia_dst AS match_ts, d.id_dst, d.value_dst,
  CASE WHEN d.dia_dst IS NULL THEN NULL WHEN {_MINUTES} = 0 THEN 1 ELSE 2 END AS match_tier
FROM ({UNIQUE}) s LEFT JOIN ({DRIFTED}) d
  ON d.estacao_id = s.estacao_id AND {_MINUTES} <= 3600000000
QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY {_MINUTES}, date_trunc('minute', d.dia_dst),
  CASE WHEN {_MINUTES} = 0 THEN abs(epoch_us(d.dia_dst) - epoch_us(s.dia)) ELSE 0 END, d.dia_dst) = 1"""


@query("nearest_match", NEAREST)
def nearest_match(spark, sf):
    return matching.nearest_by_minute(
        unique_moments(spark, sf), drifted(spark, sf), "estacao_id", "dia", "dia_dst", PAYLOAD
    )


def _verdict(match: str) -> str:
    return f"""SELECT id, dia, estacao_id, match_ts,
  CASE WHEN match_ts IS NULL THEN 'missing' WHEN abs(value - value_dst) > 0.0001 THEN 'different' ELSE 'ok' END AS status FROM ({match})"""


def _plain_target(spark, sf):
    return drifted(spark, sf).select(F.col("dia_dst").alias("dia"), "estacao_id", F.col("value_dst").alias("value"))


@query("reconcile_within_second", _verdict(_match_sql("INTERVAL 1 SECOND", "INTERVAL 1 SECOND", "abs(epoch_us(d.dia_dst) - epoch_us(s.dia)), d.dia_dst")))
def reconcile_within_second(spark, sf):
    found = compare.reconcile_within(unique_moments(spark, sf), _plain_target(spark, sf), "dia", "estacao_id", ["value"])
    return found.select("id", *KEY, "match_ts", "status")


@query("reconcile_period", _verdict(NEAREST))
def reconcile_period(spark, sf):
    found = compare.reconcile_period(unique_moments(spark, sf), _plain_target(spark, sf), "dia", "estacao_id", ["value"])
    return found.select("id", *KEY, "match_ts", "status")


@query(
    "sample_reconcile",
    f"""SELECT d.dia, d.estacao_id, CASE WHEN s.dia IS NULL THEN 'missing' WHEN {_differing(0.0001)} <> '' THEN 'different' ELSE 'ok' END AS status
FROM (SELECT * FROM ({FAULTY}) ORDER BY md5(concat_ws('|', '', strftime(dia, '%Y-%m-%d %H:%M:%S'), CAST(estacao_id AS VARCHAR))), dia, estacao_id LIMIT 50) d
LEFT JOIN ({RAIN}) s ON s.dia = d.dia AND s.estacao_id = d.estacao_id""",
)
def sample_reconcile(spark, sf):
    """A sample of the copy looked up in its source, as a spot check."""
    rows = a.rain_rows(spark, sf)
    checked = ranking.sample(faulty(rows), KEY, 50)
    return compare.reconcile(checked, rows, KEY, RAIN_METRICS, how="left").select(*KEY, "status")


@query(
    "layout_check",
    """SELECT count(*) AS partitions, 'month' AS granularity, TRUE AS accepted FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') FROM orders)""",
)
def layout_check(spark, sf):
    return contracts.layout_check(a.readings(spark, sf).withColumn("ano_mes", timecols.month_key(F.col("horaLeitura"))), "ano_mes")
