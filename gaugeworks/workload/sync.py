"""Incremental reads, lag, merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import dedupe, merge, watermarks
from gaugeworks.workload import adapters as a
from gaugeworks.workload.facts import HOURLY, HOURLY_LATEST
from gaugeworks.workload.registry import query

MOMENTS = "SELECT event_id AS id, ts AS dia, user_id AS estacao_id, value, event_type FROM events"
REPLICA = f"""SELECT m.* FROM ({MOMENTS}) m JOIN customer ON c_custkey = estacao_id
WHERE c_mktsegment <> 'MACHINERY'
  AND dia < CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '2024-01-10' ELSE TIMESTAMP '2024-01-20' END"""
AS_OF = "2024-01-31 00:00:00"


@query("incremental_global", f"SELECT * FROM ({MOMENTS}) WHERE dia > (SELECT max(dia) FROM ({REPLICA}))")
def incremental_global(spark, sf):
    wm = watermarks.global_watermark(a.replica(spark, sf), "dia")
    return watermarks.newer_than_global(a.moments(spark, sf), wm, "dia")


@query("incremental_inclusive", f"SELECT * FROM ({MOMENTS}) WHERE dia >= (SELECT max(dia) FROM ({REPLICA}))")
def incremental_inclusive(spark, sf):
    wm = watermarks.global_watermark(a.replica(spark, sf), "dia")
    return watermarks.newer_than_global(a.moments(spark, sf), wm, "dia", inclusive=True)


@query(
    "incremental_per_station",
    f"""SELECT m.* FROM ({MOMENTS}) m
LEFT JOIN (SELECT estacao_id, max(dia) AS wm FROM ({REPLICA}) GROUP BY estacao_id) w ON w.estacao_id = m.estacao_id
WHERE wm IS NULL OR dia > wm""",
)
def incremental_per_station(spark, sf):
    wm = watermarks.measured(watermarks.station_watermarks(a.replica(spark, sf), "dia", "estacao_id"))
    return watermarks.newer_than_station(a.moments(spark, sf), wm, "dia", "estacao_id")


@query("station_watermarks", f"SELECT estacao_id, max(dia) AS watermark FROM ({REPLICA}) GROUP BY estacao_id")
def station_watermarks(spark, sf):
    return watermarks.station_watermarks(a.replica(spark, sf), "dia", "estacao_id")


@query(
    "watermark_report",
    f"""SELECT count(*) AS stations, min(wm) AS oldest_watermark, max(wm) AS newest_watermark,
  CAST(floor(epoch(TIMESTAMP '{AS_OF}' - min(wm)) / 86400) AS BIGINT) AS days_behind
FROM (SELECT estacao_id, max(dia) AS wm FROM ({REPLICA}) GROUP BY estacao_id)""",
)
def watermark_report(spark, sf):
    wm = watermarks.station_watermarks(a.replica(spark, sf), "dia", "estacao_id")
    return watermarks.watermark_report(wm, AS_OF)


@query("pending_rows", "SELECT count(*) AS pending FROM events WHERE ts > TIMESTAMP '2024-01-20' AND ts <= TIMESTAMP '2024-01-25'")
def pending_rows(spark, sf):
    return watermarks.pending_rows(a.moments(spark, sf), "dia", "2024-01-20 00:00:00", "2024-01-25 00:00:00")


@query(
    "pending_distinct",
    f"""SELECT count(*) AS pending FROM (SELECT DISTINCT dia, estacao_id FROM ({HOURLY})
WHERE dia > TIMESTAMP '2024-01-20' AND dia <= TIMESTAMP '2024-01-25')""",
)
def pending_distinct(spark, sf):
    return watermarks.pending_readings(a.hourly(spark, sf), "dia", "estacao_id", "2024-01-20 00:00:00", "2024-01-25 00:00:00")


def _lag_sql(counted: str, source: str) -> str:
    return f"""SELECT last_sync, pending, TIMESTAMP '{AS_OF}' AS as_of,
  CAST(floor(epoch(TIMESTAMP '{AS_OF}' - last_sync) / 86400) AS BIGINT) AS days_behind,
  floor(epoch(TIMESTAMP '{AS_OF}' - last_sync) / 86400) > 1 AS significant,
  CASE WHEN pending > 0 THEN 'pending' ELSE 'current' END AS status
FROM (SELECT max(dia) AS last_sync FROM ({REPLICA}) WHERE dia <= TIMESTAMP '{AS_OF}' + INTERVAL 3 DAY),
  LATERAL (SELECT {counted} AS pending FROM ({source}) s WHERE s.dia > last_sync AND s.dia <= TIMESTAMP '{AS_OF}')"""


@query("lag_report", _lag_sql("count(*)", MOMENTS))
def lag_report(spark, sf):
    return watermarks.lag_report(a.replica(spark, sf), a.moments(spark, sf), "dia", AS_OF)


@query("lag_report_distinct", _lag_sql("count(DISTINCT (s.dia, s.estacao_id))", HOURLY))
def lag_report_distinct(spark, sf):
    return watermarks.lag_report(a.replica(spark, sf), a.hourly(spark, sf), "dia", AS_OF, station="estacao_id")


KEY = ["dia", "estacao_id"]
# The stored copy holds other values, so that it shows which side won.
OLD = f"SELECT * REPLACE (-1.0 AS value) FROM ({HOURLY_LATEST}) WHERE event_type <> 'purchase'"
NEW = f"SELECT * FROM ({HOURLY_LATEST}) WHERE dia >= TIMESTAMP '2024-01-15'"


def _old(spark, sf):
    rows = dedupe.latest_by_id(a.hourly(spark, sf), KEY, "id").filter(F.col("event_type") != "purchase")
    return rows.withColumn("value", F.lit(-1.0))


def _new(spark, sf):
    rows = a.hourly(spark, sf).filter(F.col("dia") >= F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00")))
    return dedupe.latest_by_id(rows, KEY, "id")


@query("upsert_source_wins", f"SELECT * FROM ({NEW}) UNION ALL SELECT * FROM ({OLD}) o WHERE NOT EXISTS (SELECT 1 FROM ({NEW}) n WHERE n.dia = o.dia AND n.estacao_id = o.estacao_id)")
def upsert_source_wins(spark, sf):
    return merge.upsert(_old(spark, sf), _new(spark, sf), KEY)


@query("insert_if_absent", f"SELECT * FROM ({OLD}) UNION ALL SELECT * FROM ({NEW}) n WHERE NOT EXISTS (SELECT 1 FROM ({OLD}) o WHERE n.dia = o.dia AND n.estacao_id = o.estacao_id)")
def insert_if_absent(spark, sf):
    return merge.insert_if_absent(_old(spark, sf), _new(spark, sf), KEY)


@query("absent_rows", f"SELECT * FROM ({NEW}) n WHERE NOT EXISTS (SELECT 1 FROM ({OLD}) o WHERE n.dia = o.dia AND n.estacao_id = o.estacao_id)")
def absent_rows(spark, sf):
    return merge.absent_from(_old(spark, sf), _new(spark, sf), KEY)


@query(
    "append_evolved",
    f"SELECT dia, estacao_id, value, NULL AS event_type FROM ({OLD}) UNION ALL SELECT dia, estacao_id, value, event_type FROM ({NEW})",
)
def append_evolved(spark, sf):
    return merge.append_evolved(
        _old(spark, sf).select("dia", "estacao_id", "value"), _new(spark, sf).select("dia", "estacao_id", "value", "event_type")
    )
