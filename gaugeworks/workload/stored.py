"""Tables written and read back: exports, loads, syncs, streams, delimited reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions.timecols import ntz
from gaugeworks.operators.dedupe import latest_by_id
from gaugeworks.plans import combined, diagnosis, rain as rain_plan, weather as weather_plan
from gaugeworks.schema import RAIN_METRICS, RAIN_METRICS_FULL
from gaugeworks.session import work_dir
from gaugeworks.sinks import exports, tables as sink
from gaugeworks.sources import reports
from gaugeworks.sources.tables import read_table, scan_range
from gaugeworks.streaming.sync import live_view, read_feed, sync_stream
from gaugeworks.workload import adapters as a
from gaugeworks.workload.facts import HOURLY_LATEST, RAIN_VERSIONS, order_rows, rain_sql, weather_sql
from gaugeworks.workload.registry import query

ORDERS = """SELECT o_orderkey AS id, o_orderdate AS dia, o_custkey AS estacao_id, c_name AS estacao, o_totalprice AS h24
FROM orders JOIN customer ON c_custkey = o_custkey"""


def plain_times(df):
    """Instants as UTC wall clock."""
    return df.withColumns({f.name: ntz(F.col(f.name)) for f in df.schema if f.dataType.typeName() == "timestamp"})


@query("export_by_year", f"SELECT *, CAST(year(dia) AS BIGINT) AS ano FROM ({ORDERS})")
def export_by_year(spark, sf):
    path = work_dir(spark, "by-year")
    exports.export_by_year(order_rows(spark, sf), path)
    return plain_times(read_table(spark, path)).withColumn("ano", F.col("ano").cast("bigint"))


@query("export_interval", f"SELECT * FROM ({ORDERS}) WHERE year(dia) BETWEEN 1996 AND 1998")
def export_interval(spark, sf):
    path = work_dir(spark, "interval")
    exports.export_interval(order_rows(spark, sf), path, 1996, 1998)
    return plain_times(read_table(spark, path))


@query("export_all", ORDERS)
def export_all(spark, sf):
    path = work_dir(spark, "all")
    exports.export_all(order_rows(spark, sf), path)
    return plain_times(read_table(spark, path))


@query("monthly_table", f"SELECT *, strftime(dia, '%Y-%m') AS ano_mes FROM ({ORDERS})")
def monthly_table(spark, sf):
    path = work_dir(spark, "monthly")
    sink.reload_table(order_rows(spark, sf), path, "dia")
    return read_table(spark, path).withColumn("ano_mes", F.col("ano_mes").cast("string"))


@query("monthly_range", f"SELECT * FROM ({ORDERS}) WHERE dia >= TIMESTAMP '1997-03-15' AND dia < TIMESTAMP '1998-02-10'")
def monthly_range(spark, sf):
    path = work_dir(spark, "monthly")
    sink.reload_table(order_rows(spark, sf), path, "dia")
    rows = scan_range(read_table(spark, path), "dia", "1997-03-15 00:00:00", "1998-02-10 00:00:00")
    return rows.drop("ano_mes")


@query(
    "stream_sync_once", HOURLY_LATEST,
)
def stream_sync_once(spark, sf):
    """Events arrive in four files, each its own micro-batch."""
    feed_path, path = work_dir(spark, "feed"), work_dir(spark, "synced")
    events = a.table(spark, sf, "events")
    events.repartition(4, "event_id").write.parquet(feed_path)
    feed = read_feed(spark, feed_path, events.schema, files_per_batch=1)
    hourly = feed.select(
        F.col("event_id").alias("id"), ntz(F.date_trunc("hour", "ts")).alias("dia"), F.col("user_id").alias("estacao_id"),
        "value", "event_type",
    )
    sync_stream(hourly, path, work_dir(spark, "progress"), ["dia", "estacao_id"], "id", ts="dia").awaitTermination()
    return read_table(spark, path).drop("ano_mes")


@query("stream_merge_on_read", HOURLY_LATEST)
def stream_merge_on_read(spark, sf):
    """As ``stream_sync_once``, appending versions and resolving them on read."""
    feed_path, path = work_dir(spark, "feed"), work_dir(spark, "versions")
    events = a.table(spark, sf, "events")
    events.repartition(4, "event_id").write.parquet(feed_path)
    feed = read_feed(spark, feed_path, events.schema, files_per_batch=2)
    hourly = feed.select(
        F.col("event_id").alias("id"), ntz(F.date_trunc("hour", "ts")).alias("dia"), F.col("user_id").alias("estacao_id"),
        "value", "event_type",
    )
    key = ["dia", "estacao_id"]
    sync_stream(
        hourly, path, work_dir(spark, "progress"), key, "id", ts="dia", merge_on_read=True
    ).awaitTermination()
    return sink.current(read_table(spark, path).drop("ano_mes"), key, "id")


@query("live_view", f"SELECT * FROM ({HOURLY_LATEST}) WHERE dia >= TIMESTAMP '2024-01-29 12:00:00' - INTERVAL 48 HOUR")
def live_view_query(spark, sf):
    path = work_dir(spark, "live")
    sink.reload_table(latest_by_id(a.hourly(spark, sf), ["dia", "estacao_id"], "id"), path, "dia")
    return live_view(spark, path, "dia", 48, "2024-01-29 12:00:00").drop("ano_mes")


# --- rain ---

REPLICA_SQL = rain_sql(RAIN_METRICS)
_MONEY = ", ".join(f"CAST(round({m}, 2) AS DOUBLE) AS {m}" for m in RAIN_METRICS)
ZONE = "America/Sao_Paulo"


def time_columns(rows: str, ts: str) -> str:
    local = f"timezone('{ZONE}', timezone('UTC', {ts}))"
    minutes = f"CAST(epoch({local} - {ts}) / 60 AS INTEGER)"
    off = f"(CASE WHEN {minutes} < 0 THEN '-' ELSE '+' END || lpad(CAST(abs({minutes}) // 60 AS VARCHAR), 2, '0') || lpad(CAST(abs({minutes}) % 60 AS VARCHAR), 2, '0'))"
    return f"""SELECT * EXCLUDE ({ts}), {ts} AS dia_utc, {local} AS dia,
  strftime({local}, '%Y-%m-%d %H:%M:%S.%g') || ' ' || {off} AS dia_original, {off} AS utc_offset FROM ({rows})"""


WAREHOUSE_SQL = time_columns(rain_sql(RAIN_METRICS_FULL), "dia")


def _rain_args(spark, sf):
    return a.readings(spark, sf), a.rain(spark, sf), a.stations(spark, sf)


def _before(readings, networks, end: str):
    """Readings already loaded earlier: one network was never loaded."""
    known = readings.join(networks, "estacao_id").filter(F.col("rede") != "MACHINERY").drop("rede")
    return known.filter(F.col("horaLeitura") < F.to_timestamp_ntz(F.lit(end))).select(*readings.columns)


def _shown(df):
    """Replica metrics as doubles."""
    return plain_times(df).select("dia", *[F.col(m).cast("double").alias(m) for m in RAIN_METRICS], "estacao", F.col("estacao_id").cast("bigint").alias("estacao_id"))


REPLICA_SHOWN = f"SELECT dia, {_MONEY}, estacao, estacao_id FROM ({REPLICA_SQL})"


@query("rain_replica_load", REPLICA_SHOWN)
def rain_replica_load(spark, sf):
    path = work_dir(spark, "replica")
    rain_plan.load_replica(*_rain_args(spark, sf), path)
    return _shown(read_table(spark, path))


@query(
    "rain_replica_sync",
    f"""SELECT r.* FROM ({REPLICA_SHOWN}) r JOIN customer ON c_custkey = estacao_id
WHERE c_mktsegment <> 'MACHINERY' OR dia > (SELECT max(o_orderdate) FROM orders JOIN customer ON c_custkey = o_custkey
  JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment <> 'MACHINERY' AND o_orderdate < TIMESTAMP '2000-01-01')""",
)
def rain_replica_sync(spark, sf):
    """One global watermark: older rows of the network loaded late are not fetched."""
    readings, rain, stations = _rain_args(spark, sf)
    path = work_dir(spark, "replica")
    rain_plan.load_replica(_before(readings, a.networks(spark, sf), "2000-01-01 00:00:00"), rain, stations, path)
    rain_plan.sync_replica(spark, readings, rain, stations, path)
    return _shown(read_table(spark, path))


@query("rain_warehouse_export", WAREHOUSE_SQL)
def rain_warehouse_export(spark, sf):
    path = work_dir(spark, "warehouse")
    rain_plan.export_warehouse(*_rain_args(spark, sf), path)
    return plain_times(read_table(spark, path)).drop("ano_mes")


@query("rain_warehouse_sync", WAREHOUSE_SQL)
def rain_warehouse_sync(spark, sf):
    """Watermarks per station: the late network is fetched whole, so the result is the full export."""
    readings, rain, stations = _rain_args(spark, sf)
    path = work_dir(spark, "warehouse")
    rain_plan.export_warehouse(_before(readings, a.networks(spark, sf), "2000-01-01 00:00:00"), rain, stations, path)
    rain_plan.sync_warehouse(spark, readings, rain, stations, path)
    return plain_times(read_table(spark, path)).drop("ano_mes")


def _copied_sql(where: str) -> str:
    order = ", ".join(RAIN_METRICS)
    return f"""SELECT dia, {order}, c_name AS estacao, estacao_id FROM (SELECT * FROM ({RAIN_VERSIONS}) WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY dia, estacao_id ORDER BY {order}) = 1) JOIN customer ON c_custkey = estacao_id"""


@query("legacy_copy", _copied_sql("TRUE"))
def legacy_copy(spark, sf):
    return rain_plan.copied_rows(None, *_rain_args(spark, sf))


@query(
    "legacy_copy_incremental",
    _copied_sql("dia >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"),
)
def legacy_copy_incremental(spark, sf):
    readings, rain, stations = _rain_args(spark, sf)
    loaded = readings.withColumnRenamed("horaLeitura", "dia").filter(F.col("dia") < F.to_timestamp_ntz(F.lit("2000-01-01 00:00:00")))
    return rain_plan.copied_rows(loaded, readings, rain, stations)


@query(
    "source_diagnosis",
    f"""WITH j AS (SELECT * FROM ({RAIN_VERSIONS}) JOIN customer ON c_custkey = estacao_id),
d AS (SELECT dia, estacao_id, count(*) AS total FROM j GROUP BY ALL HAVING count(*) > 1)
SELECT 'year ' || year(dia) AS item, count(*) AS total FROM j GROUP BY 1
UNION ALL SELECT 'first month', count(*) FROM j WHERE strftime(dia, '%Y-%m') = '1997-01'
UNION ALL SELECT 'duplicated keys', count(*) FROM d
UNION ALL SELECT 'most duplicated', sum(total)::BIGINT FROM (SELECT total FROM d ORDER BY total DESC LIMIT 10)""",
)
def source_diagnosis(spark, sf):
    """The diagnosis reports in one list."""
    found = diagnosis.diagnose(*_rain_args(spark, sf))
    return (
        found["years"].select(F.concat(F.lit("year "), F.col("ano").cast("string")).alias("item"), F.col("total_registros").alias("total"))
        .unionByName(found["first_month"].select(F.lit("first month").alias("item"), "total"))
        .unionByName(found["duplicate_count"].select(F.lit("duplicated keys").alias("item"), F.col("total_duplicatas").alias("total")))
        .unionByName(found["duplicates"].agg(F.sum("total").alias("total")).select(F.lit("most duplicated").alias("item"), "total"))
    )


# --- weather ---


def _weather_args(spark, sf):
    return (
        a.event_readings(spark, sf), a.sensor_values(spark, sf), a.sensors(spark, sf), a.rain(spark, sf), a.stations(spark, sf),
    )


# These readings are all after the cut-over, so rain is the 5-minute column.
_RAIN_5 = """SELECT date_trunc('hour', ts) AS d, user_id AS u, max(l_quantity) AS chuva
FROM events LEFT JOIN lineitem ON l_orderkey = event_id GROUP BY ALL"""
_WEATHER = f"""SELECT w.* REPLACE (r.chuva AS chuva, round(ponto_orvalho, 6) AS ponto_orvalho)
FROM ({weather_sql()}) w JOIN ({_RAIN_5}) r ON d = dia_utc AND u = estacao_id"""
WEATHER_SQL = time_columns(_WEATHER, "dia_utc")


def _weather_shown(spark, path):
    return plain_times(read_table(spark, path)).drop("ano_mes").withColumn("ponto_orvalho", F.round("ponto_orvalho", 6))


@query("weather_warehouse_export", WEATHER_SQL)
def weather_warehouse_export(spark, sf):
    path = work_dir(spark, "weather")
    weather_plan.export_warehouse(*_weather_args(spark, sf), path, station_ids=None, sensor_map=a.SENSOR_MAP)
    return _weather_shown(spark, path)


@query("weather_warehouse_sync", WEATHER_SQL)
def weather_warehouse_sync(spark, sf):
    readings, *rest = _weather_args(spark, sf)
    path = work_dir(spark, "weather")
    early = _before(readings, a.networks(spark, sf), "2024-01-20 00:00:00")
    weather_plan.export_warehouse(early, *rest, path, station_ids=None, sensor_map=a.SENSOR_MAP)
    weather_plan.sync_warehouse(spark, readings, *rest, path, station_ids=None, sensor_map=a.SENSOR_MAP)
    return _weather_shown(spark, path)


@query(
    "combined_run",
    """WITH k AS (SELECT date_trunc('hour', ts) AS d, user_id AS u, event_id FROM events JOIN customer ON c_custkey = user_id)
SELECT 'pluviometricos' AS tabela, count(DISTINCT (d, u)) AS total_registros, min(d) AS data_minima, max(d) AS data_maxima,
  count(DISTINCT u) AS total_estacoes, NULL AS last_sync, NULL AS pending, NULL AS days_behind, NULL AS status
FROM k WHERE event_id IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'meteorologicos', count(DISTINCT (d, u)), min(d), max(d), count(DISTINCT u), any_value(last_sync),
  count(DISTINCT (d, u)) FILTER (d > last_sync AND d <= TIMESTAMP '2024-01-31'),
  CAST(floor(epoch(TIMESTAMP '2024-01-31' - any_value(last_sync)) / 86400) AS BIGINT), 'pending'
FROM k, (SELECT max(d) AS last_sync FROM k JOIN customer ON c_custkey = u WHERE c_mktsegment <> 'MACHINERY' AND d < TIMESTAMP '2024-01-20')""",
)
def combined_run(spark, sf):
    readings, values, sensors, rain, stations = _weather_args(spark, sf)
    rain_path, weather_path = work_dir(spark, "rain"), work_dir(spark, "weather")
    early = _before(readings, a.networks(spark, sf), "2024-01-20 00:00:00")
    rain_plan.export_warehouse(early, rain, stations, rain_path)
    weather_plan.export_warehouse(early, values, sensors, rain, stations, weather_path, None, a.SENSOR_MAP)
    """Status of both tables after the run, and how far weather was behind before its sync."""
    behind, status = combined.run(
        spark, readings, values, sensors, rain, stations, rain_path, weather_path, "2024-01-31 00:00:00", None, a.SENSOR_MAP
    )
    behind = behind.select(F.lit("meteorologicos").alias("tabela"), "last_sync", "pending", "days_behind", F.col("status"))
    return plain_times(status.join(behind, "tabela", "left"))


# --- delimited reports ---


@query(
    "report_delimited",
    """SELECT date_trunc('second', ts) AS ts_site, date_trunc('second', ts) + INTERVAL 3 HOUR AS ts_utc,
  CASE WHEN event_type <> 'error' THEN value END AS chuva, CAST(event_id AS DOUBLE) AS dirvento, value AS temperatura
FROM events""",
)
def report_delimited(spark, sf):
    """Events written as reports of two layouts with accented headers and read back together."""
    path = work_dir(spark, "delimited")
    number = F.col("value").cast("string")
    rain = F.when(F.col("event_type") == "error", "ND").otherwise(number).alias("Precipitação (mm)")
    wind, heat = F.col("event_id").cast("string").alias("Direção do Vento"), number.alias("Temperatura")
    day, hour = F.date_format("ts", "dd/MM/yyyy").alias("Data"), F.date_format("ts", "HH:mm:ss").alias("Hora")
    events = a.table(spark, sf, "events")
    even, odd = events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")
    even.select(day, hour, rain, wind, heat).write.option("header", "true").option("sep", ";").csv(f"{path}/a")
    odd.select(heat, hour, wind, day, rain).write.option("header", "true").option("sep", "\t").csv(f"{path}/b")
    return reports.read_delimited(spark, [f"{path}/a", f"{path}/b"]).select("ts_site", "ts_utc", "chuva", "dirvento", "temperatura")
