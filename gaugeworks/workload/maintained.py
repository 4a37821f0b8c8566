"""Stored tables that are kept up to date: marks, digests, files, roll-ups, slices, schemas, buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gaugeworks.operators import compare, contracts, dedupe, digests, matching, rollup, watermarks
from gaugeworks.operators.filters import moment
from gaugeworks.plans import combined, rain as rain_plan, weather as weather_plan
from gaugeworks.schema import RAIN_METRICS, WAREHOUSE_RAIN
from gaugeworks.session import work_dir
from gaugeworks.sinks import buckets, files, marks, rollups, schemas, tables as sink
from gaugeworks.sources import reports
from gaugeworks.sources.facts import rain_versions
from gaugeworks.sources.tables import read_table
from gaugeworks.streaming.sync import dedupe_feed, read_feed
from gaugeworks.workload import adapters as a
from gaugeworks.workload.aggregates import FACT
from gaugeworks.workload.facts import HOURLY, HOURLY_LATEST, RAIN_VERSIONS, order_rows, weather_sql
from gaugeworks.workload.quality import FAULTY, KEY, PAYLOAD, RAIN, UNIQUE, faulty, unique_moments
from gaugeworks.workload.registry import query
from gaugeworks.workload.stored import _before, _weather_args, _weather_shown, plain_times, time_columns
from gaugeworks.workload.sync import AS_OF, NEW, OLD, REPLICA, _new, _old

HOUR_KEY = ["dia", "estacao_id"]


def _latest(spark, sf):
    return dedupe.latest_by_id(a.hourly(spark, sf), HOUR_KEY, "id")


def _kept_table(spark, sf) -> tuple[str, object]:
    """A marked table after a load, an append, an upsert and its replay."""
    path, rows = work_dir(spark, "kept"), _latest(spark, sf)
    day = lambda d: F.to_timestamp_ntz(F.lit(f"2024-01-{d:02d} 00:00:00"))
    sink.reload_table(rows.filter(F.col("dia") < day(10)), path, "dia", marked=True)
    sink.append_absent(spark, path, rows.filter((F.col("dia") < day(20)) & (F.col("estacao_id") % 3 != 0)), HOUR_KEY, "dia")
    for _ in range(2):
        sink.upsert_table(spark, path, rows.filter((F.col("dia") >= day(5)) & (F.col("estacao_id") % 5 != 1)), HOUR_KEY, "dia", version="id")
    return path, rows.schema


KEPT = f"""SELECT * FROM ({HOURLY_LATEST}) WHERE dia < TIMESTAMP '2024-01-10' OR (dia < TIMESTAMP '2024-01-20' AND estacao_id % 3 <> 0)
  OR estacao_id % 5 <> 1"""


@query("stored_watermarks", f"SELECT estacao_id, max(dia) AS watermark FROM ({KEPT}) WHERE dia <= TIMESTAMP '2024-01-15' + INTERVAL 3 DAY GROUP BY estacao_id")
def stored_watermarks(spark, sf):
    """By the marks beside the table; later rows count as future-dated."""
    path, schema = _kept_table(spark, sf)
    return sink.stored_watermarks(spark, path, schema, "2024-01-15 00:00:00", "dia")


@query(
    "stored_marks",
    f"""SELECT estacao_id, count(*) AS rows, min(dia) AS first, max(dia) AS last, strftime(dia, '%Y-%m') AS ano_mes
FROM ({KEPT}) GROUP BY estacao_id, strftime(dia, '%Y-%m')""",
)
def stored_marks(spark, sf):
    path, schema = _kept_table(spark, sf)
    return sink.stored_marks(spark, path, schema, "dia")[1]


@query(
    "stored_status",
    f"SELECT count(*) AS total_registros, min(dia) AS data_minima, max(dia) AS data_maxima, count(DISTINCT estacao_id) AS total_estacoes FROM ({KEPT})",
)
def stored_status(spark, sf):
    path, schema = _kept_table(spark, sf)
    return marks.status(sink.stored_marks(spark, path, schema, "dia")[1])


@query("stored_layout", "SELECT count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS partitions, 'month' AS granularity, TRUE AS accepted FROM orders")
def stored_layout(spark, sf):
    path = work_dir(spark, "layout")
    sink.reload_table(order_rows(spark, sf), path, "dia")
    return contracts.stored_layout(read_table(spark, path), sink.MONTH)


# --- pending rows and lag, as the source defines them ---

_AFTER, _UNTIL = "2024-01-20 00:00:00", "2024-01-25 00:00:00"
_IN_SPAN = f"d > TIMESTAMP '{_AFTER}' AND d <= TIMESTAMP '{_UNTIL}'"


@query(
    "pending_rain",
    f"SELECT count(*) AS pending FROM (SELECT date_trunc('hour', ts) AS d, event_id FROM events) JOIN lineitem ON l_orderkey = event_id WHERE {_IN_SPAN}",
)
def pending_rain(spark, sf):
    source = watermarks.rain_to_sync(a.event_readings(spark, sf), a.rain(spark, sf))
    return watermarks.pending_rows(source, "horaLeitura", _AFTER, _UNTIL)


# Sensors of the source without the first one, stations of one network.
_SOME_SENSORS = "SELECT r_regionkey FROM region WHERE r_regionkey > 0"
_SENSED = f"""SELECT date_trunc('hour', ts) AS d, user_id AS u FROM events
WHERE list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 IN ({_SOME_SENSORS})
  AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')"""


def _weather_to_sync(spark, sf):
    stations = a.stations(spark, sf).join(a.networks(spark, sf).filter("rede <> 'BUILDING'").select(F.col("estacao_id").alias("id")), "id", "left_semi")
    return watermarks.weather_to_sync(a.event_readings(spark, sf), a.sensor_values(spark, sf), a.sensors(spark, sf).filter("id > 0"), stations)


@query("pending_weather", f"SELECT count(*) AS pending FROM (SELECT DISTINCT d, u FROM ({_SENSED}) WHERE {_IN_SPAN})")
def pending_weather(spark, sf):
    return watermarks.pending_readings(_weather_to_sync(spark, sf), "horaLeitura", "estacao_id", _AFTER, _UNTIL)


def _lag_case(name: str, as_of: str, target: str) -> str:
    return f"""SELECT '{name}' AS caso, last_sync, pending, TIMESTAMP '{as_of}' AS as_of,
  CAST(floor(epoch(TIMESTAMP '{as_of}' - last_sync) / 86400) AS BIGINT) AS days_behind,
  coalesce(floor(epoch(TIMESTAMP '{as_of}' - last_sync) / 86400) > 1, FALSE) AS significant,
  CASE WHEN n = 0 THEN 'empty' WHEN last_sync IS NULL THEN 'future' WHEN pending > 0 THEN 'pending' ELSE 'current' END AS status
FROM (SELECT max(dia) FILTER (dia <= TIMESTAMP '{as_of}' + INTERVAL 3 DAY) AS last_sync, count(dia) AS n FROM ({target})),
  LATERAL (SELECT count(DISTINCT (d, u)) AS pending FROM ({_SENSED}) s WHERE d > last_sync AND d <= TIMESTAMP '{as_of}')"""


_LAGS = {
    "a": (AS_OF, "TRUE"), "b": ("2024-01-19 23:00:00", "TRUE"), "c": ("2023-12-01 00:00:00", "TRUE"), "d": (AS_OF, "FALSE"),
}


@query("lag_statuses", " UNION ALL ".join(_lag_case(n, t, f"SELECT * FROM ({REPLICA}) WHERE {w}") for n, (t, w) in _LAGS.items()))
def lag_statuses(spark, sf):
    """A copy that is behind, one that is not, one of future dates only, an empty one."""
    target, source, found = a.replica(spark, sf), _weather_to_sync(spark, sf), None
    for name, (as_of, where) in _LAGS.items():
        row = watermarks.lag_report(target.filter(where), source, "dia", as_of, "estacao_id", "horaLeitura").withColumn("caso", F.lit(name))
        found = row if found is None else found.unionByName(row)
    return found


@query(
    "stored_lag",
    _lag_case("x", AS_OF, "SELECT date_trunc('hour', ts) AS dia FROM events JOIN customer ON c_custkey = user_id WHERE c_mktsegment <> 'MACHINERY' "
              "AND ts < TIMESTAMP '2024-01-20' AND event_id IN (SELECT l_orderkey FROM lineitem)"),
)
def stored_lag(spark, sf):
    """The lag of a stored table by its marks."""
    readings, _, _, rain, stations = _weather_args(spark, sf)
    path = work_dir(spark, "rain")
    rain_plan.export_warehouse(_before(readings, a.networks(spark, sf), "2024-01-20 00:00:00"), rain, stations, path)
    return combined.lag(spark, path, _weather_to_sync(spark, sf), AS_OF, WAREHOUSE_RAIN).withColumn("caso", F.lit("x"))


# --- reconciliation by digests ---

# The copy is at fault in one year only, so most months are equal.
FAULTY_YEAR = f"SELECT * FROM ({FAULTY}) WHERE year(dia) = 1997 UNION ALL SELECT * FROM ({RAIN}) WHERE year(dia) <> 1997"
_EXACT = " OR ".join(f"s.{m} IS DISTINCT FROM d.{m}" for m in RAIN_METRICS)


def _faulty_year(rows):
    year = F.year("dia")
    return faulty(rows).filter(year == 1997).unionByName(rows.filter(year != 1997))


@query(
    "reconcile_digests",
    f"""SELECT coalesce(s.dia, d.dia) AS dia, coalesce(s.estacao_id, d.estacao_id) AS estacao_id,
  CASE WHEN d.dia IS NULL THEN 'missing' WHEN s.dia IS NULL THEN 'extra' WHEN {_EXACT} THEN 'different' ELSE 'ok' END AS status
FROM ({RAIN}) s FULL JOIN ({FAULTY_YEAR}) d ON s.dia = d.dia AND s.estacao_id = d.estacao_id""",
)
def reconcile_digests(spark, sf):
    rows = a.rain_rows(spark, sf)
    return digests.reconcile_by_digests(rows, _faulty_year(rows), KEY, RAIN_METRICS, "dia", "estacao_id").select(*KEY, "status")


@query(
    "digest_groups",
    f"""SELECT coalesce(s.m, d.m) AS mes FROM
  (SELECT strftime(dia, '%Y-%m') AS m, list(({', '.join(['dia', 'estacao_id', *RAIN_METRICS])}) ORDER BY dia, estacao_id) AS l FROM ({RAIN}) GROUP BY 1) s
  FULL JOIN (SELECT strftime(dia, '%Y-%m') AS m, list(({', '.join(['dia', 'estacao_id', *RAIN_METRICS])}) ORDER BY dia, estacao_id) AS l FROM ({FAULTY_YEAR}) GROUP BY 1) d
  ON s.m = d.m WHERE s.l IS DISTINCT FROM d.l""",
)
def digest_groups(spark, sf):
    """The months in which two copies differ."""
    rows = a.rain_rows(spark, sf)
    first = digests.levels("dia", "estacao_id")[:1]
    return digests.unequal_groups(rows, _faulty_year(rows), KEY, RAIN_METRICS, first)[2].select(F.col("_month").alias("mes"))


# --- files, roll-ups, slices ---


@query("upsert_files", HOURLY_LATEST)
def upsert_files(spark, sf):
    """Late and changed rows of some stations; files without them stay."""
    path, rows = work_dir(spark, "files"), _latest(spark, sf)
    stale = rows.filter("id % 7 <> 0").withColumn("value", F.when(F.col("estacao_id") < 20, -1.0).otherwise(F.col("value")))
    sink.reload_table(stale, path, "dia")
    sink.upsert_files(spark, path, rows.filter("id % 7 = 0 OR estacao_id < 20"), HOUR_KEY, "dia")
    return read_table(spark, path).drop(sink.MONTH)


def _week(rows: str) -> str:
    cents = "CAST(round(value * 100) AS BIGINT)"
    return f"""SELECT date_trunc('week', dia) AS periodo, estacao_id, c_name AS estacao, (2 * sum({cents}) + count(*)) // (2 * count(*)) / 100.0 AS media_value,
  max({cents}) / 100.0 AS max_value, count(*) AS total_leituras FROM ({rows}) JOIN customer ON c_custkey = estacao_id GROUP BY ALL"""


@query("rollup_maintained", _week(HOURLY_LATEST))
def rollup_maintained(spark, sf):
    """Three batches, the last with late rows of all weeks, after a load."""
    table, path = work_dir(spark, "readings"), work_dir(spark, "weeks")
    names = a.stations(spark, sf).select(F.col("id").alias("estacao_id"), F.col("nome").alias("estacao"))
    rows = _latest(spark, sf).join(names, "estacao_id").withColumn("value", F.col("value").cast("decimal(10,2)"))
    part = F.when(F.col("id") % 11 == 0, 3).when(F.col("dia") >= moment("2024-01-20 00:00:00"), 2).when(F.col("dia") >= moment("2024-01-12 00:00:00"), 1).otherwise(0)
    options = {"metrics": ["value"], "max_metric": "value"}
    sink.reload_table(rows.filter(part == 0), table, "dia")
    rollups.start(rows.filter(part == 0), path, "semana", **options)
    for n in (1, 2, 3):
        rollups.maintain(spark, table, path, rows.filter(part == n), HOUR_KEY, "semana", version="id", **options)
    return read_table(spark, path).drop(sink.MONTH)


# Hours of January, dealt over four years.
_YEARLY = "date_trunc('hour', ts) - to_years(CAST(event_id % 4 AS INTEGER))"
_RAIN_YEARLY = f"""SELECT {_YEARLY} AS d, user_id AS u, max(l_quantity) AS chuva FROM events LEFT JOIN lineitem ON l_orderkey = event_id GROUP BY ALL"""


@query(
    "weather_year_slices",
    time_columns(
        f"""SELECT w.* REPLACE (r.chuva AS chuva, round(ponto_orvalho, 6) AS ponto_orvalho)
FROM ({weather_sql(time=_YEARLY)}) w JOIN ({_RAIN_YEARLY}) r ON d = dia_utc AND u = estacao_id""", "dia_utc"),
)
def weather_year_slices(spark, sf):
    readings, *rest = _weather_args(spark, sf)
    back = F.make_ym_interval(-(F.col("id") % 4).cast("int"), F.lit(0))
    readings = readings.withColumn("horaLeitura", F.col("horaLeitura") + back)
    path = work_dir(spark, "weather")
    weather_plan.export_years(spark, readings, *rest, path, 2020, 2024, station_ids=None, sensor_map=a.SENSOR_MAP)
    return _weather_shown(spark, path)


@query(
    "rain_load_checks",
    f"""SELECT 'total' AS item, count(*) AS total, min(dia) AS data_minima, max(dia) AS data_maxima FROM ({RAIN})
UNION ALL SELECT CASE WHEN year(dia) < 1997 THEN 'outros' ELSE CAST(year(dia) AS VARCHAR) END, count(*), NULL, NULL FROM ({RAIN}) GROUP BY 1""",
)
def rain_load_checks(spark, sf):
    """What the load counted while it wrote."""
    checks = rain_plan.load_replica(a.readings(spark, sf), a.rain(spark, sf), a.stations(spark, sf), work_dir(spark, "replica"))
    checks = plain_times(checks)
    whole = checks.select(F.lit("total").alias("item"), "total", "data_minima", "data_maxima")
    years = checks.select(F.inline("anos")).select(F.col("ano").cast("string").alias("item"), "total")
    other = checks.select(F.lit("outros").alias("item"), F.col("outros_anos").alias("total"))
    return whole.unionByName(years.unionByName(other), allowMissingColumns=True)


@query("rain_load_sample", f"SELECT 'ok' AS status, least(50, count(*)) AS total FROM ({RAIN})")
def rain_load_sample(spark, sf):
    """Rows of the loaded copy looked up in its source."""
    net = (a.readings(spark, sf), a.rain(spark, sf), a.stations(spark, sf))
    path = work_dir(spark, "replica")
    rain_plan.load_replica(*net, path)
    return compare.status_totals(rain_plan.sample_of_load(spark, *net, path))


# --- columns ---


@query(
    "append_evolved_stored",
    f"""SELECT dia, estacao_id, value, NULL AS event_type FROM ({OLD}) UNION ALL
SELECT dia, estacao_id, value, event_type FROM ({NEW}) n WHERE NOT EXISTS (SELECT 1 FROM ({OLD}) o WHERE n.dia = o.dia AND n.estacao_id = o.estacao_id)""",
)
def append_evolved_stored(spark, sf):
    """Older files lack a column that a later append brought."""
    path = work_dir(spark, "evolved")
    schemas.reload_recorded(_old(spark, sf).select("dia", "estacao_id", "value"), path, "dia")
    schemas.append_recorded(spark, path, _new(spark, sf).select("dia", "estacao_id", "value", "event_type"), HOUR_KEY, "dia")
    return schemas.read_recorded(spark, path).drop(sink.MONTH)


@query(
    "schema_history",
    """SELECT CASE WHEN column_name IN ('o_orderkey', 'o_orderdate', 'o_custkey') THEN 1 ELSE 2 END AS versao, column_name AS coluna,
  replace(replace(lower(column_type), 'timestamp', 'timestamp_ntz'), 'varchar', 'string') AS tipo
FROM (DESCRIBE orders) WHERE column_name IN ('o_orderkey', 'o_orderdate', 'o_custkey', 'o_totalprice', 'o_orderpriority')""",
)
def schema_history(spark, sf):
    path, rows = work_dir(spark, "columns"), a.table(spark, sf, "orders")
    old = rows.select("o_orderkey", "o_orderdate", "o_custkey")
    schemas.reload_recorded(old.filter("o_orderkey % 2 = 0"), path, "o_orderdate", "o_custkey")
    more = rows.filter("o_orderkey % 2 = 1").select(*old.columns, "o_totalprice", "o_orderpriority")
    schemas.append_recorded(spark, path, more, ["o_orderkey", "o_orderdate"], "o_orderdate", "o_custkey")
    return schemas.history(spark, path)


@query(
    "schema_diff",
    """SELECT column_name AS coluna, replace(lower(column_type), 'integer', 'int') AS tipo_atual, 'double' AS tipo_esperado
FROM (DESCRIBE lineitem) WHERE column_type IN ('BIGINT', 'INTEGER')""",
)
def schema_diff(spark, sf):
    """Detail columns against a contract of numbers as doubles."""
    actual = a.table(spark, sf, "lineitem")
    wanted = actual.select(*[F.col(c).cast("double").alias(c.upper()) if t in ("bigint", "int") else F.col(c) for c, t in actual.dtypes])
    return contracts.schema_diff(spark, actual.schema, wanted.schema)


# --- feeds, buckets, matches, roll-ups, reports ---


@query("stream_dedupe_delay", f"SELECT DISTINCT dia, estacao_id FROM ({HOURLY})")
def stream_dedupe_delay(spark, sf):
    """Feed files in order of time; a state store remembers keys for a day."""
    feed_path, path = work_dir(spark, "feed"), work_dir(spark, "deduped")
    events = a.table(spark, sf, "events")
    for n, (start, end) in enumerate([(1, 8), (8, 15), (15, 22), (22, 32)]):
        days = F.dayofmonth("ts")
        events.filter((days >= start) & (days < end)).repartition(1).write.mode("append").parquet(feed_path)
    feed = read_feed(spark, feed_path, events.schema, files_per_batch=1)
    hourly = feed.select(F.date_trunc("hour", "ts").alias("dia"), F.col("user_id").alias("estacao_id"))
    out = dedupe_feed(hourly, HOUR_KEY, "dia", "1 day")
    out.writeStream.format("parquet").option("checkpointLocation", work_dir(spark, "progress")).trigger(availableNow=True).start(path).awaitTermination()
    return plain_times(read_table(spark, path, schema=out.schema))


@query("rain_fact_bucketed", f"SELECT leitura_id, dia, estacao_id, {', '.join(RAIN_METRICS)} FROM ({RAIN_VERSIONS})")
def rain_fact_bucketed(spark, sf):
    """Readings and rain in buckets of the reading's id are joined without a shuffle."""
    tag = uuid.uuid4().hex
    n = buckets.bucket_count(a.readings(spark, sf), a.rain(spark, sf))
    readings = buckets.write_bucketed(a.readings(spark, sf), f"leitura_{tag}", "id", n, work_dir(spark, "readings"))
    rain = buckets.write_bucketed(a.rain(spark, sf), f"chuva_{tag}", "leitura_id", n, work_dir(spark, "rain"))
    return rain_versions(readings, rain)


@query(
    "first_in_hour_newest",
    f"""SELECT s.id, s.dia, s.estacao_id, s.value, s.event_type, d.dia AS match_ts, d.id AS id_dst, d.value AS value_dst
FROM ({UNIQUE}) s LEFT JOIN ({HOURLY}) d ON d.estacao_id = s.estacao_id AND d.dia BETWEEN s.dia - INTERVAL 1 HOUR AND s.dia + INTERVAL 1 HOUR
QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY d.dia, d.id DESC) = 1""",
)
def first_in_hour_newest(spark, sf):
    """Several readings of one hour: of the first instant the newest id."""
    target = a.hourly(spark, sf).select(F.col("id").alias("id_dst"), F.col("dia").alias("dia_dst"), "estacao_id", F.col("value").alias("value_dst"))
    return matching.first_in_window(unique_moments(spark, sf), target, "estacao_id", "dia", "dia_dst", PAYLOAD, newest=["id_dst"])


_SIX = {"m05": "m05c", "m15": "h24c", "h01": "m05c", "h04": "h24c", "h24": "h24c", "h96": "m05c"}


def _plain_cents(cents: str) -> str:
    return f"CASE WHEN {cents} % 7 = 0 THEN NULL ELSE {cents} END"


@query(
    "period_rollup_metrics",
    f"""SELECT date_trunc('month', dia) AS periodo, estacao_id, estacao,
  {', '.join(f"coalesce((2 * sum({_plain_cents(c)}) + count({_plain_cents(c)})) // (2 * nullif(count({_plain_cents(c)}), 0)) / 100.0, 0.0) AS media_{m}" for m, c in _SIX.items())},
  coalesce(max({_plain_cents('h24c')}) / 100.0, 0.0) AS max_h24, count(*) AS total_leituras
FROM ({FACT}) WHERE dia >= TIMESTAMP '2024-01-03' AND dia < TIMESTAMP '2024-01-21' GROUP BY ALL""",
)
def period_rollup_metrics(spark, sf):
    """The six default means over whole days; the value that stands for no reading is left out."""
    rows = a.fact(spark, sf)
    for m in ("m05", "h24"):
        rows = rows.withColumn(m, F.when((F.col(m) * 100).cast("long") % 7 == 0, F.lit(-99.99)).otherwise(F.col(m)).cast("decimal(10,2)"))
    rows = rows.select("*", F.col("h24").alias("m15"), F.col("m05").alias("h01"), F.col("h24").alias("h04"), F.col("m05").alias("h96"))
    return rollup.period_rollup(rows, "mes", start="2024-01-03 00:00:00", end="2024-01-20 07:00:00", sentinel=-99.99, end_inclusive_day=True)


def _as_one_file(spark, df, path: str, encoding: str = "UTF-8", separator: str = ";") -> None:
    """``df`` as one report file at ``path``."""
    folder = work_dir(spark, "report")
    df.coalesce(1).write.option("header", "true").option("sep", separator).option("encoding", encoding).option("quote", "").csv(folder)
    (part,) = spark.read.text(folder).inputFiles()
    files.move(spark, part, path)


def _report_columns():
    number = F.col("value").cast("string")
    return {
        "day": F.date_format("ts", "dd/MM/yyyy").alias("Data"), "hour": F.date_format("ts", "HH:mm:ss").alias("Hora"),
        "rain": F.when(F.col("event_type") == "error", "ND").otherwise(number).alias("Precipitação (mm)"),
        "wind": F.col("event_id").cast("string").alias("Direção do Vento"), "heat": number.alias("Temperatura"),
    }


_REPORTED = """SELECT date_trunc('second', ts) AS ts_site, date_trunc('second', ts) + INTERVAL 3 HOUR AS ts_utc,
  CASE WHEN event_type <> 'error' THEN value END AS chuva, CAST(event_id AS DOUBLE) AS dirvento, value AS temperatura"""


@query("report_folders", f"{_REPORTED}, 'est_Met.txt' AS arquivo FROM events")
def report_folders(spark, sf):
    """One station's files have the same name in every folder, and here different columns."""
    path, c, events = work_dir(spark, "folders"), _report_columns(), a.table(spark, sf, "events")
    layouts = [["day", "hour", "rain", "heat", "wind"], ["heat", "wind", "rain", "day", "hour"], ["wind", "day", "heat", "hour", "rain"]]
    for n, order in enumerate(layouts):
        _as_one_file(spark, events.filter(F.col("event_id") % 3 == n).select(*[c[k] for k in order]), f"{path}/{2022 + n}/est_Met.txt", separator=";\t,"[n])
    found = reports.read_delimited(spark, [f"{path}/{2022 + n}" for n in range(3)])
    return found.select("ts_site", "ts_utc", "chuva", "dirvento", "temperatura", "arquivo")


@query("report_files", f"{_REPORTED} FROM events")
def report_files(spark, sf):
    """Files in three encodings."""
    path, c, events = work_dir(spark, "encodings"), _report_columns(), a.table(spark, sf, "events")
    marked = F.col("Data").alias("\ufeffData")
    for n, encoding in enumerate(["UTF-8", "ISO-8859-1", "UTF-8"]):
        rows = events.filter(F.col("event_id") % 3 == n).select(c["day"], c["hour"], c["rain"], c["wind"], c["heat"])
        _as_one_file(spark, rows.select(marked, *rows.columns[1:]) if n == 2 else rows, f"{path}/est_{n}.txt", encoding)
    return reports.read_delimited(spark, path).select("ts_site", "ts_utc", "chuva", "dirvento", "temperatura")
