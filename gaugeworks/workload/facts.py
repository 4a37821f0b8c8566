"""Dedupe, fact scans, filters and canonical columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions import timecols
from gaugeworks.operators import columns, dedupe, filters, ranking, rollup
from gaugeworks.schema import RAIN_METRICS, RAIN_METRICS_FULL, WEATHER_STATIONS
from gaugeworks.sources import facts
from gaugeworks.sources.jdbc import year_slices
from gaugeworks.workload import adapters as a
from gaugeworks.workload.registry import query

HOURLY = """SELECT event_id AS id, date_trunc('hour', ts) AS dia, user_id AS estacao_id, value, event_type
FROM events"""
HOURLY_LATEST = f"""SELECT * FROM ({HOURLY})
QUALIFY row_number() OVER (PARTITION BY dia, estacao_id ORDER BY id DESC) = 1"""

_RAIN_COLS = ", ".join(f"CAST({c} AS DOUBLE) AS {m}" for m, c in a.RAIN_COLUMNS.items())
RAIN_VERSIONS = f"""SELECT o_orderkey AS leitura_id, o_orderdate AS dia, o_custkey AS estacao_id, {_RAIN_COLS}
FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""


def rain_sql(metrics: list[str]) -> str:
    ties = ", ".join(f"{m} DESC" for m in metrics)
    return f"""SELECT dia, {', '.join(metrics)}, c_name AS estacao, estacao_id FROM (
  SELECT * FROM ({RAIN_VERSIONS})
  QUALIFY row_number() OVER (PARTITION BY dia, estacao_id ORDER BY leitura_id DESC, {ties}) = 1
) JOIN customer ON c_custkey = estacao_id"""


@query("dedupe_latest", HOURLY_LATEST)
def dedupe_latest(spark, sf):
    return dedupe.latest_by_id(a.hourly(spark, sf), ["dia", "estacao_id"], "id")


@query(
    "dedupe_keep_last",
    """SELECT o_orderdate AS dia, o_custkey AS estacao_id, o_orderkey AS id, o_totalprice AS h24, o_orderpriority AS tipo
FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderdate, o_custkey ORDER BY o_orderkey DESC) = 1""",
)
def dedupe_keep_last(spark, sf):
    rows = a.table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("dia"), F.col("o_custkey").alias("estacao_id"), F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("h24"), F.col("o_orderpriority").alias("tipo"),
    )
    return dedupe.keep_last(rows, ["dia", "estacao_id"], ["id"])


@query("rain_fact_join", rain_sql(RAIN_METRICS))
def rain_fact_join(spark, sf):
    return a.rain_rows(spark, sf)


@query("rain_fact_full_metrics", rain_sql(RAIN_METRICS_FULL))
def rain_fact_full_metrics(spark, sf):
    return facts.rain_source(a.readings(spark, sf), a.rain(spark, sf), a.stations(spark, sf), RAIN_METRICS_FULL)


@query(
    "rain_fact_raw",
    f"""SELECT dia, {', '.join(RAIN_METRICS)}, c_name AS estacao, estacao_id
FROM ({RAIN_VERSIONS}) JOIN customer ON c_custkey = estacao_id""",
)
def rain_fact_raw(spark, sf):
    return facts.rain_source_raw(a.readings(spark, sf), a.rain(spark, sf), a.stations(spark, sf))


def weather_sql(where: str = "TRUE", time: str = "date_trunc('hour', ts)") -> str:
    picks = ", ".join(f"max(CASE WHEN r_name = '{name}' THEN value END) AS {c}" for c, name in a.SENSOR_MAP.items())
    cut = a.EVENT_CUTOVER
    return f"""SELECT *, CASE WHEN temperatura IS NULL OR umidade IS NULL OR umidade <= 0 THEN NULL ELSE
  243.04 * (ln(umidade / 100.0) + 17.625 * temperatura / (243.04 + temperatura))
  / (17.625 - (ln(umidade / 100.0) + 17.625 * temperatura / (243.04 + temperatura))) END AS ponto_orvalho
FROM (
  SELECT dia_utc, estacao_id, estacao,
    max(CASE WHEN dia_utc < TIMESTAMP '{cut.start}' THEN l_tax
             WHEN estacao ILIKE '{cut.late_names[0]}%' AND dia_utc < TIMESTAMP '{cut.late_start}' THEN l_tax
             ELSE l_quantity END) AS chuva,
    {picks}
  FROM (SELECT event_id, {time} AS dia_utc, user_id AS estacao_id, c_name AS estacao, value,
               list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 AS sensor
        FROM events JOIN customer ON c_custkey = user_id)
  JOIN region ON r_regionkey = sensor
  LEFT JOIN lineitem ON l_orderkey = event_id
  WHERE {where}
  GROUP BY dia_utc, estacao_id, estacao
)"""


def _weather(spark, sf, **kw):
    # The 15-minute column of this adapter is the tax rate.
    rain = a.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("leitura_id"), F.col("l_quantity").alias("m05"), F.col("l_tax").alias("m15")
    )
    return facts.weather_source(
        a.event_readings(spark, sf), a.sensor_values(spark, sf), a.sensors(spark, sf), rain, a.stations(spark, sf),
        **{"station_ids": None, "sensor_map": a.SENSOR_MAP, "cutover": a.EVENT_CUTOVER, **kw},
    )


def rounded(df, name: str, places: int = 6):
    """Logarithms differ in the last bit between engines."""
    return df.withColumn(name, F.round(name, places))


@query("weather_fact", f"SELECT * REPLACE (round(ponto_orvalho, 6) AS ponto_orvalho) FROM ({weather_sql()})")
def weather_fact(spark, sf):
    return rounded(_weather(spark, sf), "ponto_orvalho")


@query(
    "weather_fact_range",
    "SELECT * REPLACE (round(ponto_orvalho, 6) AS ponto_orvalho) FROM ("
    + weather_sql("dia_utc >= TIMESTAMP '2024-01-05' AND dia_utc < TIMESTAMP '2024-01-25'") + ")",
)
def weather_fact_range(spark, sf):
    return rounded(_weather(spark, sf, start="2024-01-05 00:00:00", end="2024-01-25 00:00:00"), "ponto_orvalho")


@query(
    "weather_allow_list",
    "SELECT * REPLACE (round(ponto_orvalho, 6) AS ponto_orvalho) FROM ("
    + weather_sql(f"estacao_id IN ({', '.join(map(str, WEATHER_STATIONS))})") + ")",
)
def weather_allow_list(spark, sf):
    """The stations read by default."""
    return rounded(_weather(spark, sf, station_ids=WEATHER_STATIONS), "ponto_orvalho")


@query(
    "weather_single_station",
    "SELECT * REPLACE (round(ponto_orvalho, 6) AS ponto_orvalho) FROM ("
    + weather_sql("estacao_id = 11 AND dia_utc >= TIMESTAMP '2024-01-05' AND dia_utc < TIMESTAMP '2024-01-25'") + ")",
)
def weather_single_station(spark, sf):
    kw = {"start": "2024-01-05 00:00:00", "end": "2024-01-25 00:00:00", "station_ids": [11]}
    return rounded(_weather(spark, sf, **kw), "ponto_orvalho")


@query(
    "yearly_slices",
    """SELECT s.ano, s.inicio, s.fim, count(o_orderkey) AS total
FROM (SELECT range AS ano, CAST(range || '-01-01' AS TIMESTAMP) AS inicio, CAST((range + 1) || '-01-01' AS TIMESTAMP) AS fim
      FROM range(1995, 2002)) s
LEFT JOIN orders ON o_orderdate >= s.inicio AND o_orderdate < s.fim
GROUP BY ALL""",
)
def yearly_slices(spark, sf):
    """Rows of each year slice; the slices are a handful of literals evaluated per row."""
    slices = year_slices(1995, 2001)
    ts = F.col("o_orderdate")
    of_slice = F.array(*[
        F.when((ts >= filters.moment(lo)) & (ts < filters.moment(hi)), F.lit(1)).otherwise(F.lit(0)) for _, lo, hi in slices
    ])
    wide = a.table(spark, sf, "orders").select(of_slice.alias("s")).agg(
        *[F.sum(F.col("s")[i]).alias(f"n{i}") for i in range(len(slices))]
    )
    return wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(y).cast("bigint").alias("ano"), filters.moment(lo).alias("inicio"), filters.moment(hi).alias("fim"),
            F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("bigint").alias("total"),
        ) for i, (y, lo, hi) in enumerate(slices)
    ])))


@query("distinct_years", "SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS ano FROM orders")
def distinct_years(spark, sf):
    return rollup.distinct_years(a.table(spark, sf, "orders"), "o_orderdate")


_MOMENTS = "SELECT event_id AS id, ts AS dia, user_id AS estacao_id, value, event_type FROM events"


@query("range_half_open", f"SELECT * FROM ({_MOMENTS}) WHERE dia >= TIMESTAMP '2024-01-10' AND dia < TIMESTAMP '2024-01-20'")
def range_half_open(spark, sf):
    return filters.half_open(a.moments(spark, sf), "dia", "2024-01-10 00:00:00", "2024-01-20 00:00:00")


@query(
    "range_closed",
    """SELECT o_orderkey AS id, o_orderdate AS dia, o_custkey AS estacao_id FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'""",
)
def range_closed(spark, sf):
    rows = a.readings(spark, sf).withColumnRenamed("horaLeitura", "dia")
    return filters.closed(rows, "dia", "1996-01-01 00:00:00", "1998-12-31 00:00:00")


@query(
    "range_years",
    "SELECT o_orderkey AS id, o_orderdate AS dia, o_custkey AS estacao_id FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1999",
)
def range_years(spark, sf):
    rows = a.readings(spark, sf).withColumnRenamed("horaLeitura", "dia")
    return filters.years(rows, "dia", 1997, 1999)


@query(
    "canonical_columns",
    r"""SELECT CAST(user_id AS BIGINT) AS estacao_id, c_name AS estacao, ts_ms AS dia_utc,
  ts_ms - INTERVAL 3 HOUR AS dia,
  strftime(ts_ms - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S.%g') || ' -0300' AS dia_original, '-0300' AS utc_offset,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS m05,
  TRY_CAST(props AS DOUBLE) AS h24
FROM (SELECT *, date_trunc('millisecond', ts) AS ts_ms FROM events) JOIN customer ON c_custkey = user_id
WHERE event_type <> 'signup'""",
)
def canonical_columns(spark, sf):
    """Dirty text columns under source names to typed canonical columns."""
    ts = timecols.shift(F.col("ts"), hours=-3)
    dirty = a.table(spark, sf, "events").select(
        F.when(F.col("event_type") != "signup", F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" -0300"))).alias("Dia"),
        F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")).alias("id_estacao"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("M05"),
        F.col("props").alias("h24"),
        F.lit("x").alias("TimezoneOffset"),
    )
    rows = columns.coerce_numbers(columns.drop_auxiliary(columns.canonical_names(dirty)), ["m05", "h24"])
    rows = columns.require_time(columns.add_time_columns(rows))
    return facts.with_station_names(rows, a.stations(spark, sf))


@query(
    "null_time_report",
    """SELECT count(*) FILTER (WHERE event_type <> 'signup') AS kept, count(*) FILTER (WHERE event_type = 'signup') AS removed FROM events""",
)
def null_time_report(spark, sf):
    rows = a.moments(spark, sf).withColumn("dia_utc", F.when(F.col("event_type") != "signup", F.col("dia")))
    return columns.null_time_report(rows)


_ORDER_ROWS = """SELECT o_orderkey AS id, o_orderdate AS dia, o_custkey AS estacao_id, c_name AS estacao, o_totalprice AS h24
FROM orders JOIN customer ON c_custkey = o_custkey"""


def order_rows(spark, sf):
    rows = a.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("dia"), F.col("o_custkey").alias("estacao_id"),
        F.col("o_totalprice").alias("h24"),
    )
    return facts.with_station_names(rows, a.stations(spark, sf))


@query(
    "optional_filters",
    f"SELECT * FROM ({_ORDER_ROWS}) WHERE dia >= TIMESTAMP '1996-06-01' AND dia <= TIMESTAMP '1999-06-30' AND estacao ILIKE '%MER#0000001%'",
)
def optional_filters(spark, sf):
    return filters.optional(
        order_rows(spark, sf), start="1996-06-01 00:00:00", end="1999-06-30 00:00:00", name_contains="MER#0000001"
    )


@query("start_filter", f"SELECT * FROM ({_ORDER_ROWS}) WHERE dia >= TIMESTAMP '1998-01-01'")
def start_filter(spark, sf):
    return filters.since(order_rows(spark, sf), "dia", "1998-01-01 00:00:00")


@query(
    "filter_page",
    f"SELECT * FROM ({_ORDER_ROWS}) WHERE dia >= TIMESTAMP '1996-01-01' ORDER BY dia DESC, estacao_id, id LIMIT 1000 OFFSET 200",
)
def filter_page(spark, sf):
    rows = filters.optional(order_rows(spark, sf), start="1996-01-01 00:00:00")
    return ranking.page(rows, "dia", ["estacao_id", "id"], offset=200)


@query(
    "filter_page_deep",
    f"SELECT * FROM ({_ORDER_ROWS}) WHERE dia >= TIMESTAMP '1996-01-01' ORDER BY dia DESC, estacao_id, id LIMIT 12000 OFFSET 300",
)
def filter_page_deep(spark, sf):
    """The page after the 300 newest rows, found by the last of them."""
    rows = filters.optional(order_rows(spark, sf), start="1996-01-01 00:00:00")
    last = ranking.page(rows, "dia", ["estacao_id", "id"], limit=1, offset=299).first()
    return ranking.page(rows, "dia", ["estacao_id", "id"], limit=12_000, after=(str(last["dia"]), last["estacao_id"], last["id"]))


@query("filter_page_total", f"SELECT count(*) AS total FROM ({_ORDER_ROWS}) WHERE dia >= TIMESTAMP '1996-01-01'")
def filter_page_total(spark, sf):
    return ranking.total_rows(filters.optional(order_rows(spark, sf), start="1996-01-01 00:00:00"))


@query("last_hours", f"SELECT * FROM ({_MOMENTS}) WHERE dia >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 72 HOUR")
def last_hours(spark, sf):
    return filters.last_hours(a.moments(spark, sf), "dia", 72, "2024-01-30 00:00:00")


@query("plausible_only", f"SELECT * FROM ({_MOMENTS}) WHERE dia <= TIMESTAMP '2024-01-20 00:00:00' + INTERVAL 3 DAY")
def plausible_only(spark, sf):
    return filters.plausible(a.moments(spark, sf), "dia", "2024-01-20 00:00:00")
