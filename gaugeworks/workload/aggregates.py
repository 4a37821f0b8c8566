"""Profiles, roll-ups, duplicates, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import dedupe, duplicates, ranking, rollup
from gaugeworks.plans import diagnosis
from gaugeworks.workload import adapters as a
from gaugeworks.workload.facts import HOURLY, RAIN_VERSIONS
from gaugeworks.workload.registry import query

FACT = """SELECT event_id AS id, ts AS dia, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) * 100 AS m05c,
  CAST(round(value * 100) AS BIGINT) AS h24c, user_id AS estacao_id, c_name AS estacao
FROM events JOIN customer ON c_custkey = user_id"""


def mean(cents: str) -> str:
    return f"(2 * sum({cents}) + count({cents})) // (2 * count({cents})) / 100.0"


def top(cents: str) -> str:
    return f"max({cents}) / 100.0"


@query("table_profile", "SELECT count(*) AS total, min(ts) AS data_minima, max(ts) AS data_maxima FROM events")
def table_profile(spark, sf):
    return rollup.profile(a.moments(spark, sf))


@query(
    "table_status",
    """SELECT count(*) AS total_registros, min(ts) AS data_minima, max(ts) AS data_maxima,
  count(DISTINCT user_id) AS total_estacoes FROM events""",
)
def table_status(spark, sf):
    return rollup.table_status(a.moments(spark, sf), "dia")


@query(
    "global_stats",
    f"""SELECT count(*) AS total_registros, min(dia) AS data_minima, max(dia) AS data_maxima,
  count(DISTINCT estacao_id) AS total_estacoes, {mean('h24c')} AS media_geral_h24, {top('h24c')} AS max_geral_h24
FROM ({FACT})""",
)
def global_stats(spark, sf):
    return rollup.global_stats(a.fact(spark, sf))


@query(
    "station_summary",
    f"""SELECT estacao_id, estacao, count(*) AS total_registros, min(dia) AS primeira_leitura, max(dia) AS ultima_leitura
FROM ({FACT}) GROUP BY estacao_id, estacao""",
)
def station_summary(spark, sf):
    return rollup.station_summary(a.fact(spark, sf))


@query(
    "station_detail",
    f"""SELECT estacao_id, estacao, count(*) AS total_registros, min(dia) AS primeira_leitura, max(dia) AS ultima_leitura,
  {mean('h24c')} AS media_h24, {top('h24c')} AS max_h24
FROM ({FACT}) GROUP BY estacao_id, estacao""",
)
def station_detail(spark, sf):
    return rollup.station_detail(a.fact(spark, sf))


def _rollup_sql(grain: str, rows: str = FACT, where: str = "TRUE", ts: str = "dia") -> str:
    return f"""SELECT date_trunc('{grain}', {ts}) AS periodo, estacao_id, estacao, {mean('m05c')} AS media_m05,
  {mean('h24c')} AS media_h24, {top('h24c')} AS max_h24, count(*) AS total_leituras
FROM ({rows}) WHERE {where} GROUP BY ALL"""


METRICS = ["m05", "h24"]


@query("period_rollup_day", _rollup_sql("day"))
def period_rollup_day(spark, sf):
    return rollup.period_rollup(a.fact(spark, sf), "dia", metrics=METRICS)


@query("period_rollup_week", _rollup_sql("week"))
def period_rollup_week(spark, sf):
    return rollup.period_rollup(a.fact(spark, sf), "semana", metrics=METRICS)


@query("period_rollup_month", _rollup_sql("month"))
def period_rollup_month(spark, sf):
    return rollup.period_rollup(a.fact(spark, sf), "mes", metrics=METRICS)


@query("period_rollup_range", _rollup_sql("day", where="dia >= TIMESTAMP '2024-01-10' AND dia <= TIMESTAMP '2024-01-20'"))
def period_rollup_range(spark, sf):
    return rollup.period_rollup(
        a.fact(spark, sf), "dia", metrics=METRICS, start="2024-01-10 00:00:00", end="2024-01-20 00:00:00"
    )


@query("period_rollup_local_day", _rollup_sql("day", ts="dia - INTERVAL 3 HOUR"))
def period_rollup_local_day(spark, sf):
    return rollup.period_rollup(a.fact(spark, sf), "dia", metrics=METRICS, zone="America/Sao_Paulo")


@query(
    "period_rollup_deduped_week",
    _rollup_sql("week", f"SELECT * FROM ({FACT}) QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', dia), estacao_id ORDER BY id DESC) = 1"),
)
def period_rollup_deduped_week(spark, sf):
    rows = a.fact(spark, sf).withColumn("hora", F.date_trunc("hour", "dia"))
    return rollup.period_rollup(dedupe.latest_by_id(rows, ["hora", "estacao_id"], "id"), "semana", metrics=METRICS)


_WINDOW = "(SELECT greatest(date_trunc('day', max(ts)) - INTERVAL 30 DAY, date_trunc('day', min(ts))) FROM events)"
_WINDOW7 = "(SELECT date_trunc('day', max(ts)) - INTERVAL 7 DAY FROM events)"
_END = "(SELECT date_trunc('day', max(ts)) FROM events)"


@query("period_default_window", f"SELECT CAST({_WINDOW} AS TIMESTAMP) AS start, CAST({_END} AS TIMESTAMP) AS \"end\"")
def period_default_window(spark, sf):
    return rollup.default_window(a.moments(spark, sf))


@query("period_rollup_default", _rollup_sql("day", where=f"dia >= {_WINDOW} AND dia <= {_END}"))
def period_rollup_default(spark, sf):
    return rollup.period_rollup_default(a.fact(spark, sf), "dia", metrics=METRICS)


@query("period_rollup_last_days", _rollup_sql("day", where=f"dia >= {_WINDOW7} AND dia <= {_END}"))
def period_rollup_last_days(spark, sf):
    return rollup.period_rollup_default(a.fact(spark, sf), "dia", days=7, metrics=METRICS)


@query("year_histogram", "SELECT CAST(year(o_orderdate) AS BIGINT) AS ano, count(*) AS total_registros FROM orders GROUP BY 1")
def year_histogram(spark, sf):
    return rollup.year_histogram(a.readings(spark, sf), "horaLeitura")


@query(
    "year_histogram_dates",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS ano, count(*) AS total_registros,
  CAST(min(o_orderdate) AS DATE) AS primeira_data, CAST(max(o_orderdate) AS DATE) AS ultima_data FROM orders GROUP BY 1""",
)
def year_histogram_dates(spark, sf):
    return rollup.year_histogram(a.readings(spark, sf), "horaLeitura", with_dates=True)


@query("month_presence", "SELECT count(*) AS total FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01'")
def month_presence(spark, sf):
    return rollup.month_presence(a.readings(spark, sf), "horaLeitura", "1997-01")


KEY = ["dia", "estacao_id"]
_DUPS = f"SELECT dia, estacao_id, count(*) AS total, max(id) AS winner FROM ({HOURLY}) GROUP BY ALL HAVING count(*) > 1"


@query("duplicates_report", f"SELECT dia, estacao_id, total FROM ({_DUPS}) ORDER BY total DESC, dia, estacao_id LIMIT 10")
def duplicates_report(spark, sf):
    return duplicates.top_duplicates(a.hourly(spark, sf), KEY)


@query("duplicated_keys", f"SELECT * FROM ({_DUPS})")
def duplicated_keys(spark, sf):
    return duplicates.duplicated_keys(a.hourly(spark, sf), KEY, "id")


@query("duplicates_count", f"SELECT count(*) AS total_duplicatas FROM ({_DUPS})")
def duplicates_count(spark, sf):
    return duplicates.duplicate_count(a.hourly(spark, sf), KEY)


@query("duplicate_versions", f"SELECT h.*, d.total, d.winner, h.id = d.winner AS is_winner FROM ({HOURLY}) h JOIN ({_DUPS}) d USING (dia, estacao_id)")
def duplicate_versions(spark, sf):
    return duplicates.versions(a.hourly(spark, sf), KEY, "id")


@query(
    "duplicates_evidence",
    f"""SELECT h.dia, h.estacao_id, d.total AS quantidade, d.winner AS id_vencedor, h.id, h.value, h.event_type
FROM ({HOURLY}) h JOIN ({_DUPS}) d USING (dia, estacao_id)""",
)
def duplicates_evidence(spark, sf):
    return duplicates.evidence(a.hourly(spark, sf), KEY, "id", ["value", "event_type"])


@query(
    "duplicates_winner",
    f"""SELECT dia, estacao_id, count(*) AS quantidade, max(id) AS id_vencedor, arg_max(value, id) AS value, arg_max(event_type, id) AS event_type
FROM ({HOURLY}) GROUP BY dia, estacao_id HAVING count(*) > 1""",
)
def duplicates_winner(spark, sf):
    return duplicates.winners(a.hourly(spark, sf), KEY, "id", ["value", "event_type"])


@query(
    "reading_versions",
    f"""SELECT h.* FROM ({HOURLY}) h JOIN (SELECT dia, estacao_id FROM ({_DUPS}) ORDER BY total DESC, dia, estacao_id LIMIT 1)
USING (dia, estacao_id)""",
)
def reading_versions(spark, sf):
    """All versions of one reading, here the most duplicated one."""
    rows = a.hourly(spark, sf)
    pick = duplicates.top_duplicates(rows, KEY, 1)
    return duplicates.reading_versions(
        rows, *KEY, "id", pick.select("dia").scalar(), pick.select("estacao_id").scalar()
    )


@query(
    "join_coverage",
    f"""SELECT (SELECT count(*) FROM orders) AS total_leitura, (SELECT min(o_orderdate) FROM orders) AS data_min_leitura,
  (SELECT max(o_orderdate) FROM orders) AS data_max_leitura, (SELECT count(*) FROM lineitem) AS total_chuva,
  count(*) AS total_com_join, min(dia) AS data_min, max(dia) AS data_max
FROM ({RAIN_VERSIONS}) JOIN customer ON c_custkey = estacao_id""",
)
def join_coverage(spark, sf):
    return diagnosis.join_coverage(a.readings(spark, sf), a.rain(spark, sf), a.stations(spark, sf))


@query(
    "last_n_per_station",
    """SELECT event_id AS id, ts AS dia, user_id AS estacao_id, value, event_type,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS position
FROM events QUALIFY position <= 10""",
)
def last_n_per_station(spark, sf):
    rows = ranking.last_per_station(a.moments(spark, sf), "dia", "estacao_id", ["id"])
    return rows.withColumn("position", F.col("position").cast("bigint"))


@query("latest_reading", "SELECT max(ts) AS latest FROM events")
def latest_reading(spark, sf):
    return ranking.latest_reading(a.moments(spark, sf), "dia")


@query("top_stations", f"SELECT estacao, count(*) AS total FROM ({FACT}) GROUP BY estacao ORDER BY total DESC, estacao LIMIT 5")
def top_stations(spark, sf):
    return ranking.top_stations(a.fact(spark, sf))


@query(
    "sample_keys",
    "SELECT event_id AS id, ts AS dia, user_id AS estacao_id, value, event_type FROM events ORDER BY md5(CAST(event_id AS VARCHAR)), event_id LIMIT 50",
)
def sample_keys(spark, sf):
    return ranking.sample(a.moments(spark, sf), ["id"])


@query(
    "first_rows",
    "SELECT event_id AS id, ts AS dia, user_id AS estacao_id, value, event_type FROM events ORDER BY ts, user_id, event_id LIMIT 100",
)
def first_rows(spark, sf):
    return ranking.first_rows(a.moments(spark, sf), ["dia", "estacao_id", "id"])
