"""Wide rain and weather rows from the normalized source tables.

Default column names are those of the source: readings (``id``, ``horaLeitura``,
``estacao_id``), rain (``leitura_id``, metrics), sensor values (``leitura_id``,
``sensor_id``, ``valor``), sensors and stations (``id``, ``nome``).

Sensor and station tables are joined without a hint: as plain file scans their
size is known, so the planner broadcasts them only under its threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.values import dew_point, rain_by_cutover
from gaugeworks.operators.dedupe import latest_by_id
from gaugeworks.operators.filters import half_open, since
from gaugeworks.schema import CUTOVER, RAIN_METRICS, SENSORS, WEATHER_STATIONS, Cutover


def with_station_names(rows: DataFrame, stations: DataFrame) -> DataFrame:
    """Rows of known stations with the name as ``estacao``."""
    names = stations.select(F.col("id").alias("_sid"), F.col("nome").alias("estacao"))
    return rows.join(names, F.col("estacao_id") == F.col("_sid"), "inner").drop("_sid")


def rain_versions(
    readings: DataFrame, rain: DataFrame, metrics: list[str] | None = None, start=None
) -> DataFrame:
    """Every reading that has rain values: ``leitura_id, dia, estacao_id`` and the metrics."""
    metrics = RAIN_METRICS if metrics is None else metrics
    r = readings if start is None else since(readings, "horaLeitura", start)
    r = r.select(F.col("id").alias("leitura_id"), F.col("horaLeitura").alias("dia"), "estacao_id")
    return r.join(rain.select("leitura_id", *metrics), "leitura_id", "inner")


def rain_source_raw(
    readings: DataFrame, rain: DataFrame, stations: DataFrame, metrics: list[str] | None = None, start=None
) -> DataFrame:
    """Rain rows with station names, duplicates included."""
    metrics = RAIN_METRICS if metrics is None else metrics
    rows = with_station_names(rain_versions(readings, rain, metrics, start), stations)
    return rows.select("dia", *metrics, "estacao", "estacao_id")


def rain_source(
    readings: DataFrame, rain: DataFrame, stations: DataFrame, metrics: list[str] | None = None,
    start=None, keep_id: bool = False,
) -> DataFrame:
    """Rain rows, one per (time, station): the reading with the highest id.

    Names are joined after the duplicates are gone, so they are not shuffled.
    """
    metrics = RAIN_METRICS if metrics is None else metrics
    rows = latest_by_id(
        rain_versions(readings, rain, metrics, start), ["dia", "estacao_id"], "leitura_id", ties=metrics
    )
    extra = ["leitura_id"] if keep_id else []
    return with_station_names(rows, stations).select(*extra, "dia", *metrics, "estacao", "estacao_id")


def sensor_pivot(values: DataFrame, sensors: DataFrame, sensor_map: dict[str, str] | None = None) -> DataFrame:
    """One row per reading with a value of any known sensor; the largest value per named sensor.

    Aggregated by reading before any join to readings: the values of a reading lie
    together, so most of the reduction happens before the shuffle, and no product
    with rain rows can arise.
    """
    sensor_map = SENSORS if sensor_map is None else sensor_map
    s = sensors.select(F.col("id").alias("sensor_id"), F.col("nome").alias("_sensor"))
    return (
        values.select("leitura_id", "sensor_id", "valor")
        .join(s, "sensor_id", "inner")
        .groupBy("leitura_id")
        .agg(*[F.max(F.when(F.col("_sensor") == name, F.col("valor"))).alias(c) for c, name in sensor_map.items()])
    )


def weather_source(
    readings: DataFrame,
    values: DataFrame,
    sensors: DataFrame,
    rain: DataFrame,
    stations: DataFrame,
    start=None,
    end=None,
    station_ids: list | None = WEATHER_STATIONS,
    sensor_map: dict[str, str] | None = None,
    cutover: Cutover = CUTOVER,
) -> DataFrame:
    """Weather rows, one per (time, station): maxima over all readings of that instant.

    Readings without any sensor value are left out; rain is optional. Half-open
    ``[start, end)``. ``station_ids=None`` takes every station.
    """
    sensor_map = SENSORS if sensor_map is None else sensor_map
    r = readings
    if start is not None and end is not None:
        r = half_open(r, "horaLeitura", start, end)
    if station_ids is not None:
        r = r.filter(F.col("estacao_id").isin(list(station_ids)))
    r = r.select(F.col("id").alias("leitura_id"), F.col("horaLeitura").alias("dia_utc"), "estacao_id")

    # Values and rain of other readings go before anything is grouped: a short range or a
    # watermark then shuffles what belongs to it, not all history.
    wanted = r.select("leitura_id")
    values = values.join(wanted, "leitura_id", "left_semi")
    rain = rain.join(wanted, "leitura_id", "left_semi")
    rain_max = rain.groupBy("leitura_id").agg(F.max("m05").alias("_m05"), F.max("m15").alias("_m15"))
    per_reading = (
        r.join(sensor_pivot(values, sensors, sensor_map), "leitura_id", "inner")
        .join(rain_max, "leitura_id", "left")
    )
    named = with_station_names(per_reading, stations).withColumn(
        "_chuva", rain_by_cutover(F.col("dia_utc"), F.col("estacao"), F.col("_m05"), F.col("_m15"), cutover)
    )
    merged = named.groupBy("dia_utc", "estacao_id", "estacao").agg(
        F.max("_chuva").alias("chuva"), *[F.max(c).alias(c) for c in sensor_map]
    )
    if {"temperatura", "umidade"} <= set(sensor_map):
        merged = merged.withColumn(
            "ponto_orvalho",
            dew_point(F.col("temperatura").cast("double"), F.col("umidade").cast("double")),
        )
    return merged
