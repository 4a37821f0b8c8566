"""The driver's tables under the column names of the station network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.timecols import trunc
from gaugeworks.sources.facts import rain_source, with_station_names
from gaugeworks.schema import RAIN_METRICS_FULL, Cutover

# Metrics of the rain tables as lineitem columns.
RAIN_COLUMNS = {
    "m05": "l_quantity", "m10": "l_extendedprice", "m15": "l_discount", "h01": "l_tax",
    "h02": "l_quantity", "h03": "l_extendedprice", "h04": "l_linenumber", "h06": "l_discount",
    "h12": "l_tax", "h24": "l_partkey", "h96": "l_suppkey", "mes": "l_linenumber",
}
EVENT_SENSORS = ["click", "error", "purchase", "signup", "view"]
SENSOR_MAP = {
    "dirVento": "AFRICA", "velVento": "AMERICA", "temperatura": "ASIA", "pressao": "EUROPE", "umidade": "MIDDLE EAST",
}
EVENT_CUTOVER = Cutover("2024-01-10 00:00:00", "2024-01-20 00:00:00", ["customer#00000001"])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stations(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"))


def readings(spark, sf) -> DataFrame:
    """Reading headers with a multi-year history."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("horaLeitura"), F.col("o_custkey").alias("estacao_id")
    )


def rain(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("leitura_id"),
        *[F.col(RAIN_COLUMNS[m]).cast("double").alias(m) for m in RAIN_METRICS_FULL],
    )


def rain_rows(spark, sf) -> DataFrame:
    return rain_source(readings(spark, sf), rain(spark, sf), stations(spark, sf))


def event_readings(spark, sf) -> DataFrame:
    """Events as reading headers; truncated to the hour they have duplicate keys."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), trunc("hour", F.col("ts")).alias("horaLeitura"), F.col("user_id").alias("estacao_id")
    )


def sensor_values(spark, sf) -> DataFrame:
    sensor = F.array_position(F.array(*[F.lit(s) for s in EVENT_SENSORS]), F.col("event_type")) - 1
    return table(spark, sf, "events").select(
        F.col("event_id").alias("leitura_id"), sensor.cast("int").alias("sensor_id"), F.col("value").alias("valor")
    )


def sensors(spark, sf) -> DataFrame:
    return table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("nome"))


def hourly(spark, sf) -> DataFrame:
    """Event versions per (hour, station)."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), trunc("hour", F.col("ts")).alias("dia"),
        F.col("user_id").alias("estacao_id"), "value", "event_type",
    )


def moments(spark, sf) -> DataFrame:
    """Events at their exact time."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("dia"), F.col("user_id").alias("estacao_id"), "value", "event_type",
    )


def fact(spark, sf) -> DataFrame:
    """Replica-like rows: exact event times, two metrics, station names."""
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("dia"),
        F.regexp_extract("props", "[0-9]+", 0).cast("decimal(10,2)").alias("m05"),
        F.col("value").cast("decimal(10,2)").alias("h24"),
        F.col("user_id").alias("estacao_id"),
    )
    return with_station_names(rows, stations(spark, sf))


def networks(spark, sf) -> DataFrame:
    """Market segment of each station, as the network it belongs to."""
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("estacao_id"), F.col("c_mktsegment").alias("rede"))


def replica(spark, sf) -> DataFrame:
    """A copy of ``moments`` that lags: one network was never loaded, another stopped early."""
    end = F.when(F.col("rede") == "BUILDING", F.lit("2024-01-10 00:00:00")).otherwise(F.lit("2024-01-20 00:00:00"))
    return (
        moments(spark, sf)
        .join(networks(spark, sf), "estacao_id")
        .filter((F.col("rede") != "MACHINERY") & (F.col("dia") < end.cast("timestamp_ntz")))
        .drop("rede")
    )
