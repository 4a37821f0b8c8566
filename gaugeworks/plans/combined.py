"""One combined run: sync rain, check weather lag, sync weather, report status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.watermarks import lag_since, weather_to_sync
from gaugeworks.plans import rain as rain_plan
from gaugeworks.plans import weather as weather_plan
from gaugeworks.schema import WAREHOUSE_RAIN, WAREHOUSE_WEATHER, WEATHER_STATIONS
from gaugeworks.sinks import marks
from gaugeworks.sinks import tables as sink


def lag(spark: SparkSession, path: str, source: DataFrame, as_of, schema=WAREHOUSE_WEATHER, station: str | None = "estacao_id") -> DataFrame:
    """One row: how far a stored table is behind ``source``, by its marks."""
    table, kept = sink.stored_marks(spark, path, schema)
    newest = marks.watermarks(kept, table, "dia_utc", "estacao_id", as_of).agg(F.max("watermark").cast("timestamp_ntz").alias("last_sync"))
    rows = kept.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    return lag_since(newest.withColumn("rows", rows.scalar()), source, "horaLeitura", as_of, station)


def status(spark: SparkSession, rain_path: str, weather_path: str) -> DataFrame:
    """One status row per table, by their marks."""
    _, a = sink.stored_marks(spark, rain_path, WAREHOUSE_RAIN)
    _, b = sink.stored_marks(spark, weather_path, WAREHOUSE_WEATHER)
    return marks.status(a).withColumn("tabela", F.lit("pluviometricos")).unionByName(marks.status(b).withColumn("tabela", F.lit("meteorologicos")))


def run(
    spark: SparkSession, readings: DataFrame, values: DataFrame, sensors: DataFrame, rain: DataFrame,
    stations: DataFrame, rain_path: str, weather_path: str, as_of,
    station_ids: list | None = WEATHER_STATIONS, sensor_map: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Returns the weather lag before its sync, and the status of both tables after.

    What is pending is counted as the source defines it: over all its stations and sensors.
    """
    rain_plan.sync_warehouse(spark, readings, rain, stations, rain_path, as_of)
    behind = lag(spark, weather_path, weather_to_sync(readings, values, sensors, stations), as_of)
    # Kept as a row: the table changes below.
    behind = spark.createDataFrame(behind.collect(), behind.schema)
    weather_plan.sync_warehouse(
        spark, readings, values, sensors, rain, stations, weather_path, station_ids, sensor_map, as_of
    )
    return behind, status(spark, rain_path, weather_path)
