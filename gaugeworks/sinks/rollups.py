"""Roll-ups kept up to date: a batch recomputes only the (period, station) groups it touches.

The roll-up is a stored table of its own. Which groups a batch touches is written beside it before the
readings change; after that the groups are recomputed from the readings of their periods and replace
their rows. A stop in between leaves the touched groups, and the next batch recomputes them, too. Rows
may come late by any amount. A station has one name within a period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from gaugeworks.functions import timecols
from gaugeworks.operators.rollup import period_rollup
from gaugeworks.session import path_exists
from gaugeworks.sinks import tables as sink
from gaugeworks.sources.tables import read_table

TOUCHED = "_touched"


def _period(grain: str, ts: str, zone: str | None):
    return timecols.trunc(grain, F.col(ts), zone)


def start(readings: DataFrame, path: str, grain: str, ts: str = "dia", station: str = "estacao_id", **options) -> None:
    """The roll-up of all readings, stored at ``path``. ``options``: see ``period_rollup``."""
    sink.reload_table(period_rollup(readings, grain, ts, station, **options), path, "periodo", station)


def maintain(
    spark: SparkSession, readings_path: str, path: str, batch: DataFrame, key: list[str], grain: str,
    ts: str = "dia", station: str = "estacao_id", version: str | None = None, zone: str | None = None, **options,
) -> None:
    """Merge ``batch`` into the stored readings and bring the roll-up at ``path`` up to date."""
    groups = batch.select(_period(grain, ts, zone).cast("timestamp_ntz").alias("periodo"), station).distinct()
    schema = StructType([StructField("periodo", TimestampNTZType()), groups.schema[station]])
    groups.write.mode("append").parquet(f"{path}/{TOUCHED}")
    sink.upsert_files(spark, readings_path, batch, key, ts, station, version)
    catch_up(spark, readings_path, path, schema, grain, ts, station, zone, **options)


def catch_up(
    spark: SparkSession, readings_path: str, path: str, schema: StructType, grain: str,
    ts: str = "dia", station: str = "estacao_id", zone: str | None = None, **options,
) -> None:
    """Recompute the groups noted beside the roll-up; ``schema`` is that of the notes (periodo, station)."""
    if not path_exists(spark, f"{path}/{TOUCHED}"):
        return
    noted = spark.read.schema(schema).parquet(f"{path}/{TOUCHED}")
    groups = noted.distinct()
    # A period lies in few months, of which only those are read.
    days = {"dia": 1, "semana": 7, "mes": 31}[grain]
    first, last = timecols.month_key(timecols.shift(F.col("periodo"), hours=-24)), timecols.month_key(timecols.shift(F.col("periodo"), hours=24 * (days + 1)))
    months = [r[0] for r in noted.select(F.explode(F.array_distinct(F.array(first, timecols.month_key(F.col("periodo")), last))).alias("m")).distinct().collect()]
    if not months:
        return
    rows = read_table(spark, readings_path).filter(F.col(sink.MONTH).isin(months)).drop(sink.MONTH)
    period = _period(grain, ts, zone).cast("timestamp_ntz")
    rows = rows.withColumn("_period", period).join(
        groups.select(F.col("periodo").alias("_p"), F.col(station).alias("_s")), (F.col("_period") == F.col("_p")) & (F.col(station) == F.col("_s")), "left_semi"
    ).drop("_period")
    anew = period_rollup(rows, grain, ts, station, zone=zone, **options)
    sink.upsert_table(spark, path, anew, ["periodo", station], "periodo", station)
    none = spark.createDataFrame([], schema)
    none.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{TOUCHED}")
