"""Rain: full loads and incremental syncs of the replica and the warehouse table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.timecols import to_utc
from gaugeworks.operators import columns, watermarks
from gaugeworks.operators.compare import reconcile
from gaugeworks.operators.contracts import stored_layout
from gaugeworks.operators.dedupe import latest
from gaugeworks.operators.ranking import sample
from gaugeworks.schema import FIRST_YEAR, RAIN_METRICS, RAIN_METRICS_FULL, REPLICA_RAIN, WAREHOUSE_RAIN
from gaugeworks.sinks import tables as sink
from gaugeworks.sources.facts import rain_source, rain_source_raw
from gaugeworks.sources.tables import read_table

REPLICA_KEY = ["dia", "estacao_id"]
WAREHOUSE_KEY = ["dia_utc", "estacao_id"]
LAST_YEAR = 2100  # to which loads are counted by year


def replica_rows(
    readings: DataFrame, rain: DataFrame, stations: DataFrame, naive_zone: str = "UTC"
) -> DataFrame:
    """Replica contract rows, one per key. Zone-less times are read in ``naive_zone``."""
    rows = rain_source(readings, rain, stations)
    if rows.schema["dia"].dataType.typeName() == "timestamp_ntz":
        rows = rows.withColumn("dia", to_utc(F.col("dia"), naive_zone))
    return columns.conform(columns.require_time(rows, "dia"), REPLICA_RAIN)


def warehouse_rows(
    readings: DataFrame, rain: DataFrame, stations: DataFrame, naive_zone: str = "UTC"
) -> DataFrame:
    """Warehouse contract rows, one per key."""
    rows = rain_source(readings, rain, stations, RAIN_METRICS_FULL).withColumnRenamed("dia", "dia_utc")
    rows = columns.drop_auxiliary(columns.canonical_names(rows))
    rows = columns.add_time_columns(rows, naive_zone=naive_zone)
    rows = columns.require_time(columns.coerce_numbers(rows, RAIN_METRICS_FULL))
    return columns.conform(rows, WAREHOUSE_RAIN)


def new_for_replica(readings: DataFrame, rain: DataFrame, stations: DataFrame, watermark: DataFrame) -> DataFrame:
    """Replica rows read after the replica's newest time."""
    return replica_rows(watermarks.newer_than_global(readings, watermark, "horaLeitura"), rain, stations)


def new_for_warehouse(readings: DataFrame, rain: DataFrame, stations: DataFrame, per_station: DataFrame) -> DataFrame:
    """Warehouse rows after each station's own newest time, and unseen stations."""
    newer = watermarks.newer_than_station(readings, per_station, "horaLeitura", "estacao_id")
    return warehouse_rows(newer, rain, stations)


def copied_rows(
    target: DataFrame | None, readings: DataFrame, rain: DataFrame, stations: DataFrame
) -> DataFrame:
    """Legacy copy: rows at or after the newest time, duplicates resolved by first insert.

    The source order inside one key is undefined there; here the lowest metric
    values make it repeatable.
    """
    r = readings
    if target is not None:
        wm = watermarks.global_watermark(target, "dia")
        r = watermarks.newer_than_global(readings, wm, "horaLeitura", inclusive=True)
    raw = rain_source_raw(r, rain, stations)
    metrics = [c for c in raw.columns if c not in (*REPLICA_KEY, "estacao")]
    return latest(raw, REPLICA_KEY, *[F.col(m).asc_nulls_last() for m in metrics])


# --- runs on stored tables ---


def load_replica(readings: DataFrame, rain: DataFrame, stations: DataFrame, path: str, last_year: int = LAST_YEAR) -> DataFrame:
    """Load the replica; returns what the write counted, without another scan: see ``load_checks``."""
    seen = Observation()
    sink.reload_table(replica_rows(readings, rain, stations), path, "dia", marked=True, observed=(seen, _load_metrics(last_year)))
    return load_checks(readings.sparkSession, seen.get, last_year)


def _load_metrics(last_year: int) -> list[Column]:
    year = F.year("dia")
    known = [F.count(F.when(year == y, 1)).alias(f"ano_{y}") for y in range(FIRST_YEAR, last_year + 1)]
    other = F.count(F.when(~year.between(FIRST_YEAR, last_year), 1)).alias("outros_anos")
    return [F.count(F.lit(1)).alias("total"), F.min("dia").alias("data_minima"), F.max("dia").alias("data_maxima"), other, *known]


def load_checks(spark: SparkSession, seen: dict, last_year: int = LAST_YEAR) -> DataFrame:
    """One row of a load: rows, first and last time, rows by year and rows of other years."""
    years = [(y, seen[f"ano_{y}"]) for y in range(FIRST_YEAR, last_year + 1) if seen[f"ano_{y}"]]
    row = (seen["total"], seen["data_minima"], seen["data_maxima"], years, seen["outros_anos"])
    return spark.createDataFrame([row], "total bigint, data_minima timestamp, data_maxima timestamp, anos array<struct<ano:bigint,total:bigint>>, outros_anos bigint")


def sample_of_load(spark: SparkSession, readings: DataFrame, rain: DataFrame, stations: DataFrame, path: str, n: int = 50) -> DataFrame:
    """``n`` rows of the stored replica, chosen by a hash of their key, looked up in the source: the spot check after a load."""
    stored = read_table(spark, path, schema=sink.with_month(REPLICA_RAIN)).drop(sink.MONTH)
    return reconcile(sample(stored, REPLICA_KEY, n), replica_rows(readings, rain, stations), REPLICA_KEY, RAIN_METRICS, how="left")


def sync_replica(
    spark: SparkSession, readings: DataFrame, rain: DataFrame, stations: DataFrame, path: str, as_of=None
) -> None:
    """The watermark comes from the marks beside the table, which is not scanned for it."""
    newest = sink.stored_watermarks(spark, path, REPLICA_RAIN, as_of, "dia").agg(F.max("watermark").alias("watermark"))
    watermarks.require_watermark(newest)
    sink.upsert_table(spark, path, new_for_replica(readings, rain, stations, newest), REPLICA_KEY, "dia")


def export_warehouse(readings: DataFrame, rain: DataFrame, stations: DataFrame, path: str) -> None:
    sink.reload_table(warehouse_rows(readings, rain, stations), path, marked=True)


def sync_warehouse(
    spark: SparkSession, readings: DataFrame, rain: DataFrame, stations: DataFrame, path: str, as_of=None
) -> None:
    """Watermarks come from the marks beside the table, which is not scanned for them."""
    warehouse = read_table(spark, path, schema=sink.with_month(WAREHOUSE_RAIN))
    if not stored_layout(warehouse, sink.MONTH).first()["accepted"]:
        raise ValueError("the table must be partitioned by month")
    fresh = new_for_warehouse(readings, rain, stations, sink.stored_watermarks(spark, path, WAREHOUSE_RAIN, as_of))
    sink.append_absent(spark, path, fresh, WAREHOUSE_KEY, schema=WAREHOUSE_RAIN)
