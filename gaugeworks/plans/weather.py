"""Weather: full export and incremental sync of the warehouse table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.operators import columns, watermarks
from gaugeworks.operators.contracts import stored_layout
from gaugeworks.plans import slices
from gaugeworks.schema import SENSORS, WAREHOUSE_WEATHER, WEATHER_METRICS, WEATHER_STATIONS
from gaugeworks.sinks import tables as sink
from gaugeworks.sources.facts import weather_source
from gaugeworks.sources.jdbc import year_slices
from gaugeworks.sources.tables import read_table

KEY = ["dia_utc", "estacao_id"]


def warehouse_rows(
    readings: DataFrame, values: DataFrame, sensors: DataFrame, rain: DataFrame, stations: DataFrame,
    start=None, end=None, station_ids: list | None = WEATHER_STATIONS,
    sensor_map: dict[str, str] | None = None, naive_zone: str = "UTC",
) -> DataFrame:
    """Warehouse contract rows, one per key."""
    rows = weather_source(
        readings, values, sensors, rain, stations, start, end, station_ids, sensor_map or SENSORS
    )
    rows = columns.add_time_columns(columns.canonical_names(rows), naive_zone=naive_zone)
    rows = columns.require_time(columns.coerce_numbers(rows, WEATHER_METRICS))
    return columns.conform(rows, WAREHOUSE_WEATHER)


def new_for_warehouse(
    readings: DataFrame, values: DataFrame, sensors: DataFrame, rain: DataFrame, stations: DataFrame, per_station: DataFrame,
    station_ids: list | None = WEATHER_STATIONS, sensor_map: dict[str, str] | None = None,
) -> DataFrame:
    """Rows after each station's own newest time, and unseen stations of the list."""
    newer = watermarks.newer_than_station(readings, per_station, "horaLeitura", "estacao_id")
    return warehouse_rows(
        newer, values, sensors, rain, stations, station_ids=station_ids, sensor_map=sensor_map
    )


def export_warehouse(
    readings: DataFrame, values: DataFrame, sensors: DataFrame, rain: DataFrame, stations: DataFrame,
    path: str, station_ids: list | None = WEATHER_STATIONS, sensor_map: dict[str, str] | None = None,
) -> None:
    """All years in one job."""
    sink.reload_table(
        warehouse_rows(
            readings, values, sensors, rain, stations, station_ids=station_ids, sensor_map=sensor_map
        ),
        path,
        marked=True,
    )


def export_slice(
    readings: DataFrame, values: DataFrame, sensors: DataFrame, rain: DataFrame, stations: DataFrame,
    path: str, start, end, station_ids: list | None = WEATHER_STATIONS,
    sensor_map: dict[str, str] | None = None,
) -> None:
    """Replace the months of ``[start, end)``; raises unless it starts and ends with a month."""
    for bound in (start, end):
        if datetime.fromisoformat(str(bound)) != datetime.fromisoformat(str(bound)[:7] + "-01"):
            raise ValueError(f"{bound} is not the start of a month: the rest of its month would be lost")
    sink.reload_months(
        warehouse_rows(readings, values, sensors, rain, stations, start, end, station_ids, sensor_map), path
    )


def export_years(
    spark: SparkSession, readings: DataFrame, values: DataFrame, sensors: DataFrame, rain: DataFrame, stations: DataFrame,
    path: str, first_year: int, last_year: int, station_ids: list | None = WEATHER_STATIONS,
    sensor_map: dict[str, str] | None = None,
) -> list[int]:
    """The full export year by year; one that was cut short goes on after its last finished year.

    The first year of a new run replaces the table, the others their months. Returns the years written.
    """

    def write(piece: slices.Slice, first: bool) -> None:
        _, start, end = piece
        if first:
            rows = warehouse_rows(readings, values, sensors, rain, stations, start, end, station_ids, sensor_map)
            sink.reload_table(rows, path)
        else:
            export_slice(readings, values, sensors, rain, stations, path, start, end, station_ids, sensor_map)

    written = slices.run(spark, path, year_slices(first_year, last_year), write, close=False)
    sink.start_marks(spark, path, sink.with_month(WAREHOUSE_WEATHER))
    slices.run(spark, path, [], write)
    return [y for y, _, _ in written]


def sync_warehouse(
    spark: SparkSession, readings: DataFrame, values: DataFrame, sensors: DataFrame, rain: DataFrame,
    stations: DataFrame, path: str, station_ids: list | None = WEATHER_STATIONS,
    sensor_map: dict[str, str] | None = None, as_of=None,
) -> None:
    """Watermarks come from the marks beside the table, which is not scanned for them."""
    warehouse = read_table(spark, path, schema=sink.with_month(WAREHOUSE_WEATHER))
    if not stored_layout(warehouse, sink.MONTH).first()["accepted"]:
        raise ValueError("the table must be partitioned by month")
    per_station = sink.stored_watermarks(spark, path, WAREHOUSE_WEATHER, as_of)
    fresh = new_for_warehouse(readings, values, sensors, rain, stations, per_station, station_ids, sensor_map)
    sink.append_absent(spark, path, fresh, KEY, schema=WAREHOUSE_WEATHER)
