"""Incremental reads, watermarks and lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.filters import moment, plausible, plausible_until
from gaugeworks.schema import EPOCH_UTC
from gaugeworks.session import settled

LOWEST = "0001-01-01 00:00:00"


def global_watermark(target: DataFrame, ts: str, as_of=None) -> DataFrame:
    """One row with the newest time; future-dated rows are ignored given ``as_of``."""
    rows = plausible(target, ts, as_of) if as_of is not None else target
    return rows.agg(F.max(ts).alias("watermark"))


def station_watermarks(target: DataFrame, ts: str, station: str, as_of=None) -> DataFrame:
    """Newest time per station; future-dated rows are ignored given ``as_of``."""
    rows = plausible(target, ts, as_of) if as_of is not None else target
    return (
        rows.filter(F.col(station).isNotNull() & F.col(ts).isNotNull())
        .groupBy(station)
        .agg(F.max(ts).alias("watermark"))
    )


def measured(df: DataFrame) -> DataFrame:
    """A reduced table computed once, in the shared folder, so that the planner sees its real size.

    A join to it is broadcast only when that size is under ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffled otherwise. Nothing stays in the executors' memory.
    """
    return settled(df, "measured")


def newer_than_global(source: DataFrame, watermark: DataFrame, ts: str, inclusive: bool = False) -> DataFrame:
    """Source rows after the single watermark (at or after it when ``inclusive``).

    The watermark is a scalar subquery: computed once, compared as a constant, no
    join. An empty target has a NULL watermark and lets every row through.
    """
    wm = watermark.agg(F.coalesce(F.max("watermark"), moment(LOWEST))).scalar()
    return source.filter(F.col(ts) >= wm if inclusive else F.col(ts) > wm)


def newer_than_station(source: DataFrame, watermarks: DataFrame, ts: str, station: str) -> DataFrame:
    """Source rows after their own station's watermark, plus stations never seen."""
    wm = watermarks.select(F.col(station).alias("_station"), F.col("watermark").alias("_wm"))
    return (
        source.join(wm, F.col(station) == F.col("_station"), "left")
        .filter(F.col("_wm").isNull() | (F.col(ts) > F.col("_wm")))
        .drop("_station", "_wm")
    )


def require_watermark(watermark: DataFrame) -> None:
    """Refuse an incremental run on an empty or never loaded target."""
    row = watermark.agg(F.max("watermark").alias("w")).select(
        (F.col("w").isNotNull() & (F.col("w") > moment(EPOCH_UTC))).alias("ok")
    ).first()
    if not row["ok"]:
        raise ValueError("the target has no usable watermark: run the full load first")


def watermark_report(watermarks: DataFrame, as_of) -> DataFrame:
    """Stations, oldest and newest watermark, and days behind the oldest one."""
    now = moment(as_of)
    return watermarks.agg(
        F.count(F.lit(1)).alias("stations"),
        F.min("watermark").alias("oldest_watermark"),
        F.max("watermark").alias("newest_watermark"),
    ).withColumn("days_behind", whole_days(F.col("oldest_watermark"), now))


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed whole days, rounded down."""
    return F.floor(F.timestamp_diff("SECOND", start, end) / 86400).cast("bigint")


def pending_rows(source: DataFrame, ts: str, after, until) -> DataFrame:
    """One row: source rows in ``(after, until]``."""
    return source.filter((F.col(ts) > moment(after)) & (F.col(ts) <= moment(until))).agg(
        F.count(F.lit(1)).alias("pending")
    )


def pending_readings(source: DataFrame, ts: str, station: str, after, until) -> DataFrame:
    """One row: distinct (time, station) readings in ``(after, until]``."""
    return source.filter((F.col(ts) > moment(after)) & (F.col(ts) <= moment(until))).agg(
        F.countDistinct(ts, station).alias("pending")
    )


def rain_to_sync(readings: DataFrame, rain: DataFrame) -> DataFrame:
    """Rain rows of the source as a sync would count them: one per reading and rain row."""
    return readings.join(rain.select(F.col("leitura_id").alias("id")), "id").select("horaLeitura", "estacao_id")


def weather_to_sync(readings: DataFrame, values: DataFrame, sensors: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings of known stations with a value of a known sensor; count them distinct by time and station."""
    known = values.join(sensors.select(F.col("id").alias("sensor_id")), "sensor_id", "left_semi")
    found = readings.join(known.select(F.col("leitura_id").alias("id")), "id", "left_semi")
    return found.join(stations.select(F.col("id").alias("estacao_id")), "estacao_id", "left_semi").select("horaLeitura", "estacao_id")


def newest_of(target: DataFrame, ts: str, as_of) -> DataFrame:
    """One row: ``last_sync``, the newest time that is plausible, and ``rows`` with a time."""
    return target.agg(F.max(F.when(F.col(ts) <= plausible_until(as_of), F.col(ts))).alias("last_sync"), F.count(ts).alias("rows"))


def lag_report(
    target: DataFrame,
    source: DataFrame,
    ts: str,
    as_of,
    station: str | None = None,
    source_ts: str | None = None,
) -> DataFrame:
    """One row comparing target and source; see ``lag_since``."""
    return lag_since(newest_of(target, ts, as_of), source, source_ts or ts, as_of, station)


def lag_since(newest: DataFrame, source: DataFrame, ts: str, as_of, station: str | None = None) -> DataFrame:
    """One row comparing the source with what a target holds (``newest_of``, or from its marks).

    ``status`` is ``empty`` (no rows), ``future`` (only implausible future rows),
    ``pending`` or ``current``. Pending rows are counted in
    ``(newest target time, as_of]``, distinct by (time, station) when ``station``
    is given. A lag over one whole day is significant.
    """
    now, time = moment(as_of), F.col(ts)
    counted = F.countDistinct(time, F.col(station)) if station else F.count(F.lit(1))
    # NULL last_sync (empty target) leaves nothing pending, as there is no sync to lag.
    pending = source.filter((time <= now) & (time > newest.select("last_sync").scalar())).agg(counted)
    return (
        newest.withColumn("pending", pending.scalar())
        .withColumn("as_of", now)
        .withColumn("days_behind", whole_days(F.col("last_sync"), F.col("as_of")))
        .withColumn("significant", F.coalesce(F.col("days_behind") > 1, F.lit(False)))
        .withColumn(
            "status",
            F.when(F.col("rows") == 0, "empty")
            .when(F.col("last_sync").isNull(), "future")
            .when(F.col("pending") > 0, "pending")
            .otherwise("current"),
        )
        .drop("rows")
    )
