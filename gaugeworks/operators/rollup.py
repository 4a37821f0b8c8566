"""Profiles, station summaries and period roll-ups.

Every aggregate here combines on the map side, so a station or period holding a
large share of the rows sends one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import timecols
from gaugeworks.functions.values import rounded_max, rounded_mean, snap_zero, without_sentinel
from gaugeworks.operators.filters import moment, optional

ROLLUP_METRICS = ["m05", "m15", "h01", "h04", "h24", "h96"]


def profile(df: DataFrame, ts: str = "dia") -> DataFrame:
    """One row: rows, first and last time."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.min(ts).alias("data_minima"), F.max(ts).alias("data_maxima")
    )


def table_status(df: DataFrame, ts: str = "dia_utc", station: str = "estacao_id") -> DataFrame:
    """One row: rows, first and last time, stations."""
    return df.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.min(ts).alias("data_minima"),
        F.max(ts).alias("data_maxima"),
        F.countDistinct(station).alias("total_estacoes"),
    )


def global_stats(
    df: DataFrame, ts: str = "dia", station: str = "estacao_id", metric: str = "h24", sentinel: float | None = None
) -> DataFrame:
    """``table_status`` plus rounded mean and maximum of one metric.

    The distinct count runs on (station) partials first, so the other aggregates
    are combined per station before the final row.
    """
    v = F.col(metric) if sentinel is None else without_sentinel(F.col(metric), sentinel)
    return df.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.min(ts).alias("data_minima"),
        F.max(ts).alias("data_maxima"),
        F.countDistinct(station).alias("total_estacoes"),
        snap_zero(rounded_mean(v, kind=df.schema[metric].dataType)).alias(f"media_geral_{metric}"),
        snap_zero(rounded_max(v)).alias(f"max_geral_{metric}"),
    )


def station_summary(df: DataFrame, ts: str = "dia", station: str = "estacao_id", name: str = "estacao") -> DataFrame:
    """Rows, first and last reading per station."""
    return df.groupBy(station, name).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.min(ts).alias("primeira_leitura"),
        F.max(ts).alias("ultima_leitura"),
    )


def station_detail(
    df: DataFrame, ts: str = "dia", station: str = "estacao_id", name: str = "estacao",
    metric: str = "h24", station_id: int | None = None,
) -> DataFrame:
    """``station_summary`` plus rounded mean and maximum of one metric, for one or all stations."""
    rows = df if station_id is None else df.filter(F.col(station) == station_id)
    return rows.groupBy(station, name).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.min(ts).alias("primeira_leitura"),
        F.max(ts).alias("ultima_leitura"),
        snap_zero(rounded_mean(F.col(metric), kind=rows.schema[metric].dataType)).alias(f"media_{metric}"),
        snap_zero(rounded_max(F.col(metric))).alias(f"max_{metric}"),
    )


def period_rollup(
    df: DataFrame,
    grain: str = "dia",
    ts: str = "dia",
    station: str = "estacao_id",
    name: str = "estacao",
    metrics: list[str] | None = None,
    max_metric: str = "h24",
    start=None,
    end=None,
    station_id: int | None = None,
    zone: str | None = None,
    sentinel: float | None = None,
    end_inclusive_day: bool = False,
) -> DataFrame:
    """Rounded means, one maximum and the row count per period and station.

    ``grain`` is dia, semana or mes. ``sentinel`` leaves out that stored value,
    which the default keeps. ``zone`` groups by local periods.
    """
    if grain not in ("dia", "semana", "mes"):
        raise ValueError("grain must be dia, semana or mes")
    rows = optional(df, ts, station, name, start, end, station_id, end_inclusive_day=end_inclusive_day)

    def value(m: str) -> Column:
        return F.col(m) if sentinel is None else without_sentinel(F.col(m), sentinel)

    names = ROLLUP_METRICS if metrics is None else metrics
    return (
        rows.withColumn("periodo", timecols.trunc(grain, F.col(ts), zone))
        .groupBy("periodo", station, name)
        .agg(
            *[snap_zero(rounded_mean(value(m), kind=rows.schema[m].dataType)).alias(f"media_{m}") for m in names],
            snap_zero(rounded_max(value(max_metric))).alias(f"max_{max_metric}"),
            F.count(F.lit(1)).alias("total_leituras"),
        )
    )


def default_window(df: DataFrame, ts: str = "dia", days: int | None = None) -> DataFrame:
    """One row ``start``, ``end`` (midnights): the last ``days`` days of data.

    Without ``days`` the last 30 days, but not before the first day of data.
    """
    first, last = (F.date_trunc("day", f(ts)).cast("timestamp_ntz") for f in (F.min, F.max))
    back = last - F.make_dt_interval(F.lit(30 if days is None else days))
    return df.agg((back if days is not None else F.greatest(back, first)).alias("start"), last.alias("end"))


def period_rollup_default(df: DataFrame, grain: str = "dia", ts: str = "dia", days: int | None = None, **kw) -> DataFrame:
    """``period_rollup`` over ``default_window``; the bounds are scalar subqueries."""
    window = default_window(df, ts, days)
    start, end = window.select("start").scalar(), window.select("end").scalar()
    return period_rollup(df.filter((F.col(ts) >= start) & (F.col(ts) <= end)), grain, ts, **kw)


def year_histogram(df: DataFrame, ts: str = "dia", with_dates: bool = False) -> DataFrame:
    extra = [F.to_date(F.min(ts)).alias("primeira_data"), F.to_date(F.max(ts)).alias("ultima_data")] if with_dates else []
    return df.groupBy(F.year(ts).cast("bigint").alias("ano")).agg(F.count(F.lit(1)).alias("total_registros"), *extra)


def distinct_years(df: DataFrame, ts: str = "dia") -> DataFrame:
    return df.select(F.year(ts).cast("bigint").alias("ano")).distinct()


def month_presence(df: DataFrame, ts: str, month: str) -> DataFrame:
    """One row: rows in the month ``yyyy-MM``."""
    first = moment(f"{month}-01 00:00:00")
    after = F.date_trunc("month", first + F.make_dt_interval(F.lit(31))).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= first) & (F.col(ts) < after)).agg(F.count(F.lit(1)).alias("total"))
