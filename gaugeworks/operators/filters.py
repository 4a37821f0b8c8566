"""Row filters. All are plain predicates, so they reach the file scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(value) -> Column:
    """A literal or column as a UTC wall clock."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def since(df: DataFrame, ts: str, start) -> DataFrame:
    return df.filter(F.col(ts) >= moment(start))


def half_open(df: DataFrame, ts: str, start, end, station: str | None = None, stations=None) -> DataFrame:
    """``start <= ts < end``, optionally for a list of stations."""
    out = df.filter((F.col(ts) >= moment(start)) & (F.col(ts) < moment(end)))
    return out.filter(F.col(station).isin(list(stations))) if stations else out


def closed(df: DataFrame, ts: str, start, end, station: str | None = None, stations=None) -> DataFrame:
    """``start <= ts <= end``, optionally for a list of stations."""
    out = df.filter(F.col(ts).between(moment(start), moment(end)))
    return out.filter(F.col(station).isin(list(stations))) if stations else out


def years(df: DataFrame, ts: str, first: int, last: int) -> DataFrame:
    """Whole years ``first..last`` as a time range, so files can be skipped."""
    if first > last:
        raise ValueError("first year must not be after last year")
    return half_open(df, ts, f"{first}-01-01 00:00:00", f"{last + 1}-01-01 00:00:00")


def optional(
    df: DataFrame,
    ts: str = "dia",
    station: str = "estacao_id",
    name: str = "estacao",
    start=None,
    end=None,
    station_id=None,
    name_contains: str | None = None,
    end_inclusive_day: bool = False,
) -> DataFrame:
    """Only the filters that are given.

    ``end`` is compared as an instant, so a plain date keeps only its midnight;
    ``end_inclusive_day`` keeps that whole day.
    """
    conditions = []
    if start is not None:
        conditions.append(F.col(ts) >= moment(start))
    if end is not None:
        if end_inclusive_day:
            conditions.append(F.col(ts) < F.date_trunc("day", moment(end)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(1)))
        else:
            conditions.append(F.col(ts) <= moment(end))
    if station_id is not None:
        conditions.append(F.col(station) == station_id)
    if name_contains:
        conditions.append(name_like(F.col(name), name_contains))
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df


def name_like(name: Column, part: str, prefix: bool = False, ignore_accents: bool = False) -> Column:
    """Case-insensitive contains or prefix; accents can be ignored by collation."""
    if ignore_accents:
        folded = F.collate(name, "UNICODE_CI_AI")
        wanted = F.collate(F.lit(part), "UNICODE_CI_AI")
        return F.startswith(folded, wanted) if prefix else F.contains(folded, wanted)
    return name.ilike(f"{part}%" if prefix else f"%{part}%")


def last_hours(df: DataFrame, ts: str, hours: int, as_of) -> DataFrame:
    return df.filter(F.col(ts) >= moment(as_of) - F.make_dt_interval(hours=F.lit(hours)))


def plausible_until(as_of, days_ahead: int = 3) -> Column:
    return moment(as_of) + F.make_dt_interval(F.lit(days_ahead))


def plausible(df: DataFrame, ts: str, as_of, days_ahead: int = 3) -> DataFrame:
    """Rows not dated more than ``days_ahead`` days after ``as_of``."""
    return df.filter(F.col(ts) <= plausible_until(as_of, days_ahead))
