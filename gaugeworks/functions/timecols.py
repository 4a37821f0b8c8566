"""Time columns.

Wall-clock values, UTC or local, are ``timestamp_ntz``. Casts from and to
``timestamp`` use the session zone, which ``tune`` pins to UTC, so they keep the
wall clock. Zone shifts use the functions that resolve a literal zone once per
task; ``convert_timezone`` looks it up for every row, about ten times slower.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks.schema import LOCAL_ZONE

# Accepted text layouts, the usual ones first; seconds and up to six fraction digits may be missing.
_CLOCK = "yyyy-MM-dd HH:mm[:ss][.SSSSSS]"
_ZONED_LAYOUTS = [f"{_CLOCK}[ ]XXX", f"{_CLOCK}[ ]X"]  # Z, -03:00; -0300, -03
_PLAIN_LAYOUTS = [_CLOCK, "yyyy-MM-dd"]

_GRAINS = {
    "dia": "day", "semana": "week", "mes": "month",
    "minute": "minute", "hour": "hour", "day": "day",
    "week": "week", "month": "month", "year": "year",
}


def ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def shift(c: Column, **parts: int) -> Column:
    """Add hours/mins/secs/days (possibly negative) to a timestamp."""
    return c + F.make_dt_interval(**{k: F.lit(v) for k, v in parts.items()})


def to_utc(c: Column, naive_zone: str = "UTC") -> Column:
    """Zone-less wall clock in ``naive_zone`` to UTC wall clock."""
    if naive_zone == "UTC":
        return ntz(c)
    return ntz(F.to_utc_timestamp(c.cast("timestamp"), naive_zone))


def to_local(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall clock to local wall clock."""
    return ntz(F.from_utc_timestamp(utc.cast("timestamp"), zone))


def offset_minutes(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.timestamp_diff("MINUTE", ntz(utc), to_local(utc, zone)).cast("int")


def offset_text(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local offset as ``-0300``; NULL time, NULL text."""
    minutes = offset_minutes(utc, zone)
    # Both parts truncate toward zero, so -210 minutes give -330.
    digits = F.call_function("div", minutes, F.lit(60)) * 100 + minutes % 60
    return F.concat(F.when(digits < 0, "-").otherwise("+"), F.lpad(F.abs(digits).cast("string"), 4, "0"))


def offset_text_colon(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local offset as ``-03:00``."""
    text = offset_text(utc, zone)
    return F.concat(F.left(text, F.lit(3)), F.lit(":"), F.right(text, F.lit(2)))


def original_text(utc: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local time with milliseconds and offset: ``2009-02-16 02:12:20.000 -0300``."""
    return F.concat(
        F.date_format(to_local(utc, zone), "yyyy-MM-dd HH:mm:ss.SSS"),
        F.lit(" "),
        offset_text(utc, zone),
    )


def parse_text_utc(text: Column, naive_zone: str = "UTC") -> Column:
    """ISO-like text, with or without an offset or ``Z``, to UTC wall clock.

    Date and time are joined by a space or a ``T``; a date alone is midnight.
    Anything else gives NULL.
    """
    body = F.trim(F.replace(text, F.lit("T"), F.lit(" ")))
    zoned = [ntz(F.try_to_timestamp(body, F.lit(f))) for f in _ZONED_LAYOUTS]
    plain = F.coalesce(*[F.try_to_timestamp(body, F.lit(f)) for f in _PLAIN_LAYOUTS])
    return F.coalesce(*zoned, to_utc(ntz(plain), naive_zone))


def local_to_utc(wall: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local wall clock to UTC at clock changes.

    A wall clock that occurs twice gives NULL; one that was skipped gives the
    first valid instant after the gap (gaps start on the hour in this zone).
    """
    w = ntz(wall)
    utc = to_utc(w, zone)
    occurs_twice = (to_local(shift(utc, hours=1), zone) == w) | (
        to_local(shift(utc, hours=-1), zone) == w
    )
    skipped = to_local(utc, zone) != w
    into_gap = w - ntz(F.date_trunc("hour", w))
    return F.when(skipped, ntz(utc - into_gap)).when(~occurs_twice, utc)


def parse_day_first(text: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` to wall clock, NULL when malformed."""
    return ntz(F.try_to_timestamp(F.trim(text), F.lit("dd/MM/yyyy HH:mm:ss")))


def trunc(grain: str, ts: Column, zone: str | None = None) -> Column:
    """Start of the minute, hour, day, week (Monday), month or year.

    With ``zone`` the period is the local one and the result is local wall clock.
    """
    if grain not in _GRAINS:
        raise ValueError(f"grain must be one of {sorted(_GRAINS)}")
    base = to_local(ts, zone) if zone else ntz(ts)
    return ntz(F.date_trunc(_GRAINS[grain], base))


def month_key(ts: Column) -> Column:
    """Partition value ``yyyy-MM``."""
    return F.date_format(ntz(ts), "yyyy-MM")
