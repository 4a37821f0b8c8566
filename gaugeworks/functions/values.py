"""Value expressions: coercion, comparison, rounding, dew point."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from gaugeworks.schema import CUTOVER, SENTINEL, Cutover


def to_double(c: Column) -> Column:
    """Number from any input; unreadable text gives NULL."""
    return F.trim(c.cast("string")).try_cast("double")


def to_long(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("bigint")


def token_to_double(c: Column) -> Column:
    """Report token to number: ``ND`` and blanks are NULL, comma is the decimal mark."""
    # Blanks are tested first: a failing cast is far slower than a comparison.
    t = F.trim(c)
    return F.when(~F.upper(t).isin("ND", ""), F.replace(t, F.lit(","), F.lit(".")).try_cast("double"))


def without_sentinel(c: Column, sentinel: float = SENTINEL) -> Column:
    return F.when(c.cast("double") != F.lit(float(sentinel)), c)


def equal_within(a: Column, b: Column, tolerance: float) -> Column:
    """Both NULL: equal; one NULL: different; otherwise within ``tolerance``."""
    close = F.abs(a.cast("double") - b.cast("double")) <= F.lit(float(tolerance))
    return F.coalesce(close, a.isNull() & b.isNull())


def columns_where(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in order, as an array of strings."""
    marks = F.array(*[F.when(cond, F.lit(name)) for name, cond in conditions.items()])
    return F.array_compact(marks)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def snap_zero(c: Column, below: float = 0.001) -> Column:
    return F.when(F.abs(c) < F.lit(below), F.lit(0.0)).otherwise(c)


def rounded_mean(c: Column, places: int = 2, kind: DataType | None = None) -> Column:
    """``round(coalesce(avg(c), 0), 2)``: the mean is rounded once, half away from zero.

    Values are summed as decimals of six places, so the result does not depend on row order. A column
    whose ``kind`` is a decimal of at most 18 digits is summed as whole numbers of its last place, which
    is faster. Under ANSI mode a sum beyond its range raises instead of wrapping.
    """
    if places != 2:
        raise ValueError("means are given with two decimals")
    n = F.count(c)
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        unit = 10**kind.scale
        # As decimals again before they are multiplied: one value per group.
        total, one = F.sum((c * F.lit(unit)).cast("bigint")).cast("decimal(19,0)"), F.lit(unit).cast("decimal(19,0)")
    else:
        total, one = F.sum(exact(c)), F.lit(1)
    # No group is empty, but a group without values has n = 0.
    half_up = F.call_function("div", F.abs(total) * 200 + n * one, F.greatest(n, F.lit(1)) * one * 2)
    value = F.when(total < 0, -half_up).otherwise(half_up) / F.lit(100.0)
    return F.coalesce(value, F.lit(0.0))


def rounded_max(c: Column) -> Column:
    return F.coalesce(F.round(F.max(exact(c)), 2).cast("double"), F.lit(0.0))


def exact(c: Column) -> Column:
    return c.cast("decimal(20,6)")


def rain_by_cutover(
    ts_utc: Column, name: Column, m05: Column, m15: Column, cutover: Cutover = CUTOVER
) -> Column:
    """15-minute value before the instrument cut-over, 5-minute value after."""
    late = any_of([name.ilike(f"{n}%") for n in cutover.late_names])
    before = ts_utc < F.to_timestamp_ntz(F.lit(cutover.start))
    before_late = ts_utc < F.to_timestamp_ntz(F.lit(cutover.late_start))
    return F.when(before | (late & before_late), m15).otherwise(m05)


def dew_point(temperature: Column, humidity: Column) -> Column:
    """Dew point in Celsius by the Magnus formula; NULL where it is undefined."""
    a, b = 17.625, 243.04
    gamma = F.ln(humidity / F.lit(100.0)) + (F.lit(a) * temperature) / (F.lit(b) + temperature)
    return F.when(humidity > 0, (F.lit(b) * gamma) / (F.lit(a) - gamma))
