"""Matching readings of the same station by time.

No pairs are formed. Probe and target rows are laid on one time line per
(station, time bucket) and the neighbouring targets are read off with a window.
A bucket is at least as long as the tolerance, so a neighbour lies in the probe's
own bucket or is the last (first) target of the bucket before (after); those are
pre-aggregated to one row per bucket and offered to the next one. Work and shuffle
grow linearly with both inputs, and a busy station is spread over its buckets.

A bucket longer than a second is cut into slots of a second. Slots are summarized,
the summaries of one bucket are read in order to carry the last target across empty
slots, and rows are compared within their slot only. With unique (station, time)
rows, which are held in microseconds, a slot has at most a million rows of one
station and a bucket at most as many summaries as it has seconds, whatever share of
the data sits there. Probes without a key or time match nothing and take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions import timecols
from gaugeworks.operators.dedupe import latest

MICROS = 1_000_000

_PLACE = ["_key", "_bucket"]


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _floor_div(pos: Column, width: int) -> Column:
    w = F.lit(width)
    return F.call_function("div", pos - F.pmod(pos, w), w)


def _targets(target: DataFrame, key: str, ts: str, hit: Column) -> DataFrame:
    return target.filter(F.col(ts).isNotNull()).select(
        F.col(key).alias("_key"), _micros(F.col(ts)).alias("_pos"), F.lit(0).alias("_side"), hit.alias("_hit")
    )


def _probes(probe: DataFrame, key: str, at: Column) -> DataFrame:
    return probe.filter(F.col(key).isNotNull() & at.isNotNull()).select(
        F.col(key).alias("_key"), _micros(at).alias("_pos"), F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in probe.columns]).alias("_row"),
    )


def _with_placeless(matched: DataFrame, probe: DataFrame, key: str, at: Column) -> DataFrame:
    """``matched`` and the probes without a key or time, which have no match."""
    return matched.unionByName(probe.filter(F.col(key).isNull() | at.isNull()), allowMissingColumns=True)


def _edge(function, only: Column | None = None) -> Column:
    entry = F.struct("_pos", "_hit")
    return function(entry if only is None else F.when(only, entry))


def _as_targets(summary: DataFrame, place: list[str], offers: list[Column]) -> DataFrame:
    """Summary rows turned into target rows at the place they are offered to."""
    rows = summary.select("_key", F.inline(F.array(*offers)))
    return rows.filter(F.col("_pos").isNotNull()).select(*place, "_pos", F.lit(0).alias("_side"), "_hit")


def _slot(width: int, slot: int) -> Column:
    """Slot of a row; targets offered from outside the bucket go just before or after it."""
    first = F.col("_bucket") * width
    return _floor_div(F.greatest(first - 1, F.least(F.col("_pos"), first + width)), slot)


def _carried(rows: DataFrame) -> DataFrame:
    """For every slot with probes, the last target of earlier slots and the first of later ones."""
    is_target = F.col("_side") == 0
    summary = rows.groupBy(*_PLACE, "_slot").agg(
        _edge(F.max, is_target).alias("_last"), _edge(F.min, is_target).alias("_first"), F.max("_side").alias("_probed")
    )
    slots = Window.partitionBy(*_PLACE)
    others = (Window.unboundedPreceding, -1)
    carried = summary.withColumns({
        "_before": F.last("_last", ignorenulls=True).over(slots.orderBy(F.asc("_slot")).rowsBetween(*others)),
        "_after": F.last("_first", ignorenulls=True).over(slots.orderBy(F.desc("_slot")).rowsBetween(*others)),
    }).filter(F.col("_probed") == 1)
    offers = [
        F.struct("_bucket", "_slot", F.col(f"{c}._pos").alias("_pos"), F.col(f"{c}._hit").alias("_hit"))
        for c in ("_before", "_after")
    ]
    return _as_targets(carried, [*_PLACE, "_slot"], offers)


def _time_line(probes: DataFrame, targets: DataFrame, tolerance: int) -> DataFrame:
    """All rows by (_key, _bucket, _slot), with every target a probe may need in its slot.

    The layout follows from the tolerance alone.
    """
    slot = max(1, min(tolerance, MICROS))
    slots = max(1, -(-tolerance // slot))
    width = slot * slots

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", _floor_div(F.col("_pos"), width))

    t, p = placed(targets), placed(probes)
    edges = t.groupBy(*_PLACE).agg(_edge(F.max).alias("_last"), _edge(F.min).alias("_first"))
    offers = [
        F.struct((F.col("_bucket") + step).alias("_bucket"), F.col(f"{c}._pos").alias("_pos"), F.col(f"{c}._hit").alias("_hit"))
        for c, step in (("_last", 1), ("_first", -1))
    ]
    line = t.select(*_PLACE, "_pos", "_side", "_hit").unionByName(_as_targets(edges, _PLACE, offers))
    line = line.unionByName(p, allowMissingColumns=True)
    if slots == 1:
        return line.withColumn("_slot", F.lit(0).cast("bigint"))
    line = line.withColumn("_slot", _slot(width, slot))
    return line.unionByName(_carried(line), allowMissingColumns=True)


def _neighbours(line: DataFrame, before: bool = True, after: bool = True) -> DataFrame:
    """Probe rows with ``_before`` and ``_after`` = (p, h): the targets at or next to them."""
    by = Window.partitionBy(*_PLACE, "_slot")
    seen = (Window.unboundedPreceding, Window.currentRow)
    mark = F.when(F.col("_side") == 0, F.struct(F.col("_pos").alias("p"), F.col("_hit").alias("h")))
    looks = {}
    if before:
        looks["_before"] = F.last(mark, ignorenulls=True).over(
            by.orderBy(F.col("_pos").asc(), F.col("_side").asc()).rowsBetween(*seen)
        )
    if after:
        # Read from the end, so that this frame also only grows.
        looks["_after"] = F.last(mark, ignorenulls=True).over(
            by.orderBy(F.col("_pos").desc(), F.col("_side").asc()).rowsBetween(*seen)
        )
    return line.withColumns(looks).filter(F.col("_side") == 1).select("_key", "_pos", "_row", *looks)


def _nearer(before: Column, after: Column) -> Column:
    """The closer of two neighbours; ties go to the earlier."""
    closer = (F.col("_pos") - before["p"]) <= (after["p"] - F.col("_pos"))
    return F.when(before.isNotNull() & (after.isNull() | closer), before).otherwise(after)


def asof(
    probe: DataFrame,
    target: DataFrame,
    key: str,
    probe_ts: str,
    target_ts: str,
    payload: list[str],
    tolerance_seconds: float,
    direction: str = "nearest",
    match_ts: str = "match_ts",
    start: Column | None = None,
    newest: list[str] | None = None,
) -> DataFrame:
    """Left as-of join: every probe row once, with at most one target row.

    ``direction`` is ``backward`` (last target at or before), ``forward`` (first at
    or after) or ``nearest`` (ties go to the earlier target). ``start`` replaces
    the probe time as the point to search from. Targets are unique on (key, time);
    where they are not, ``newest`` names the columns whose highest values choose one
    of each instant. Adds ``match_ts`` and ``payload``, NULL without a match.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError("direction must be backward, forward or nearest")
    tolerance = int(round(tolerance_seconds * MICROS))
    at = start if start is not None else F.col(probe_ts)
    if newest:
        target = latest(target, [key, target_ts], *[F.desc_nulls_last(c) for c in newest])
    hit = F.struct(F.col(target_ts).alias(match_ts), *[F.col(c) for c in payload])
    line = _time_line(
        _probes(probe, key, at),
        _targets(target, key, target_ts, hit),
        tolerance,
    )
    found = _neighbours(line, direction != "forward", direction != "backward")
    if direction == "nearest":
        best = _nearer(F.col("_before"), F.col("_after"))
    else:
        best = F.col("_before" if direction == "backward" else "_after")
    near = F.abs(F.col("_pos") - F.col("_best.p")) <= F.lit(tolerance)
    matched = found.withColumn("_best", best).withColumn("_m", F.when(near, F.col("_best.h"))).select(
        *[F.col(f"_row.{c}").alias(c) for c in probe.columns],
        *[F.col(f"_m.{c}").alias(c) for c in [match_ts, *payload]],
    )
    return _with_placeless(matched, probe, key, at)


def within_seconds(
    probe: DataFrame, target: DataFrame, key: str, probe_ts: str, target_ts: str,
    payload: list[str], seconds: float = 1.0,
) -> DataFrame:
    """One target row within ``±seconds`` (the nearest), or none."""
    return asof(probe, target, key, probe_ts, target_ts, payload, seconds)


def first_in_window(
    probe: DataFrame, target: DataFrame, key: str, probe_ts: str, target_ts: str,
    payload: list[str], seconds: float = 3600.0, newest: list[str] | None = None,
) -> DataFrame:
    """The earliest target row within ``±seconds``; of one instant the highest by ``newest``.

    That is the first target at or after ``time - seconds``, no later than twice
    the tolerance.
    """
    start = timecols.ntz(F.col(probe_ts)) - F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))
    return asof(
        probe, target, key, probe_ts, target_ts, payload, 2 * seconds, "forward", start=start, newest=newest
    )


def nearest_by_minute(
    probe: DataFrame, target: DataFrame, key: str, probe_ts: str, target_ts: str,
    payload: list[str], seconds: float = 3600.0,
) -> DataFrame:
    """Nearest target in the probe's own minute, else the first row of the nearest minute.

    Tier 1 compares exact times within the same minute. Only when the target has
    no row in that minute does tier 2 take the nearest minute within ``seconds``
    (ties to the earlier) and its first row. Adds ``match_ts`` and ``match_tier``.
    """
    hit = F.struct(F.col(target_ts).alias("match_ts"), *[F.col(c) for c in payload])
    targets = _targets(target, key, target_ts, hit)
    minute = 60 * MICROS
    tolerance = int(round(seconds * MICROS))

    # Minutes within the tolerance lie less than one minute further apart in time.
    line = _time_line(_probes(probe, key, F.col(probe_ts)), targets, tolerance + minute)
    found = _neighbours(line).withColumns({
        "_minute": _floor_div(F.col("_pos"), minute),
        "_mbefore": _floor_div(F.col("_before.p"), minute),
        "_mafter": _floor_div(F.col("_after.p"), minute),
    })
    mine, earlier, later = F.col("_minute"), F.col("_mbefore"), F.col("_mafter")
    exact = _nearer(F.when(earlier == mine, F.col("_before")), F.when(later == mine, F.col("_after")))
    # The neighbours lie in the nearest earlier and later minute that have targets.
    chosen = F.when(
        earlier.isNotNull() & (later.isNull() | (mine - earlier <= later - mine)), earlier
    ).otherwise(later)
    decided = found.withColumns({"_exact": exact["h"], "_near": chosen})

    # The first row of the chosen minute, from one row per (station, minute).
    firsts = targets.groupBy(F.col("_key").alias("_k"), _floor_div(F.col("_pos"), minute).alias("_m")).agg(
        _edge(F.min).alias("_first")
    )
    both = decided.join(firsts, (F.col("_key") == F.col("_k")) & (F.col("_near") == F.col("_m")), "left")
    in_reach = F.abs(F.col("_near") - F.col("_minute")) * minute <= tolerance
    matched = both.withColumn("_match", F.coalesce("_exact", F.when(in_reach, F.col("_first._hit")))).select(
        *[F.col(f"_row.{c}").alias(c) for c in probe.columns],
        *[F.col(f"_match.{c}").alias(c) for c in ["match_ts", *payload]],
        F.when(F.col("_exact").isNotNull(), F.lit(1)).when(F.col("_match").isNotNull(), F.lit(2)).alias("match_tier"),
    )
    return _with_placeless(matched, probe, key, F.col(probe_ts))
