"""Reconciling two copies of the same readings.

Inputs are unique on the key (see ``dedupe``), so the full outer join has no hot
keys whatever the station mix, and deduplicated inputs reach it already
partitioned and sorted by that key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.values import any_of, columns_where, equal_within
from gaugeworks.operators import matching

TOLERANCE = 0.0001
SITE_TOLERANCE = 0.05


def _side(df: DataFrame, key: list[str], metrics: list[str], suffix: str) -> DataFrame:
    return df.select(
        *key, *[F.col(m).alias(f"{m}_{suffix}") for m in metrics], F.lit(True).alias(f"_in_{suffix}")
    )


def paired(
    left: DataFrame, right: DataFrame, key: list[str], metrics: list[str],
    names: tuple[str, str] = ("src", "dst"), how: str = "full_outer",
) -> DataFrame:
    """Rows of both sides on the key, metrics suffixed, with ``presence`` both/left_only/right_only."""
    a, b = names
    joined = _side(left, key, metrics, a).join(_side(right, key, metrics, b), key, how)
    presence = (
        F.when(F.col(f"_in_{a}").isNull(), "right_only")
        .when(F.col(f"_in_{b}").isNull(), "left_only")
        .otherwise("both")
    )
    return joined.withColumn("presence", presence).drop(f"_in_{a}", f"_in_{b}")


def _differs(metrics: list[str], names: tuple[str, str], tolerance: float) -> dict[str, Column]:
    a, b = names
    return {m: ~equal_within(F.col(f"{m}_{a}"), F.col(f"{m}_{b}"), tolerance) for m in metrics}


def reconcile(
    source: DataFrame, target: DataFrame, key: list[str], metrics: list[str],
    tolerance: float = TOLERANCE, how: str = "full_outer",
) -> DataFrame:
    """Every key with ``status``: missing (source only), extra (target only), different or ok.

    ``differing`` lists the differing columns. ``how="left"`` checks source rows only.
    """
    both = paired(source, target, key, metrics, how=how)
    differs = _differs(metrics, ("src", "dst"), tolerance)
    status = (
        F.when(F.col("presence") == "left_only", "missing")
        .when(F.col("presence") == "right_only", "extra")
        .when(any_of(list(differs.values())), "different")
        .otherwise("ok")
    )
    differing = F.when(F.col("presence") == "both", columns_where(differs)).otherwise(
        F.array().cast("array<string>")
    )
    return both.withColumns({"status": status, "differing": differing}).drop("presence")


def status_totals(compared: DataFrame, by: list[str] | None = None) -> DataFrame:
    return compared.groupBy(*(by or []), "status").agg(F.count(F.lit(1)).alias("total"))


def reconcile_exact(source: DataFrame, target: DataFrame, key: list[str], metrics: list[str]) -> DataFrame:
    """As ``reconcile`` with exact equality; two NULLs count as equal."""
    both = paired(source, target, key, metrics)
    differs = {m: ~F.col(f"{m}_src").eqNullSafe(F.col(f"{m}_dst")) for m in metrics}
    status = (
        F.when(F.col("presence") == "left_only", "missing")
        .when(F.col("presence") == "right_only", "extra")
        .when(any_of(list(differs.values())), "different")
        .otherwise("ok")
    )
    return both.withColumns(
        {"status": status, "differing": F.when(status == "different", columns_where(differs))}
    ).drop("presence")


def key_sets(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Each distinct key with the side(s) it occurs on.

    One grouped pass instead of two anti joins and a semi join.
    """
    both = left.select(*key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    sides = both.groupBy(*key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return sides.select(
        *key,
        F.when(F.col("_r") == 0, "left_only").when(F.col("_l") == 0, "right_only").otherwise("both").alias("side"),
    )


def metric_summary(
    left: DataFrame, right: DataFrame, key: list[str], metrics: list[str], tolerance: float = SITE_TOLERANCE,
) -> DataFrame:
    """Per metric: largest difference, comparable rows and rows over tolerance.

    A row is comparable when both sides have a value. All metrics are aggregated
    in one pass; only the single result row is turned into one row per metric.
    """
    both = paired(left, right, key, metrics, ("site", "ref"), how="inner")
    diff = {m: F.abs(F.col(f"{m}_site").cast("double") - F.col(f"{m}_ref").cast("double")) for m in metrics}
    wide = both.agg(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.max(d).alias("max_diff"),
                F.count(d).alias("comparable"),
                F.count(F.when(d > F.lit(tolerance), 1)).alias("over_tolerance"),
            ).alias(m)
            for m, d in diff.items()
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(m) for m in metrics])))


def presence_totals(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Rows matched, only on the left and only on the right."""
    return key_sets(left, right, key).groupBy("side").agg(F.count(F.lit(1)).alias("total"))


def worst_examples(
    left: DataFrame, right: DataFrame, key: list[str], metrics: list[str],
    tolerance: float = SITE_TOLERANCE, n: int = 10,
) -> DataFrame:
    """Per metric, the ``n`` over-tolerance rows with the smallest left value."""
    both = paired(left, right, key, metrics, ("site", "ref"), how="inner")
    entries = F.array(*[
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"{m}_site").cast("double").alias("site_value"),
            F.col(f"{m}_ref").cast("double").alias("ref_value"),
        )
        for m in metrics
    ])
    over = F.filter(entries, lambda e: F.abs(e["site_value"] - e["ref_value"]) > F.lit(tolerance))
    rank = F.row_number().over(Window.partitionBy("metric").orderBy("site_value", *key))
    return (
        both.select(*key, F.inline(over))
        .withColumn("position", rank)
        .filter(F.col("position") <= n)
    )


def examples_by_status(compared: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows of each status."""
    rank = F.row_number().over(Window.partitionBy("status").orderBy(*order))
    return compared.withColumn("position", rank).filter(F.col("position") <= n)


def long_form(
    source: DataFrame, target: DataFrame, key: list[str], metrics: list[str], tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per key and column: both values, exact and tolerant equality, difference."""
    both = paired(source, target, key, metrics, how="inner")
    entries = F.array(*[
        F.struct(
            F.lit(m).alias("campo"),
            F.col(f"{m}_src").cast("double").alias("origem"),
            F.col(f"{m}_dst").cast("double").alias("destino"),
        )
        for m in metrics
    ])
    a, b = F.col("origem"), F.col("destino")
    rows = both.select(*key, F.inline(entries)).withColumns({
        "equal_exact": a.eqNullSafe(b),
        "equal_tolerant": equal_within(a, b, tolerance),
        "difference": F.abs(a - b),
    })
    ok = F.col("equal_exact") | F.col("equal_tolerant")
    return rows.withColumn("status", F.when(ok, "ok").otherwise("different"))


def _matched_status(matched: DataFrame, metrics: list[str], tolerance: float) -> DataFrame:
    differs = {m: ~equal_within(F.col(m), F.col(f"{m}_dst"), tolerance) for m in metrics}
    return matched.withColumns({
        "status": F.when(F.col("match_ts").isNull(), "missing")
        .when(any_of(list(differs.values())), "different")
        .otherwise("ok"),
        "differing": F.when(F.col("match_ts").isNotNull(), columns_where(differs)).otherwise(
            F.array().cast("array<string>")),
    })


def _suffixed(target: DataFrame, ts: str, station: str, metrics: list[str]) -> DataFrame:
    return target.select(station, F.col(ts).alias("_dst_ts"), *[F.col(m).alias(f"{m}_dst") for m in metrics])


def reconcile_within(
    source: DataFrame, target: DataFrame, ts: str, station: str, metrics: list[str],
    seconds: float = 1.0, tolerance: float = TOLERANCE,
) -> DataFrame:
    """Source rows against the target row within ``±seconds`` of the same station."""
    matched = matching.within_seconds(
        source, _suffixed(target, ts, station, metrics), station, ts, "_dst_ts",
        [f"{m}_dst" for m in metrics], seconds,
    )
    return _matched_status(matched, metrics, tolerance)


def reconcile_period(
    source: DataFrame, target: DataFrame, ts: str, station: str, metrics: list[str],
    seconds: float = 3600.0, tolerance: float = TOLERANCE,
) -> DataFrame:
    """Source rows against the nearest target row by minute, tolerating a zone shift."""
    matched = matching.nearest_by_minute(
        source, _suffixed(target, ts, station, metrics), station, ts, "_dst_ts",
        [f"{m}_dst" for m in metrics], seconds,
    )
    return _matched_status(matched, metrics, tolerance)
