"""Reconciliation by digests: only groups of rows whose digests differ are joined.

A digest sums up the rows of a group without regard to their order: how many there are, and the exclusive
or of two 64-bit hashes over key and metrics. Two copies are digested by coarse groups first (months), the
groups that differ by finer ones (months and station buckets, then days), and only the rows of groups that
still differ are shuffled and joined. Where copies are mostly equal this reads each side once per level and
shuffles little more than the differences.

Keys are unique on each side. Groups with equal rows have equal digests; different rows pass as equal with
a probability of 2 ** -128. Columns should have the same types on both sides: otherwise all groups differ,
which costs time but changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.timecols import month_key
from gaugeworks.operators.compare import reconcile, reconcile_exact
from gaugeworks.session import settled

BUCKETS = 64


def levels(ts: str, station: str, buckets: int = BUCKETS) -> list[dict[str, Column]]:
    """Months, station buckets of months, days of these: each level is finer than the one before."""
    month = {"_month": month_key(F.col(ts))}
    bucket = {**month, "_bucket": F.pmod(F.xxhash64(station), F.lit(buckets)).cast("int")}
    return [month, bucket, {**bucket, "_day": F.to_date(ts)}]


def digests(df: DataFrame, by: list[str], key: list[str], metrics: list[str]) -> DataFrame:
    """(by..., rows, a, b): one row per group, combined before the shuffle."""
    # Null flags, since a null is skipped by the hash.
    fields = [c for name in (*key, *metrics) for c in (F.col(name), F.isnull(name))]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*fields)).alias("a"), F.bit_xor(F.xxhash64(F.lit("second"), *fields)).alias("b")
    )


def _within(df: DataFrame, groups: DataFrame | None, by: list[str], how: str = "left_semi") -> DataFrame:
    if groups is None:
        return df
    on = [df[c].eqNullSafe(groups[c]) for c in by]
    return df.join(groups, on, how)


def unequal_groups(
    source: DataFrame, target: DataFrame, key: list[str], metrics: list[str], steps: list[dict[str, Column]],
) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """Both sides with the columns of the groups, the groups of the last level that differ, and their columns.

    The groups of each level are stored in the shared folder, so the next one is planned by their size.
    """
    source, target = source.withColumns(steps[-1]), target.withColumns(steps[-1])
    groups, by = None, []
    for step in steps:
        found = []
        for side in (source, target):
            found.append(digests(_within(side, groups, by), list(step), key, metrics))
        left, right = (d.select(*[F.col(c).alias(f"{c}{n}") for c in step], F.struct("rows", "a", "b").alias(f"digest{n}")) for n, d in enumerate(found))
        both = left.join(right, [F.col(f"{c}0").eqNullSafe(F.col(f"{c}1")) for c in step], "full_outer")
        # A group of one side only has no digest on the other.
        names = [F.when(F.col("digest0").isNotNull(), F.col(f"{c}0")).otherwise(F.col(f"{c}1")).alias(c) for c in step]
        groups, by = settled(both.filter(~F.col("digest0").eqNullSafe(F.col("digest1"))).select(*names), "digests"), list(step)
    return source, target, groups, by


def reconcile_by_digests(
    source: DataFrame, target: DataFrame, key: list[str], metrics: list[str],
    ts: str, station: str, tolerance: float | None = None, steps: list[dict[str, Column]] | None = None,
) -> DataFrame:
    """The rows of ``compare.reconcile_exact``, or of ``reconcile`` given a ``tolerance``.

    Rows of equal groups are ``ok`` as they stand and are taken from the source without a join.
    """
    source, target, groups, by = unequal_groups(source, target, key, metrics, steps or levels(ts, station))
    a, b = _within(source, groups, by).drop(*by), _within(target, groups, by).drop(*by)
    joined = reconcile_exact(a, b, key, metrics) if tolerance is None else reconcile(a, b, key, metrics, tolerance)
    none = F.lit(None) if tolerance is None else F.array()
    alike = _within(source, groups, by, "left_anti").select(
        *key, *[F.col(m).alias(f"{m}_src") for m in metrics], *[F.col(m).alias(f"{m}_dst") for m in metrics],
        F.lit("ok").alias("status"), none.cast("array<string>").alias("differing"),
    )
    return joined.unionByName(alike)
