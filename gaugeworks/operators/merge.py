"""Combining a batch with a target. Keys are compared exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.operators.columns import conform
from gaugeworks.operators.dedupe import latest


def upsert(target: DataFrame, batch: DataFrame, key: list[str], version: str | None = None) -> DataFrame:
    """Source wins: every batch row, plus target rows whose key is not in the batch.

    The batch must be unique on ``key``. With ``version`` the higher version wins
    instead, so batches may arrive in any order.
    """
    rows = batch.select(*target.columns)
    if version is not None:
        # Of equal versions the batch's stays, so that a replay changes nothing.
        both = target.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
        return latest(both, key, F.desc_nulls_last(version), F.desc("_new")).drop("_new")
    kept = target.join(rows.select(*key), key, "left_anti").select(*target.columns)
    return kept.unionByName(rows)


def absent_from(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Batch rows whose key the target does not hold (target wins).

    The batch must be unique on ``key``.
    """
    return batch.join(target.select(*key), key, "left_anti").select(*batch.columns)


def insert_if_absent(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    return target.unionByName(absent_from(target, batch, key).select(*target.columns))


def append_evolved(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append where either side may have columns the other lacks (filled with NULL)."""
    return target.unionByName(batch, allowMissingColumns=True)


def evolve(target: StructType, batch: StructType) -> StructType:
    """Target schema after an allowed change: new nullable fields, required to nullable.

    A changed type raises. Names are compared without case.
    """
    incoming = {f.name.lower(): f for f in batch.fields}
    out = StructType()
    for f in target.fields:
        new = incoming.pop(f.name.lower(), None)
        if new is not None and new.dataType != f.dataType:
            raise ValueError(f"column {f.name} changes type {f.dataType.simpleString()} -> {new.dataType.simpleString()}")
        out.add(f.name, f.dataType, f.nullable or new is None or new.nullable)
    for f in incoming.values():
        out.add(f.name, f.dataType, True)
    return out


def aligned(batch: DataFrame, target: StructType) -> DataFrame:
    """Batch in the evolved target schema."""
    return conform(batch, evolve(target, batch.schema))
