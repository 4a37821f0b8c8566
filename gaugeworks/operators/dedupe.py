"""One row per key: the latest version wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The whole first row of each key under ``order`` (for example newest id first).

    The rank filter is planned with a row limit per key before the shuffle, so a
    key with any number of copies sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_by_id(df: DataFrame, key: list[str], version: str, ties: list[str] | None = None) -> DataFrame:
    """Highest ``version`` wins; ``ties`` (all descending) make equal versions deterministic."""
    order = [F.col(version).desc_nulls_last()] + [F.col(t).desc_nulls_last() for t in ties or []]
    return latest(df, key, *order)


def keep_last(df: DataFrame, key: list[str], position: list[str]) -> DataFrame:
    """Drop duplicates keeping the last row in the order of ``position``."""
    return latest(df, key, *[F.col(p).desc_nulls_last() for p in position])
