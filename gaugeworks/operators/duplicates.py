"""Duplicate keys: counts, evidence and which version wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.filters import moment


def duplicated_keys(df: DataFrame, key: list[str], version: str | None = None) -> DataFrame:
    """Keys held by more than one row, with the row count and the winning version."""
    winner = [F.max(version).alias("winner")] if version else []
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("total"), *winner).filter(F.col("total") > 1)


def top_duplicates(df: DataFrame, key: list[str], n: int = 10) -> DataFrame:
    return duplicated_keys(df, key).orderBy(F.desc("total"), *key).limit(n)


def duplicate_count(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: how many keys are duplicated."""
    return duplicated_keys(df, key).agg(F.count(F.lit(1)).alias("total_duplicatas"))


def versions(df: DataFrame, key: list[str], version: str) -> DataFrame:
    """Every row of every duplicated key, with ``total`` and ``is_winner``."""
    return df.join(duplicated_keys(df, key, version), key, "inner").withColumn(
        "is_winner", F.col(version) == F.col("winner")
    )


def evidence(df: DataFrame, key: list[str], version: str, payload: list[str]) -> DataFrame:
    """One row per version of each duplicated key: how many there are, which wins, and its values.

    Versions stay rows, so a key may have any number of them.
    """
    return versions(df, key, version).select(
        *key, F.col("total").alias("quantidade"), F.col("winner").alias("id_vencedor"), F.col(version).alias("id"), *payload
    )


def winners(df: DataFrame, key: list[str], version: str, payload: list[str]) -> DataFrame:
    """The winning row of each duplicated key with the number of versions."""
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), version)
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("quantidade"), F.max(version).alias("id_vencedor"), best.alias("_w"))
        .filter(F.col("quantidade") > 1)
        .select(*key, "quantidade", "id_vencedor", "_w.*")
    )


def reading_versions(df: DataFrame, ts: str, station: str, version: str, at, station_id) -> DataFrame:
    """All versions of one reading, newest first."""
    return df.filter((F.col(ts) == moment(at)) & (F.col(station) == station_id)).orderBy(F.desc(version))
