"""Ordered parquet exports.

Rows are split by ranges of (time, station): files follow each other in that order
and a busy year or instant is spread over as many tasks as its size needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.filters import years


def utc_instant(df: DataFrame, ts: str = "dia") -> DataFrame:
    """The time column as an instant; zone-less values mean UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def ordered(df: DataFrame, ts: str = "dia", station: str = "estacao_id") -> DataFrame:
    return df.repartitionByRange(ts, station).sortWithinPartitions(ts, station)


def export_by_year(df: DataFrame, path: str, ts: str = "dia", station: str = "estacao_id") -> None:
    """One folder ``ano=yyyy`` per year."""
    out = df.withColumn("ano", F.year(ts)).repartitionByRange(ts, station).sortWithinPartitions("ano", ts, station)
    utc_instant(out, ts).write.mode("overwrite").option("partitionOverwriteMode", "static").option(
        "compression", "snappy"
    ).partitionBy("ano").parquet(path)


def export_interval(df: DataFrame, path: str, first: int, last: int, ts: str = "dia", station: str = "estacao_id") -> None:
    """The years ``first..last``."""
    export_all(years(df, ts, first, last), path, ts, station)


def export_all(df: DataFrame, path: str, ts: str = "dia", station: str = "estacao_id") -> None:
    utc_instant(ordered(df, ts, station), ts).write.mode("overwrite").option("compression", "snappy").parquet(path)
