"""Stored marks: rows, first and last time per (month, station) of a stored table, kept beside it.

Watermarks, status and lag are read from the marks, which have one row per month and station however
many readings there are, so a sync does not scan its target. Whatever changes months of a table renews
the marks of these months (``renew``), which reads their time and station columns only. The change is
noted before it begins (``sinks.tables``); after a stop in between, the marks of the noted months are
renewed by whatever touches the table next. A table without marks gets them from one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gaugeworks.operators.filters import plausible, plausible_until
from gaugeworks.session import path_exists
from gaugeworks.sources.tables import read_table

MONTH, MARKS = "ano_mes", "_marks"


def _schema(table: StructType, ts: str, station: str) -> StructType:
    time, place = table[ts].dataType, table[station].dataType
    return StructType([
        StructField(station, place), StructField("rows", LongType()), StructField("first", time), StructField("last", time), StructField(MONTH, StringType()),
    ])


def of(table: DataFrame, ts: str, station: str) -> DataFrame:
    """The marks of a table by a scan of its time and station columns."""
    return table.groupBy(station, F.col(MONTH).cast("string").alias(MONTH)).agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first"), F.max(ts).alias("last")
    ).select(station, "rows", "first", "last", MONTH)


def _write(marks: DataFrame, path: str, dynamic: bool) -> None:
    writer = marks.hint("rebalance", F.col(MONTH)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").partitionBy(MONTH).parquet(f"{path}/{MARKS}")


def stored(spark: SparkSession, path: str, table: StructType, ts: str, station: str) -> DataFrame:
    """The marks beside a marked table with the columns ``table``."""
    return read_table(spark, f"{path}/{MARKS}", schema=_schema(table, ts, station))


def kept(spark: SparkSession, path: str) -> bool:
    """Whether the table has marks."""
    return path_exists(spark, f"{path}/{MARKS}")


def renew(spark: SparkSession, path: str, table: DataFrame, ts: str, station: str, months: list[str] | None = None) -> None:
    """Write the marks of ``months`` anew (all of them by default). Only these months are read."""
    rows = table if months is None else table.filter(F.col(MONTH).isin(months))
    _write(of(rows, ts, station), path, dynamic=months is not None)


def watermarks(marks: DataFrame, table: DataFrame, ts: str, station: str, as_of=None) -> DataFrame:
    """Newest time per station, as ``operators.watermarks.station_watermarks`` of the table.

    Given ``as_of``, future-dated rows are ignored. Marks that lie wholly on one side of that bound
    decide by themselves; months with marks across it, if there are any, are read for those alone.
    """
    known = marks.filter(F.col(station).isNotNull() & F.col("last").isNotNull())
    if as_of is None:
        return known.groupBy(station).agg(F.max("last").alias("watermark"))
    until = plausible_until(as_of)
    across = [r[0] for r in known.filter((F.col("last") > until) & (F.col("first") <= until)).select(MONTH).distinct().collect()]
    times = known.filter(F.col("last") <= until).select(station, F.col("last").alias("watermark"))
    if across:
        rows = table.filter(F.col(MONTH).isin(across) & F.col(station).isNotNull())
        times = times.unionByName(plausible(rows, ts, as_of).select(station, F.col(ts).alias("watermark")))
    return times.groupBy(station).agg(F.max("watermark").alias("watermark"))


def status(marks: DataFrame, station: str = "estacao_id") -> DataFrame:
    """One row, as ``operators.rollup.table_status`` of the table."""
    return marks.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_registros"), F.min("first").alias("data_minima"),
        F.max("last").alias("data_maxima"), F.countDistinct(station).alias("total_estacoes"),
    )
