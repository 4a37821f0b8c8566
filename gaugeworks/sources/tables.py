"""Scans of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.functions.timecols import month_key
from gaugeworks.operators.filters import closed, half_open, moment


def read_table(
    spark: SparkSession, path: str, merge_schema: bool = False, schema: StructType | None = None
) -> DataFrame:
    """A parquet table.

    With a declared ``schema`` no file is opened to find the columns, and columns
    added later are NULL in older files. ``merge_schema`` collects them from every
    file instead.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("mergeSchema", str(merge_schema and schema is None).lower()).parquet(path)


def scan_range(
    df: DataFrame, ts: str, start, end, include_end: bool = False,
    station: str | None = None, stations=None, month: str | None = "ano_mes",
) -> DataFrame:
    """Time range of a table, one or more stations.

    The month partition is not derivable from the time by the planner, so its
    bounds are added explicitly and whole folders are skipped.
    """
    rows = df
    if month and month in df.columns:
        rows = rows.filter(F.col(month).between(month_key(moment(start)), month_key(moment(end))))
    pick = closed if include_end else half_open
    return pick(rows, ts, start, end, station, stations)
