"""Versions of a stored table's columns, kept beside the data.

Readers declare the newest version, so no file is opened to find columns and older files show the columns
they lack as NULL. Appends may bring new columns: the version is written before the rows that need it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.operators.merge import evolve
from gaugeworks.session import path_exists
from gaugeworks.sinks import tables as sink
from gaugeworks.sources.tables import read_table

VERSIONS, ROW = "_columns", "version int, fields string"


def versions(spark: SparkSession, path: str) -> list[StructType]:
    """All versions, the oldest first; a table without any has none."""
    if not path_exists(spark, f"{path}/{VERSIONS}"):
        return []
    rows = spark.read.schema(ROW).json(f"{path}/{VERSIONS}").collect()
    return [StructType.fromDDL(r["fields"]) for r in sorted(rows, key=lambda r: r["version"])]


def record(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """The newest version after ``schema`` has been taken in; a changed type raises."""
    known = versions(spark, path)
    newest = evolve(known[-1], schema) if known else StructType([f for f in schema.fields])
    if not known or newest.simpleString() != known[-1].simpleString():
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in newest.fields)
        spark.createDataFrame([(len(known) + 1, ddl)], ROW).coalesce(1).write.mode("append").json(f"{path}/{VERSIONS}")
    return newest


def reload_recorded(df: DataFrame, path: str, ts: str = "dia_utc", station: str = "estacao_id") -> None:
    """``reload_table``, whose columns become the first version."""
    sink.reload_table(df, path, ts, station)
    record(df.sparkSession, path, df.schema)


def append_recorded(spark: SparkSession, path: str, batch: DataFrame, key: list[str], ts: str = "dia_utc", station: str = "estacao_id") -> None:
    """``append_absent`` by the recorded columns, which take in those of the batch first."""
    sink.append_absent(spark, path, batch, key, ts, station, record(spark, path, batch.schema))


def read_recorded(spark: SparkSession, path: str) -> DataFrame:
    """The table with the columns of its newest version and its month."""
    return read_table(spark, path, schema=sink.with_month(versions(spark, path)[-1]))


def history(spark: SparkSession, path: str) -> DataFrame:
    """(versao, coluna, tipo) of every column in the version that brought it."""
    rows, seen = [], set()
    for number, version in enumerate(versions(spark, path), 1):
        for f in version.fields:
            if f.name.lower() not in seen:
                seen.add(f.name.lower())
                rows.append((number, f.name, f.dataType.simpleString()))
    return spark.createDataFrame(rows, "versao int, coluna string, tipo string").select(F.col("versao").cast("bigint").alias("versao"), "coluna", "tipo")
