"""Schema and layout checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.session import path_exists


def schema_differences(actual: StructType, expected: StructType) -> list[tuple[str, str, str]]:
    """Columns of both schemas whose types differ: (name, actual type, expected type)."""
    wanted = {f.name.lower(): f.dataType.simpleString() for f in expected.fields}
    return [
        (f.name, f.dataType.simpleString(), wanted[f.name.lower()])
        for f in actual.fields
        if f.name.lower() in wanted and f.dataType.simpleString() != wanted[f.name.lower()]
    ]


def schema_diff(spark: SparkSession, actual: StructType, expected: StructType) -> DataFrame:
    return spark.createDataFrame(
        schema_differences(actual, expected), "coluna string, tipo_atual string, tipo_esperado string"
    )


def layout_check(df: DataFrame, partition: str, most: int | None = None) -> DataFrame:
    """One row on the partitioning of a table: partitions, granularity, verdict.

    Only the partition column is read. Months are accepted; days are rejected, as
    is any layout of more than ``most`` partitions, if given.
    """
    p = F.col(partition).cast("string")
    grain = (
        F.when(F.col("_months") == F.col("partitions"), "month")
        .when(F.col("_days") == F.col("partitions"), "day")
        .when(F.col("_years") == F.col("partitions"), "year")
        .otherwise("other")
    )
    # Partial distinct per task; one row per partition value is left to count.
    values = df.select(p.alias("p")).distinct()
    return (
        values.agg(
            F.count(F.lit(1)).alias("partitions"),
            F.count(F.when(F.col("p").rlike(r"^\d{4}-\d{2}$"), 1)).alias("_months"),
            F.count(F.when(F.col("p").rlike(r"^\d{4}-\d{2}-\d{2}$"), 1)).alias("_days"),
            F.count(F.when(F.col("p").rlike(r"^\d{4}$"), 1)).alias("_years"),
        )
        .withColumn("granularity", grain)
        .withColumn("accepted", (F.col("granularity") != "day") & (F.lit(True) if most is None else F.col("partitions") <= most))
        .drop("_months", "_days", "_years")
    )


def stored_layout(table: DataFrame, partition: str, most: int | None = None) -> DataFrame:
    """``layout_check`` of a stored table by the names of its folders; no file is opened."""
    names = {f.rsplit(f"/{partition}=", 1)[1].split("/", 1)[0] for f in table.inputFiles() if f"/{partition}=" in f}
    values = table.sparkSession.createDataFrame([(n,) for n in sorted(names)], f"{partition} string")
    return layout_check(values, partition, most)


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """A catalog table, or a folder that a reader can open."""
    if "/" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    return path_exists(spark, name_or_path)
