"""Checks of the source before a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.timecols import month_key
from gaugeworks.session import settled

TOP = 10


def by_key(readings: DataFrame, rain: DataFrame, stations: DataFrame) -> DataFrame:
    """(dia, estacao_id, lidas, chuvas, total): per key its readings, their rain rows, and rows of the full join.

    Rain rows are counted per reading before the one join, in which either side may lack the other. Rain
    without a reading has no time. Ids of readings are unique.
    """
    per_reading = rain.groupBy(F.col("leitura_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    known = stations.select(F.col("id").alias("_sid"), F.lit(True).alias("_known"))
    both = readings.select("id", F.col("horaLeitura").alias("dia"), "estacao_id").join(per_reading, F.col("id") == F.col("_id"), "full_outer")
    both = both.join(known, F.col("estacao_id") == F.col("_sid"), "left")
    return both.groupBy("dia", "estacao_id").agg(
        F.count("id").alias("lidas"), F.coalesce(F.sum("_n"), F.lit(0)).alias("chuvas"),
        F.coalesce(F.sum(F.when(F.col("_known") & F.col("id").isNotNull(), F.col("_n"))), F.lit(0)).alias("total"),
    )


def summary(keys: DataFrame, first_month: str) -> DataFrame:
    """By year of the full join (``ano``, NULL where a key has none), and over all (``tudo``), in one aggregation."""
    joined, read = F.col("total") > 0, F.col("lidas") > 0
    year = F.when(joined, F.year("dia")).cast("bigint").alias("ano")
    return keys.select("*", year).rollup("ano").agg(
        F.grouping("ano").cast("boolean").alias("tudo"),
        F.sum("lidas").alias("total_leitura"), F.min(F.when(read, F.col("dia"))).alias("data_min_leitura"), F.max(F.when(read, F.col("dia"))).alias("data_max_leitura"),
        F.sum("chuvas").alias("total_chuva"), F.coalesce(F.sum("total"), F.lit(0)).alias("total_com_join"),
        F.min(F.when(joined, F.col("dia"))).alias("data_min"), F.max(F.when(joined, F.col("dia"))).alias("data_max"),
        F.count(F.when(F.col("total") > 1, 1)).alias("total_duplicatas"),
        F.coalesce(F.sum(F.when(month_key(F.col("dia")) == first_month, F.col("total"))), F.lit(0)).alias("primeiro_mes"),
    )


def _coverage(found: DataFrame) -> DataFrame:
    names = ["total_leitura", "data_min_leitura", "data_max_leitura", "total_chuva", "total_com_join", "data_min", "data_max"]
    return found.filter("tudo").select(*names)


def join_coverage(readings: DataFrame, rain: DataFrame, stations: DataFrame) -> DataFrame:
    """One row: rows of both tables, rows joined, and first and last time before and after, from one join."""
    return _coverage(summary(by_key(readings, rain, stations), ""))


def diagnose(
    readings: DataFrame, rain: DataFrame, stations: DataFrame, first_month: str = "1997-01"
) -> dict[str, DataFrame]:
    """The source reports: coverage, years, first month, duplicated keys and their number.

    One job computes all of them: the summary and the most duplicated keys share one join and one
    aggregation by key. Its few rows are kept in the shared folder, from which the reports read.
    """
    keys = by_key(readings, rain, stations)
    top = keys.filter("total > 1").orderBy(F.desc("total"), "dia", "estacao_id").limit(TOP).select("dia", "estacao_id", "total")
    found = summary(keys, first_month).unionByName(top.withColumns({"tudo": F.lit(None).cast("boolean")}), allowMissingColumns=True)
    found = settled(found.coalesce(1), "diagnosis")
    whole, years = found.filter("tudo"), found.filter("NOT tudo AND total_com_join > 0")
    return {
        "coverage": _coverage(found),
        "years": years.select("ano", F.col("total_com_join").alias("total_registros")),
        "first_month": whole.select(F.col("primeiro_mes").alias("total")),
        "duplicates": found.filter("tudo IS NULL").select("dia", "estacao_id", "total"),
        "duplicate_count": whole.select("total_duplicatas"),
    }
