"""Pages, top rows and spot-check samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.operators.filters import moment

DEFAULT_PAGE = 1_000


def page(
    df: DataFrame, ts: str, ties: list[str], limit: int = DEFAULT_PAGE, offset: int = 0, after: tuple | None = None
) -> DataFrame:
    """``limit`` rows, newest first; ``ties`` make the order total.

    ``after`` holds the time and ties of the last row of the page before: rows up to it
    are filtered while scanning, so a deep page costs no more than the first, where
    ``offset`` has to sort all rows it skips. Times and ties must not be NULL then.
    """
    order = [F.desc(ts), *[F.asc(t) for t in ties]]
    if after is not None:
        last = [moment(after[0]), *[F.lit(v) for v in after[1:]]]
        beyond = F.lit(False)
        for column, value in reversed(list(zip(ties, last[1:]))):
            beyond = (F.col(column) > value) | ((F.col(column) == value) & beyond)
        df = df.filter((F.col(ts) < last[0]) | ((F.col(ts) == last[0]) & beyond))
    return df.orderBy(*order).offset(offset).limit(limit)


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def last_readings(df: DataFrame, ts: str, station: str, station_id, ties: list[str], n: int = 10) -> DataFrame:
    """The newest ``n`` readings of one station."""
    return df.filter(F.col(station) == station_id).orderBy(F.desc(ts), *[F.desc(t) for t in ties]).limit(n)


def last_per_station(df: DataFrame, ts: str, station: str, ties: list[str], n: int = 10) -> DataFrame:
    """The newest ``n`` readings of every station, limited per task before the shuffle."""
    order = [F.desc(ts), *[F.desc(t) for t in ties]]
    rank = F.row_number().over(Window.partitionBy(station).orderBy(*order))
    return df.withColumn("position", rank).filter(F.col("position") <= n)


def latest_reading(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.max(ts).alias("latest"))


def top_stations(df: DataFrame, name: str = "estacao", n: int = 5) -> DataFrame:
    """Station names with the most rows."""
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("total")).orderBy(F.desc("total"), name).limit(n)


def sample(df: DataFrame, key: list[str], n: int = 50, seed: str = "") -> DataFrame:
    """``n`` rows in the order of a hash of the key: random-looking and repeatable."""
    text = F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in key]) if (seed or len(key) > 1) else F.col(key[0]).cast("string")
    return df.orderBy(F.md5(text), *key).limit(n)


def first_rows(df: DataFrame, order: list[str], n: int = 100) -> DataFrame:
    return df.orderBy(*order).limit(n)
