"""Relational source read in time slices, one task per slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession



def year_slices(first: int, last: int) -> list[tuple[int, str, str]]:
    """(year, start, end) for each year, half-open."""
    return [(y, f"{y}-01-01", f"{y + 1}-01-01") for y in range(first, last + 1)]


def month_slices(first: int, last: int) -> list[tuple[int, str, str]]:
    """As ``year_slices`` by month: more and smaller tasks."""
    out = []
    for y, _, _ in year_slices(first, last):
        for m in range(1, 13):
            after = f"{y + 1}-01-01" if m == 12 else f"{y}-{m + 1:02d}-01"
            out.append((y, f"{y}-{m:02d}-01", after))
    return out


def slice_predicates(column: str, slices: list[tuple[int, str, str]]) -> list[str]:
    """One predicate per slice, the first and last open-ended, and one for rows without a time.

    Together they take every row of the table once, whatever its time.
    """
    if not slices:
        raise ValueError("at least one slice is needed")
    c = f'"{column}"'
    bounds = [lo for _, lo, _ in slices[1:]]
    if bounds != [hi for _, _, hi in slices[:-1]] or bounds != sorted(set(bounds)):
        raise ValueError("slices must follow each other without a gap")
    cuts = [None, *bounds, None]
    ranges = [" AND ".join([*([f"{c} >= '{lo}'"] if lo else []), *([f"{c} < '{hi}'"] if hi else [])]) for lo, hi in zip(cuts, cuts[1:])]
    return [*[r or f"{c} IS NOT NULL" for r in ranges], f"{c} IS NULL"]


def read_sliced(
    spark: SparkSession, url: str, table: str, slices: list[tuple[int, str, str]], column: str = "horaLeitura",
    fetch_size: int = 10_000, properties: dict[str, str] | None = None,
) -> DataFrame:
    """A whole table over JDBC with one partition per slice; failed slices are retried by Spark."""
    return spark.read.jdbc(
        url,
        table,
        predicates=slice_predicates(column, slices),
        properties={"fetchsize": str(fetch_size), **(properties or {})},
    )


def read_keyed(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int,
    fetch_size: int = 10_000, properties: dict[str, str] | None = None,
) -> DataFrame:
    """A detail table without a time column, split on its numeric key."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties={"fetchsize": str(fetch_size), **(properties or {})},
    )
