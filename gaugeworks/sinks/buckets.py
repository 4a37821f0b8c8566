"""Bucketed tables: laid out by the key they are joined on.

Tables with the same number of buckets on their join keys are joined bucket by bucket, without a shuffle,
however often they are read. Rows are dealt to tasks as buckets are, so a bucket is one file. There are as
many buckets as the rows need: a task sorts one bucket of each table. A bucketed table lives in the catalog,
which keeps its layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

BUCKETS, MOST_BUCKETS = 8, 1 << 16  # Spark takes 100,000 by default
ROWS = 1 << 20  # of a bucket, at most on average


def bucket_count(*tables: DataFrame) -> int:
    """Buckets for ``tables`` that are joined with each other, by their rows together: a power of two."""
    rows, n = sum(t.count() for t in tables), BUCKETS
    while n * ROWS < rows and n < MOST_BUCKETS:
        n *= 2
    return n


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Replace the catalog table ``name`` by ``df`` in buckets of ``key``, sorted by it; returns the table.

    ``buckets``: by default what ``df`` needs by itself; tables that are joined take a common ``bucket_count``.
    ``path`` names its folder, by default one in the warehouse.
    """
    buckets = bucket_count(df) if buckets is None else buckets
    writer = df.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
