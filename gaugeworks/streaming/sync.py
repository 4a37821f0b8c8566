"""Continuous and one-shot sync of new files into a stored table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gaugeworks.functions.timecols import month_key, shift
from gaugeworks.operators.contracts import table_exists
from gaugeworks.operators.dedupe import latest_by_id
from gaugeworks.operators.filters import last_hours, moment
from gaugeworks.sinks.tables import MONTH, append_versions, reload_table, upsert_table
from gaugeworks.sources.tables import read_table


def read_feed(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """New files of a folder as they arrive. Streams need a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def sync_stream(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    key: list[str],
    version: str,
    ts: str = "dia_utc",
    station: str = "estacao_id",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    every: str | None = None,
    merge_on_read: bool = False,
) -> StreamingQuery:
    """Upsert each micro-batch by key; the highest version of a key stays.

    Replaying a batch after a failure changes nothing, and rows may be late or out
    of order by any amount, since keys decide. ``every`` (for example
    ``"5 minutes"``) runs continuously; without it the backlog is processed once.

    By default a batch rewrites the months it touches and the table has one row
    per key. Where months are large and batches frequent, ``merge_on_read`` only
    appends; read with ``sinks.tables.current`` and run ``compact`` now and then.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = latest_by_id(prepare(batch), key, version)
        if merge_on_read:
            append_versions(rows, path, ts, station)
        elif table_exists(spark, path):
            upsert_table(spark, path, rows, key, ts, station, version)
        elif not rows.isEmpty():
            reload_table(rows, path, ts, station)

    writer = feed.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def dedupe_feed(feed: DataFrame, key: list[str], ts: str, delay: str) -> DataFrame:
    """First arrival of each key within ``delay``; later ones beyond it are not tracked."""
    return feed.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


def live_view(spark: SparkSession, path: str, ts: str, hours: int, as_of) -> DataFrame:
    """Last hours of the table, newest first, read at call time; only their months are opened."""
    table, now = read_table(spark, path), moment(as_of)
    if MONTH in table.columns:
        # No upper bound on the time, so none on the month either.
        table = table.filter(F.col(MONTH) >= month_key(shift(now, hours=-hours)))
    return last_hours(table, ts, hours, as_of).orderBy(F.desc(ts))
