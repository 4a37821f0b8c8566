"""Exports in slices that resume where they stopped.

Finished slices are noted in the table's own folder, under a name that readers skip. A run that was cut
short leaves its notes, and the next run begins with the first slice that is not among them; a slice that
was cut short is done again, which replaces its months. A complete run removes its notes, so that the run
after it starts over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from gaugeworks.session import path_exists

NOTES = "_slices"
Slice = tuple[int, str, str]


def finished(spark: SparkSession, path: str) -> list[str]:
    """The starts of the slices that an open run has finished."""
    if not path_exists(spark, f"{path}/{NOTES}"):
        return []
    return sorted(r["start"] for r in spark.read.schema("start string").json(f"{path}/{NOTES}").collect())


def _noted(spark: SparkSession, path: str, starts: list[str]) -> None:
    spark.createDataFrame([(s,) for s in starts], "start string").coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").json(f"{path}/{NOTES}")


def run(spark: SparkSession, path: str, slices: list[Slice], write: Callable[[Slice, bool], None], close: bool = True) -> list[Slice]:
    """Write the slices that are not finished, in order; returns those written.

    ``write(slice, first)`` writes one slice of the table at ``path``; ``first`` is set for the first slice of a
    run that starts over, which replaces the whole table. ``close=False`` leaves the run open.
    """
    done = finished(spark, path)
    written = []
    for piece in slices:
        if piece[1] in done:
            continue
        write(piece, not done)
        done.append(piece[1])
        _noted(spark, path, done)
        written.append(piece)
    if close:
        _noted(spark, path, [])
    return written
