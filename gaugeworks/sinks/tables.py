"""Stored tables: monthly layout, reload, upsert, append.

A month may be large or hot. Rows are rebalanced by month rather than hashed to
one task per month, so the run time splits big months and packs small ones; files
are sorted by station, which lets scans for a station skip row groups.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gaugeworks.functions.timecols import month_key
from gaugeworks.operators import merge
from gaugeworks.operators.dedupe import latest_by_id
from gaugeworks.session import path_exists, work_dir
from gaugeworks.sinks import files, marks
from gaugeworks.sinks.marks import MONTH
from gaugeworks.sources.tables import read_table

# A change of a table that is under way. ``ready``: staged rows of whole months that replace them.
# ``moves`` and ``gone``: staged files that come in the place of others. ``months``: whose marks follow.
NOTE = "ready string, columns array<string>, moves array<struct<source:string,target:string>>, gone array<string>, months array<string>"
NOTE_NAME = "_replacing"


def _write(df: DataFrame, path: str, mode: str, dynamic: bool, ts: str, station: str) -> None:
    (
        df.sortWithinPartitions(MONTH, station, ts)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .option("compression", "snappy")
        .partitionBy(MONTH)
        .parquet(path)
    )


def by_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(MONTH, month_key(F.col(ts))).hint("rebalance", F.col(MONTH))


def reload_table(
    df: DataFrame, path: str, ts: str = "dia_utc", station: str = "estacao_id", marked: bool = False,
    observed: tuple[Observation, list[Column]] | None = None,
) -> None:
    """Replace the whole table in one job. ``marked`` keeps marks beside it (``sinks.marks``).

    ``observed`` are aggregates that the last stage counts while it writes.
    """
    rows = by_month(df, ts)
    if observed:
        rows = rows.observe(observed[0], *observed[1])
    _write(rows, path, "overwrite", False, ts, station)
    if marked:
        start_marks(df.sparkSession, path, with_month(df.schema), ts, station)


def reload_months(df: DataFrame, path: str, ts: str = "dia_utc", station: str = "estacao_id") -> None:
    """Replace only the months present in ``df`` (a slice of the history).

    The months of a marked table are found first, from the times of ``df``.
    """
    spark = df.sparkSession
    months = []
    if marks.kept(spark, path):
        months = [r[0] for r in df.select(month_key(F.col(ts)).alias(MONTH)).distinct().collect()]
        finish_open(spark, path, ts, station)
        _note(spark, path, months=months)
    _write(by_month(df, ts), path, "overwrite", True, ts, station)
    if months:
        _renewed(spark, path, with_month(df.schema), months, ts, station)
        _note(spark, path)


def start_marks(spark: SparkSession, path: str, schema: StructType, ts: str = "dia_utc", station: str = "estacao_id") -> DataFrame:
    """The marks of a table, from one scan where it has none yet. ``schema`` includes the month."""
    finish_open(spark, path, ts, station)
    if not marks.kept(spark, path):
        # Without months the note asks for all marks anew, should the scan be cut short.
        _note(spark, path, months=None)
        marks.renew(spark, path, read_table(spark, path, schema=schema), ts, station)
        _note(spark, path)
    return marks.stored(spark, path, schema, ts, station)


def stored_marks(spark: SparkSession, path: str, schema: StructType, ts: str = "dia_utc", station: str = "estacao_id") -> tuple[DataFrame, DataFrame]:
    """A table with the columns ``schema`` (without the month) and its marks, none of whose changes is open."""
    columns = with_month(schema)
    kept = start_marks(spark, path, columns, ts, station)
    return read_table(spark, path, schema=columns), kept


def stored_watermarks(spark: SparkSession, path: str, schema: StructType, as_of=None, ts: str = "dia_utc", station: str = "estacao_id") -> DataFrame:
    """Newest time per station by the marks beside the table, as a plain UTC time."""
    table, kept = stored_marks(spark, path, schema, ts, station)
    return marks.watermarks(kept, table, ts, station, as_of).withColumn("watermark", F.col("watermark").cast("timestamp_ntz"))


def _renewed(spark: SparkSession, path: str, schema: StructType | None, months: list[str] | None, ts: str, station: str) -> None:
    if marks.kept(spark, path) or months is None:
        marks.renew(spark, path, read_table(spark, path, schema=schema), ts, station, months)


def _staged(spark: SparkSession, df: DataFrame, ts: str, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, cutting its lineage.

    The schema is declared, since an empty batch leaves no file to read it from.
    """
    path = work_dir(spark, label)
    by_month(df, ts).write.mode("errorifexists").partitionBy(MONTH).parquet(path)
    return read_table(spark, path, schema=with_month(df.schema))


def _months(staged: DataFrame) -> list[str]:
    """Calendar months of a staged batch. Every row of a stored table needs its time."""
    months = [r[0] for r in staged.select(MONTH).distinct().collect()]
    if None in months or any(m.startswith("__HIVE") for m in months):
        raise ValueError("the batch has rows without a time; drop them first (columns.require_time)")
    return months


def _emptied(staged: DataFrame) -> None:
    """Removes the rows of a staged batch; an empty folder stays."""
    (path,) = {f.rsplit(f"/{MONTH}=", 1)[0] for f in staged.inputFiles()} or {None}
    if path:
        none = staged.sparkSession.createDataFrame([], staged.schema)
        none.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _note(spark: SparkSession, path: str, **entry) -> None:
    """Note a change that begins; without an entry, that it has ended. Readers skip the note's name."""
    fields = ["ready", "columns", "moves", "gone", "months"]
    rows = [tuple(entry.get(f) for f in fields)] if entry else []
    spark.createDataFrame(rows, NOTE).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").json(f"{path}/{NOTE_NAME}")


def _replace_months(spark: SparkSession, path: str, rows: DataFrame, columns: list[str], ts: str, station: str) -> None:
    """Replace the months of ``rows``, noting it first, so that a stop in between loses nothing."""
    ready = _staged(spark, rows, ts, "merged")
    found = ready.inputFiles()
    if not found:
        return
    months = sorted({_month_of(f) for f in found})
    _note(spark, path, ready=found[0].rsplit(f"/{MONTH}=", 1)[0], columns=columns, months=months)
    _write(ready.select(*columns), path, "overwrite", True, ts, station)
    _renewed(spark, path, None, months, ts, station)
    _note(spark, path)
    _emptied(ready)


def _month_of(file: str) -> str:
    return file.rsplit(f"/{MONTH}=", 1)[1].split("/", 1)[0]


def finish_open(spark: SparkSession, path: str, ts: str = "dia_utc", station: str = "estacao_id") -> bool:
    """Finish a change of the table that was cut short, if there is one."""
    if not path_exists(spark, f"{path}/{NOTE_NAME}"):
        return False
    entries = spark.read.schema(NOTE).json(f"{path}/{NOTE_NAME}").collect()
    for entry in entries:
        ready = None
        if entry["ready"]:
            ready = spark.read.parquet(entry["ready"])
            _write(ready.select(*entry["columns"]), path, "overwrite", True, ts, station)
        if entry["moves"]:
            _exchange(spark, [(m["source"], m["target"]) for m in entry["moves"]], entry["gone"] or [])
        if entry["months"] is not None or ready is None:
            _renewed(spark, path, None, entry["months"], ts, station)
        _note(spark, path)
        if ready is not None:
            _emptied(ready)
    return bool(entries)


def _exchange(spark: SparkSession, moves: list[tuple[str, str]], gone: list[str]) -> None:
    """Bring in staged files, then take out those they replace. Doing it again changes nothing."""
    for source, target in moves:
        if not files.move(spark, source, target) and not path_exists(spark, target):
            raise OSError(f"{source} is lost")
    for file in gone:
        files.remove(spark, file)


def upsert_table(
    spark: SparkSession, path: str, batch: DataFrame, key: list[str],
    ts: str = "dia_utc", station: str = "estacao_id", version: str | None = None,
) -> None:
    """Merge a batch into the table, rewriting only the months it touches.

    The key must contain ``ts``, so a key never changes month; rows without a time
    raise. The merged months are complete in the shared folder before the table is
    touched, and noted there: a replacement that was cut short is finished by
    whatever changes the table next (or by ``finish_open``).
    """
    if ts not in key:
        raise ValueError("the key must contain the time column")
    finish_open(spark, path, ts, station)
    staged = _staged(spark, batch, ts, "batch")
    months = _months(staged)
    if not months:
        return
    table = read_table(spark, path)
    touched = table.filter(F.col(MONTH).isin(months)).drop(MONTH)
    merged = merge.upsert(touched, staged.drop(MONTH), key, version)
    _replace_months(spark, path, merged, table.columns, ts, station)
    _emptied(staged)


def append_absent(
    spark: SparkSession, path: str, batch: DataFrame, key: list[str],
    ts: str = "dia_utc", station: str = "estacao_id", schema: StructType | None = None,
) -> None:
    """Append rows whose key the table does not hold; existing rows win.

    New nullable columns are added to the table. ``schema`` declares its columns;
    without it they are merged from its files. Running it twice adds nothing the
    second time.
    """
    finish_open(spark, path, ts, station)
    staged = _staged(spark, batch, ts, "batch")
    months = _months(staged)
    if not months:
        return
    table = read_table(spark, path, True, with_month(schema) if schema else None)
    held = table.filter(F.col(MONTH).isin(months))
    fresh = merge.absent_from(held, staged.drop(MONTH), key)
    plain = table.drop(MONTH)
    marked = marks.kept(spark, path)
    if marked:
        _note(spark, path, months=months)
    _write(by_month(merge.aligned(fresh, plain.schema), ts), path, "append", False, ts, station)
    if marked:
        _renewed(spark, path, table.schema, months, ts, station)
        _note(spark, path)
    _emptied(staged)


def upsert_files(
    spark: SparkSession, path: str, batch: DataFrame, key: list[str],
    ts: str = "dia_utc", station: str = "estacao_id", version: str | None = None,
) -> tuple[int, int]:
    """Merge a batch into the table, rewriting only the files that hold its keys; all others stay as they are.

    The result is that of ``upsert_table``. Files with keys of the batch are found by a semi join over the
    keys of its months; their names are collected, never their rows. The new files are complete in the
    shared folder and noted, with those they replace, before the table changes; whatever changes the table
    next finishes an exchange that was cut short. New files come in before old ones go: a reader in between
    may see a row twice, but misses none. Returns how many files came and went.
    """
    if ts not in key:
        raise ValueError("the key must contain the time column")
    finish_open(spark, path, ts, station)
    staged = _staged(spark, batch, ts, "batch")
    months = _months(staged)
    if not months:
        return 0, 0
    table = read_table(spark, path)
    keys = table.filter(F.col(MONTH).isin(months)).select(*key, F.col("_metadata.file_path").alias("_file"))
    found = keys.join(staged.select(*key), key, "left_semi").select("_file").distinct().collect()
    gone = sorted(unquote(r[0]) for r in found)
    plain = table.drop(MONTH)
    held = spark.read.schema(table.schema).option("basePath", path).parquet(*gone).drop(MONTH) if gone else plain.limit(0)
    merged = merge.upsert(held, staged.drop(MONTH), key, version)
    folder = work_dir(spark, "files")
    _write(by_month(merged.select(*plain.columns), ts), folder, "errorifexists", False, ts, station)
    come = spark.read.schema(table.schema).parquet(folder).inputFiles()
    moves = [(unquote(f), f"{path}/{MONTH}={_month_of(f)}/{f.rsplit('/', 1)[1]}") for f in come]
    _note(spark, path, moves=moves, gone=gone, months=months)
    _exchange(spark, moves, gone)
    _renewed(spark, path, table.schema, months, ts, station)
    _note(spark, path)
    _emptied(staged)
    return len(moves), len(gone)


def with_month(schema: StructType) -> StructType:
    """A contract with the partition column of its stored table."""
    return StructType([*schema.fields, StructField(MONTH, StringType(), True)])


# --- tables of versions: cheap frequent writes, resolved on read ---


def append_versions(df: DataFrame, path: str, ts: str = "dia_utc", station: str = "estacao_id") -> None:
    """Add rows without looking at the table; a key may then have several versions. Such a table has no marks."""
    if marks.kept(df.sparkSession, path):
        raise ValueError("a marked table takes batches, not versions")
    _write(by_month(df, ts), path, "append", False, ts, station)


def current(table: DataFrame, key: list[str], version: str) -> DataFrame:
    """The table as an upsert would have left it: the highest version of each key."""
    return latest_by_id(table, key, version)


def compact(
    spark: SparkSession, path: str, months: list[str], key: list[str], version: str,
    ts: str = "dia_utc", station: str = "estacao_id",
) -> None:
    """Replace the given months by their current rows."""
    finish_open(spark, path, ts, station)
    table = read_table(spark, path)
    rows = current(table.filter(F.col(MONTH).isin(months)).drop(MONTH), key, version)
    _replace_months(spark, path, rows, table.columns, ts, station)
