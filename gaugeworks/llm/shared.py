"""Session settings, checkpoints and column helpers of the text operators."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import work_dir

# Long texts travel to Python in small batches, so that a worker holds a few of them at a time.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def prepared(spark: SparkSession) -> SparkSession:
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    # Workers on this machine import the package from where the driver has it; a cluster gets it shipped.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder; its lineage ends there."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_dir(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    return [n if n.lower() not in have else f"{n}_{uuid.uuid4().hex[:8]}" for n in names]


def crc_mod(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % modulus
