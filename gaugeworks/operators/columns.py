"""Canonical columns: renames, coercion, time columns, key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from gaugeworks.functions import timecols, values
from gaugeworks.schema import LOCAL_ZONE

# Source spellings of the canonical columns.
RENAMES = {
    "Dia": "dia_utc",
    "data_hora": "dia_utc",
    "id_estacao": "estacao_id",
    "nome_estacao": "estacao",
    "Estacao": "estacao",
}
AUXILIARY = ["TimezoneOffset", "leitura_id"]


def canonical_names(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename known source spellings; exact case, absent names are ignored."""
    names = RENAMES if renames is None else renames
    return df.toDF(*[names.get(c, c) for c in df.columns])


def drop_auxiliary(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    return df.drop(*(AUXILIARY if names is None else names))


def coerce_numbers(df: DataFrame, metrics: list[str], station: str | None = "estacao_id") -> DataFrame:
    """Metrics to double and the station id to a nullable integer, by case-insensitive name.

    Only text is parsed; numbers are cast.
    """
    wanted = {m.lower(): m for m in metrics}
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    out = []
    for c in df.columns:
        if c.lower() in wanted:
            out.append((values.to_double(F.col(c)) if c in text else F.col(c).cast("double")).alias(wanted[c.lower()]))
        elif station and c.lower() == station.lower():
            out.append((values.to_long(F.col(c)) if c in text else F.col(c).cast("bigint")).alias(station))
        else:
            out.append(F.col(c))
    return df.select(*out)


def add_time_columns(
    df: DataFrame, ts: str = "dia_utc", zone: str = LOCAL_ZONE, naive_zone: str = "UTC"
) -> DataFrame:
    """Fill ``dia_utc`` (UTC), ``dia`` (local), ``dia_original`` and ``utc_offset``."""
    kind = df.schema[ts].dataType.typeName()
    if kind == "string":
        utc = timecols.parse_text_utc(F.col(ts), naive_zone)
    elif kind == "timestamp_ntz":
        utc = timecols.to_utc(F.col(ts), naive_zone)
    else:
        utc = timecols.ntz(F.col(ts))
    u = F.col("dia_utc")
    return df.withColumn("dia_utc", utc).withColumns(
        {
            "dia": timecols.to_local(u, zone),
            "dia_original": timecols.original_text(u, zone),
            "utc_offset": timecols.offset_text(u, zone),
        }
    )


def require_time(df: DataFrame, ts: str = "dia_utc") -> DataFrame:
    """Drop rows without a time."""
    return df.filter(F.col(ts).isNotNull())


def null_time_report(df: DataFrame, ts: str = "dia_utc") -> DataFrame:
    """One row: rows kept and rows removed by ``require_time``."""
    return df.agg(
        F.count(ts).alias("kept"), (F.count(F.lit(1)) - F.count(ts)).alias("removed")
    )


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Exactly the contract's columns and types, matched by case-insensitive name.

    Values of another type are cast; a missing nullable column becomes NULL, a
    missing required one raises. The read side enforces non-null keys with
    ``require_time``, since a file format does not.
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in contract.fields:
        source = have.get(field.name.lower())
        if source is None and not field.nullable:
            raise ValueError(f"required column {field.name} is missing")
        value = F.col(source) if source else F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)
