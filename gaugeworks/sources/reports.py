"""Published station reports as text.

Fixed layout: free text, a header line with ``Dia``, ``Hora`` and ``Chuva``, a
units line, then ``dd/MM/yyyy HH:mm:ss`` and six values (seven with a leading
flag). Lines are parsed where they are read, so files of any size split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions import timecols
from gaugeworks.functions.values import any_of, token_to_double
from gaugeworks.operators.dedupe import latest
from gaugeworks.schema import LOCAL_ZONE
from gaugeworks.session import settled

# --- fixed values: report columns, header names and fragments, separators, date layouts ---
REPORT_METRICS = ["chuva", "dirvento", "velvento", "temperatura", "pressao", "umidade"]
HEADER_PARTS = {
    "chuva": ["chuva", "precip"],
    "dirvento": ["direc"],
    "velvento": ["veloc"],
    "temperatura": ["temperat"],
    "pressao": ["press"],
    "umidade": ["umid"],
}
TIME_NAMES = ["data_hora", "timestamp", "datahora"]
DAY_NAME, DAY_PREFIX, HOUR_PART, NOT_HOUR_PART = "dia", "data", "hora", "direc"
SEPARATORS = ["\t", ";", ","]
DAY_FIRST = ["dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm"]
# --- end of fixed values ---

_DATE = r"^\d{2}/\d{2}/\d{4}$"
_TIME = r"^\d{2}:\d{2}:\d{2}$"
_ACCENTED, _PLAIN = "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn"


def decoded(value: Column) -> Column:
    """A line as text: UTF-8 where valid, else Latin-1; a byte order mark is removed."""
    text = F.when(F.is_valid_utf8(value), value).otherwise(F.decode(F.to_binary(F.hex(value), F.lit("hex")), "ISO-8859-1"))
    return F.regexp_replace(text, "^﻿", "")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of the files as ``linha`` with their file name ``arquivo`` and path ``caminho``.

    Files are told apart by their path: those of a station have one name in every folder.
    """
    return spark.read.text(paths).select(
        decoded(F.col("value")).alias("linha"), F.col("_metadata.file_name").alias("arquivo"), F.col("_metadata.file_path").alias("caminho"),
        # Place in the file: lines of a block keep their order.
        F.struct(F.col("_metadata.file_block_start").alias("bloco"), F.monotonically_increasing_id().alias("nth")).alias("posicao"),
    )


def _file(lines: DataFrame) -> list[str]:
    """The columns that name a file; lines that were not read from files may have a name only."""
    return ["arquivo", "caminho"] if "caminho" in lines.columns else ["arquivo"]


def _is_header(line: Column) -> Column:
    s = F.trim(line)
    return s.startswith("Dia ") & s.contains("Hora") & s.contains("Chuva")


def files_without_header(lines: DataFrame) -> DataFrame:
    """Files that are not station reports."""
    return (
        lines.groupBy(*_file(lines))
        .agg(F.max(_is_header(F.col("linha"))).alias("_ok"))
        .filter(~F.col("_ok"))
        .drop("_ok")
    )


def with_site_times(df: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Drop rows without a local time and add ``ts_utc`` (NULL for a repeated local time)."""
    return df.filter(F.col("ts_site").isNotNull()).withColumn("ts_utc", timecols.local_to_utc(F.col("ts_site"), zone))


def parse_report(lines: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """``ts_site, ts_utc``, six metrics and the file for every data line.

    A line is split into date, time, then six values, or seven with a flag first.
    Exploding the list of accepted splits (none or one) keeps the planner from
    splitting the line again for every condition and value.
    """

    def is_data(t: Column) -> Column:
        known = F.size(t).isin(2 + len(REPORT_METRICS), 3 + len(REPORT_METRICS))
        return known & t[0].rlike(_DATE) & t[1].rlike(_TIME)

    split = F.array(F.split(F.trim("linha"), r"\s+"))
    rows = lines.select(F.explode(F.filter(split, is_data)).alias("_t"), *_file(lines)).withColumn(
        "ts_site", timecols.parse_day_first(F.concat_ws(" ", F.col("_t")[0], F.col("_t")[1]))
    )
    # Values are counted from the end, so a flag in front does not matter.
    values = [
        token_to_double(F.element_at("_t", i - len(REPORT_METRICS))).alias(m) for i, m in enumerate(REPORT_METRICS)
    ]
    return with_site_times(rows.select("ts_site", *values, *_file(lines)), zone).select(
        "ts_site", "ts_utc", *REPORT_METRICS, *_file(lines)
    )


def last_report_wins(parsed: DataFrame, station: str = "estacao") -> DataFrame:
    """One row per station and instant over several files; the last file by name wins, then by path.

    A local time that occurs twice has no instant; such rows count by their local time.
    """
    rows = parsed.withColumn("_local", F.when(F.col("ts_utc").isNull(), F.col("ts_site")))
    order = [*[F.desc(c) for c in _file(parsed)], F.desc("ts_site"), *[F.desc_nulls_last(m) for m in REPORT_METRICS]]
    return latest(rows, [station, "ts_utc", "_local"], *order).drop("_local")


def _fields(line: Column, separator: Column) -> Column:
    """The fields of a delimited line; a separator within double quotes does not count.

    The separator is the first known one in the line, else white space.
    """
    def cut(sep: str) -> Column:
        outside = F.split(line, sep + r'(?=(?:[^"]*"[^"]*")*[^"]*$)')
        return F.when(line.contains('"'), outside).otherwise(F.split(line, sep))

    out = F.split(F.trim(line), r"\s+")
    for sep in reversed(SEPARATORS):
        out = F.when(separator == sep, cut(sep)).otherwise(out)
    return F.transform(out, lambda f: F.trim(F.btrim(F.trim(f), F.lit('"'))))


def _separator(line: Column) -> Column:
    return F.coalesce(*[F.when(line.contains(s), F.lit(s)) for s in SEPARATORS], F.lit(" "))


def _roles() -> dict[str, object]:
    """Role -> condition on a folded header name."""
    def moment(h):
        return h.isin(TIME_NAMES)

    def metric(parts):
        return lambda h: any_of([h.contains(p) for p in parts])

    return {
        "ts": moment,
        "dia": lambda h: ~moment(h) & ((h == DAY_NAME) | h.startswith(DAY_PREFIX)),
        "hora": lambda h: ~moment(h) & h.contains(HOUR_PART) & ~h.contains(NOT_HOUR_PART),
        **{m: metric(parts) for m, parts in HEADER_PARTS.items()},
    }


def header_roles(lines: DataFrame) -> DataFrame:
    """``lines`` with the separator ``_sep`` and ``_roles``, the 0-based field of each role a header line has.

    ``_roles`` is NULL for a line that names no time, or not both of date and time.
    """
    rows = lines.withColumn("_sep", _separator(F.col("linha")))
    names = F.transform(_fields(F.col("linha"), F.col("_sep")), lambda f: F.translate(F.lower(f), _ACCENTED, _PLAIN))
    rows = rows.withColumn("_names", names)
    place = {r: F.nullif(F.array_position(F.transform("_names", test), F.lit(True)), F.lit(0)).cast("int") - 1 for r, test in _roles().items()}
    found = F.struct(*[p.alias(r) for r, p in place.items()])
    rows = rows.withColumn("_found", found)
    timed = F.col("_found.ts").isNotNull() | (F.col("_found.dia").isNotNull() & F.col("_found.hora").isNotNull())
    return rows.withColumn("_roles", F.when(timed, F.col("_found"))).drop("_names", "_found")


def parse_delimited(lines: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Delimited lines of any number of files, each read by its own header.

    The first line of a file that names a time is its header; separator and columns
    follow from it, so files of different layouts go together. Metrics a file does
    not have and unreadable values are NULL; rows without a time are dropped, as are
    files without a header (see ``files_without_layout``).
    """
    file = _file(lines)[-1]
    head = header_roles(lines).filter(F.col("_roles").isNotNull())
    head = head.groupBy(F.col(file).alias("_file")).agg(F.min_by(F.struct("_sep", "_roles"), "posicao").alias("_h"))
    # One row per file, settled so that its size is known: a large file's lines stay where they are.
    rows = lines.join(settled(head, "headers"), F.col(file) == F.col("_file"))
    rows = rows.select(*_file(lines), _fields(F.col("linha"), F.col("_h._sep")).alias("_f"), F.col("_h._roles").alias("_roles"))

    def field(role: str) -> Column:
        return F.get("_f", F.col(f"_roles.{role}"))

    text = F.coalesce(field("ts"), F.concat_ws(" ", field("dia"), field("hora")))
    wall = timecols.ntz(F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DAY_FIRST]))
    rows = rows.select(wall.alias("ts_site"), *[field(m).try_cast("double").alias(m) for m in REPORT_METRICS], *_file(lines))
    return with_site_times(rows, zone).select("ts_site", "ts_utc", *REPORT_METRICS, *_file(lines))


def files_without_layout(lines: DataFrame) -> DataFrame:
    """Files of which no line names a time, in delimited reports."""
    known = F.max(F.col("_roles").isNotNull())
    return header_roles(lines).groupBy(*_file(lines)).agg(known.alias("_ok")).filter(~F.col("_ok")).drop("_ok")


def read_delimited(spark: SparkSession, path: str | list[str], zone: str = LOCAL_ZONE) -> DataFrame:
    """Delimited report files, see ``parse_delimited``; encodings are decided per line."""
    return parse_delimited(read_lines(spark, path), zone)
