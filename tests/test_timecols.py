from support import at
from pyspark.sql import functions as F

import pytest

from gaugeworks.functions import timecols as t
from gaugeworks.operators.columns import add_time_columns


def one(spark, value, fn, kind="timestamp_ntz"):
    df = spark.createDataFrame([(value,)], "x string").select(fn(F.col("x").cast(kind)).alias("y"))
    return df.first()["y"]


@pytest.mark.parametrize("utc,local,offset", [
    ("2009-02-16 01:12:20", "2009-02-15 22:12:20", "-0300"),
    ("2009-02-10 01:12:20", "2009-02-09 23:12:20", "-0200"),
    (None, None, None),
])
def test_local_time_and_offset(spark, utc, local, offset):
    assert one(spark, utc, t.to_local) == (at(local) if local else None)
    assert one(spark, utc, t.offset_text) == offset
    assert one(spark, utc, t.offset_text_colon) == (f"{offset[:3]}:{offset[3:]}" if offset else None)


def test_original_text_pads_milliseconds(spark):
    assert one(spark, "2009-02-16 01:12:20.005", t.original_text) == "2009-02-15 22:12:20.005 -0300"
    assert one(spark, "2009-02-16 01:12:20", t.original_text) == "2009-02-15 22:12:20.000 -0300"


def test_offsets_of_part_hours_and_east(spark):
    assert one(spark, "2024-01-01 00:00:00", lambda c: t.offset_text(c, "Asia/Kolkata")) == "+0530"
    assert one(spark, "2024-01-01 00:00:00", lambda c: t.offset_text(c, "America/St_Johns")) == "-0330"


@pytest.mark.parametrize("text,utc", [
    ("2009-02-18 00:57:20.000 -0300", "2009-02-18 03:57:20"),
    ("2009-02-18 00:57:20.000 -03:00", "2009-02-18 03:57:20"),
    ("2019-02-16T23:45:00-0200", "2019-02-17 01:45:00"),
    ("2019-02-16 23:45:00.5 -0200", "2019-02-17 01:45:00.500000"),
    ("2009-02-18 00:57:20", "2009-02-18 00:57:20"),
    ("2009-02-18T00:57:20Z", "2009-02-18 00:57:20"), ("2009-02-18 00:57:20-03", "2009-02-18 03:57:20"),
    ("2009-02-18 00:57:20.5 -03", "2009-02-18 03:57:20.500000"), ("2009-02-18", "2009-02-18 00:00:00"),
    ("2009-02-18 00:57", "2009-02-18 00:57:00"), ("2009-02-18T00:57+0530", "2009-02-17 19:27:00"),
    ("junk", None), ("2009-13-01 00:00:00 -0300", None), ("2009-02-18 00:57:20 extra", None), ("", None), (None, None),
])
def test_parse_text(spark, text, utc):
    assert one(spark, text, t.parse_text_utc, "string") == (at(utc) if utc else None)


def test_parse_text_uses_naive_zone(spark):
    got = one(spark, "2009-02-18 00:57:20", lambda c: t.parse_text_utc(c, "-03:00"), "string")
    assert got == at("2009-02-18 03:57:20")


@pytest.mark.parametrize("wall,utc", [
    ("2018-02-17 23:30:00", None),  # occurs twice
    ("2018-11-04 00:30:00", "2018-11-04 03:00:00"),  # skipped
    ("2018-11-04 00:00:00", "2018-11-04 03:00:00"),  # skipped
    ("2018-02-17 22:59:00", "2018-02-18 00:59:00"),
    ("2018-02-18 00:00:00", "2018-02-18 03:00:00"),
    ("2018-11-04 01:00:00", "2018-11-04 03:00:00"),
])
def test_local_to_utc_at_clock_changes(spark, wall, utc):
    assert one(spark, wall, t.local_to_utc) == (at(utc) if utc else None)


def test_local_to_utc_inverts_to_local(spark):
    hours = spark.range(0, 24 * 365, 7).select(
        t.shift(F.to_timestamp_ntz(F.lit("2018-01-01 00:30:00")), days=0).alias("base"), "id"
    ).select((F.col("base") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("u"))
    back = hours.select("u", t.local_to_utc(t.to_local(F.col("u"))).alias("b"))
    wrong = back.filter(F.col("b") != F.col("u")).count()
    nulls = back.filter(F.col("b").isNull()).count()
    assert wrong == 0 and nulls <= 2


def test_trunc(spark):
    assert one(spark, "2024-03-03 10:11:12", lambda c: t.trunc("semana", c)) == at("2024-02-26 00:00:00")
    assert one(spark, "2024-03-01 01:00:00", lambda c: t.trunc("mes", c, t.LOCAL_ZONE)) == at("2024-02-01 00:00:00")
    with pytest.raises(ValueError):
        t.trunc("decade", F.col("x"))


def test_time_columns_from_each_input_kind(spark):
    want = (at("2009-02-16 01:12:20"), at("2009-02-15 22:12:20"), "2009-02-15 22:12:20.000 -0300", "-0300")
    names = ["dia_utc", "dia", "dia_original", "utc_offset"]
    for value, kind, zone in [
        ("2009-02-16 01:12:20", "timestamp_ntz", "UTC"), ("2009-02-15 22:12:20", "timestamp_ntz", "-03:00"),
        ("2009-02-15 22:12:20", "timestamp_ntz", t.LOCAL_ZONE), ("2009-02-15 22:12:20.000 -0300", "string", "UTC"),
        ("2009-02-15 22:12:20-03:00", "timestamp", "UTC"),
    ]:
        df = spark.createDataFrame([(value,)], "x string").select(F.col("x").cast(kind).alias("dia_utc"))
        assert tuple(add_time_columns(df, naive_zone=zone).select(*names).first()) == want
