import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions import values as v
from gaugeworks.schema import SENTINEL


def test_tokens(spark):
    df = spark.createDataFrame([("ND",), ("nd",), ("1,5",), (" ",), ("x",), (None,), ("-3.2",)], "x string")
    assert [r[0] for r in df.select(v.token_to_double(F.col("x"))).collect()] == [None, None, 1.5, None, None, None, -3.2]


def test_equal_within(spark):
    df = spark.createDataFrame(
        [(None, None), (1.0, None), (None, 1.0), (1.0, 1.00009), (1.0, 1.00011), (59.2, 59.4)], "a double, b double")
    got = [r[0] for r in df.select(v.equal_within(F.col("a"), F.col("b"), 0.0001)).collect()]
    assert got == [True, False, False, True, False, False]


def half_up(xs):
    cents = [round(x * 100) for x in xs]
    if not cents:
        return 0.0
    total, n = sum(cents), len(cents)
    size = (2 * abs(total) + n) // (2 * n)
    return (-size if total < 0 else size) / 100


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-999999, 999999).map(lambda i: i / 100), max_size=8))
def test_rounded_mean_is_exact_half_up(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    money = F.col("x").cast("decimal(10,2)")
    got = df.select(v.rounded_mean(F.col("x")).alias("m"), v.rounded_mean(money).alias("d"), v.rounded_mean(money, kind=T.DecimalType(10, 2)).alias("k")).first()
    assert got["k"] == got["d"]
    assert got["m"] == got["d"] == half_up(xs)


def test_empty_mean_and_max_are_zero(spark):
    df = spark.createDataFrame([], "x double").agg(v.rounded_mean(F.col("x")), v.rounded_max(F.col("x")))
    assert tuple(df.first()) == (0.0, 0.0)


def test_sentinel_and_snap(spark):
    df = spark.createDataFrame([(SENTINEL,), (0.0004,), (-0.0004,), (0.2,)], "x double")
    assert [r[0] for r in df.select(v.without_sentinel(F.col("x"))).collect()] == [None, 0.0004, -0.0004, 0.2]
    assert [r[0] for r in df.select(v.snap_zero(F.col("x"))).collect()] == [SENTINEL, 0.0, 0.0, 0.2]


@pytest.mark.parametrize("temp,hum,want", [
    (25.0, 60.0, 16.7), (None, 60.0, None), (25.0, None, None), (25.0, 0.0, None), (25.0, -1.0, None), (20.0, 100.0, 20.0)])
def test_dew_point(spark, temp, hum, want):
    df = spark.createDataFrame([(temp, hum)], "t double, h double")
    got = df.select(v.dew_point(F.col("t"), F.col("h"))).first()[0]
    assert got is None if want is None else math.isclose(got, want, abs_tol=0.1)


@pytest.mark.parametrize("ts,name,want", [
    ("2020-01-31 23:59:59", "Iraja", "m15"), ("2020-02-01 00:00:00", "Iraja", "m05"),
    ("2020-02-29 23:59:59", "GUARATIBA", "m15"), ("2020-03-01 00:00:00", "Guaratiba", "m05"),
    ("2020-02-15 00:00:00", "são cristóvão", "m15"), ("2020-02-15 00:00:00", "Sao Cristovao II", "m15"),
    ("2020-02-15 00:00:00", "Barra Guaratiba", "m05")])
def test_rain_by_cutover(spark, ts, name, want):
    df = spark.createDataFrame([(ts, name)], "ts string, n string")
    got = df.select(v.rain_by_cutover(F.col("ts").cast("timestamp_ntz"), F.col("n"), F.lit("m05"), F.lit("m15"))).first()[0]
    assert got == want
