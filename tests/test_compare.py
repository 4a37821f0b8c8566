from datetime import datetime, timedelta

import pytest
from support import at, rows
from pyspark.sql import functions as F

from gaugeworks.operators import compare
from gaugeworks.schema import RAIN_METRICS

KEY = ["dia", "estacao_id"]
SCHEMA = "dia timestamp_ntz, " + ", ".join(f"{m} double" for m in RAIN_METRICS) + ", estacao string, estacao_id int"


@pytest.fixture(scope="module")
def pair(spark):
    """204 shared keys, 115 of them with another h96; more cases at another station."""
    src, dst = [], []
    for i in range(204):
        ts = datetime(2009, 2, 16, 1, 12, 20) + timedelta(minutes=15 * i)
        row = [-99.99, -99.99, 0.2, 0.4, 1.0, 20.0, 59.2]
        src.append((ts, *row, "Santa Teresa", 14))
        dst.append((ts, *row[:6], 59.2 + (0.2 if i < 114 else 35.6 if i == 114 else 0.0), "Santa Teresa", 14))
    base = [1.0, 1.0, 1.0, 1.0, 1.0, 1.0]
    t0 = datetime(2009, 2, 16)
    extra = [
        (0, 1.0, 1.0), (1, None, 1.0), (2, 1.0, None), (3, None, None), (4, 1.0, 1.00009), (5, 1.0, 1.00011),
        (6, 1.0, 1.0499), (7, 1.0, 1.0501),
    ]
    for i, a, b in extra:
        src.append((t0 + timedelta(hours=i), *base, a, "Urca", 15))
        dst.append((t0 + timedelta(hours=i), *base, b, "Urca", 15))
    src.append((t0 + timedelta(hours=50), *base, 1.0, "Urca", 15))
    dst.append((t0 + timedelta(hours=60), *base, 1.0, "Urca", 15))
    return spark.createDataFrame(src, SCHEMA), spark.createDataFrame(dst, SCHEMA)


def test_reconcile_statuses(spark, pair):
    src, dst = pair
    got = compare.reconcile(src, dst, KEY, RAIN_METRICS)
    assert rows(compare.status_totals(got, ["estacao_id"])) == [
        (14, "different", 115), (14, "ok", 89), (15, "different", 5), (15, "extra", 1), (15, "missing", 1), (15, "ok", 3)]
    named = got.filter("status = 'different'").select(F.explode("differing").alias("c")).distinct()
    assert rows(named) == [("h96",)]


def test_reconcile_with_itself_is_clean(pair):
    src, _ = pair
    assert rows(compare.status_totals(compare.reconcile(src, src, KEY, RAIN_METRICS))) == [("ok", src.count())]


def test_exact_reconcile(pair):
    src, dst = pair
    got = compare.reconcile_exact(src, dst, KEY, RAIN_METRICS)
    # Noise below the tolerance counts here; two NULLs are equal.
    assert dict(rows(compare.status_totals(got)))["different"] == 115 + 6


def test_metric_summary(pair):
    src, dst = pair
    got = {r["metric"]: r for r in compare.metric_summary(src, dst, KEY, RAIN_METRICS).collect()}
    h96 = got["h96"]
    # A NULL side is not comparable, unlike in reconcile.
    assert (h96["comparable"], h96["over_tolerance"]) == (204 + 5, 116)
    assert abs(h96["max_diff"] - 35.6) < 1e-9
    assert got["m05"]["over_tolerance"] == 0 and got["m05"]["comparable"] == 212


def test_presence_and_examples(pair):
    src, dst = pair
    assert rows(compare.presence_totals(src, dst, KEY)) == [("both", 212), ("left_only", 1), ("right_only", 1)]
    worst = compare.worst_examples(src, dst, KEY, RAIN_METRICS, n=3).orderBy("position").collect()
    assert [r["metric"] for r in worst] == ["h96"] * 3 and worst[0]["site_value"] == 1.0
    first = compare.examples_by_status(compare.reconcile(src, dst, KEY, RAIN_METRICS), KEY, n=2)
    assert rows(first.groupBy("status").count()) == [("different", 2), ("extra", 1), ("missing", 1), ("ok", 2)]


def test_long_form_of_one_record(pair):
    src, dst = pair
    one = src.filter("estacao_id = 15 and dia = timestamp_ntz'2009-02-16 04:00:00'")
    got = {r["campo"]: r for r in compare.long_form(one, dst, KEY, RAIN_METRICS).collect()}
    assert got["h96"]["equal_exact"] is False and got["h96"]["equal_tolerant"] is True and got["h96"]["status"] == "ok"
    assert len(got) == 7


def test_reconcile_within_and_period(spark):
    src = spark.createDataFrame([(at("2009-10-27 23:54:00"), 11, 1.0), (at("2009-10-28 00:30:00"), 11, 2.0), (at("2009-10-28 03:00:00"), 11, 3.0)],
                                "dia timestamp_ntz, estacao_id int, h24 double")
    dst = spark.createDataFrame([(at("2009-10-27 23:54:00.9"), 11, 1.0), (at("2009-10-28 00:50:00"), 11, 9.0)],
                                "dia timestamp_ntz, estacao_id int, h24 double")
    got = compare.reconcile_within(src, dst, "dia", "estacao_id", ["h24"]).orderBy("dia")
    assert [r["status"] for r in got.collect()] == ["ok", "missing", "missing"]
    got = compare.reconcile_period(src, dst, "dia", "estacao_id", ["h24"]).orderBy("dia")
    assert [(r["status"], r["differing"]) for r in got.collect()] == [("ok", []), ("different", ["h24"]), ("missing", [])]
