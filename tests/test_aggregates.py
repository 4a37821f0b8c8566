import pytest
from support import at, plan, rows
from pyspark.sql import functions as F

from gaugeworks.operators import dedupe, duplicates, filters, ranking, rollup
from gaugeworks.schema import SENTINEL


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame([
        (1, at("2024-01-01 00:00:00"), 1, "A", SENTINEL, 1.0), (2, at("2024-01-01 10:00:00"), 1, "A", 0.5, 2.01),
        (3, at("2024-01-07 23:59:59"), 1, "A", None, None), (4, at("2024-01-08 00:00:00"), 2, "A", 1.0, 4.0),
        (5, at("2024-02-01 00:00:00"), 2, "A", 1.0, 0.0), (6, at("2024-02-01 01:00:00"), 3, "B", 1.0, 5.0),
    ], "id int, dia timestamp_ntz, estacao_id int, estacao string, m05 double, h24 double")


def test_rollup_keeps_or_drops_the_sentinel(fact):
    day = rollup.period_rollup(fact, "dia", metrics=["m05"]).orderBy("periodo").first()
    assert (day["media_m05"], day["max_h24"], day["total_leituras"]) == (-49.75, 2.01, 2)
    clean = rollup.period_rollup(fact, "dia", metrics=["m05"], sentinel=SENTINEL).orderBy("periodo").first()
    assert (clean["media_m05"], clean["total_leituras"]) == (0.5, 2)


def test_rollup_weeks_start_on_monday_and_end_date_is_midnight(fact):
    weeks = rollup.period_rollup(fact, "semana", metrics=["h24"], end="2024-01-08")
    assert rows(weeks, "periodo", "estacao_id", "total_leituras") == [
        (at("2024-01-01 00:00:00"), 1, 3), (at("2024-01-08 00:00:00"), 2, 1)]
    whole = rollup.period_rollup(fact, "mes", metrics=["h24"], end="2024-02-01", end_inclusive_day=True)
    assert whole.agg(F.sum("total_leituras")).first()[0] == 6
    with pytest.raises(ValueError):
        rollup.period_rollup(fact, "hora")


def test_rollup_of_empty_and_null_groups(fact):
    assert rollup.period_rollup(fact.limit(0), "dia", metrics=["m05"]).count() == 0
    sunday = rollup.period_rollup(fact, "dia", metrics=["m05", "h24"]).filter("periodo = timestamp_ntz'2024-01-07 00:00:00'").first()
    assert (sunday["media_m05"], sunday["media_h24"], sunday["max_h24"]) == (0.0, 0.0, 0.0)


def test_default_window(fact):
    assert rows(rollup.default_window(fact)) == [(at("2024-01-02 00:00:00"), at("2024-02-01 00:00:00"))]
    assert rows(rollup.default_window(fact, days=5)) == [(at("2024-01-27 00:00:00"), at("2024-02-01 00:00:00"))]
    assert rows(rollup.default_window(fact.filter("dia < '2024-01-09'"))) == [(at("2024-01-01 00:00:00"), at("2024-01-08 00:00:00"))]


def test_stats_of_no_rows(fact):
    r = rollup.global_stats(fact.limit(0)).first()
    assert (r["total_registros"], r["total_estacoes"], r["media_geral_h24"], r["data_minima"]) == (0, 0, 0.0, None)


def test_top_stations_groups_by_name(fact):
    assert [tuple(r) for r in ranking.top_stations(fact).collect()] == [("A", 5), ("B", 1)]


def test_station_detail_for_one_station(fact):
    got = rollup.station_detail(fact, station_id=1).first()
    assert (got["total_registros"], got["media_h24"], got["max_h24"]) == (3, 1.51, 2.01)


def test_histograms(fact):
    assert rows(rollup.year_histogram(fact, with_dates=True)) == [(2024, 6, at("2024-01-01").date(), at("2024-02-01").date())]
    assert rollup.month_presence(fact, "dia", "2024-02").first()[0] == 2
    assert rollup.month_presence(fact, "dia", "2023-12").first()[0] == 0


def test_page_takes_what_is_asked_for_in_total_order(spark, fact):
    assert [r["id"] for r in ranking.page(fact, "dia", ["estacao_id", "id"], limit=2, offset=1).collect()] == [5, 4]
    many = spark.range(20_000).select(F.col("id"), F.lit(at("2024-01-01")).cast("timestamp_ntz").alias("dia"))
    assert ranking.page(many, "dia", ["id"], limit=12_000).count() == 12_000
    # By the last row of the page before: the same rows as by offset.
    rows_ = [(i, at(f"2024-01-0{1 + i % 3}")) for i in range(50)]
    few = spark.createDataFrame(rows_, "id int, dia timestamp_ntz")
    first = ranking.page(few, "dia", ["id"], limit=20).collect()
    deep = ranking.page(few, "dia", ["id"], limit=20, after=(str(first[-1]["dia"]), first[-1]["id"])).collect()
    assert deep == ranking.page(few, "dia", ["id"], limit=20, offset=20).collect()


def test_last_readings(fact):
    assert [r["id"] for r in ranking.last_readings(fact, "dia", "estacao_id", 1, ["id"], 2).collect()] == [3, 2]


def test_sample_is_repeatable_and_seeded(spark):
    df = spark.range(1000)
    pick = lambda seed: [r[0] for r in ranking.sample(df, ["id"], 20, seed).collect()]
    assert pick("") == pick("") and pick("a") != pick("b")


# --- duplicates ---


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows share one key."""
    return spark.range(0, 3000).select(
        "id",
        F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).cast("int").alias("estacao_id"),
        F.lit(at("2009-02-15 22:12:20")).cast("timestamp_ntz").alias("dia"),
        (F.col("id") / 10).alias("h96"),
    )


KEY = ["dia", "estacao_id"]


def test_hot_key_dedupes_and_counts(hot):
    one = dedupe.latest_by_id(hot, KEY, "id")
    assert one.count() == 2001 and one.filter("estacao_id = 7").first()["id"] == 999
    assert plan(one).count("WindowGroupLimit") == 2
    assert rows(duplicates.duplicate_count(hot, KEY)) == [(1,)]
    assert rows(duplicates.winners(hot, KEY, "id", ["h96"]), "quantidade", "id_vencedor", "h96") == [(1000, 999, 99.9)]


def test_evidence_has_a_row_per_version(spark, hot):
    got = duplicates.evidence(hot, KEY, "id", ["h96"]).collect()
    assert {(r["quantidade"], r["id_vencedor"]) for r in got} == {(1000, 999)}
    assert sorted((r["id"], r["h96"]) for r in got) == [(i, i / 10) for i in range(1000)]
    many = spark.range(5000).selectExpr("id", "1 AS k", "CAST(NULL AS DOUBLE) AS v")
    assert duplicates.evidence(many, ["k"], "id", ["v"]).count() == 5000


def test_dedupe_is_idempotent_and_order_decides(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 1, None), (3, 2, "b")], "id int, k int, v string")
    once = dedupe.latest_by_id(df, ["k"], "id")
    assert rows(once) == rows(dedupe.latest_by_id(once, ["k"], "id")) == [(2, 1, None), (3, 2, "b")]
    assert rows(dedupe.keep_last(df, ["k"], ["id"])) == rows(once)


def test_reading_versions(spark):
    df = spark.createDataFrame([(1, 11, at("2009-10-27 23:54:00")), (5, 11, at("2009-10-27 23:54:00")), (6, 12, at("2009-10-27 23:54:00"))],
                               "id int, estacao_id int, dia timestamp_ntz")
    got = duplicates.reading_versions(df, "dia", "estacao_id", "id", "2009-10-27 23:54:00", 11)
    assert [r["id"] for r in got.collect()] == [5, 1]


# --- filters ---


def test_optional_filters(fact):
    ids = lambda **kw: sorted(r["id"] for r in filters.optional(fact, **kw).collect())
    assert ids() == [1, 2, 3, 4, 5, 6]
    assert ids(start="2024-01-08", end="2024-02-01") == [4, 5]
    assert ids(start="2024-01-08", end="2024-02-01", end_inclusive_day=True) == [4, 5, 6]
    assert ids(station_id=3) == [6] and ids(name_contains="b") == [6]


def test_name_matching_folds_case_and_optionally_accents(spark):
    df = spark.createDataFrame([("São Cristóvão",), ("SÃO CRISTÓVÃO",), ("Sao Cristovao",), ("Tijuca",)], "n string")
    count = lambda **kw: df.filter(filters.name_like(F.col("n"), **kw)).count()
    assert count(part="são cris") == 2 and count(part="sao cris") == 1
    assert count(part="sao cris", ignore_accents=True) == 3
    assert count(part="CRIS", prefix=True) == 0 and count(part="sao", prefix=True, ignore_accents=True) == 3


def test_years_rejects_a_reversed_interval(fact):
    with pytest.raises(ValueError):
        filters.years(fact, "dia", 2025, 2024)
    assert filters.years(fact, "dia", 2023, 2024).count() == 6


def test_last_hours_and_plausible(fact):
    assert filters.last_hours(fact, "dia", 2, "2024-02-01 01:00:00").count() == 2
    assert filters.plausible(fact, "dia", "2024-01-05 00:00:00").count() == 4
