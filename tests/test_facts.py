import pytest
from support import at, rows

from gaugeworks.plans import diagnosis, rain as rain_plan, weather as weather_plan
from gaugeworks.schema import REPLICA_RAIN, RAIN_METRICS, WAREHOUSE_RAIN, WAREHOUSE_WEATHER
from gaugeworks.sources import facts


@pytest.fixture(scope="module")
def net(spark):
    """Readings, rain, sensor values, sensors, stations of a small network."""
    r = spark.createDataFrame([
        (1, at("2019-02-15 23:00:00"), 1), (2, at("2019-02-15 23:00:00"), 1), (3, at("2020-02-10 00:00:00"), 11),
        (4, at("2020-02-10 00:00:00"), 1), (5, at("2020-02-10 00:15:00"), 99), (6, at("2020-02-10 00:30:00"), 1),
        (7, at("2019-02-15 23:00:00"), 1),
    ], "id bigint, horaLeitura timestamp_ntz, estacao_id int")
    blank = [None] * 8
    c = spark.createDataFrame([
        (1, 1.0, -99.99, 1.5, *blank, 1.0), (2, 2.0, -99.99, 2.5, *blank, 2.0), (3, 3.0, None, 3.5, *blank, None),
        (4, 4.0, None, 4.5, *blank, None), (5, 5.0, None, 5.5, *blank, None), (100, 9.0, None, 9.5, *blank, None),
    ], "leitura_id bigint, m05 double, m10 double, m15 double, h01 double, h02 double, h03 double, h04 double, h06 double, h12 double, h24 double, h96 double, mes double")
    v = spark.createDataFrame([
        (1, 3, 25.0), (1, 5, 60.0), (2, 3, 26.0), (2, 3, 24.0), (3, 3, 20.0), (3, 5, 0.0), (4, 9, 1.0), (6, 1, 180.0),
        (5, 3, 30.0), (7, 5, 50.0),
    ], "leitura_id bigint, sensor_id int, valor double")
    s = spark.createDataFrame([
        (1, "Direcao do Vento"), (2, "Velocidade do Vento"), (3, "Temperatuda do Ar"), (4, "Pressao ATM"), (5, "Umidade do Ar"), (9, "Bateria"),
    ], "id int, nome string")
    e = spark.createDataFrame([(1, "Iraja"), (11, "Guaratiba"), (99, "Longe")], "id int, nome string")
    return r, c, v, s, e


def test_rain_keeps_the_newest_reading_that_has_rain(spark, net):
    r, c, _, _, e = net
    got = rows(facts.rain_source(r, c, e, keep_id=True), "leitura_id", "dia", "estacao", "m05")
    # Reading 7 is newer but has no rain values.
    assert (2, at("2019-02-15 23:00:00"), "Iraja", 2.0) in got and len(got) == 4
    assert facts.rain_source_raw(r, c, e).count() == 5


def test_rain_start_filter(spark, net):
    r, c, _, _, e = net
    assert facts.rain_source(r, c, e, start="2020-01-01 00:00:00").count() == 3


def test_weather_merges_maxima_of_all_versions(spark, net):
    r, c, v, s, e = net
    got = {(x["dia_utc"], x["estacao_id"]): x for x in facts.weather_source(r, v, s, c, e).collect()}
    first = got[at("2019-02-15 23:00:00"), 1]
    # Largest value of each column over three readings; before the cut-over the 15-minute rain counts.
    assert (first["chuva"], first["temperatura"], first["umidade"]) == (2.5, 26.0, 60.0)
    assert first["ponto_orvalho"] is not None
    # A late station still reports 15-minute rain in February 2020; humidity 0 has no dew point.
    late = got[at("2020-02-10 00:00:00"), 11]
    assert late["chuva"] == 3.5 and late["ponto_orvalho"] is None
    # Any sensor keeps the reading, unnamed ones give no value.
    battery = got[at("2020-02-10 00:00:00"), 1]
    assert battery["chuva"] == 4.0 and battery["temperatura"] is None
    # No rain row: left join.
    assert got[at("2020-02-10 00:30:00"), 1]["chuva"] is None
    # Station 99 is not on the list.
    assert len(got) == 4
    assert facts.weather_source(r, v, s, c, e, station_ids=None).count() == 5


def test_weather_for_one_station_and_range(spark, net):
    r, c, v, s, e = net
    got = facts.weather_source(r, v, s, c, e, "2020-01-01 00:00:00", "2020-02-10 00:30:00", [1])
    assert rows(got, "dia_utc", "estacao_id") == [(at("2020-02-10 00:00:00"), 1)]


def test_contracts_hold(spark, net):
    r, c, v, s, e = net
    for df, contract in [
        (rain_plan.replica_rows(r, c, e), REPLICA_RAIN), (rain_plan.warehouse_rows(r, c, e), WAREHOUSE_RAIN),
        (weather_plan.warehouse_rows(r, v, s, c, e), WAREHOUSE_WEATHER),
    ]:
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in contract]
    row = rain_plan.warehouse_rows(r, c, e).filter("estacao_id = 1 and m05 = 2").first()
    assert (row["dia"], row["utc_offset"]) == (at("2019-02-15 21:00:00"), "-0200")


def test_replica_load_reads_zone_less_times_in_a_given_zone(spark, net):
    r, c, _, _, e = net
    got = rain_plan.replica_rows(r, c, e, naive_zone="-03:00").selectExpr("cast(min(dia) as timestamp_ntz) as d").first()
    assert got["d"] == at("2019-02-16 02:00:00")


def test_diagnosis(spark, net):
    r, c, _, _, e = net
    found = diagnosis.diagnose(r, c, e, "2019-02")
    cov = found["coverage"].first()
    assert (cov["total_leitura"], cov["total_chuva"], cov["total_com_join"]) == (7, 6, 5)
    assert rows(found["years"]) == [(2019, 2), (2020, 3)]
    assert found["first_month"].first()[0] == 2
    assert rows(found["duplicates"]) == [(at("2019-02-15 23:00:00"), 1, 2)]
    assert found["duplicate_count"].first()[0] == 1


def test_metrics_keep_the_sentinel(spark, net):
    r, c, _, _, e = net
    assert facts.rain_source(r, c, e).filter("m10 = -99.99").count() == 1
    assert facts.rain_source(r, c, e).columns == ["dia", *RAIN_METRICS, "estacao", "estacao_id"]


def test_a_short_range_reduces_values_and_rain_before_grouping(spark, tmp_path):
    """The semi joins lie under the aggregates of values and rain."""
    readings = spark.createDataFrame([(1, at("2024-01-01"), 1), (2, at("2024-02-01"), 1)], "id int, horaLeitura timestamp_ntz, estacao_id int")
    values = spark.createDataFrame([(1, 5, 2.0), (2, 5, 3.0)], "leitura_id int, sensor_id int, valor double")
    sensors = spark.createDataFrame([(5, "S")], "id int, nome string")
    rain = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 3.0)], "leitura_id int, m05 double, m15 double")
    stations = spark.createDataFrame([(1, "A")], "id int, nome string")
    df = facts.weather_source(readings, values, sensors, rain, stations, "2024-02-01 00:00:00", "2024-03-01 00:00:00", [1], {"x": "S"})
    text = df._jdf.queryExecution().optimizedPlan().toString()
    semi = [line.index("Join LeftSemi") for line in text.splitlines() if "Join LeftSemi" in line]
    assert len(semi) == 2
    for at_depth in semi:
        above = [line for line in text.splitlines() if "Aggregate [leitura_id" in line and line.index("Aggregate") < at_depth]
        assert above
    assert rows(df, "x", "chuva") == [(3.0, 1.0)]
