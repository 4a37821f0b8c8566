"""Stored tables kept up to date: marks, files, roll-ups, slices, columns, digests, buckets, feeds."""

import glob
import os
import random
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from support import at, plan, rows

from gaugeworks.operators import compare, contracts, digests, matching, rollup
from gaugeworks.operators import watermarks as w
from gaugeworks.operators.watermarks import station_watermarks
from gaugeworks.plans import diagnosis, slices
from gaugeworks.plans import rain as rain_plan
from gaugeworks.plans import weather as weather_plan
from gaugeworks.schema import WAREHOUSE_RAIN
from gaugeworks.sinks import buckets, files, marks, rollups, schemas
from gaugeworks.sinks import tables as sink
from gaugeworks.sources import reports
from gaugeworks.sources.facts import rain_versions
from gaugeworks.sources.tables import read_table
from gaugeworks.streaming.sync import dedupe_feed, read_feed

KEY = ["dia", "estacao_id"]
SCHEMA = "id bigint, dia timestamp_ntz, estacao_id bigint, h24 double"
STORED = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("dia", T.TimestampNTZType()), T.StructField("estacao_id", T.LongType()), T.StructField("h24", T.DoubleType()),
])


def frame(spark, *data):
    return spark.createDataFrame([(i, at(d) if d else None, s, v) for i, d, s, v in data], SCHEMA)


def many(spark, n, first=0, start="2024-01-01 00:00:00", step=7, seed=1):
    pick = random.Random(seed)
    return spark.createDataFrame([(first + i, at(start) + timedelta(hours=step * i), pick.randrange(4), float(i)) for i in range(n)], SCHEMA)


def same_marks(spark, path, as_of=None):
    table, kept = sink.stored_marks(spark, path, STORED, "dia")
    assert rows(kept) == rows(marks.of(table, "dia", "estacao_id"))
    want = station_watermarks(table, "dia", "estacao_id", as_of)
    assert rows(sink.stored_watermarks(spark, path, STORED, as_of, "dia"), "estacao_id", "watermark") == rows(want, "estacao_id", "watermark")
    assert rows(marks.status(kept)) == rows(rollup.table_status(table, "dia"))


# --- marks ---


def test_marks_follow_every_change(spark, path):
    sink.reload_table(many(spark, 150), path, "dia", marked=True)
    late = many(spark, 60, 1000, "2024-01-01 03:00:00", 9, 2)
    for _ in range(2):
        sink.append_absent(spark, path, late, KEY, "dia")
    same_marks(spark, path)
    sink.upsert_table(spark, path, many(spark, 40, 2000, "2024-02-10 00:00:00", 31, 3), KEY, "dia")
    same_marks(spark, path)
    sink.upsert_files(spark, path, many(spark, 40, 3000, "2024-02-01 00:00:00", 13, 4), KEY, "dia")
    same_marks(spark, path)
    # Months that are replaced may lose their newest rows.
    sink.reload_months(many(spark, 5, 4000, "2024-02-01 00:00:00", 1, 5), path, "dia")
    same_marks(spark, path)
    sink.compact(spark, path, ["2024-01"], KEY, "id", "dia")
    same_marks(spark, path)
    with pytest.raises(ValueError):
        sink.append_versions(late, path, "dia")


def test_marks_of_an_unmarked_and_an_empty_table(spark, path):
    sink.reload_table(many(spark, 30), path, "dia")
    assert not marks.kept(spark, path)
    same_marks(spark, path)
    assert marks.kept(spark, path)
    sink.reload_table(many(spark, 30).limit(0), path, "dia", marked=True)
    _, kept = sink.stored_marks(spark, path, STORED, "dia")
    assert kept.count() == 0 and marks.status(kept).first()["total_registros"] == 0


def test_marks_ignore_future_rows(spark, path):
    good = many(spark, 50)
    bad = frame(spark, (900, "2103-01-01 00:00:00", 1, 0.0), (901, "2024-01-15 12:00:00", 2, 0.0))
    sink.reload_table(good.unionByName(bad), path, "dia", marked=True)
    for as_of in (None, "2024-01-10 00:00:00", "2024-01-20 00:00:00", "2020-01-01 00:00:00", "2110-01-01 00:00:00"):
        same_marks(spark, path, as_of)


def test_watermarks_do_not_scan_the_table(spark, path):
    sink.reload_table(many(spark, 60), path, "dia", marked=True)
    read = sink.stored_watermarks(spark, path, STORED, "2030-01-01 00:00:00", "dia").inputFiles()
    assert read and all(f"/{marks.MARKS}/" in f for f in read)


@pytest.mark.parametrize("change", ["append", "months", "files", "upsert"])
def test_marks_after_a_change_cut_short(spark, path, change, monkeypatch):
    """The rows are in the table, the marks are old: whatever comes next renews them."""
    sink.reload_table(many(spark, 50), path, "dia", marked=True)
    batch = many(spark, 30, 500, "2024-01-09 02:00:00", 5, 8)
    renew = marks.renew

    def stop(*a, **k):
        raise RuntimeError("stopped")

    monkeypatch.setattr(marks, "renew", stop)
    with pytest.raises(RuntimeError):
        if change == "append":
            sink.append_absent(spark, path, batch, KEY, "dia")
        elif change == "months":
            sink.reload_months(batch, path, "dia")
        elif change == "files":
            sink.upsert_files(spark, path, batch, KEY, "dia")
        else:
            sink.upsert_table(spark, path, batch, KEY, "dia")
    monkeypatch.setattr(marks, "renew", renew)
    same_marks(spark, path)
    assert sink.finish_open(spark, path, "dia") is False


def test_marks_started_and_cut_short(spark, path, monkeypatch):
    sink.reload_table(many(spark, 50), path, "dia")
    write = marks._write

    def half(df, to, dynamic):
        write(df.limit(1), to, dynamic)
        raise RuntimeError("stopped")

    monkeypatch.setattr(marks, "_write", half)
    with pytest.raises(RuntimeError):
        sink.start_marks(spark, path, sink.with_month(STORED), "dia")
    monkeypatch.setattr(marks, "_write", write)
    same_marks(spark, path)


def test_syncs_read_marks_only(spark, path, monkeypatch):
    """A sync of the warehouse asks its target for no watermark."""
    readings = spark.createDataFrame([(i, at("2024-01-01") + timedelta(hours=i), i % 3) for i in range(60)], "id bigint, horaLeitura timestamp_ntz, estacao_id bigint")
    rain = readings.select(F.col("id").alias("leitura_id"), *[F.lit(1.0).alias(m.name) for m in WAREHOUSE_RAIN if m.dataType == T.DoubleType()])
    stations = spark.createDataFrame([(i, f"s{i}") for i in range(3)], "id bigint, nome string")
    rain_plan.export_warehouse(readings.filter("id < 30"), rain, stations, path)
    monkeypatch.setattr(w, "station_watermarks", None)
    monkeypatch.setattr(w, "measured", None)
    rain_plan.sync_warehouse(spark, readings, rain, stations, path)
    assert read_table(spark, path).count() == 60
    rain_plan.sync_warehouse(spark, readings, rain, stations, path)
    assert read_table(spark, path).count() == 60


# --- files ---


def names(path):
    return {f for f in glob.glob(f"{path}/ano_mes=*/*.parquet")}


@pytest.mark.parametrize("version", [None, "id"])
def test_upsert_files_equals_upsert_and_leaves_other_files(spark, path, tmp_path, version):
    table = many(spark, 400, step=5)
    other = str(tmp_path / "other")
    for p in (path, other):
        table.repartitionByRange(6, "estacao_id").withColumn("ano_mes", F.date_format("dia", "yyyy-MM")).write.partitionBy("ano_mes").parquet(p)
    before = names(path)
    batch = table.filter("estacao_id = 2 and id % 9 = 0").withColumn("h24", F.lit(-1.0)).withColumn("id", F.col("id") + 1000)
    batch = batch.unionByName(frame(spark, (5000, "2024-09-01 00:00:00", 9, 9.0), (5001, "2024-01-01 01:30:00", 9, 9.0)))
    touched = {f for f in before if spark.read.parquet(f).join(batch.select(*KEY), KEY, "left_semi").count()}
    sink.upsert_table(spark, other, batch, KEY, "dia", version=version)
    for _ in range(2):
        come, gone = sink.upsert_files(spark, path, batch, KEY, "dia", version=version)
        assert rows(read_table(spark, path), *SCHEMA_NAMES) == rows(read_table(spark, other), *SCHEMA_NAMES)
        assert come and gone
    # Files with a key of the batch went, all others have their names.
    assert touched and before - touched and before & names(path) == before - touched
    assert sink.upsert_files(spark, path, batch.limit(0), KEY, "dia") == (0, 0)
    with pytest.raises(ValueError):
        sink.upsert_files(spark, path, batch, ["estacao_id"], "dia")


SCHEMA_NAMES = ["id", "dia", "estacao_id", "h24"]


@pytest.mark.parametrize("after", [0, 1])
def test_exchange_of_files_cut_short_is_finished(spark, path, tmp_path, after, monkeypatch):
    table = many(spark, 200, step=9)
    sink.reload_table(table, path, "dia")
    batch = many(spark, 80, 900, "2024-01-20 00:00:00", 9, 1)
    want_path = str(tmp_path / "want")
    sink.reload_table(table, want_path, "dia")
    sink.upsert_table(spark, want_path, batch, KEY, "dia")
    left = [after]

    def counted(fn):
        def run(*a):
            if left[0] == 0:
                raise RuntimeError("stopped")
            left[0] -= 1
            return fn(*a)
        return run

    move, remove = files.move, files.remove
    monkeypatch.setattr(files, "move", counted(move))
    monkeypatch.setattr(files, "remove", counted(remove))
    with pytest.raises(RuntimeError):
        sink.upsert_files(spark, path, batch, KEY, "dia")
    monkeypatch.setattr(files, "move", move)
    monkeypatch.setattr(files, "remove", remove)
    assert sink.finish_open(spark, path, "dia") is True
    assert rows(read_table(spark, path), *SCHEMA_NAMES) == rows(read_table(spark, want_path), *SCHEMA_NAMES)
    assert sink.finish_open(spark, path, "dia") is False


# --- roll-ups ---


@pytest.mark.parametrize("grain,zone", [("semana", "America/Sao_Paulo"), ("mes", None)])
def test_maintained_rollup_equals_a_full_one(spark, tmp_path, grain, zone):
    table, path = str(tmp_path / "t"), str(tmp_path / "r")
    options = {"metrics": ["h24"], "zone": zone}
    named = lambda df: df.withColumn("estacao", F.concat(F.lit("s"), "estacao_id"))
    first = named(many(spark, 200, step=5))
    sink.reload_table(first, table, "dia")
    rollups.start(first, path, grain, **options)
    for n in (1, 2, 3):
        batch = named(many(spark, 30, 1000 * n, ["2024-02-25 00:00:00", "2024-01-01 02:00:00", "2024-01-31 20:00:00"][n - 1], 11, n))
        rollups.maintain(spark, table, path, batch, KEY, grain, version="id", **options)
        want = rollup.period_rollup(read_table(spark, table).drop("ano_mes"), grain, **options)
        assert rows(read_table(spark, path), *want.columns) == rows(want)


def test_rollup_catches_up_after_a_stop(spark, tmp_path, monkeypatch):
    table, path = str(tmp_path / "t"), str(tmp_path / "r")
    named = lambda df: df.withColumn("estacao", F.lit("x"))
    sink.reload_table(named(many(spark, 60)), table, "dia")
    rollups.start(named(many(spark, 60)), path, "dia", metrics=["h24"])
    catch_up = rollups.catch_up

    def stop(*a, **k):
        raise RuntimeError("stopped")

    monkeypatch.setattr(rollups, "catch_up", stop)
    with pytest.raises(RuntimeError):
        rollups.maintain(spark, table, path, named(many(spark, 20, 500, "2024-01-03 00:00:00", 5, 3)), KEY, "dia", metrics=["h24"])
    monkeypatch.setattr(rollups, "catch_up", catch_up)
    rollups.maintain(spark, table, path, named(many(spark, 5, 700, "2024-03-03 00:00:00", 5, 3)), KEY, "dia", metrics=["h24"])
    want = rollup.period_rollup(read_table(spark, table).drop("ano_mes"), "dia", metrics=["h24"])
    assert rows(read_table(spark, path), *want.columns) == rows(want)


def test_rollup_reads_touched_months_only(spark, tmp_path, monkeypatch):
    table, path = str(tmp_path / "t"), str(tmp_path / "r")
    named = lambda df: df.withColumn("estacao", F.lit("x"))
    sink.reload_table(named(many(spark, 300, step=24)), table, "dia")
    rollups.start(named(many(spark, 300, step=24)), path, "dia", metrics=["h24"])
    plans, whole = [], rollups.period_rollup

    def seen(df, *a, **k):
        plans.append(plan(df))
        return whole(df, *a, **k)

    monkeypatch.setattr(rollups, "period_rollup", seen)
    rollups.maintain(spark, table, path, named(frame(spark, (9000, "2024-05-15 01:00:00", 1, 4.0))), KEY, "dia", metrics=["h24"])
    (p,) = plans
    assert "PartitionFilters: [(ano_mes" in p and "= 2024-05)" in p
    assert read_table(spark, path).filter("periodo = timestamp_ntz'2024-05-15'").select("total_leituras").collect()


# --- slices ---


def weather_net(spark):
    readings = spark.createDataFrame([(i, at(f"{2019 + i % 4}-03-0{1 + i % 5} 0{i % 9}:00:00"), 1 + i % 2) for i in range(40)], "id bigint, horaLeitura timestamp_ntz, estacao_id bigint")
    values = spark.createDataFrame([(i, 0, float(i)) for i in range(40)], "leitura_id bigint, sensor_id int, valor double")
    sensors = spark.createDataFrame([(0, "Temperatuda do Ar")], "id int, nome string")
    rain = spark.createDataFrame([(i, 1.0, 2.0) for i in range(40)], "leitura_id bigint, m05 double, m15 double")
    stations = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, nome string")
    return readings, values, sensors, rain, stations


def test_year_slices_resume_after_a_stop(spark, tmp_path, monkeypatch):
    net, path, whole = weather_net(spark), str(tmp_path / "w"), str(tmp_path / "all")
    weather_plan.export_warehouse(*net, whole, station_ids=None)
    export, left = weather_plan.export_slice, [1]

    def stop(*a, **k):
        if not left[0]:
            raise RuntimeError("stopped")
        left[0] -= 1
        export(*a, **k)

    monkeypatch.setattr(weather_plan, "export_slice", stop)
    with pytest.raises(RuntimeError):
        weather_plan.export_years(spark, *net, path, 2019, 2022, station_ids=None)
    assert slices.finished(spark, path) == ["2019-01-01", "2020-01-01"]
    monkeypatch.setattr(weather_plan, "export_slice", export)
    assert weather_plan.export_years(spark, *net, path, 2019, 2022, station_ids=None) == [2021, 2022]
    assert rows(read_table(spark, path)) == rows(read_table(spark, whole))
    # A run after a complete one starts over.
    assert slices.finished(spark, path) == []
    assert weather_plan.export_years(spark, *net, path, 2020, 2021, station_ids=None) == [2020, 2021]
    assert {r[0] for r in read_table(spark, path).select(F.year("dia_utc")).distinct().collect()} == {2020, 2021}


# --- columns ---


def test_recorded_columns(spark, path):
    old = many(spark, 20).drop("h24")
    schemas.reload_recorded(old, path, "dia")
    schemas.append_recorded(spark, path, many(spark, 20, 100, "2024-03-01 00:00:00"), KEY, "dia")
    schemas.append_recorded(spark, path, many(spark, 4, 200, "2024-05-01 00:00:00").drop("h24").withColumn("mes", F.lit("x")), KEY, "dia")
    table = schemas.read_recorded(spark, path)
    assert table.columns == ["id", "dia", "estacao_id", "h24", "mes", "ano_mes"]
    assert table.filter("h24 is null").count() == 24 and table.filter("mes is null").count() == 40
    assert rows(schemas.history(spark, path)) == [(1, "dia", "timestamp_ntz"), (1, "estacao_id", "bigint"), (1, "id", "bigint"), (2, "h24", "double"), (3, "mes", "string")]
    with pytest.raises(ValueError):
        schemas.append_recorded(spark, path, many(spark, 4).withColumn("h24", F.lit("text")), KEY, "dia")
    assert len(schemas.versions(spark, path)) == 3


# --- digests ---


def faulty_pair(spark):
    left = many(spark, 300, step=3).dropDuplicates(KEY)
    right = left.filter("id <> 40").withColumn("h24", F.when(F.col("id") == 41, 99.0).when(F.col("id") == 42, None).otherwise(F.col("h24")))
    right = right.withColumn("dia", F.when(F.col("id") == 43, F.col("dia") + F.expr("interval 1 second")).otherwise(F.col("dia")))
    left = left.withColumn("h24", F.when(F.col("id") == 200, None).otherwise(F.col("h24")))
    return left, right


@pytest.mark.parametrize("tolerance", [None, 0.0001])
def test_digests_give_the_rows_of_a_full_comparison(spark, tolerance):
    left, right = faulty_pair(spark)
    got = digests.reconcile_by_digests(left, right, KEY, ["h24"], "dia", "estacao_id", tolerance)
    want = compare.reconcile_exact(left, right, KEY, ["h24"]) if tolerance is None else compare.reconcile(left, right, KEY, ["h24"], tolerance)
    assert rows(got, *want.columns) == rows(want)


def test_only_unequal_groups_are_joined(spark):
    left, right = faulty_pair(spark)
    _, _, groups, by = digests.unequal_groups(left, right, KEY, ["h24"], digests.levels("dia", "estacao_id"))
    found = rows(groups.select("_month", "_day").distinct())
    differ = rows(compare.reconcile_exact(left, right, KEY, ["h24"]).filter("status <> 'ok'").select(F.date_format("dia", "yyyy-MM"), F.to_date("dia")).distinct())
    assert found == differ and by == ["_month", "_bucket", "_day"]
    same = digests.unequal_groups(left, left, KEY, ["h24"], digests.levels("dia", "estacao_id"))[2]
    assert same.count() == 0


def test_digests_ignore_order_and_see_nulls(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 2.0, None)], "k int, a double, b double")
    swapped = spark.createDataFrame([(2, None, 2.0), (1, 2.0, None)], "k int, a double, b double")
    one = lambda d: rows(digests.digests(d.withColumn("g", F.lit(0)), ["g"], ["k"], ["a", "b"]))
    assert one(df) == one(df.orderBy(F.desc("k"))) and one(df) != one(swapped)


# --- diagnosis, checks, lag ---


def test_diagnosis_reads_each_input_once(spark, tmp_path):
    readings = spark.createDataFrame([(1, at("2019-01-05"), 1), (2, at("2019-01-05"), 1), (3, None, 2), (4, at("2020-01-01"), 7), (5, at("2020-01-02"), 2)], "id bigint, horaLeitura timestamp_ntz, estacao_id bigint")
    rain = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 1.0), (4, 1.0), (9, 1.0), (None, 3.0)], "leitura_id bigint, m05 double")
    stations = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, nome string")
    tables = []
    for n, df in enumerate((readings, rain, stations)):
        df.write.parquet(str(tmp_path / str(n)))
        tables.append(spark.read.parquet(str(tmp_path / str(n))))
    keys = diagnosis.by_key(*tables)
    both = diagnosis.summary(keys, "2019-01").unionByName(keys.filter("total > 1").select("dia", "estacao_id", "total"), allowMissingColumns=True)
    both.collect()
    final = plan(both).split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 3 and "ReusedExchange" in final
    found = diagnosis.diagnose(*tables, "2019-01")
    assert rows(found["coverage"]) == [(5, at("2019-01-05"), at("2020-01-02"), 6, 3, at("2019-01-05"), at("2019-01-05"))]
    assert rows(found["years"]) == [(2019, 3)] and found["first_month"].first()[0] == 3
    assert rows(found["duplicates"]) == [(at("2019-01-05"), 1, 3)] and found["duplicate_count"].first()[0] == 1
    assert rows(diagnosis.join_coverage(*tables)) == rows(found["coverage"])


def test_load_checks_are_counted_while_writing(spark, path):
    readings = spark.createDataFrame([(i, at(f"20{18 + i % 3}-01-0{1 + i % 9}"), i) for i in range(30)], "id bigint, horaLeitura timestamp_ntz, estacao_id int")
    metrics = ["m05", "m10", "m15", "h01", "h04", "h24", "h96"]
    rain = readings.select(F.col("id").alias("leitura_id"), *[F.lit(1.0).alias(m) for m in metrics])
    stations = spark.createDataFrame([(i, f"s{i}") for i in range(30)], "id int, nome string")
    got = rain_plan.load_replica(readings, rain, stations, path, last_year=2019).first()
    assert (got["total"], [tuple(x) for x in got["anos"]], got["outros_anos"]) == (30, [(2018, 10), (2019, 10)], 10)
    assert read_table(spark, path).count() == 30


def test_pending_as_the_source_counts_it(spark):
    readings = spark.createDataFrame([(1, at("2024-01-02"), 1), (2, at("2024-01-02"), 1), (3, at("2024-01-03"), 2), (4, at("2024-01-04"), 9), (5, at("2024-01-05"), 1)], "id bigint, horaLeitura timestamp_ntz, estacao_id bigint")
    rain = spark.createDataFrame([(1,), (1,), (3,), (8,)], "leitura_id bigint")
    values = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 5), (4, 1)], "leitura_id bigint, sensor_id int")
    sensors = spark.createDataFrame([(1, "a"), (2, "b")], "id int, nome string")
    stations = spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, nome string")
    span = ("2024-01-01 00:00:00", "2024-01-31 00:00:00")
    assert w.pending_rows(w.rain_to_sync(readings, rain), "horaLeitura", *span).first()[0] == 3
    # Readings 1 and 2 are one instant; 3 has no known sensor, 4 no known station.
    source = w.weather_to_sync(readings, values, sensors, stations)
    assert w.pending_readings(source, "horaLeitura", "estacao_id", *span).first()[0] == 1


def test_layout_by_folder_names(spark, path):
    sink.reload_table(many(spark, 300), path, "dia", marked=True)
    table = read_table(spark, path)
    assert rows(contracts.stored_layout(table, "ano_mes")) == rows(contracts.layout_check(table, "ano_mes"))


# --- buckets, matches, reports, feeds ---


def test_bucketed_join_needs_no_exchange(spark, tmp_path):
    readings = spark.createDataFrame([(i, at("2024-01-01"), i % 5) for i in range(200)], "id bigint, horaLeitura timestamp_ntz, estacao_id bigint")
    rain = spark.createDataFrame([(i % 150, float(i)) for i in range(400)], "leitura_id bigint, m05 double")
    a = buckets.write_bucketed(readings, "leitura_teste", "id", path=str(tmp_path / "a"))
    b = buckets.write_bucketed(rain, "chuva_teste", "leitura_id", path=str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = rain_versions(a, b, ["m05"])
        assert "Exchange" not in plan(joined)
        assert rows(joined) == rows(rain_versions(readings, rain, ["m05"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE leitura_teste")
        spark.sql("DROP TABLE chuva_teste")


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS", 100)
    readings = spark.range(2000).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' AS horaLeitura", "id % 5 AS estacao_id")
    rain = spark.range(4000).selectExpr("id % 1500 AS leitura_id", "CAST(id AS DOUBLE) AS m05")
    n = buckets.bucket_count(readings, rain)
    assert n == 64 and buckets.bucket_count(readings.limit(0)) == buckets.BUCKETS
    a = buckets.write_bucketed(readings, "leitura_larga", "id", n, str(tmp_path / "a"))
    b = buckets.write_bucketed(rain, "chuva_larga", "leitura_id", n, str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = rain_versions(a, b, ["m05"])
        assert "Exchange" not in plan(joined) and joined.rdd.getNumPartitions() == 64
        assert rows(joined) == rows(rain_versions(readings, rain, ["m05"]))
        buckets.write_bucketed(rain, "chuva_larga", "leitura_id", path=str(tmp_path / "b"))
        assert "64 out of 64" in plan(spark.table("chuva_larga").filter("leitura_id >= 0").join(a, F.col("id") == F.col("leitura_id")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS leitura_larga")
        spark.sql("DROP TABLE IF EXISTS chuva_larga")


def test_first_in_hour_takes_the_newest_of_an_instant(spark):
    probe = spark.createDataFrame([(1, at("2024-01-01 10:00:00"))], "estacao_id int, dia timestamp_ntz")
    target = spark.createDataFrame([(1, at("2024-01-01 09:30:00"), i) for i in (5, 9, 7)] + [(1, at("2024-01-01 09:40:00"), 11)], "estacao_id int, quando timestamp_ntz, id int")
    got = matching.first_in_window(probe, target, "estacao_id", "dia", "quando", ["id"], newest=["id"])
    assert rows(got, "match_ts", "id") == [(at("2024-01-01 09:30:00"), 9)]


def test_same_named_reports_of_two_folders(spark, tmp_path):
    for folder, head, line in (("x", "Data;Hora;Chuva;Temperatura", "01/02/2024;00:00:00;1.5;21.0"), ("y", "Data;Hora;Temperatura;Chuva", "01/02/2024;00:15:00;22.0;2.5")):
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / "est_Met.txt").write_text(f"{head}\n{line}\n")
    (tmp_path / "y" / "leia.txt").write_text("nada\n")
    lines = reports.read_lines(spark, [str(tmp_path / "x"), str(tmp_path / "y")])
    assert rows(reports.parse_delimited(lines), "ts_site", "chuva", "temperatura", "arquivo") == [
        (at("2024-02-01 00:00:00"), 1.5, 21.0, "est_Met.txt"), (at("2024-02-01 00:15:00"), 2.5, 22.0, "est_Met.txt")]
    assert rows(reports.files_without_layout(lines), "arquivo") == [("leia.txt",)]
    both = reports.parse_delimited(lines).withColumn("ts_utc", F.lit(at("2024-02-01 00:00:00"))).withColumn("estacao", F.lit("e"))
    # Of two files of one name the one in the later folder wins.
    assert rows(reports.last_report_wins(both), "chuva") == [(2.5,)]


def test_timed_feed_goes_on_after_a_stop(spark, tmp_path):
    """A stream with a trigger and a state store is stopped and started again from its checkpoint."""
    feed, out, progress = (str(tmp_path / n) for n in ("feed", "out", "progress"))

    def start():
        source = read_feed(spark, feed, STORED, files_per_batch=1)
        keys = dedupe_feed(source, KEY, "dia", "2 days").select("id", *KEY)
        return keys.writeStream.format("parquet").option("checkpointLocation", progress).trigger(processingTime="200 milliseconds").start(out)

    def arrived(n):
        end = time.time() + 60
        while time.time() < end:
            if os.path.isdir(out) and spark.read.schema("id bigint, dia timestamp, estacao_id bigint").parquet(out).count() >= n:
                return True
            time.sleep(0.3)
        return False

    frame(spark, (1, "2024-01-01 00:00:00", 1, 0.0), (2, "2024-01-01 01:00:00", 1, 0.0)).coalesce(1).write.mode("append").parquet(feed)
    query = start()
    assert arrived(2)
    query.stop()
    # Arrives while nothing runs: a key seen before the stop and a new one.
    frame(spark, (3, "2024-01-01 00:00:00", 1, 0.0), (4, "2024-01-01 02:00:00", 1, 0.0)).coalesce(1).write.mode("append").parquet(feed)
    query = start()
    assert arrived(3)
    query.processAllAvailable()
    query.stop()
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (4,)]
