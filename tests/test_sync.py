"""Watermarks, merges, stored tables, streams."""

import pytest
from support import at, plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators import columns, contracts, merge, watermarks as w
from gaugeworks.schema import WAREHOUSE_RAIN
from gaugeworks.session import work_dir
from gaugeworks.sinks import exports, tables as sink
from gaugeworks.sources.jdbc import month_slices, slice_predicates, year_slices
from gaugeworks.sources.tables import read_table, scan_range
from gaugeworks.streaming.sync import dedupe_feed, live_view, read_feed, sync_stream

KEY = ["dia", "estacao_id"]
SCHEMA = "id bigint, dia timestamp_ntz, estacao_id bigint, h24 double"


def frame(spark, *data):
    return spark.createDataFrame([(i, at(d) if d else None, s, v) for i, d, s, v in data], SCHEMA)


@pytest.fixture
def old(spark):
    return frame(spark, (1, "2024-01-01 00:00:00", 1, 1.0), (2, "2024-01-02 00:00:00", 1, 2.0), (3, "2024-02-01 00:00:00", 2, 3.0))


@pytest.fixture
def new(spark):
    return frame(spark, (4, "2024-01-02 00:00:00", 1, 20.0), (5, "2024-01-01 12:00:00", 2, 5.0), (6, "2024-03-01 00:00:00", 9, 6.0))


def test_global_watermark_loses_slow_stations_station_watermarks_do_not(old, new):
    wm = w.global_watermark(old, "dia")
    assert rows(w.newer_than_global(new, wm, "dia"), "id") == [(6,)]
    assert rows(w.newer_than_global(old, wm, "dia", inclusive=True), "id") == [(3,)]
    per = w.station_watermarks(old, "dia", "estacao_id")
    # Station 9 was never seen.
    assert rows(w.newer_than_station(new, per, "dia", "estacao_id"), "id") == [(6,)]
    late = new.withColumn("dia", F.col("dia") + F.expr("interval 25 hours"))
    assert rows(w.newer_than_station(late, per, "dia", "estacao_id"), "id") == [(4,), (6,)]


def test_empty_target_lets_everything_through(old, new):
    empty = old.limit(0)
    assert w.newer_than_global(new, w.global_watermark(empty, "dia"), "dia").count() == 3
    assert w.newer_than_station(new, w.station_watermarks(empty, "dia", "estacao_id"), "dia", "estacao_id").count() == 3


def test_watermark_is_compared_in_the_scan(spark, old, new, path):
    new.write.parquet(path)
    p = plan(w.newer_than_global(spark.read.parquet(path), w.global_watermark(old, "dia"), "dia"))
    assert "ScalarSubquery" in p and "Join" not in p


def test_measured_watermarks_are_broadcast_by_size(spark, old, path):
    old.write.parquet(path)
    per = w.measured(w.station_watermarks(spark.read.parquet(path), "dia", "estacao_id"))
    p = plan(w.newer_than_station(spark.read.parquet(path), per, "dia", "estacao_id"))
    assert "BroadcastHashJoin" in p
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(w.newer_than_station(spark.read.parquet(path), per, "dia", "estacao_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_future_rows_do_not_poison_the_watermark(spark, old):
    bad = old.unionByName(frame(spark, (9, "2103-01-01 00:00:00", 1, 0.0)))
    assert w.global_watermark(bad, "dia", "2024-02-02 00:00:00").first()[0] == at("2024-02-01 00:00:00")
    assert dict(rows(w.station_watermarks(bad, "dia", "estacao_id", "2024-02-02 00:00:00")))[1] == at("2024-01-02 00:00:00")


def test_require_watermark(old):
    w.require_watermark(w.global_watermark(old, "dia"))
    for target in [old.limit(0), old.withColumn("dia", F.to_timestamp_ntz(F.lit("1997-01-01 00:00:00")))]:
        with pytest.raises(ValueError):
            w.require_watermark(w.global_watermark(target, "dia"))


def lag(target, source, as_of, **kw):
    r = w.lag_report(target, source, "dia", as_of, **kw).first()
    return r["status"], r["pending"], r["days_behind"], r["significant"]


def test_lag_report(spark, old, new):
    assert lag(old, new, "2024-03-02 00:00:00") == ("pending", 1, 30, True)
    assert lag(old, old, "2024-02-02 12:00:00") == ("current", 0, 1, False)
    assert lag(old.limit(0), new, "2024-03-02 00:00:00") == ("empty", 0, None, False)
    assert lag(old, new, "1999-01-01 00:00:00") == ("future", 0, None, False)
    twice = new.unionByName(new)
    assert lag(old, twice, "2024-03-02 00:00:00")[1] == 2
    assert lag(old, twice, "2024-03-02 00:00:00", station="estacao_id")[1] == 1


def test_merges(old, new):
    up = merge.upsert(old, new, KEY)
    assert rows(up, "id") == [(1,), (3,), (4,), (5,), (6,)]
    assert rows(merge.upsert(up, new, KEY)) == rows(up)
    assert rows(merge.insert_if_absent(old, new, KEY), "id") == [(1,), (2,), (3,), (5,), (6,)]
    # With a version the newer stays, whichever side it is on.
    assert rows(merge.upsert(new, old, KEY, "id")) == rows(merge.upsert(old, new, KEY, "id")) == rows(up)


def test_schema_evolution(spark, old):
    wider = old.withColumn("mes", F.lit(1.0)).drop("h24")
    both = merge.append_evolved(old, wider)
    assert both.columns == ["id", "dia", "estacao_id", "h24", "mes"] and both.filter("mes is null").count() == 3
    evolved = merge.evolve(old.schema, wider.schema)
    assert evolved.names == ["id", "dia", "estacao_id", "h24", "mes"] and evolved["h24"].nullable
    with pytest.raises(ValueError):
        merge.evolve(old.schema, T.StructType([T.StructField("H24", T.StringType())]))


def test_conform_and_coercion(spark):
    df = spark.createDataFrame([("1", "x", " 7 "), ("2", "1.5", "a")], "ID string, H24 string, id_estacao string")
    got = columns.coerce_numbers(columns.canonical_names(df), ["h24"])
    assert rows(got, "h24", "estacao_id") == [(1.5, None), (None, 7)]
    contract = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("novo", T.DoubleType())])
    assert rows(columns.conform(df, contract)) == [(1, None), (2, None)]
    with pytest.raises(ValueError):
        columns.conform(df.drop("ID"), contract)


# --- stored tables ---


def stored(spark, path):
    return rows(read_table(spark, path), "id", "dia", "estacao_id", "h24")


def test_upsert_table_rewrites_touched_months_only(spark, old, new, path):
    sink.reload_table(old, path, "dia")
    before = rows(read_table(spark, path).filter("ano_mes = '2024-02'"), "_metadata.file_path")
    sink.upsert_table(spark, path, new, KEY, "dia")
    assert stored(spark, path) == rows(merge.upsert(old, new, KEY))
    assert before == rows(read_table(spark, path).filter("ano_mes = '2024-02'"), "_metadata.file_path")
    once = stored(spark, path)
    sink.upsert_table(spark, path, new, KEY, "dia")
    assert stored(spark, path) == once
    sink.upsert_table(spark, path, new.limit(0), KEY, "dia")
    assert stored(spark, path) == once
    sink.append_absent(spark, path, new.limit(0), KEY, "dia")
    assert stored(spark, path) == once
    with pytest.raises(ValueError):
        sink.upsert_table(spark, path, new, ["estacao_id"], "dia")


def test_append_absent_is_repeatable_and_adds_columns(spark, old, new, path):
    sink.reload_table(old, path, "dia")
    wider = new.withColumn("mes", F.lit(9.0))
    for _ in range(2):
        sink.append_absent(spark, path, wider, KEY, "dia")
    got = read_table(spark, path, merge_schema=True)
    assert rows(got, "id", "mes") == [(1, None), (2, None), (3, None), (5, 9.0), (6, 9.0)]
    declared = T.StructType([*old.schema.fields, T.StructField("mes", T.DoubleType())])
    assert rows(read_table(spark, path, schema=sink.with_month(declared)), "id", "mes") == rows(got, "id", "mes")


def test_reload_replaces_table_or_months(spark, old, new, path):
    sink.reload_table(old, path, "dia")
    sink.reload_months(new, path, "dia")
    # January and March are new; February stayed.
    assert rows(read_table(spark, path), "id") == [(3,), (4,), (5,), (6,)]
    sink.reload_table(old, path, "dia")
    assert rows(read_table(spark, path), "id") == [(1,), (2,), (3,)]


def test_versions_and_compaction(spark, old, new, path):
    sink.append_versions(old, path, "dia")
    sink.append_versions(new, path, "dia")
    want = rows(merge.upsert(old, new, KEY), "id")
    assert rows(sink.current(read_table(spark, path), KEY, "id"), "id") == want
    sink.compact(spark, path, ["2024-01"], KEY, "id", "dia")
    assert rows(read_table(spark, path), "id") == want


def test_month_scan_prunes_folders(spark, old, new, path):
    sink.reload_table(old.unionByName(new), path, "dia")
    got = scan_range(read_table(spark, path), "dia", "2024-01-01 06:00:00", "2024-01-31 00:00:00", station="estacao_id", stations=[1])
    assert rows(got, "id") == [(2,), (4,)]
    p = plan(got)
    assert "PartitionFilters: [isnotnull(ano_mes" in p and "PushedFilters" in p


def test_exports(spark, old, new, path):
    df = old.unionByName(new)
    exports.export_by_year(df, path)
    back = read_table(spark, path)
    assert rows(back, "id", "ano") == [(i, 2024) for i in range(1, 7)]
    assert back.schema["dia"].dataType == T.TimestampType()
    exports.export_interval(df, path + "-i", 2024, 2024)
    assert read_table(spark, path + "-i").count() == 6
    exports.export_all(df, path + "-a")
    ordered = [r["dia"] for r in spark.read.parquet(path + "-a").orderBy("dia", "estacao_id").collect()]
    assert len(ordered) == 6
    with pytest.raises(ValueError):
        exports.export_interval(df, path + "-x", 2025, 2024)


def test_layout_and_schema_checks(spark, old):
    monthly = old.withColumn("p", F.date_format("dia", "yyyy-MM"))
    assert rows(contracts.layout_check(monthly, "p")) == [(2, "month", True)]
    daily = old.withColumn("p", F.date_format("dia", "yyyy-MM-dd"))
    assert rows(contracts.layout_check(daily, "p")) == [(3, "day", False)]
    wrong = T.StructType([T.StructField("M05", T.LongType()), T.StructField("estacao", T.StringType()), T.StructField("outra", T.StringType())])
    assert rows(contracts.schema_diff(spark, wrong, WAREHOUSE_RAIN)) == [("M05", "bigint", "double")]


def test_table_exists(spark, old, path):
    assert not contracts.table_exists(spark, path) and not contracts.table_exists(spark, "no_such_table")
    sink.reload_table(old, path, "dia")
    assert contracts.table_exists(spark, path)


def test_jdbc_slices():
    assert year_slices(1997, 1998) == [(1997, "1997-01-01", "1998-01-01"), (1998, "1998-01-01", "1999-01-01")]
    assert len(month_slices(1997, 1998)) == 24 and month_slices(1997, 1997)[-1] == (1997, "1997-12-01", "1998-01-01")
    got = slice_predicates("t", year_slices(1997, 1999))
    assert got == ["\"t\" < '1998-01-01'", "\"t\" >= '1998-01-01' AND \"t\" < '1999-01-01'", "\"t\" >= '1999-01-01'", '"t" IS NULL']
    assert slice_predicates("t", year_slices(1997, 1997)) == ['"t" IS NOT NULL', '"t" IS NULL']
    with pytest.raises(ValueError):
        slice_predicates("t", year_slices(1990, 1991) + year_slices(1995, 1996))
    with pytest.raises(ValueError):
        slice_predicates("t", [])


def test_slices_take_every_row_once(spark):
    times = [None, "1990-05-01", "1997-01-01", "1998-12-31", "1999-01-01", "2090-01-01"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    parts = [df.filter(p.replace('"', "`")) for p in slice_predicates("t", year_slices(1997, 1999))]
    assert sorted(str(r["t"]) for p in parts for r in p.collect()) == sorted(map(str, times))


# --- streams ---


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0]])
def test_stream_in_any_file_order_equals_batch(spark, tmp_path, path, order):
    feed = str(tmp_path / "feed")
    parts = [
        frame(spark, (1, "2024-01-01 00:00:00", 1, 1.0), (2, "2024-02-01 00:00:00", 1, 2.0)),
        frame(spark, (3, "2024-01-01 00:00:00", 1, 3.0), (4, "2024-01-05 00:00:00", 2, 4.0)),
        frame(spark, (5, "2024-01-01 00:00:00", 1, 5.0), (0, "2024-02-01 00:00:00", 1, 0.0)),
    ]
    for i in order:
        parts[i].coalesce(1).write.mode("append").parquet(feed)
        source = read_feed(spark, feed, parts[0].schema, files_per_batch=1)
        sync_stream(source, path, str(tmp_path / "progress"), KEY, "id", "dia").awaitTermination()
    assert rows(read_table(spark, path), "id") == [(2,), (4,), (5,)]
    assert rows(live_view(spark, path, "dia", 24, "2024-02-01 00:00:00"), "id") == [(2,)]


def test_stream_dedupe_within_delay(spark, tmp_path):
    feed = str(tmp_path / "feed")
    df = frame(spark, (1, "2024-01-01 00:00:00", 1, 1.0), (2, "2024-01-01 00:00:00", 1, 2.0), (3, "2024-01-01 00:00:00", 2, 2.0))
    df.coalesce(1).write.parquet(feed)
    out = dedupe_feed(read_feed(spark, feed, df.schema), KEY, "dia", "1 hour")
    q = out.writeStream.format("memory").queryName("deduped").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    assert spark.table("deduped").count() == 2


def test_work_dir_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(base) and b.startswith(base)


def test_a_replacement_cut_short_is_finished(spark, path, monkeypatch):
    """A stop after the old month went and before the new one came loses nothing."""
    import shutil

    schema = "id int, dia_utc timestamp_ntz, estacao_id int"
    first = spark.createDataFrame([(1, at("2024-01-01"), 1), (2, at("2024-01-02"), 1), (3, at("2024-02-01"), 1)], schema)
    sink.reload_table(first, path)
    write = sink._write

    def stop(df, to, *rest):
        if to == path:
            shutil.rmtree(f"{path}/ano_mes=2024-01")
            raise RuntimeError("stopped")
        write(df, to, *rest)

    monkeypatch.setattr(sink, "_write", stop)
    batch = spark.createDataFrame([(9, at("2024-01-02"), 1), (4, at("2024-01-03"), 1)], schema)
    with pytest.raises(RuntimeError):
        sink.upsert_table(spark, path, batch, ["dia_utc", "estacao_id"])
    monkeypatch.setattr(sink, "_write", write)
    sink.upsert_table(spark, path, batch, ["dia_utc", "estacao_id"])
    assert rows(spark.read.parquet(path), "id") == [(1,), (3,), (4,), (9,)]
    assert sink.finish_open(spark, path) is False


def test_rows_without_a_time_raise_and_leave_the_table(spark, path):
    schema = "id int, dia_utc timestamp_ntz, estacao_id int"
    sink.reload_table(spark.createDataFrame([(1, at("2024-01-01"), 1)], schema), path)
    batch = spark.createDataFrame([(2, None, 1), (3, at("2024-01-02"), 1)], schema)
    for write in (sink.upsert_table, sink.append_absent):
        with pytest.raises(ValueError, match="without a time"):
            write(spark, path, batch, ["dia_utc", "estacao_id"])
    assert rows(spark.read.parquet(path), "id") == [(1,)]


def test_slices_that_cut_a_month_raise(spark, path):
    from gaugeworks.plans import weather

    with pytest.raises(ValueError, match="start of a month"):
        weather.export_slice(None, None, None, None, None, path, "2024-01-10 00:00:00", "2024-01-20 00:00:00")
