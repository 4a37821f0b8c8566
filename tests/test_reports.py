import pytest
from pyspark.sql import functions as F
from support import at, rows

from gaugeworks.sources import reports

HEAD = "Sistema\nRelatório Meteorológico\n\nDados normalizados HBV\nDia         Hora      Chuva  DirVento VelVento Temperatura Pressao Umidade\n   (mm) (graus) (Km/h)\n"


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_fixed_layout(spark, tmp_path):
    write(tmp_path, "a_Met.txt", HEAD + "\n".join([
        "01/02/2026  00:00:00   0,2  180,0  3.5  25,1  ND  80",
        "01/02/2026 00:15:00 HBV 0.4 181 3 25 1013 81",
        "01/02/2026 00:30:00 1 2 3 4 5",
        "  ", "texto livre", "99/99/2026 00:45:00 1 2 3 4 5 6",
        "17/02/2018 23:30:00 1 2 3 4 5 6",
    ]), "latin-1")
    lines = reports.read_lines(spark, str(tmp_path))
    got = {r["ts_site"]: r for r in reports.parse_report(lines).collect()}
    assert set(got) == {at("2026-02-01 00:00:00"), at("2026-02-01 00:15:00"), at("2018-02-17 23:30:00")}
    first = got[at("2026-02-01 00:00:00")]
    assert (first["chuva"], first["pressao"], first["umidade"], first["ts_utc"]) == (0.2, None, 80.0, at("2026-02-01 03:00:00"))
    assert got[at("2026-02-01 00:15:00")]["chuva"] == 0.4
    # A local time that occurs twice has no instant.
    assert got[at("2018-02-17 23:30:00")]["ts_utc"] is None
    assert reports.files_without_header(lines).count() == 0


@pytest.mark.parametrize("encoding", ["utf-8-sig", "utf-8", "latin-1", "cp1252"])
def test_line_encodings(spark, tmp_path, encoding):
    write(tmp_path, "x.txt", "Relatório São Cristóvão\n", encoding)
    assert rows(reports.read_lines(spark, str(tmp_path)), "linha") == [("Relatório São Cristóvão",)]


def test_several_files_last_wins_and_missing_header(spark, tmp_path):
    write(tmp_path, "a.txt", HEAD + "01/02/2026 00:00:00 1 2 3 4 5 6\n")
    write(tmp_path, "b.txt", HEAD + "01/02/2026 00:00:00 9 2 3 4 5 6\n01/02/2026 01:00:00 7 2 3 4 5 6\n")
    write(tmp_path, "c.txt", "nada\n")
    lines = reports.read_lines(spark, str(tmp_path))
    got = reports.last_report_wins(reports.parse_report(lines).withColumn("estacao", F.lit("x")))
    assert rows(got, "ts_site", "chuva", "arquivo") == [
        (at("2026-02-01 00:00:00"), 9.0, "b.txt"), (at("2026-02-01 01:00:00"), 7.0, "b.txt")]
    assert rows(reports.files_without_header(lines), "arquivo") == [("c.txt",)]


def delimited(sep, *lines):
    return "\n".join(sep.join(x) for x in lines) + "\n"


@pytest.mark.parametrize("sep,encoding", [("\t", "utf-8"), (";", "latin-1"), (",", "utf-8-sig"), ("   ", "cp1252")])
def test_delimited(spark, tmp_path, sep, encoding):
    path = write(tmp_path, "r.txt", delimited(
        sep, ["Data", "Hora", "Precipitação", "Direção", "Umidade"],
        ["01/02/2026", "00:00:00", "0.2", "180", "80"], ["02/02/2026", "00:15", "ND", "-", "81"], ["ruim", "00:30:00", "1", "2", "3"]), encoding)
    got = reports.read_delimited(spark, path)
    assert rows(got, "ts_site", "ts_utc", "chuva", "dirvento", "umidade", "pressao", "arquivo") == [
        (at("2026-02-01 00:00:00"), at("2026-02-01 03:00:00"), 0.2, 180.0, 80.0, None, "r.txt"),
        (at("2026-02-02 00:15:00"), at("2026-02-02 03:15:00"), None, None, 81.0, None, "r.txt")]


def test_files_of_different_layouts_go_together(spark, tmp_path):
    write(tmp_path, "a.txt", delimited(";", ["Data", "Hora", "Chuva", "Temperatura"], ["01/02/2026", "00:00:00", "2", "21"]))
    write(tmp_path, "b.txt", "Estação X\n" + delimited(",", ["Temperatura", '"Chuva, mm"', "Data_Hora"], ["21", '"2"', "01/02/2026 01:00:00"]))
    write(tmp_path, "c.txt", "nada\n1;2\n")
    lines = reports.read_lines(spark, str(tmp_path))
    assert rows(reports.parse_delimited(lines), "ts_site", "chuva", "temperatura") == [
        (at("2026-02-01 00:00:00"), 2.0, 21.0), (at("2026-02-01 01:00:00"), 2.0, 21.0)]
    assert rows(reports.files_without_layout(lines), "arquivo") == [("c.txt",)]


def test_header_roles(spark):
    lines = spark.createDataFrame([(t,) for t in ("Data_Hora;Direção;Velocidade;Temperatura (C);Pressão;Umidade;Chuva", "Dia;Chuva", "Dia Hora Chuva", "1;2")], "linha string")
    got = [(r["_sep"], r["_roles"]) for r in reports.header_roles(lines).collect()]
    assert got[0][0] == ";" and tuple(got[0][1]) == (0, None, None, 6, 1, 2, 3, 4, 5)
    assert got[1][1] is None and got[3][1] is None
    assert got[2][0] == " " and tuple(got[2][1])[:4] == (None, 0, 1, 2)


def test_last_wins_keeps_stations_and_repeated_local_times(spark):
    lines = [("17/02/2018 23:30:00 1 2 3 4 5 6", "a"), ("17/02/2018 23:45:00 1 2 3 4 5 6", "a"), ("17/02/2018 23:30:00 2 2 3 4 5 6", "b")]
    parsed = reports.parse_report(spark.createDataFrame(lines, "linha string, arquivo string")).withColumn("estacao", F.col("arquivo"))
    assert reports.last_report_wins(parsed).count() == 3
