"""Archives read back, rerun and compared byte for byte."""

import base64
import gzip
import hashlib
import os
from collections import Counter

import pytest

from gaugeworks.llm import warc

PAGES = "page_id long, url string, html string, sha string, _first string"


def rows():
    out = [(i, f"http://a.example/{i}", f"<p>{i % 7} é</p>" * (i % 5), "x", "y") for i in range(300)]
    out += [(5000, None, None, "x", "y"), (5001, "u\r\nX: 1 é%", "", "x", "y"), (None, "n", "<p>1 é</p>", "x", "y"), (None, None, None, None, None)]
    return out + [(40, "http://a.example/40", "<p>5 é</p>" * 0, "x", "y"), (6000, "long", "z" * 300_000, "x", "y"), (6001, "long", "z" * 300_000, "x", "y")]


def plain(least):
    first = {}
    for page, _, html, *_ in rows():
        if page is not None:
            p = (html or "").encode()
            first[p] = min(first.get(p, page), page)
    out = []
    for page, _, html, *_ in rows():
        p = (html or "").encode()
        again = page is not None and len(p) >= least and first[p] != page
        out.append((page, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", first[p] if again else None))
    return Counter(out)


def files(folder):
    return {f: open(f"{folder}/{f}", "rb").read() for f in sorted(os.listdir(folder)) if f.endswith(".gz")}


@pytest.mark.parametrize("least", [0, 100])
def test_read_back(spark, tmp_path, least):
    pages = spark.createDataFrame(rows(), PAGES)
    manifest = warc.write(pages, str(tmp_path / "a"), least=least, shard=64, roll=1000)
    got = warc.read(spark, str(tmp_path / "a")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(map(tuple, got)) == plain(least)
    own = files(tmp_path / "a")
    listed = {r.file: r for r in manifest.collect()}
    assert set(listed) == set(own) and not [f for f in os.listdir(tmp_path / "a") if "tmp" in f]
    assert all(listed[f].sha256 == hashlib.sha256(b).hexdigest() and listed[f].bytes == len(b) for f, b in own.items())
    assert max(Counter(r.shard for r in listed.values()).values()) > 1  # rolled
    # Other partitions, the same bytes.
    warc.write(pages.repartition(7), "file:" + str(tmp_path / "b"), least=least, shard=64, roll=1000)
    assert files(tmp_path / "b") == own


@pytest.mark.parametrize("ids", [[1_000_003 * i for i in range(300)], [7] * 300, [None] * 300])
def test_shards_follow_records_not_ids(spark, tmp_path, ids):
    """Sparse ids make no more files than dense ones; equal and null ids are cut, too."""
    pages = spark.createDataFrame([(i, f"u{k}", f"<p>{k}</p>") for k, i in enumerate(ids)], "page_id long, url string, html string")
    assert warc.write(pages, str(tmp_path / "one")).count() == 1
    shards = {r.shard for r in warc.write(pages, str(tmp_path / "many"), shard=20).collect()}
    assert 5 < len(shards) < 40
    got = warc.read(spark, str(tmp_path / "many")).select("page_id", "url", "record_type").collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, f"u{k}") for k, i in enumerate(ids))
    found = [line for b in files(tmp_path / "many").values() for line in gzip.decompress(b).split(b"\r\n") if line.startswith(b"WARC-Record-ID")]
    assert len(set(found)) == 300


def test_revisits_refer_to_a_record(spark, tmp_path):
    warc.write(spark.createDataFrame(rows(), PAGES), str(tmp_path / "a"), shard=16)
    lines = [line for b in files(tmp_path / "a").values() for line in gzip.decompress(b).split(b"\r\n")]
    ids = {line.partition(b": ")[2] for line in lines if line.startswith(b"WARC-Record-ID: ")}
    refers = {line.partition(b": ")[2] for line in lines if line.startswith(b"WARC-Refers-To: ")}
    assert refers and refers <= ids


def test_a_shard_has_one_writer(spark, tmp_path):
    """However the planner joins, no task writes the files of another one."""
    plans = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in plans}
    for key, value in plans.items():
        spark.conf.set(key, value)
    try:
        manifest = warc.write(spark.createDataFrame(rows(), PAGES), str(tmp_path / "a"), shard=16)
        got = warc.read(spark, str(tmp_path / "a")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len({r.file for r in manifest.collect()}) == manifest.count()
    assert Counter(map(tuple, got)) == plain(0)


def test_records(tmp_path):
    one = warc.record(3, "http://x/ü a", "é".encode(), None)
    assert b"WARC-Target-URI: http://x/\xc3\xbc%20a\r\n" in one and one.endswith("\r\n\r\né\r\n\r\n".encode())
    path = tmp_path / "x.gz"
    path.write_bytes(gzip.compress(one) + gzip.compress(one.replace("é".encode(), b"ee")))
    with pytest.raises(ValueError, match="digest"):
        list(warc._records(open(path, "rb")))


def test_empty(spark, tmp_path):
    assert warc.write(spark.createDataFrame([], PAGES), str(tmp_path / "e")).count() == 0
    assert warc.read(spark, str(tmp_path / "e")).count() == 0
