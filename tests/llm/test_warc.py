import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from newsloom.llm import warc


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def archive(spark, rows, tmp_path, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string, first int")
    path = f"file://{tmp_path}/archive"
    warc.write_warc(warc.page_records(pages, **options), path)
    return path


ROWS = [
    (5, "http://a/\r\nX: y", "same", "c", 1),
    (3, " http://b/é ", "same", "c", 1),
    (9, None, None, None, None),
    (8, "u", "", "c", 2),
    (1, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 50, "c", 2),
    (2, "u", "ü" * 3_000_000, "c", 2),
    (4, "u", "tie", "c", 2),
    (4, "u", "tie", "c", 2),
    (None, "u", "tie", "c", 2),
    (None, "u", "alone", "c", 2),
]


def test_round_trip(spark, tmp_path):
    path = archive(spark, ROWS, tmp_path)
    got = sorted((tuple(r) for r in warc.archived_pages(spark, path).collect()), key=str)
    plain = [(i, (h or "").encode()) for i, _, h, *_ in ROWS]
    expected = []
    for i, payload in plain:
        first = min((j for j, p in plain if p == payload and j is not None), default=None)
        again = first is not None and (i is None or i > first)
        expected.append((i, len(payload), digest(payload), "revisit" if again else "response", first if again else None))
    assert got == sorted(expected, key=str)
    urls = {r.target_uri for r in warc.read_warc(spark, path).collect()}
    assert urls == {"http://a/%0D%0AX: y", "%20http://b/é%20", None, "u"}


def test_smaller_payloads_are_not_revisits(spark, tmp_path):
    path = archive(spark, ROWS, tmp_path, min_revisit_bytes=4)
    kinds = {(r.page_id, r.record_type) for r in warc.archived_pages(spark, path).collect()}
    assert (9, "response") in kinds and (8, "response") in kinds and (5, "revisit") in kinds


def test_filters_reach_the_reader(spark, tmp_path, capfd):
    path = archive(spark, ROWS, tmp_path)
    reader = warc.WarcReader(path, True)
    left = list(
        reader.pushFilters([warc.EqualTo(("warc_type",), "revisit"), warc.In(("target_uri",), ("u",)), warc.EqualTo(("payload",), b"")])
    )
    assert len(left) == 1 and reader.allowed == {"warc_type": {"revisit"}, "target_uri": {"u"}}
    rows = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
    assert {r["warc_type"] for r in rows} == {"revisit"} and len(rows) == 1
    plan = warc.read_warc(spark, path).filter("warc_type = 'revisit' AND target_uri = 'u'")
    assert plan.count() == 1
    plan.explain()
    assert "Filter (" not in capfd.readouterr().out, "both conditions are left to the reader"
    assert warc.read_warc(spark, path).filter(F.col("headers")["WARC-Type"] == "revisit").count() == 3


def test_files_that_were_not_committed_are_not_read(spark, tmp_path):
    path = archive(spark, ROWS, tmp_path)
    with gzip.open(f"{tmp_path}/archive/part-lost.warc.gz", "wb") as f:
        f.write(b"broken")
    assert warc.read_warc(spark, path).count() == len(ROWS)


def test_foreign_archives(spark, tmp_path):
    body = b"WARC/1.0\nwarc-type: resource\nWARC-Target-URI: x\n  y\ncontent-length: 3\n\nabc\n\n"
    (tmp_path / "one.warc").write_bytes(body * 2)
    got = warc.read_warc(spark, f"{tmp_path}/one.warc", payload=True).collect()
    assert [(r.warc_type, r.target_uri, bytes(r.payload)) for r in got] == [("resource", "x y", b"abc")] * 2
    (tmp_path / "cut.warc").write_bytes(body[:-4])
    with pytest.raises(Exception, match="ends inside"):
        warc.read_warc(spark, f"{tmp_path}/cut.warc", payload=True).collect()


def test_empty(spark, tmp_path):
    path = archive(spark, [], tmp_path)
    assert warc.archived_pages(spark, path).collect() == []
