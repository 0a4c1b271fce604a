import hashlib
import os
import random

import pytest

from stemma.llm import registry, warc
from tests.llm.cases import SF, folder
from tests.oracle import connection, duck_rows, spark_rows

PAGES = "page_id bigint, url string, html string"
FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Type: text/plain\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def hard_pages():
    rng = random.Random(4)
    long = "".join(rng.choice("ab\r\n<>") for _ in range(300_000))
    same = "<p>" + "same text " * 20
    rows = [(i, f"http://h/{i}", f"<p>{'x' * (i * 7)}</p>") for i in range(40)]
    rows += [(100 + i, f"http://h/{i}\r\nWARC-Type: metadata", same) for i in range(30)]
    rows += [(200, None, None), (201, "u", ""), (202, "é ß", "é😀" * 30), (203, "u", long), (None, "u", same), (None, "u", "null id " * 30), (101, "again", same), (100, "again", same)]
    rows += [(300 + i, "u", "small" * (i % 3)) for i in range(6)]
    # magics, whole records and long runs of records inside payloads
    rows += [(400, "WARC/1.0", "\r\n\r\nWARC/1.1\r\n"), (401, "u", f"\r\n\r\n{FAKE}" * 3), (402, "u", f"text\n{FAKE}" + "y" * 500), (403, "u", f"\r\n\r\n{FAKE}" * 900 + "\nWARC/1."), (404, "u", "\n" * 50 + f"\n{FAKE}\r\n\r\n")]
    rows += [(405, "u", FAKE.replace("Length: 3", "Length: 99999999") + "\n" + FAKE)]
    return rows


def expected(rows):
    first = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        other = first.get(h)
        again = other is not None and other != i
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", other if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["128m", "20k", "5k"])
def test_round_trip_of_hard_pages(spark, tmp_path, split):
    rows = hard_pages()
    sf = folder(spark, tmp_path, spark.createDataFrame([], "doc_id bigint"), pages=spark.createDataFrame([(*r, "q", 1) for r in rows], PAGES + ", digest string, original int").coalesce(2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.op11_warc(spark, sf).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_payloads_and_files(spark, tmp_path):
    rows = hard_pages()
    path = str(tmp_path / "archive")
    warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), path)
    files = [f for f in os.listdir(path) if f.startswith("part")]
    data = b"".join((tmp_path / "archive" / f).read_bytes() for f in files)
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: re") and data.endswith(b"\r\n\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30k")
    try:
        got = warc.read_warc(spark, path, payloads=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {i: (h or "").encode() for i, _, h in rows if i is not None}
    assert len(got) == len(rows)
    for r in got:
        if r.type == "response":
            assert r.payload_digest == hashlib.sha256(r.payload).hexdigest() == r.digest.removeprefix("sha256:")
            assert r.record_id == "<urn:page:>" or want[int(r.record_id[10:-1])] == r.payload
        else:
            assert r.payload == b"" and r.refers_to == "<urn:page:100>"


def test_other_writers(spark, tmp_path):
    """Version 1.0, continued headers, records that are not HTTP messages, binary content."""
    one = b"WARC/1.0\r\nwarc-type: warcinfo\r\nContent-Length: 4\r\n\r\nab\r\n\r\n\r\n"
    two = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: http://h/\r\n  more\r\nContent-Type: image/png\r\nContent-Length: 9\r\n\r\n\x89\xff\nWARC/1\r\n\r\n"
    three = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 13\r\n\r\n" + b"\xff\x00\nWARC/1.1\r\n" + b"\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(one + two + three)
    (tmp_path / "b.warc").write_bytes(b"")
    got = sorted(warc.read_warc(spark, str(tmp_path), payloads=True).collect(), key=lambda r: r.at)
    assert [bytes(r.payload) for r in got] == [b"ab\r\n", b"\x89\xff\nWARC/1", b"\xff\x00\nWARC/1.1\r\n"]
    assert got[1].target_uri == "http://h/ more" and [r.at for r in got] == [0, len(one), len(one + two)]


def test_damaged_files_are_found(spark, tmp_path):
    whole = FAKE.encode()
    (tmp_path / "a.warc").write_bytes(whole * 3 + whole[:-2])
    with pytest.raises(ValueError, match="a.warc"):
        warc.read_warc(spark, str(tmp_path))


def test_empty_table(spark, tmp_path):
    sf = folder(spark, tmp_path, spark.createDataFrame([], "doc_id bigint"), pages=spark.createDataFrame([], PAGES))
    assert warc.op11_warc(spark, sf).collect() == []


def test_hot_payloads(spark, tmp_path):
    rows = [(i, "u", "hot payload " * 20 if i % 3 == 0 else f"{i // 2} " * 60) for i in range(4000)]
    sf = folder(spark, tmp_path, spark.createDataFrame([], "doc_id bigint"), pages=spark.createDataFrame(rows, PAGES))
    assert sorted(map(tuple, warc.op11_warc(spark, sf).collect()), key=str) == expected(rows)


def test_equals_sql(spark):
    got, names = spark_rows(registry.QUERIES["op11_warc"](spark, SF))
    want, expected = duck_rows(connection(SF), registry.ORACLES["op11_warc"])
    assert names == expected and got == want
