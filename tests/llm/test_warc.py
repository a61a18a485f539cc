import gzip

import duckdb
import pytest

import edge
from imlens.llm import arc
from imlens.llm import op9_warc as warc

DDL = "page_id long, url string, html string"


def _pages():
    rows = [(i, f"http://h{i % 3}.org/{i}", f"<p>{i % 7}</p>") for i in range(40)]
    return rows + [(100, None, None), (101, "http://a b\n/c", ""), (102, "", "WARC/1.1\r\n\r\n\r\n\r\nx"), (103, "http://x", "é" * 200_000), (104, "http://x", "<p>3</p>")]


def test_pages_against_sql(spark, tmp_path):
    folder = edge.write(spark, str(tmp_path), "pages", _pages(), DDL)
    out = warc.op9_warc(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({warc.ORACLE})").fetchall()
    assert sorted((tuple(r) for r in out.collect()), key=edge.key) == sorted(want, key=edge.key)


def test_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "u", "same"), (5, "u", "same"), (5, "u", "same"), (None, "u", "alone"), (7, "v", "same")]
    got = warc.op9_warc(spark, edge.write(spark, str(tmp_path), "pages", rows, DDL)).collect()
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in got)
    assert kinds == [(0, "response", 0), (0, "revisit", 5), (5, "response", 0), (5, "revisit", 5), (7, "revisit", 5)]


def test_both_versions_and_damage(spark):
    def archive(version, cut=0):
        body = b"HTTP/1.0 200 OK\r\nX-Page-Id: 9\r\n\r\nhello\n\nworld"
        out = arc.arc_open("f.arc", version, b"19970101000000")
        out += arc.arc_record("f.arc", version, 0, b"http://a/x y", b"1.2.3.4", b"19970102030405", b"text/html", body)
        out += arc.arc_record("f.arc", version, 0, b"dns:a", b"1.2.3.4", b"1997", b"text/dns", b"a 1.2.3.4")
        return out[: len(out) - cut]

    rows = [("one.arc", archive(1)), ("two.arc", archive(2)), ("cut.arc", archive(1, 4)), ("odd.arc", b"no archive\n")]
    got = warc.convert(spark.createDataFrame([(n, bytearray(c)) for n, c in rows], "name string, content binary")).collect()
    sound = [r for r in got if r["error"] is None]
    assert sorted(r["record_type"] for r in sound) == ["resource"] * 2 + ["response"] * 3 + ["warcinfo"] * 3
    page = next(r for r in sound if r["record_type"] == "response")
    assert (page["url"], page["date"], page["page_id"]) == ("http://a/x%20y", "1997-01-02T03:04:05Z", 9)
    assert bytes(page["payload"]) == b"hello\n\nworld" and page["payload_digest"] == arc.digest(b"hello\n\nworld")
    assert next(r for r in sound if r["record_type"] == "resource")["date"] == "1997-01-01T00:00:00Z"
    assert len({r["record_id"] for r in got}) == len(got)
    errors = sorted(r["error"] for r in got if r["error"])
    assert len(errors) == 2 and errors[0].startswith("cut.arc at ") and errors[0].endswith("body is shorter than declared") and errors[1].startswith("odd.arc at 0: ")


def test_files_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame(_pages(), DDL)
    folder = str(tmp_path / "w")
    warc.write_warc(warc.deduplicate(warc.convert(warc.pages_to_arc(pages))), folder, max_records=10)
    files = sorted((tmp_path / "w").glob("*.gz"))
    records = [r for f in files for r in arc.parse_warc(gzip.decompress(f.read_bytes()))]
    assert len(files) > 3 and sum(r[0]["WARC-Type"] in ("response", "revisit") for r in records) == len(_pages())
    assert all(f"sha1:{arc.digest(b)}" == h["WARC-Block-Digest"] for h, b in records)
    back = warc.read_warc(spark, folder).filter("record_type = 'response'").collect()
    assert {bytes(r["payload"]).decode() for r in back} == {r[2] or "" for r in _pages()}


def test_files_are_bounded_by_bytes(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", chr(97 + i % 26) * 50_000 + str(i)) for i in range(40)], DDL).coalesce(1)
    folder = str(tmp_path / "w")
    warc.write_warc(warc.convert(warc.pages_to_arc(pages)).coalesce(1), folder, file_bytes=200_000)
    sizes = [len(gzip.decompress(f.read_bytes())) for f in (tmp_path / "w").glob("*.gz")]
    assert len(sizes) >= 9 and max(sizes) < 200_000 + 60_000
    assert warc.read_warc(spark, folder).filter("record_type = 'response'").count() == 40


def test_damaged_warc_is_an_error():
    with pytest.raises(ValueError):
        list(arc.parse_warc(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n"))


def test_empty_table(spark, tmp_path):
    assert warc.op9_warc(spark, edge.write(spark, str(tmp_path), "pages", [], DDL)).collect() == []
