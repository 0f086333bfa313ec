import base64
import hashlib

from pyspark.sql import functions as F

from driftline.llm import warc
from driftline.llm.token_files import store

PAGES = [(1, "http://a/", "same"), (2, "http://b/", "same"), (9, "http://c/\r\nX: y", "same"), (4, None, None), (5, "u", ""), (6, "http://é/", "ünï\r\n\r\ncode"), (7, "http://x/", "y" * 300000), (None, "n", "no id")]


def _brute(pages, least=0):
    keep = {}
    for i, _, h in pages:
        if i is not None:
            keep[h or ""] = max(keep.get(h or "", i), i)
    out = []
    for i, _, h in pages:
        raw = (h or "").encode()
        k = keep.get(h or "")
        revisit = k is not None and i != k and len(raw) >= least
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", k if revisit else None))
    return sorted(out, key=str)


def test_round_trip_and_assembly(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("refers_to", F.lit(3))
    for least in (0, 5):
        files = warc.write_warc(pages, min_bytes=least)
        captures = warc.assemble(warc.read_warc(spark, files))
        assert sorted((tuple(r) for r in warc.capture_digests(captures).collect()), key=str) == _brute(PAGES, least)
        for r in captures.collect():
            assert r.request and r.response and r.metadata and r.response.concurrent_to == r.request.record_id == r.metadata.concurrent_to
            if r.response.warc_type == "response":
                assert r.response.block.split(b"\r\n\r\n", 1)[1] is not None


def test_repeated_and_null_ids_lose_no_payload(spark):
    rows = [(1, "u", "same"), (9, "u", "same"), (1, "u", "OTHER"), (3, "a", "p"), (3, "b", "p"), (3, "b", "p"), (None, "u", "same"), (None, "v", "same"), (None, "u", "alone"), (9, "u", "q"), (2, "u", "q"), (2, "u", "q")]
    records = warc.read_warc(spark, warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string")))
    assert sorted((tuple(r) for r in warc.capture_digests(warc.assemble(records)).collect()), key=str) == _brute(rows)
    stored = {r.block.split(b"\r\n\r\n", 1)[1].decode() for r in records.where("warc_type = 'response'").collect()}
    assert stored == {h for *_, h in rows} and records.select("record_id").distinct().count() == 3 * len(rows)


def test_foreign_archives_resolve(spark):
    """A revisit's target is found by its record id, whatever the metadata say; one that no archive has is null."""
    rows = [("request", "q1", None, None, b""), ("response", "r1", "q1", None, b""), ("metadata", "m1", "q1", None, b"page-id: 5\r\n"), ("request", "q2", None, None, b""), ("revisit", "r2", "q2", "r1", b""), ("metadata", "m2", "q2", None, b"page-id: 6\r\n"), ("request", "q3", None, None, b""), ("revisit", "r3", "q3", "gone", b"")]
    records = spark.createDataFrame([(k, i, c, t, "u", "d", "X", "X", 1, bytes(x)) for k, i, c, t, x in rows], warc._RECORD)
    got = {r.page_id: r.refers_to for r in warc.capture_digests(warc.assemble(records)).collect()}
    assert got == {5: None, 6: 5, None: None}


def test_records_are_gzip_members(spark):
    import gzip

    files = warc.write_warc(spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")).collect()
    n = 0
    for f in files:
        fs, name = store(f.path)
        whole = gzip.decompress(fs.open_input_stream(name, compression=None).read())
        n += whole.count(b"WARC/1.1\r\n")
    assert n == 9


def test_lonely_records(spark):
    files = warc.write_warc(spark.createDataFrame(PAGES[5:7], "page_id long, url string, html string"))
    records = warc.read_warc(spark, files).where("warc_type <> 'metadata'")
    assert all(r.metadata is None and r.request for r in warc.assemble(records).collect())


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.capture_digests(warc.assemble(warc.read_warc(spark, warc.write_warc(none)))).count() == 0


def test_repeated_ids_are_captures_of_their_own(spark):
    pages = [(1, "http://a/", "one"), (1, "http://a/", "one"), (1, "http://b/", "two"), (3, "http://c/", "one"), (3, "http://c/", "other"), (3, "http://d/", "one")]
    files = warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string"))
    captures = warc.assemble(warc.read_warc(spark, files))
    assert sorted(tuple(r) for r in warc.capture_digests(captures).collect()) == _brute(pages)
    got = captures.collect()
    kept = {r.response.record_id: r.response.payload_digest for r in got if r.response.warc_type == "response"}
    assert len({r.response.record_id for r in got}) == len(pages)
    assert all(kept[r.response.refers_to] == r.response.payload_digest for r in got if r.response.warc_type == "revisit")
