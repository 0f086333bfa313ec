"""Identities, traces, landed responses and bundles, and the reads of the live map."""

import datetime as dt
import gzip
import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from driftline import serving
from driftline.functions import geo, identity
from driftline.models import segments
from driftline.sources import discovery, files, rest
from driftline.streaming import live


def registrations():
    """All US registrations in the order of their addresses, from the definition."""
    letters = identity.LETTERS
    pairs = [""] + [x for a in letters for x in [a, *(a + b for b in letters)]]

    def below(text):
        depth = len(text) - 1
        yield from (text + s for s in (pairs if depth < 4 else ["", *letters] if depth == 4 else [""]))
        if depth < 5:
            for d in range(10):
                yield from below(text + str(d))

    for d in range(1, 10):
        yield from below(f"N{d}")


def test_registrations_are_counted_like_the_pages_of_a_tree(spark):
    every = list(registrations())
    assert len(every) == identity.ADDRESSES == len(set(every))
    at = sorted({*range(0, 1500), *random.Random(1).sample(range(len(every)), 3000), len(every) - 1})
    rows = [(f"{identity.FIRST_ADDRESS + i:06x}", every[i]) for i in at]
    got = spark.createDataFrame(rows, "address string, reg string").select("address", "reg", identity.registration_of(F.col("address")).alias("r"), identity.address_of(F.lower("reg")).alias("a")).collect()
    assert all(r.r == r.reg and r.a == r.address for r in got)
    odd = spark.createDataFrame([("N0",), ("N12I",), ("N1234AB",), ("N12345A",), ("N123456",), ("JA1A",), ("",), (None,), ("N",)], "reg string")
    assert {r[0] for r in odd.select(identity.address_of(F.col("reg"))).collect()} == {None}
    out = spark.createDataFrame([("a00000",), ("adf7c8",), ("840001",), (None,)], "address string")
    assert {r[0] for r in out.select(identity.registration_of(F.col("address"))).collect()} == {None}


def test_norms(spark):
    df = spark.createDataFrame([(" '12ab ' ", " ana1 ", "\"2fake\""), (None, "", "a-b")], "a string, b string, c string")
    assert [tuple(r) for r in df.select(identity.registration_norm(F.col("a")), identity.callsign_plain(F.col("b")), identity.bare_identity(F.col("c"))).collect()] == [("N12AB", "ANA1", "2FAKE"), (None, None, None)]
    routes = spark.createDataFrame([("X 4530N/17000W 9059N/00000E 1260S/00000E 0000S/18000W 0000N/18001E",), (None,)], "r string")
    assert [[tuple(p) for p in r[0]] for r in routes.select(identity.route_points(F.col("r"))).collect()] == [[(45.5, -170.0), (0.0, -180.0)], []]
    kinds = spark.createDataFrame([("H1", "helicopter", 2, "Jet"), ("B788", "landplane", 2, "Jet"), ("A320", "landplane", 2, "Jet"), ("AT72", "landplane", 2, "Turboprop"), ("MD11", "landplane", 3, "Jet"), ("A388", "landplane", 4, "Jet"), ("C172", "landplane", 1, "Piston"), ("?", "landplane", None, "Jet")], "t string, k string, e int, j string")
    assert [r[0] for r in kinds.select(identity.body_class(F.col("t"), F.col("k"), F.col("e"), F.col("j"), ["helicopter"], ["B788"])).collect()] == ["heli", "widebody", "narrowbody", "regional", "widebody", "quad", "ga", ""]
    names = spark.createDataFrame([("All Nippon", "ALL NIPPON"), ("Abc Airlines Ltd", "Abc Airlines"), ("Abc Cargo", "Abc"), ("Abctokyo", "Abcto"), ("Xyz", "Abc"), (None, "a"), ("Same", "Same"), ("Abc Blue", "Abc")], "n string, l string")
    assert [r[0] for r in names.select(identity.name_verdict(F.col("n"), F.col("l"), ["ltd", "inc"], ["cargo"])).collect()] == ["casing", "suffix", "ambiguous", "mashed", "", "", "", "ambiguous"]


def test_airports_by_rank(spark):
    ddl = "ident string, type string, icao_code string, iata_code string, name string, municipality string, iso_country string, latitude_deg double, longitude_deg double, scheduled_service string"
    rows = [("RJTT", "large_airport", "RJTT", "HND", "Haneda", "T", "JP", 1.0, 2.0, "yes"), ("X1", "small_airport", "RJTT", "", "Other", "T", "JP", 1.0, 2.0, "yes"), ("RJXX", "small_airport", "", "", "Strip", "", "JP", 1.0, 2.0, "no"), ("RJCC", "closed", "RJCC", "", "", "", "JP", 1.0, 2.0, "no"), ("lower", "small_airport", "", "", "", "", "", 1.0, 2.0, "no")]
    runways = spark.createDataFrame([("RJTT", "9000", "0"), ("RJTT", "11000", "0"), ("RJTT", "20000", "1"), ("RJXX", "?", "0")], "airport_ident string, length_ft string, closed string")
    got = {r.icao: (r.name, r.scheduled_service, r.runway_length_ft) for r in identity.best_airports(spark.createDataFrame(rows, ddl), runways, {"large_airport": 0, "small_airport": 2}).collect()}
    assert got == {"RJTT": ("Haneda", True, 11000), "RJXX": ("Strip", False, 0)}


POINT = "icao24 string, base_ts double, i int, dt_s double, lat double, lon double, alt_ft double, ground boolean, gs_kt double, track double, flags int, callsign string, squawk string"


def test_segments_break_where_a_flight_ends(spark):
    p = lambda i, t, alt=9000.0, ground=False, lat=35.0, flags=0, cs=None: ("840001", 1000.0, i, float(t), lat, 139.0, alt, ground, None, None, flags, cs, None)
    rows = [
        p(0, 0, 0.0, True), p(1, 10, 500.0, cs="ANA2"), p(2, 20.7, cs="ANA1"), p(3, 25, flags=1), p(4, 30, lat=None), p(5, 40, 0.0, True, cs="ANA1"), p(6, 50),  # the landing opens the next one
        p(7, 3000, 900.0, lat=36.0), p(8, 3010, lat=36.0),  # low after a turnaround's silence
        p(9, 3010 + 1800, 9000.0, lat=36.1), p(10, 4820, 20000.0, lat=36.1), p(11, 4820 + 5300, 20000.0, lat=36.1), p(12, 10130, 20000.0, lat=36.1), p(13, 10130 + 5401, 20000.0, lat=44.0),  # slow below the cruise; high and slow stays; a long silence; one fix
    ]
    points = spark.createDataFrame(rows, POINT)
    got = sorted((r.seg_start, r.seg_end, r.num_fixes, r.callsign, r.first_on_ground) for r in segments.trace_segments(points, F.lit("2024-01-01")).collect())
    assert got == [(1000, 1020, 3, "ANA1", True), (1040, 1050, 2, "ANA1", True), (4000, 4010, 2, None, False), (5810, 11130, 4, None, False)]
    path = segments.trace_paths(points, F.lit("2024-01-01"))
    assert sorted((r.seg_start, r.ts) for r in path.collect()) == sorted((s, t) for s, ts in ((1000, (1000, 1010, 1020)), (1040, (1040, 1050)), (4000, (4000, 4010)), (5810, (5810, 5820, 11120, 11130))) for t in ts)
    assert segments.affected_pairs(path).count() == 0 and [tuple(r) for r in segments.affected_pairs(path.withColumn("seg_start", F.lit(0))).collect()] == [("840001", "2024-01-01")]
    dense = segments.dense_points(points, 1000, {"near": (34, 138, 35.5, 140), "all": (30, 130, 40, 150)})
    assert [r.zone for r in dense.orderBy("i").collect()][:3] == ["near"] * 3 and dense.where("i = 2").first().callsign == "ANA1" and dense.where("i = 13").count() == 0


def test_targets(spark):
    d = dt.date(2024, 1, 2)
    at = lambda day, h=0: dt.datetime(2024, 1, day, h)
    flights = spark.createDataFrame([("AB", at(1), at(2), "x", None), ("CD", at(2), at(3), "x", "y"), ("EF", at(3), at(3), "x", "y"), (None, at(2), at(2), None, None)], "icao24 string, start_time timestamp, end_time timestamp, origin_icao string, dest_icao string")
    assert {r[0] for r in segments.route_targets(flights, d).collect()} == {"ab", "cd"}
    assert [tuple(r) for r in segments.unresolved_targets(flights).collect()] == [("ab", dt.date(2024, 1, 1))]
    adsb = spark.createDataFrame([("ABCDEF", 1704153600.0), ("~12345", 1704153600.0), ("abcdef", 1704153700.0), ("000001", 1.0), (None, 1704153600.0)], "hex string, capture_ts double")
    assert [r[0] for r in segments.rooftop_cohort(adsb, d).collect()] == ["abcdef"]


def test_responses(spark):
    vector = ["840001", "ANA1 ", "Japan", 5, None, 139.5, 35, None, False, 200.5, 90, 0.0, None, 1000, "1234", True, 0]
    docs = spark.createDataFrame([(json.dumps({"time": 7, "states": [vector, vector[:5]]}), "japan", "i"), (json.dumps({"time": 8, "states": None}), "japan", "i"), ("{broken", "japan", "i"), (None, "japan", "i")], "body string, region string, ingested_at string")
    got = rest.states(docs).collect()
    assert len(got) == 2 and got[0].asDict() | {"sensors": None} == dict(zip([k for k, _ in rest.STATE_FIELDS], vector)) | {"sensors": None, "snapshot_time": 7, "region": "japan", "ingested_at": "i"} and got[1].latitude is None
    body = json.dumps([{"icao24": "840001", "firstSeen": 5, "lastSeen": 9, "estArrivalAirport": "RJTT", "more": 1}, {"icao24": "x"}])
    docs = spark.createDataFrame([(200, body, "RJTT", "arrival", "d2"), (404, body, "RJOO", "arrival", "d2"), (200, "[]", "RJOO", "arrival", "d2")], "status int, body string, airport string, direction string, window_kind string")
    assert [tuple(r) for r in rest.flights(docs).collect()] == [("840001", None, 5, 9, None, "RJTT", "RJTT", "arrival", "d2")]
    assert rest.flight_windows(10 * 86400)[2] == ("departure", "d0", 9 * 86400, 10 * 86400) and all(z - a <= 2 * 86400 for *_, a, z in rest.flight_windows(10**9))


def test_bundles(spark, tmp_path):
    def put(name, content="x"):
        at = tmp_path / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(content if isinstance(content, str) else json.dumps(content))

    def manifest(folder, stem, stream="adsb", complete=True, uuid="p1", start="2024-01-01T00:00:00Z", name=None):
        put(f"{folder}/{stem}.manifest.json", {"stream": stream, "filename": name or f"{stem}.parquet", "complete": complete, "process_uuid": uuid, "process_start_ts": start})

    manifest("a", "whole"), put("a/whole.parquet")
    manifest("a", "orphan")
    manifest("a", "busy", name="busy.inprogress"), put("a/busy.inprogress")
    manifest("a", "part", complete=False, uuid="p0", start="2023-12-31T00:00:00Z"), put("a/part.parquet")  # a later writer has completed one
    manifest("a", "own", complete=False, uuid="p1"), put("a/own.parquet")
    manifest("a", "newer", complete=False, uuid="p9", start="2024-02-01T00:00:00Z"), put("a/newer.parquet")
    manifest("b", "raw", stream="beast", name="raw.gz"), put("b/raw.gz")
    manifest("b", "raw2", stream="beast", name="raw2.gz"), put("b/raw2.gz"), put("b/raw2.idx.gz")
    put("a/bad.manifest.json", "{broken")
    manifest("a", "alien", stream="other"), put("a/alien.parquet")
    root = f"file://{tmp_path}"
    args = discovery.manifests(spark, root), discovery.listing(spark, root)
    got = {(r.filename, r.complete) for r in discovery.bundles(*args, {"adsb": "", "beast": ""}, {"beast": (".gz", [".idx.gz"])}).collect()}
    assert got == {("whole.parquet", True), ("part.parquet", False), ("raw2.gz", True)}
    with pytest.raises(files.ContractError):
        discovery.bundles(*args, {"adsb": "", "other": "edge"})
    spark.range(7).write.parquet(f"{root}/rows")
    assert discovery.footer_rows(spark, f"{root}/rows") == 7
    assert discovery.ingest_summary([{"rows": 3}, {"rows": 0}, ValueError()]) == {"attempted": 3, "succeeded": 2, "with_data": 1} and discovery.ingest_summary([])["attempted"] == 0
    with pytest.raises(RuntimeError):
        discovery.ingest_summary([ValueError()])
    ledger = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "e timestamp")
    assert [discovery.stale(d, "e", n).first().stale for d, n in ((ledger, "2024-01-01 01:00:00"), (ledger, "2024-01-01 03:00:00"), (ledger.limit(0), "2024-01-01 01:00:00"))] == [False, True, True]


def test_tar_in_parts(spark, tmp_path):
    doc = {"icao": "840001", "timestamp": 1000.0, "trace": [[0.0, 35.0, 139.0, 100, 10.0, 90.0, 0, None, None, "adsb", None]]}
    whole = io.BytesIO()
    with tarfile.open(fileobj=whole, mode="w") as tar:
        for k in range(40):
            raw = gzip.compress(json.dumps(doc | {"icao": f"{k:06x}"}).encode())
            m = tarfile.TarInfo(f"trace_full_{k}.json")
            m.size = len(raw)
            tar.addfile(m, io.BytesIO(raw))
    data = whole.getvalue()
    for k, name in enumerate(("aa", "ab", "ac")):
        (tmp_path / f"day.tar.{name}").write_bytes(data[k * 15000 : (k + 1) * 15000 if k < 2 else None])
    (tmp_path / "short.tar").write_bytes(data[:5000])
    got = files.traces_tar(spark, str(tmp_path))
    n = {r.icao24: r["count"] for r in got.groupBy("icao24").count().collect()}
    assert set(n) == {f"{k:06x}" for k in range(40)} and n["000000"] == 2


def test_ring_centroid():
    square = [(0.0, 179.0), (0.0, -179.0), (2.0, -179.0), (2.0, 179.0)]
    lat, lon = geo.ring_centroid(square)
    assert abs(lat - 1) < 1e-9 and abs(abs(lon) - 180) < 1e-9
    assert geo.ring_centroid(square[::-1])[0] == pytest.approx(lat)
    assert geo.ring_centroid([(1.0, 2.0), (3.0, 4.0)]) == pytest.approx((2.0, 3.0)) and geo.ring_centroid([(5.0, 6.0)]) == (5.0, 6.0)


def test_live_reads(spark):
    current = spark.createDataFrame([("a1", " ANA1 ", 35.0, 139.0, False, '["x","y"]'), ("a2", "", 35.0, 139.0, None, "no list"), ("a3", "X", None, 139.0, False, None), ("a4", "P", 35.0, 139.0, True, None), ("A5", "Q1", 35.0, 139.0, False, None)], "hex string, flight string, lat double, lon double, is_ladd boolean, nav_modes string")
    routes = spark.createDataFrame([("ANA1", "RJTT", "RJOO")], "callsign string, origin_icao string, dest_icao string")
    ladd = spark.createDataFrame([("a5", None, None)], "icao24 string, callsign string, valid_to date")
    day = dt.date(2024, 1, 1)
    assert {r.hex for r in serving.aircraft_snapshot(current, routes).collect()} == {"a1", "a2", "a4", "A5"}
    got = {r.hex: r for r in serving.aircraft_snapshot(current, routes, ladd, day).collect()}
    assert set(got) == {"a1", "a2"} and got["a1"].route.dest_icao == "RJOO" and got["a1"].nav_modes == ["x", "y"] and got["a2"].flight is None and got["a2"].route is None and got["a2"].nav_modes is None
    positions = spark.createDataFrame([("A1", float(t), 35.0, 139.0, "100") for t in (100, 2000, 1500, 2100)] + [("a1", 1900.0, None, 1.0, "0"), ("b1", 1900.0, 1.0, 1.0, "0"), ("a5", 1900.0, 1.0, 1.0, "0")], "hex string, capture_ts double, lat double, lon double, alt_baro string")
    assert [r.capture_ts for r in serving.track(positions, " a1", 2000.0).collect()] == [1500.0, 2000.0] and serving.track(positions, "a5", 2000.0, private=ladd).count() == 0


def test_path_ladder(spark):
    at = lambda day, m=0: dt.datetime(2024, 5, day) + dt.timedelta(minutes=m)
    flights = spark.createDataFrame(
        [(1, "AA", "A1", at(1), at(1, 60), 0), (2, "aa", "A2", at(1, 90), at(1, 120), 0), (3, "aa", "A3", at(3), at(3, 60), 0), (4, "aa", "A4", at(3, 65), at(3, 120), 0), (5, "bb", "B5", at(1), at(1, 60), 0), (6, "cc", "C6", None, None, 0), (7, "dd", "D7", at(1), at(1, 60), 1)],
        "flight_id long, icao24 string, callsign string, start_time timestamp, end_time timestamp, is_ladd int",
    )
    fix = "lat double, lon double, alt_ft double, gs_kt double, track_deg double, on_ground boolean"
    own = (35.0, 139.0, 1.0, 1.0, 1.0, False)
    path = spark.createDataFrame([(k, at(1, 10 * m), *own, "adsb", at(1).date()) for k in (1, 7) for m in (2, 1)], f"flight_id long, ts timestamp, {fix}, source string, day_key date")
    fixes = spark.createDataFrame([("adsb", 1, "aa", at(3, m), *own) for m in (0, 30, 62, 100)], f"source string, src_rank int, icao24 string, ts timestamp, {fix}")
    ladd = spark.createDataFrame([("bb", None, None)], "icao24 string, callsign string, valid_to date")
    asked = spark.createDataFrame([(x,) for x in ("1", "2", "3", "5", "6", "7", "99", "x1", "01")], "flight_id string")
    got = {r.flight_id: (r.status, [p.ts % 86400 // 60 for p in r.points]) for r in serving.flight_paths(asked, flights, path, fixes, ladd, dt.date(2024, 5, 1)).collect()}
    assert got == {"1": ("settled", [10, 20]), "01": ("settled", [10, 20]), "2": ("settled_empty", []), "3": ("provisional", [0, 30]), "5": ("denied", []), "6": ("denied", []), "7": ("denied", []), "99": ("denied", []), "x1": ("denied", [])}
    assert {r.flight_id: r.status for r in serving.flight_paths(asked, flights, path, fixes).collect()}["7"] == "settled"
    assert {r.status for r in serving.flight_paths(asked, flights, path.limit(0), fixes).collect()} == {"denied"}


def test_streams_meet_tables_and_keep_versions_apart(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("hex string, v int")
    spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], schema).write.parquet(f"file://{tmp_path}/in")
    dim = spark.createDataFrame([("a", "reg", 5)], "icao24 string, registration string, v2 int")
    stream = live.enriched(live.file_stream(spark, f"file://{tmp_path}/in", schema), {"hex": (dim, "icao24")})
    live.drain(stream, live.versioned(f"file://{tmp_path}/cp", "enriched", schema, 1), table="enriched_rows")
    assert {(r.hex, r.v, r.registration) for r in spark.table("enriched_rows").collect()} == {("a", 1, "reg"), ("b", 2, None), (None, 3, None)}
    assert len({live.versioned("r", "q", schema, 1), live.versioned("r", "q", schema, 2), live.versioned("r", "q", schema.add("w", "integer"), 1)}) == 3
