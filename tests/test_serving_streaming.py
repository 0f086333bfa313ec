"""Serving functions, gates, sinks, sources and streams."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from driftline import checks, serving
from driftline.operators import scd
from driftline.sources import files, sinks
from driftline.streaming import live

D = dt.date
T0 = dt.datetime(2024, 5, 1, 23, 30)


@pytest.fixture(scope="module")
def flights(spark):
    ddl = "flight_id long, icao24 string, callsign string, airline_name string, registration string, typecode string, start_time timestamp, end_time timestamp, origin_icao string, origin_iata string, origin_city string, dest_icao string, dest_iata string, dest_city string"
    row = lambda i, cs, o, d, days=0: (i, f"84000{i}", cs, "All Nippon" if cs else None, f"JA-{i}", "B788", T0 + dt.timedelta(days=days), T0 + dt.timedelta(days=days, hours=1), o, None, None, d, d and d[1:], None)
    return spark.createDataFrame([row(1, "ANA1", "RJTT", "RJOO"), row(2, "ANA1", "RJTT", "RJOO"), row(3, "ANA2", "RJTT", "RJTT"), row(4, None, None, None), row(5, "ANA1", "RJTT", "RJOO", -7)], ddl)


@pytest.fixture(scope="module")
def tiers(spark):
    return spark.createDataFrame([(1, "settled", 59, 10, 1, 59, 0.8), (2, "estimated", 900, 5, 0, 899, 0.9), (3, "none", None, None, 0, 900, 0.1), (5, "settled", 1, 1, 0, 3600, 0.5)], "flight_id long, tier string, effective_gap_s long, n_points long, is_military int, largest_gap_s long, observed_fraction double")


DAYS = (D(2024, 5, 2), D(2024, 5, 2))


def test_workbench(flights, tiers):
    got = serving.instances(flights, tiers, *DAYS).collect()
    assert [(r.flight_id, r.tier) for r in got] == [("4", "unknown"), ("3", "none"), ("2", "estimated"), ("1", "settled")]  # 23:30 UTC is the next day in Japan
    assert [r.flight_id for r in serving.instances(flights, tiers, *DAYS, callsign="ana1", military=True).collect()] == ["1"]
    assert serving.instances_count(flights, None, *DAYS, airport="OO").count() == 1
    assert serving.instances(flights, tiers, *DAYS, limit=-5).count() == 0
    assert [tuple(r) for r in serving.od_breakdown(flights, tiers, *DAYS).collect()] == [("RJTT", "JOO", 2), ("RJTT", "JTT", 1)]
    a = serving.airlines(flights, tiers, "nippon").first()
    assert (a.n_flights, a.n_services, a.tier_settled, a.tier_none) == (4, 2, 2, 1)
    s = serving.services(flights, tiers, "All Nippon").where("callsign = 'ANA1'").first()
    assert s.n_instances == 3 and [(o.o, o.d, o.n) for o in s.top_od] == [("RJTT", "JOO", 3)]
    assert {(r.ge, r.n) for r in serving.coverage_gaps(flights, tiers, *DAYS).collect()} == {(0, 1), (60, 0), (300, 1), (900, 1), (3600, 0), (10800, 0), (21600, 0), (43200, 0)}
    assert serving.coverage_observed(flights, tiers, *DAYS).first().med == 0.8
    assert {(r.k, r.n, r.prev_n) for r in serving.trends(flights, "airport", *DAYS, D(2024, 4, 20), D(2024, 5, 1)).collect()} == {("RJTT", 3, 1), ("JOO", 2, 1), ("JTT", 1, 0)}
    found = serving.search(flights, flights.selectExpr("origin_icao icao", "origin_iata iata", "'Haneda' name", "'Tokyo' city").where("icao is not null").distinct(), "han")
    assert found["airports"].count() == 1 and found["airlines"].count() == 0
    assert serving.search(flights, flights.selectExpr("origin_icao icao", "origin_iata iata", "'H' name", "'T' city"), "JA1")["airframes"].first().icao24 == "840001"


def test_summary_and_errors(spark, flights, tiers):
    flags = spark.createDataFrame([(1, "military", ""), (1, "single_source", ""), (9, "military", "")], "flight_id long, flag_class string, detail string")
    ddl = "estimate_id string, seg_idx int, input_fingerprint long, computed_at timestamp, settled int, skip_ambiguous int, err_p50_km double, errs_km array<float>, config_hash long, producer string, input_provisional int"
    s = spark.createDataFrame([("a", 1, 1, T0, 1, 0, 1.0, [float(x) for x in range(1, 11)], 7, "p", 0), ("b", 1, 1, T0, 1, 0, 1.0, [99.0], 7, "p", 0), ("c", 1, 2, T0, 0, 0, None, [], 7, "p", 1), ("d", 1, 3, T0, 0, 1, None, [], 7, "p", 1)], ddl)
    rows = {(r.sect, r.k, r.k2): (r.v1, r.v2) for r in serving.summary(flights, *DAYS, D(2024, 4, 20), D(2024, 5, 1), flags, tiers, s).collect()}
    assert rows[("total", "flights", "")] == (4, 0) and rows[("total", "services", "")] == (2, 0) and rows[("mover", "RJTT-JOO", "")] == (2, 1)
    assert rows[("flagged", "", "")] == (1, 0) and rows[("tier", "unknown", "")] == (1, 0) and rows[("est", "p50", "")] == (5.0, 1.0)
    e = serving.estimate_percentiles(s, *DAYS).first()
    assert (e.cfg, e.n, e.p50, e.p90) == ("7", 1, 5.0, 9.0)
    assert tuple(serving.estimate_outcomes(s, *DAYS).first())[:3] == (2, 1, 1)
    assert [r.n for r in serving.flag_classes(flags, flights, *DAYS).collect()] == [1, 1]
    assert serving.flag_feed(flags, flights, tiers, *DAYS, "military").first().flag_class == "military"
    assert serving.recent_routes(flights, dt.datetime(2024, 5, 2, 12)).where("callsign = 'ANA1'").first().dest_icao == "RJOO"


def test_gates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    with pytest.raises(checks.GateFailed):
        checks.assert_grain(df, ["k"])
    checks.assert_grain(df, ["v"])
    h = dt.datetime(2024, 1, 1, 5)
    w = checks.value_window(h, h + dt.timedelta(days=9))
    assert (w.lo, w.hi) == (h - dt.timedelta(hours=6), h + dt.timedelta(days=2)) and checks.value_window(h, h + dt.timedelta(minutes=59)) is None
    a = spark.createDataFrame([(h, "x", 1), (h + dt.timedelta(days=30), "x", 5)], "h timestamp, k string, n int")
    assert checks.value_gate(a, a.where("n = 1"), ["k"], ["n"], "h", w) == w.hi
    with pytest.raises(checks.GateFailed):
        checks.value_gate(a, a.withColumn("n", F.lit(2)), ["k"], ["n"], "h", w)
    assert {r.k: r.share for r in checks.completeness(df, df.where("v <> 'a'"), "k").where("k is not null").collect()} == {1: 0.5}
    assert checks.orphans(df, df.where("k = 1"), "k").count() == 1


def test_scd2_round(spark):
    attrs = ["seg"]
    old = spark.createDataFrame([("a", "x", D(2024, 1, 1), None), ("b", "y", D(2024, 1, 1), None), ("z", "q", D(2023, 1, 1), D(2023, 2, 1))], "k string, seg string, valid_from date, valid_to date")
    new = spark.createDataFrame([("a", "w"), ("c", "n")], "k string, seg string")
    actions = scd.scd2_diff(old.where("valid_to is null").select("k", "seg"), new, "k", attrs, "2024-03-01")
    after = sorted(tuple(map(str, r)) for r in scd.apply_scd2(old, actions, "k", attrs).collect())
    assert after == [("a", "w", "2024-03-01", "None"), ("a", "x", "2024-01-01", "2024-02-29"), ("b", "y", "2024-01-01", "2024-02-29"), ("c", "n", "2024-03-01", "None"), ("z", "q", "2023-01-01", "2023-02-01")]
    with pytest.raises(scd.MassClose):
        scd.guard_mass_close(actions, 2, 0.2)


def test_sinks(spark, tmp_path):
    t = f"file://{tmp_path}"
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2))], "v int, d date")
    sinks.overwrite_days(df, f"{t}/days", "d")
    sinks.overwrite_days(df.where("v = 2").withColumn("v", F.lit(9)), f"{t}/days", "d")
    assert sorted(r.v for r in spark.read.parquet(f"{t}/days").collect()) == [1, 9]
    assert [sinks.publish_generation(df, f"{t}/gen") for _ in range(2)] == [1, 2] and sinks.generations(spark, f"{t}/gen") == [2] and sinks.read_generation(spark, f"{t}/gen").count() == 2
    with pytest.raises(ValueError):
        sinks.publish_generation(df.limit(0), f"{t}/gen")
    sinks.stage_and_swap(df, f"{t}/swap")
    with pytest.raises(ValueError):
        sinks.stage_and_swap(df.limit(0), f"{t}/swap")
    assert spark.read.parquet(f"{t}/swap").count() == 2
    first = sinks.read_swapped(spark, f"{t}/swap")
    for v in (3, 4):
        sinks.stage_and_swap(df.withColumn("v", F.lit(v)), f"{t}/swap")
        assert {r.v for r in sinks.read_swapped(spark, f"{t}/swap").collect()} == {v}
        assert v == 4 or first.count() == 2  # a reader that has begun still has its version
    ledger = spark.createDataFrame([("a", "loaded", 1), ("b", "pending", 2)], "path string, status string, n int")
    news = spark.createDataFrame([("b", "loaded", None), ("c", "pending", 3)], "path string, status string, n int")
    assert sorted(map(tuple, sinks.upsert_ledger(ledger, news, "path", ["n"]).collect())) == [("a", "loaded", 1), ("b", "loaded", 2), ("c", "pending", 3)]
    assert [r.path for r in files.pending(news.select("path"), ledger).orderBy("path").collect()] == ["b", "c"]
    now = dt.datetime(2024, 1, 10)
    seen = spark.createDataFrame([("e", "error", 1, now - dt.timedelta(minutes=5)), ("f", "error", 1, now), ("m", "missing", 1, now - dt.timedelta(days=8)), ("n", "missing", 2, now - dt.timedelta(days=8)), ("l", "landed", 1, now - dt.timedelta(days=80))], "k string, status string, attempts int, last_attempt timestamp")
    pairs = spark.createDataFrame([(k,) for k in "efmnlx"], "k string")
    assert sorted(r.k for r in sinks.to_attempt(pairs, seen, ["k"], now).collect()) == ["e", "m", "x"]


def test_sources(spark, tmp_path):
    import gzip
    import io
    import tarfile

    doc = {"icao": "840001", "timestamp": 1000.0, "trace": [[0.0, 35.0, 139.0, "ground", 10.0, 90.0, 1, None, {"flight": "ANA1 ", "squawk": "1234"}, "adsb", None], [5.5, 35.1, 139.1, 1000, None, None, 0, 64, None, "adsb", 1100]]}
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a.json").write_bytes(gzip.compress(json.dumps(doc).encode()))
    (tmp_path / "t/b.json").write_bytes(b"{broken")
    rows = files.traces(spark, str(tmp_path / "t")).orderBy("i").collect()
    assert [(r.icao24, r.ground, r.alt_ft, r.callsign, r.flags) for r in rows] == [("840001", True, 0.0, "ANA1", 1), ("840001", False, 1000.0, None, 0)]
    with tarfile.open(tmp_path / "x.tar", "w") as tar:
        for name, raw in (("a", gzip.compress(json.dumps(doc).encode())), ("b", b"\x1f\x8bno")):
            m = tarfile.TarInfo(name)
            m.size = len(raw)
            tar.addfile(m, io.BytesIO(raw))
    assert files.traces_tar(spark, str(tmp_path / "x.tar")).count() == 2
    (tmp_path / "n.json").write_text("\n".join([json.dumps({"a": 1, "b": "x"}), "{bad", json.dumps({"a": None})] + [json.dumps({"a": k}) for k in range(7)]))
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("a int, b string")
    assert files.ndjson(spark, str(tmp_path / "n.json"), schema, ["a"], 0.5).count() == 8
    with pytest.raises(files.ContractError):
        files.ndjson(spark, str(tmp_path / "n.json"), schema, ["a"], 0.1)
    (tmp_path / "c.csv").write_text("a,b\n1,x\n2, \n")
    assert files.csv_checked(spark, str(tmp_path / "c.csv"), schema, 2).count() == 2
    with pytest.raises(files.ContractError):
        files.csv_checked(spark, str(tmp_path / "c.csv"), schema, 3)
    assert [r.b for r in files.seed_csv(spark, str(tmp_path / "c.csv"), schema).collect()] == ["x", None]
    assert files.identities(["a", "", '"b"']) == ["a", "b"]
    with pytest.raises(files.ContractError):
        files.identities(["a", "b,c"])
    assert files.csv_sniffed(spark, ["Tail-Number,Call Sign", "N1,ABC"], {"registration": ["tail number"], "callsign": ["callsign", "call sign"]}).first() == ("N1", "ABC")
    xml = "<e xmlns='u:x'><m id='1'><p><q>A</q></p></m><m id='2'/></e>"
    got = files.xml_messages(spark.createDataFrame([(7, xml), (8, "<e/>")], "n int, x string"), "x", "m", {"id": "id"}, {"q": "p/q"}).select("n", "id", "q").collect()
    assert sorted(map(tuple, got), key=str) == [(7, "1", "A"), (7, "2", None)]
    empty = tmp_path / "none"
    empty.mkdir()
    assert files.parquet_tree(spark, str(empty), schema).count() == 0


EVENT = "k string, ts timestamp, v int"


def feed(spark, tmp_path, name, *batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "stage"))
        (tmp_path / name).mkdir(exist_ok=True)
        for p in (tmp_path / "stage").glob("part-*.parquet"):
            p.rename(tmp_path / name / f"{i}.parquet")
    return live.file_stream(spark, str(tmp_path / name), EVENT, files_per_trigger=1)


def at(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def test_latest_view_by_upserts(spark, tmp_path):
    stream = feed(spark, tmp_path, "a", [("x", at(1), 1), ("y", at(1), 1)], [("x", at(0), 9), ("x", at(200), 2)])
    path = f"file://{tmp_path}/view"
    sink = live.upsert_latest(path, ["k"], "ts", expire_s=120)
    live.drain(stream, str(tmp_path / "cp"), sink)
    seen = live.current_generation(spark, path, EVENT)
    assert [tuple(r) for r in seen.collect()] == [("x", at(200), 2)]  # y is older than 120 s
    sink(spark.createDataFrame([("x", at(0), 9), ("x", at(200), 2)], EVENT), 1)  # a replayed batch
    seen = live.current_generation(spark, path, EVENT)
    assert seen.count() == 1
    assert live.alive(seen, "ts", at(330), 120).count() == 0 and live.alive(seen, "ts", at(319), 120).count() == 1


def test_partials_of_batches_merge(spark, tmp_path):
    rows = [("x", at(i * 600), i % 5) for i in range(20)]
    stream = feed(spark, tmp_path, "b", rows[:12], rows[8:])
    live.drain(stream, str(tmp_path / "cp2"), live.append_partials(str(tmp_path / "st"), ["k"], F.date_trunc("hour", "ts"), "v"))
    assert live.merged_partials(spark, str(tmp_path / "st"), ["k"], "v").first().members == 5


def test_windows_sessions_replays_joins(spark, tmp_path):
    rows = [("x", at(0), 1), ("x", at(0), 1), ("x", at(50), 2), ("y", at(4000), 3)]
    late = [("z", at(90000), 0)]
    w = live.windowed_counts(feed(spark, tmp_path, "c", rows, late), "ts", "1 minute", by=["k"])
    live.drain(w, str(tmp_path / "cp3"), table="w_out")
    assert {(r.k, r.n) for r in spark.table("w_out").collect()} == {("x", 3), ("y", 1)}
    s = live.session_counts(feed(spark, tmp_path, "d", rows, late), "ts", "100 seconds", ["k"])
    live.drain(s, str(tmp_path / "cp4"), table="s_out")
    assert {(r.k, r.n) for r in spark.table("s_out").collect()} == {("x", 3), ("y", 1)}
    live.drain(live.without_replays(feed(spark, tmp_path, "e", rows, rows), "ts", ["k", "v"], "1 hour"), str(tmp_path / "cp5"), table="r_out")
    assert spark.table("r_out").count() == 3
    a, b = feed(spark, tmp_path, "f", rows), feed(spark, tmp_path, "g", [("x", at(30), 7)])
    j = live.interval_join(a, b.selectExpr("k", "ts AS ts2", "v AS v2"), "k", "ts", "ts2", "1 minute").selectExpr("a.v AS v", "b.v2 AS v2")
    live.drain(j, str(tmp_path / "cp6"), table="j_out")
    assert sorted(map(tuple, spark.table("j_out").collect())) == [(1, 7), (1, 7), (2, 7)]
    live.drain(live.counts(feed(spark, tmp_path, "h", rows), {"k": F.col("k"), "v": F.col("v")}), str(tmp_path / "cp7"), table="n_out", mode="complete")
    assert {(r.dim, r.val): r.n for r in spark.table("n_out").collect()}[("k", "x")] == 3


def test_expiry_by_timers(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = live.latest_with_expiry(feed(spark, tmp_path, "i", [("x", at(1), 1), ("x", at(5), 2)]), "k", "ts", 2)
        q = out.writeStream.outputMode("update").format("memory").queryName("t_out").option("checkpointLocation", str(tmp_path / "cp8")).trigger(processingTime="1 second").start()
        for _ in range(60):
            time.sleep(1)
            if spark.table("t_out").where("expired").count():
                break
        q.stop()
        got = spark.table("t_out").collect()
        assert [(r.key, r.expired) for r in got] == [("x", False), ("x", True)] and json.loads(got[0].row)["v"] == 2
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_decode_json(spark):
    raw = spark.createDataFrame([(b'{"a": 1}', T0), (b"{bad", T0)], "value binary, timestamp timestamp")
    assert [r.a for r in live.decode_json(raw, "a int").collect()] == [1, None]
