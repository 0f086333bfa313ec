"""The domain models on small hand-made inputs, from bronze to marts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftline.config import CONFIG
from driftline.models import marts, paths, reconcile, silver

T0 = dt.datetime(2024, 5, 1, 0, 0)
at = lambda m: T0 + dt.timedelta(minutes=m)


def frame(spark, ddl, rows):
    return spark.createDataFrame(rows, ddl)


@pytest.fixture(scope="module")
def airports(spark):
    rows = [
        ("RJTT", "HND", "Haneda", "Tokyo", "JP", 35.55, 139.78, "large_airport", True, 9800), ("RJAA", "NRT", "Narita", "Tokyo", "JP", 35.76, 140.39, "large_airport", True, 13000), ("RJOO", "ITM", "Itami", "Osaka", "JP", 34.78, 135.44, "large_airport", True, 9800),
        ("RJXX", "", "Strip", "", "JP", 35.56, 139.79, "small_airport", False, 0), ("RJSH", "SHT", "Short", "", "JP", 34.79, 135.45, "small_airport", True, 3000), ("PANC", "ANC", "Anchorage", "", "US", 61.17, -149.99, "large_airport", True, 12000),
    ]
    return frame(spark, "icao string, iata string, name string, city string, country string, lat double, lon double, airport_type string, scheduled_service boolean, runway_length_ft int", rows)


@pytest.fixture(scope="module")
def ranges(spark):
    return frame(spark, "block_lo long, block_hi long, country string", [(0x840000, 0x87FFFF, "Japan"), (0xA00000, 0xAFFFFF, "United States")])


@pytest.fixture(scope="module")
def airlines(spark):
    return frame(spark, "icao string, name string, country string", [("ANA", "All Nippon", "JP")])


@pytest.fixture(scope="module")
def types(spark):
    return frame(spark, "typecode string, engines int, body_class string, model_name string", [("B788", 2, "widebody", "787-8"), ("C130", 4, "quad", "Hercules"), ("C172", 1, "single", "Skyhawk")])


STATE = "icao24 string, callsign string, origin_country string, time_position timestamp, last_contact timestamp, longitude double, latitude double, baro_altitude double, on_ground boolean, velocity double, true_track double, vertical_rate double, geo_altitude double, squawk string, spi boolean, position_source long, snapshot_time timestamp, region string, ingested_at string, source string"


def state(hex_, cs, m, lat, lon, alt, ground=False, vel=200.0, ingested="a", region="japan"):
    return (hex_, cs, "Japan", at(m), at(m), lon, lat, alt, ground, vel, 90.0, 0.0, alt, None, False, 0, at(m), region, ingested, "x")


@pytest.fixture(scope="module")
def states(spark):
    rows = [
        state("840001", " ANA1 ", 0, 35.55, 139.80, 500.0), state("840001", "ANA1", 30, 35.1, 137.5, 9000.0), state("840001", "ANA1", 60, 34.80, 135.46, 800.0), state("840001", "", 65, 34.79, 135.45, 0.0, True),
        state("840001", "ANA2", 120, 34.79, 135.50, 600.0), state("840001", "ANA2", 150, 35.55, 139.70, 700.0), state("840001", "ANA2", 400, 35.0, 139.0, 9000.0),
        state("840001", "ANA1", 30, 35.1, 137.5, 9000.0, ingested="b"), state("840002", None, 10, 10.0, 100.0, 100.0), state("840003", "JA01", 5, None, None, 100.0), state("840004", "X", 5, 35.0, 139.0, 16000.0, vel=400.0),
    ]
    return frame(spark, STATE, rows)


def test_states_and_legs(spark, states, airports):
    stg = silver.stg_states(states)
    assert stg.count() == 8 and stg.where("icao24 = '840001' and snapshot_time = timestamp'2024-05-01 00:30:00'").first().ingested_at == "b"
    snaps = silver.fact_state_snapshots(stg)
    jets = frame(spark, "icao24 string", [("840001",)])
    legs = {r.leg_id: r for r in silver.int_flight_legs_opensky(snaps.where("icao24 = '840001'"), airports, jets).collect()}
    assert {k: (r.callsign, r.num_fixes, r.origin_icao, r.dest_icao) for k, r in legs.items()} == {1: ("ANA1", 3, "RJTT", "RJOO"), 2: ("ANA2", 2, "RJOO", "RJTT"), 3: ("ANA2", 1, None, None)}
    odd = {r.icao24: r.anomaly_type for r in marts.anomalies(stg).collect()}
    assert odd == {"840004": "altitude_too_high"}
    country = marts.agg_country_traffic(stg).first()
    assert (country.origin_country, country.airborne_aircraft, str(country.avg_speed_kmh)) == ("Japan", 1, "720.00")
    assert silver.stg_states_adsblol(states).count() == 10


ADSB = "hex string, capture_ts double, flight string, r string, t string, `desc` string, category string, ownOp string, db_flags int, lat double, lon double, alt_baro string, gs double, track double"


@pytest.fixture(scope="module")
def adsb(spark):
    e = T0.replace(tzinfo=dt.timezone.utc).timestamp()
    rows = [
        ("840001", e + 100, "", "JA1A", "B788", "BOEING", "A5", None, 0, 35.5, 139.7, "ground", 10.0, 1.0), ("840001", e + 1900, None, None, None, None, None, "Own", 0, 35.1, 137.6, "30000", 400.0, 2.0), ("840001", e + 1900 + 2000, " ", None, None, None, None, None, 0, 35.0, 137.0, "x", 400.0, 2.0),
        ("840005", e, "ANA9", None, "C130", None, None, None, 1, 35.0, 139.0, "1000", 1.0, 1.0), ("~12345", e, "N1", None, None, None, None, None, 4, 35.0, 139.0, "1000", 1.0, 1.0), (None, e, None, None, None, None, None, None, None, None, None, None, None, None),
    ]
    return frame(spark, ADSB, rows)


def test_airframes_and_backfill(spark, states, adsb, ranges, airlines, types):
    fill = {(r.hex, round(r.capture_ts % 86400)): r.filled_callsign for r in silver.int_adsb_callsign_from_opensky(adsb, states).collect()}
    assert fill == {("840001", 100): "ANA1", ("840001", 1900): "ANA1", ("840001", 3900): "ANA1"}
    reg = frame(spark, "icao24 string, registration string, typecode string, icaoaircrafttype string, manufacturername string, model string, operator string, operatorcallsign string, operatoricao string, owner string, as_of_date date, committed_at timestamp", [
        ("840001", "", "", "L2J", "Boeing", "787", "Op", None, None, None, dt.date(2024, 1, 8), T0), ("840001", "OLD", "OLD", "", None, None, None, None, None, None, dt.date(2024, 1, 1), T0), ("aaaaaa", "N1", "C172", "", None, None, None, None, None, None, dt.date(2024, 1, 1), T0)])
    community = frame(spark, "icao24 string, registration string, icaotype string, short_type string, manufacturer string, model string, ownop string, year string, faa_pia int, faa_ladd int, mil int, as_of_date date, committed_at timestamp", [("840001", "JA1A", "B788", None, "B", "M", "Owner", None, 0, 0, 0, dt.date(2024, 1, 8), T0), ("840009", "JA9", "B788", None, None, None, None, None, 0, 0, 1, dt.date(2024, 1, 8), T0)])
    registry = silver.dim_aircraft_registry(reg, ranges, community)
    got = {r.icao24: (r.registration, r.typecode, r.owner, r.country_of_registration) for r in registry.collect()}
    assert got == {"840001": ("JA1A", "B788", "Owner", "Japan"), "840009": ("JA9", "B788", None, "Japan"), "aaaaaa": ("N1", "C172", None, "United States")}
    aircraft = silver.dim_aircraft(adsb, registry, types, ranges)
    assert {r.icao24: (r.registration, r.typecode, r.operator_raw, r.model) for r in aircraft.collect()}["840001"] == ("JA1A", "B788", "Own", "787")
    jets = {r.icao24 for r in silver.int_jet_airframes(registry, aircraft, types).collect()}
    assert jets == {"840001", "840009"}
    full = silver.fct_adsb_state(adsb, silver.int_adsb_callsign_from_opensky(adsb, states), aircraft, airlines, ranges)
    assert full.count() == adsb.count()
    r = full.where("hex = '840005'").first()
    assert (r.airline_name, r.is_military, r.is_pia, r.reg_country, r.callsign_source) == ("All Nippon", True, False, "Japan", "adsb")
    assert full.where("hex = '~12345'").first().reg_country is None


def segment(hex_, cs, start, end, a, b, ground=(False, False), alts=(30000.0, 30000.0), n=10):
    return (hex_, cs, at(start), at(end), n, a[0], a[1], alts[0], ground[0], b[0], b[1], alts[1], ground[1], dt.date(2024, 5, 1), "s", T0)


SEGMENT = "icao24 string, callsign string, seg_start timestamp, seg_end timestamp, num_fixes long, first_lat double, first_lon double, first_alt_ft double, first_on_ground boolean, last_lat double, last_lon double, last_alt_ft double, last_on_ground boolean, trace_day date, source string, ingested_at timestamp"
HND, MID, ITM = (35.55, 139.78), (35.2, 137.6), (34.78, 135.44)


def test_segments_routes_chains(spark, airports):
    rows = [
        segment("840001", "ANA1", 0, 10, HND, (35.5, 138.9), alts=(0.0, 20000.0), ground=(True, False)), segment("840001", "ANA1", 20, 30, (35.2, 137.4), ITM, alts=(25000.0, 500.0)),
        segment("840001", "ANA2", 90, 100, ITM, MID, alts=(500.0, 30000.0)), segment("840002", None, 0, 5, MID, MID),
    ]
    stg = silver.stg_flight_segments_adsblol(frame(spark, SEGMENT, rows + [rows[0][:-1] + (at(-5),)]))
    assert stg.count() == 4
    routes = silver.int_flight_routes_adsblol(stg, airports, frame(spark, "icao24 string", [("840001",)]))
    chains = sorted(silver.int_flight_chains_adsblol(stg, routes).collect(), key=lambda r: (r.icao24, r.chain_start))
    assert [(r.icao24, r.num_segments, r.callsign, r.origin_icao, r.dest_icao, r.callsign_consistent) for r in chains] == [("840001", 2, "ANA1", "RJTT", "RJOO", True), ("840001", 1, "ANA2", "RJOO", None, True), ("840002", 1, None, None, None, True)]


def test_schedules_and_filed_flights(spark, airports, states, adsb):
    routes = frame(spark, "callsign string, code string, number string, airline_code string, airport_codes string, ingested_at timestamp", [("ANA001", "", "", "", "RJTT-RJOO-RJTT", T0), ("ANA1", "", "", "", "RJTT-PANC", T0), ("XYZ2", "", "", "", "PANC-PANC", T0)])
    got = sorted((r.callsign, r.origin_icao, r.dest_icao, r.n_box_legs) for r in silver.stg_vrs_routes(routes, airports).collect())
    assert got == [("ANA001", "RJOO", "RJTT", 2), ("ANA001", "RJTT", "RJOO", 2)]
    assert silver.stg_vrs_routes(None, airports).count() == 0
    ddl = "gufi string, flight_ref string, acid string, computer_id string, filed_departure_time timestamp, filed_arrival_time timestamp, dep_point string, dep_point_kind string, arr_point string, arr_point_kind string, msg_timestamp timestamp, _dedup_fp long"
    swim = silver.int_swim_flight(frame(spark, ddl, [("g1", None, "ANA1", None, at(0), None, "HND", "airport", "PANC", None, at(0), 1), ("g1", None, "ANA1", None, at(0), at(60), "HND", "airport", "RJOO", "fix", at(1), 1), (None, None, "ZZZ9", "c", at(0), None, "X", None, None, None, at(0), 2)]), airports, states, adsb)
    rows = {r.flight_key: r for r in swim.collect()}
    assert (rows["g1"].icao24, rows["g1"].origin_icao, rows["g1"].dest_icao, rows["g1"].hex_ambiguous) == ("840001", "RJTT", "RJOO", 0)
    assert rows["ZZZ9|c|2024-05-01"].icao24 is None
    d = silver.int_swim_diagnostics(swim).first()
    assert (d.flights, d.hex_resolved, d.dep_airport, d.arr_non_airport, d.arr_kind_unknown) == (2, 1, 1, 1, 1)
    assert [r.icao24 for r in silver.int_swim_opinion(swim, airports).collect()] == ["840001"]


OPINION = "source string, source_rank int, icao24 string, win_start timestamp, win_end timestamp, callsign string, origin_icao string, dest_icao string, origin_gated int, dest_gated int"


@pytest.fixture(scope="module")
def opinions(spark):
    rows = [
        ("opensky_flights", 3, "840001", at(0), at(60), "ANA1", "RJTT", "RJOO", 0, 0), ("opensky_flights", 3, "840001", at(55), at(70), None, None, "RJOO", 0, 0), ("opensky_flights", 3, "840001", at(120), at(160), "ANA2", "RJOO", None, 0, 0),
        ("adsblol", 4, "840001", at(2), at(58), "ANA1", "RJTT", "RJAA", 0, 0), ("adsblol", 4, "840009", at(0), at(50), None, "RJTT", None, 1, 0), ("opensky_states", 5, "840001", at(5), at(50), "ANA1", "RJAA", "RJOO", 0, 0), ("opensky_states", 5, "840001", at(5), at(50), "QQQ1", None, None, 0, 0), ("opensky_states", 5, "840008", at(0), at(600), None, None, None, 0, 0),
        ("swim", 1, "840001", at(0), at(60), "ANA1", "RJTT", "RJOO", 0, 0),
    ]
    return frame(spark, OPINION, rows)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """As a build does it: a model is written, and read back."""
    def put(df):
        at = str(tmp_path_factory.mktemp("model") / "t")
        df.write.parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    return put


@pytest.fixture(scope="module")
def reconciled(spark, table, opinions, airports, airlines, ranges, states):
    jets = frame(spark, "icao24 string", [("840001",)])
    spine = table(reconcile.int_flight_spine(opinions))
    schedules = frame(spark, "callsign string, callsign_norm string, leg_idx int, origin_icao string, dest_icao string, n_box_legs long", [("ANA2", "ANA2", 1, "RJOO", "RJTT", 1), ("ANA1", "ANA1", 1, "RJTT", "RJOO", 2), ("ANA1", "ANA1", 2, "PANC", "RJSH", 2)])
    attach = table(reconcile.int_flight_attach(opinions, spine, schedules, airports, jets))
    aircraft = frame(spark, "icao24 string, registration string, typecode string, operator string, model string", [("840001", "JA1A", "B788", "Op", "787")])
    overrides = frame(spark, "callsign string, valid_from date, valid_to date, origin_icao string, dest_icao string", [("ANA2", dt.date(2024, 1, 1), dt.date(2024, 12, 31), None, "RJAA"), ("ANA2", dt.date(2023, 1, 1), dt.date(2024, 12, 31), "RJTT", "NONE")])
    ladd = frame(spark, "registration string, callsign string, icao24 string, valid_from date, valid_to date", [("x", "ANA2", None, dt.date(2030, 1, 1), None), ("y", None, "840001", dt.date(2020, 1, 1), dt.date(2020, 2, 1))])
    flights = reconcile.fct_flights_reconciled(spine, attach, jets, airports, aircraft, airlines, ranges, states, overrides, ladd)
    flights = table(flights)
    return spine, attach, flights, aircraft


def test_reconciliation(spark, reconciled):
    spine, attach, flights, _ = reconciled
    s = sorted((r.anchor_source, r.icao24, r.anchor_callsign, r.flight_start) for r in spine.collect())
    assert s == [("adsblol", "840009", None, at(0)), ("opensky_flights", "840001", "ANA1", at(0)), ("opensky_flights", "840001", "ANA2", at(120)), ("opensky_states", "840001", "QQQ1", at(5))]
    got = {r.callsign: r for r in flights.collect()}
    a = got["ANA1"]
    assert (a.origin_icao, a.origin_agreement, a.origin_source, a.dest_icao, a.dest_agreement, a.n_sources) == ("RJTT", "majority", "swim", "RJOO", "majority", 5)
    assert a.origin_votes == {"RJTT": 4, "RJAA": 1} and a.is_ladd == 0 and (a.registration, a.airline_name, a.reg_country, a.dest_city) == ("JA1A", "All Nippon", "Japan", "Osaka")
    b = got["ANA2"]
    assert (b.origin_icao, b.dest_icao, b.dest_source, b.dest_agreement, b.is_ladd) == ("RJOO", "RJAA", "curated", "curated", 1)
    assert None not in got and "QQQ1" in got  # an unseen anchor goes, one seen in the box stays


def test_marts(spark, reconciled):
    _, _, flights, aircraft = reconciled
    daily = {(r.airport_icao, r.direction): (str(r.traffic_day), r.flights) for r in marts.agg_airport_daily(flights).collect()}
    assert daily[("RJTT", "departure")] == ("2024-05-01", 1) and ("RJOO", "arrival") in daily
    assert {r.route_inferred for r in marts.agg_route_traffic(flights).collect()} == {"RJTT-RJOO", "RJOO-RJAA"}
    assert [(r.callsign, r.day_rank) for r in marts.longest_flights(flights, aircraft).orderBy("day_rank").collect()] == [("ANA1", 1), ("ANA2", 2)]
    assert marts.agg_operator_traffic(flights, aircraft).first().operator_name == "Op"


def test_paths_tiers_flags(spark, table, reconciled, adsb, states):
    _, _, flights, _ = reconciled
    traces = frame(spark, "icao24 string, ts timestamp, lat double, lon double, alt_ft double, on_ground boolean, gs_kt double, track_deg double", [("840001", at(m), 35.0 + m / 100, 139.0, 1000.0, False, 300.0, 90.0) for m in range(0, 170, 5)])
    every = paths.fixes(adsb, traces, states)
    path = table(paths.fct_flight_path(every, flights))
    assert path.groupBy("flight_id", "ts").count().where("count > 1").count() == 0
    one = dt.date(2024, 5, 1)
    chunked = paths.fct_flight_path(every, flights, [one])
    assert sorted(map(tuple, chunked.collect())) == sorted(map(tuple, path.where(F.col("day_key") == one).collect()))
    assert path.where("ts = timestamp'2024-05-01 00:30:00'").first().source == "adsblol"
    summary = table(paths.fct_flight_path_summary(path, flights))
    assert all(0 <= r.observed_fraction <= 1 and r.n_points == r.n_adsb + r.n_adsblol + r.n_opensky for r in summary.collect())
    tiers = table(reconcile.fct_flight_recon_tier(flights, summary, path, adsb))
    assert {r.callsign: r.tier for r in tiers.collect()}["ANA1"] == "estimated" and {r.is_military for r in tiers.collect()} == {0}
    flags = {(r.callsign, r.flag_class): r.detail for r in reconcile.fct_flight_flags(flights, tiers).collect()}
    # QQQ1's only opinion shares source, airframe and start with one of ANA1's, and such windows have one vote: it goes to the better anchor
    assert {r.callsign: r.n_sources for r in flights.collect()}["QQQ1"] == 0 and not any(k[0] == "QQQ1" for k in flags) and ("ANA1", "tiebreak_endpoint") not in flags


def test_diversions(spark):
    ddl = "flight_id long, icao24 string, callsign string, start_time timestamp, anchor_source string, n_sources int, origin_icao string, origin_agreement string, dest_icao string, dest_agreement string, feasibility_gated int"
    rows = [(i, "a", "ANA7", T0 + dt.timedelta(days=i), "x", 2, "RJTT", "majority", "RJOO", "majority", 0) for i in range(6)] + [(90, "a", "ANA7", T0 + dt.timedelta(days=6), "x", 2, "RJTT", "tiebreak", "RJAA", "majority", 1), (91, "a", "ANA7", T0 + dt.timedelta(days=7), "x", 1, "RJTT", "majority", "RJTT", "majority", 0), (92, "b", None, T0, "x", 2, None, None, "RJAA", "single", 0)]
    tiers = frame(spark, "flight_id long, is_military int", [(92, 1), (1, 0)])
    got = {(r.flight_id, r.flag_class): r.detail for r in reconcile.fct_flight_flags(frame(spark, ddl, rows), tiers).collect()}
    assert got == {
        (90, "diversion"): "dest RJAA vs modal RJOO 6/7", (90, "tiebreak_endpoint"): "origin tiebreak / dest majority", (90, "feasibility_snap"): "SP4 jet runway feasibility gate",
        (91, "single_source"): "only x", (91, "same_endpoint"): "at RJTT vs modal RJOO 6/8", (92, "one_sided_intl"): "origin unresolved / dest RJAA", (92, "military"): "",
    }


def test_days_to_build(spark):
    d = lambda k: dt.date(2024, 5, k)
    flights = frame(spark, "flight_id long, start_time timestamp", [(k, dt.datetime(2024, 5, k, 12)) for k in range(1, 13)])
    args = (d(12), d(1))
    assert paths.days_to_build(flights, *args) == [d(1), d(2), d(3), d(4), d(5)]
    built = frame(spark, "flight_id long, day_key date", [(k, d(k)) for k in range(1, 6)])
    assert paths.days_to_build(flights, *args, built) == [d(6), d(7), d(8), d(9), d(10)]
    assert paths.days_to_build(flights, *args, built.unionByName(frame(spark, "flight_id long, day_key date", [(777, d(2)), (778, d(3)), (779, d(5))]))) == [d(2), d(3)]
    near = frame(spark, "flight_id long, day_key date", [(k, d(k)) for k in range(1, 10)])
    assert paths.days_to_build(flights, *args, near) == [d(7), d(8), d(9), d(10), d(11)]
    assert paths.days_to_build(flights, *args, frame(spark, "flight_id long, day_key date", [(11, d(11))])) == []
    assert paths.days_to_build(flights, *args, built, repair=[d(4), d(2), d(3), d(9)]) == [d(2), d(3), d(4)]
    with pytest.raises(ValueError):
        paths.days_to_build(flights, *args, repair=[d(2)])


def test_settlement(spark):
    e = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    pts = [(e, 0.0, 179.0, 1.0), (e + 3600, 0.0, -179.0, 1.0)]
    ddl = "estimate_id string, seg_idx int, producer string, kind string, flight_id long, method_version int, config_hash long, input_fingerprint long, uncertainty_bin string, uncertainty_p50_km float, uncertainty_p90_km float, computed_at timestamp, input_provisional int, icao24 string, points array<struct<ts:bigint,lat:double,lon:double,alt_ft:double>>, skips array<struct<kind:string,reason:string>>, subject_key string"
    row = lambda i, hex_, producer="live", kind="gap", seg=1: (i, seg, producer, kind, 5, 1, 1, 1, "b", 1.0, 2.0, T0, 0, hex_, pts, [("gap", "long")], "s")
    est = frame(spark, ddl, [row("hex", "840001"), row("ends", ""), row("t", "840001", "test"), row("hex", "840001", kind="head", seg=0)])
    flights = frame(spark, "flight_id long, icao24 string, start_time timestamp, end_time timestamp", [(5, "840001", T0, at(60))])
    path = frame(spark, "flight_id long, ts timestamp, lat double, lon double, day_key date", [(5, at(m), 0.0, (179.0 + m / 30 + 180) % 360 - 180, T0.date()) for m in range(0, 61, 10)])
    got = {r.estimate_id: r for r in paths.fct_est_settlement(est, flights, path).collect()}
    assert set(got) == {"hex", "ends"}
    for r in got.values():
        assert (r.matched_flight_id, r.n_cand, r.truth_pts, r.wrap_pts, r.settled) == (5, 1, 5, 5, 1) and r.err_max_km < 0.01
    assert (got["hex"].match_via, got["ends"].match_via) == ("icao24", "anchor")
    use = marts.agg_est_usage_daily(est).first()
    assert (use.requests, use.arm, use.segments) == (2, "settled", 2)
    assert {(r.dimension, r.value): r.n for r in marts.agg_est_breakdown_daily(est).collect()} == {("skip", "gap:long"): 1, ("segment_kind", "gap"): 2, ("uncertainty_bin", "b"): 2}


def test_aggregate_states_are_immune_to_replays(spark, states, airlines, adsb, ranges):
    once = marts.hourly_traffic(marts.hourly_traffic_state(states))
    twice = marts.hourly_traffic(marts.hourly_traffic_state(states).unionByName(marts.hourly_traffic_state(states)))
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(once) == rows(twice)
    s = marts.airline_traffic_state(states, airlines, "callsign", "icao24", F.col("snapshot_time"))
    assert [tuple(r)[:2] for r in marts.distinct_members(s, ["airline_name"], "icao24").collect()] == [("All Nippon", 1)]
    c = marts.country_traffic_state(adsb, ranges, F.timestamp_seconds("capture_ts"))
    assert rows(marts.distinct_members(c, ["reg_country", "is_military"], "hex").select("reg_country", "is_military", "aircraft")) == [("Japan", False, 1), ("Japan", True, 1)]
    assert CONFIG.tier_gap_s == 900
