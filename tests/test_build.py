"""The models as a graph: order, a build of tables, and parts of it."""

import datetime as dt

import pytest

from driftline.models import build

from .test_models import SEGMENT, T0, adsb, airlines, airports, at, frame, ranges, segment, states, types  # noqa: F401


@pytest.fixture(scope="module")
def sources(spark, states, adsb, ranges, airlines, types, airports):  # noqa: F811
    reg = frame(spark, "icao24 string, registration string, typecode string, icaoaircrafttype string, manufacturername string, model string, operator string, operatorcallsign string, operatoricao string, owner string, as_of_date date, committed_at timestamp", [("840001", "JA1A", "B788", "L2J", "Boeing", "787", "Op", None, None, "Own", dt.date(2024, 1, 1), T0)])
    flights = frame(spark, "icao24 string, callsign string, first_seen timestamp, last_seen timestamp, est_departure_airport string, est_arrival_airport string, captured_for_airport string, direction string, window_kind string, ingested_at timestamp, committed_at timestamp, flight_duration_seconds long", [("840001", "ANA1", at(0), at(62), "RJTT", "RJOO", "RJTT", "departure", "d2", T0, T0, 3720)])
    swim = frame(spark, "gufi string, flight_ref string, acid string, computer_id string, filed_departure_time timestamp, filed_arrival_time timestamp, dep_point string, dep_point_kind string, arr_point string, arr_point_kind string, msg_timestamp timestamp, _dedup_fp long", [("g1", None, "ANA1", None, at(0), at(60), "HND", "airport", "RJOO", "airport", at(0), 1)])
    segments = frame(spark, SEGMENT, [segment("840001", "ANA1", 0, 60, (35.55, 139.78), (34.78, 135.44), alts=(0.0, 500.0), ground=(True, False))])
    traces = frame(spark, "icao24 string, ts timestamp, lat double, lon double, alt_ft double, on_ground boolean, gs_kt double, track_deg double", [("840001", at(m), 35.0 + m / 100, 139.0, 1000.0, False, 300.0, 90.0) for m in range(0, 60, 5)])
    overrides = frame(spark, "callsign string, valid_from date, valid_to date, origin_icao string, dest_icao string", [("ANA9", dt.date(2024, 1, 1), dt.date(2024, 12, 31), None, "RJAA")])
    return {
        "bronze_states": states, "bronze_states_adsblol": states, "bronze_adsb": adsb, "bronze_segments": segments, "bronze_registry": reg, "bronze_flights": flights, "bronze_swim": swim, "bronze_traces": traces,
        "hex_ranges": ranges, "airlines": airlines, "aircraft_types": types, "airports": airports, "overrides": overrides,
    }


def test_order_puts_inputs_first(monkeypatch):
    names = build.order()
    assert sorted(names) == sorted(build.GRAPH)
    for n in names:
        assert all(names.index(i.rstrip("?")) < names.index(n) for i in build.GRAPH[n][1] if i.rstrip("?") in build.GRAPH)
    monkeypatch.setitem(build.GRAPH, "stg_states", (lambda x: x, ("anomalies",)))
    with pytest.raises(ValueError, match="circle"):
        build.order()


def test_builds_what_its_sources_allow(spark, sources, tmp_path):
    made = build.build(spark, sources, str(tmp_path))
    missing = {"fct_est_settlement", "agg_est_usage_daily", "agg_est_breakdown_daily"}  # no estimates
    assert set(made) == set(build.GRAPH) - missing
    flights = {r.callsign: r for r in made["fct_flights_reconciled"].collect()}
    assert (flights["ANA1"].origin_icao, flights["ANA1"].dest_icao, flights["ANA1"].registration) == ("RJTT", "RJOO", "JA1A")
    assert made["fct_flight_path"].count() > 0 and made["agg_airport_daily"].count() > 0 and made["int_swim_opinion"].count() == 1
    assert {r.tier for r in made["fct_flight_recon_tier"].collect()} <= {"settled", "estimated", "provisional", "none"}
    # one model again, over the tables that are there
    before = sorted(map(tuple, made["fct_flight_recon_tier"].collect()))
    again = build.build(spark, {"bronze_adsb": sources["bronze_adsb"]}, str(tmp_path), ["fct_flight_recon_tier"])
    assert sorted(map(tuple, again["fct_flight_recon_tier"].collect())) == before
