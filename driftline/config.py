"""The tunables of the domain models, as one frozen object."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # Thresholds of sessions, chains, snapping, reconciliation, paths and flags.
    legs_gap_min: int = 90
    legs_turnaround_min: int = 30
    snap_km: float = 100.0
    cruise_alt_m: float = 3000.0
    iata_pref_km: float = 10.0
    backfill_window_s: int = 600
    chain_speed_kmh: tuple[float, float] = (300.0, 1100.0)
    chain_stop_gap_h: int = 1
    chain_stop_speed_kmh: float = 550.0
    chain_stop_alt_m: float = 8000.0
    chain_low_fix_alt_m: float = 300.0
    chain_low_fix_gap_min: int = 45
    anchor_merge_gap_min: int = 30
    flight_max_hours: float = 8.0
    swim_max_flight_hours: int = 20
    anchor_max_hours: float = 16.0
    fused_speed_kmh: float = 550.0
    jet_min_runway_ft: int = 4500
    path_pad_min: int = 10
    path_lag_days: int = 1
    path_chunk_days: int = 5
    #: south, west, north, east
    box: tuple[float, float, float, float] = (20.0, 122.0, 50.0, 165.0)
    tier_gap_s: int = 900
    diversion_days: int = 90
    diversion_support: int = 5
    diversion_share: float = 0.6


CONFIG = Config()
#: Voters by rank, best first.
SOURCES = {1: "swim", 2: "vrs_routes", 3: "opensky_flights", 4: "adsblol", 5: "opensky_states"}
