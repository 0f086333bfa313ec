"""All models in the order of their inputs, each written as a table and read back.

A model that reads tables has a plan of its own size, however many models lie before it; and a lost executor costs the model that it worked on, not the graph. A run may
build some models only (their inputs must have been built), and leaves out those whose sources are absent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from . import marts, paths, reconcile, silver

#: model -> (function, its inputs by position). Names that no model has are sources; one that ends in ``?`` is passed as None where it is absent.
GRAPH: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "stg_states": (silver.stg_states, ("bronze_states",)),
    "stg_states_adsblol": (silver.stg_states_adsblol, ("bronze_states_adsblol",)),
    "stg_flight_segments_adsblol": (silver.stg_flight_segments_adsblol, ("bronze_segments",)),
    "stg_vrs_routes": (silver.stg_vrs_routes, ("bronze_routes?", "airports")),
    "fact_state_snapshots": (silver.fact_state_snapshots, ("stg_states",)),
    "int_adsb_callsign_from_opensky": (silver.int_adsb_callsign_from_opensky, ("bronze_adsb", "bronze_states")),
    "dim_aircraft_registry": (silver.dim_aircraft_registry, ("bronze_registry", "hex_ranges", "bronze_community?")),
    "dim_aircraft": (silver.dim_aircraft, ("bronze_adsb", "dim_aircraft_registry", "aircraft_types", "hex_ranges")),
    "fct_adsb_state": (silver.fct_adsb_state, ("bronze_adsb", "int_adsb_callsign_from_opensky", "dim_aircraft", "airlines", "hex_ranges")),
    "int_jet_airframes": (silver.int_jet_airframes, ("dim_aircraft_registry", "dim_aircraft", "aircraft_types")),
    "int_flight_legs_opensky": (silver.int_flight_legs_opensky, ("fact_state_snapshots", "airports", "int_jet_airframes")),
    "int_flight_routes_adsblol": (silver.int_flight_routes_adsblol, ("stg_flight_segments_adsblol", "airports", "int_jet_airframes")),
    "int_flight_chains_adsblol": (silver.int_flight_chains_adsblol, ("stg_flight_segments_adsblol", "int_flight_routes_adsblol")),
    "int_swim_flight": (silver.int_swim_flight, ("bronze_swim", "airports", "bronze_states", "bronze_adsb")),
    "int_swim_diagnostics": (silver.int_swim_diagnostics, ("int_swim_flight",)),
    "int_swim_opinion": (silver.int_swim_opinion, ("int_swim_flight", "airports")),
    "fact_flights": (reconcile.fact_flights, ("bronze_flights", "fact_state_snapshots", "airports", "dim_aircraft_registry")),
    "int_flight_opinions": (reconcile.int_flight_opinions, ("int_swim_opinion", "fact_flights", "int_flight_chains_adsblol", "int_flight_legs_opensky", "airports", "int_jet_airframes")),
    "int_flight_spine": (reconcile.int_flight_spine, ("int_flight_opinions",)),
    "int_flight_attach": (reconcile.int_flight_attach, ("int_flight_opinions", "int_flight_spine", "stg_vrs_routes", "airports", "int_jet_airframes")),
    "fct_flights_reconciled": (
        reconcile.fct_flights_reconciled,
        ("int_flight_spine", "int_flight_attach", "int_jet_airframes", "airports", "dim_aircraft", "airlines", "hex_ranges", "bronze_states", "overrides", "ladd?"),
    ),
    "fct_flight_legs": (marts.fct_flight_legs, ("int_flight_legs_opensky", "dim_aircraft", "airlines", "fct_adsb_state", "hex_ranges")),
    "int_fixes": (paths.fixes, ("bronze_adsb", "bronze_traces", "bronze_states")),
    "fct_flight_path": (paths.fct_flight_path, ("int_fixes", "fct_flights_reconciled")),
    "fct_flight_path_summary": (paths.fct_flight_path_summary, ("fct_flight_path", "fct_flights_reconciled")),
    "fct_flight_recon_tier": (reconcile.fct_flight_recon_tier, ("fct_flights_reconciled", "fct_flight_path_summary", "fct_flight_path", "bronze_adsb", "bronze_community?")),
    "fct_flight_flags": (reconcile.fct_flight_flags, ("fct_flights_reconciled", "fct_flight_recon_tier")),
    "fct_est_settlement": (paths.fct_est_settlement, ("estimates", "fct_flights_reconciled", "fct_flight_path")),
    "agg_est_usage_daily": (marts.agg_est_usage_daily, ("estimates",)),
    "agg_est_breakdown_daily": (marts.agg_est_breakdown_daily, ("estimates",)),
    "agg_airport_daily": (marts.agg_airport_daily, ("fct_flights_reconciled",)),
    "agg_country_traffic": (marts.agg_country_traffic, ("stg_states",)),
    "agg_operator_traffic": (marts.agg_operator_traffic, ("fct_flights_reconciled", "dim_aircraft_registry")),
    "agg_route_traffic": (marts.agg_route_traffic, ("fct_flights_reconciled",)),
    "longest_flights": (marts.longest_flights, ("fct_flights_reconciled", "dim_aircraft")),
    "anomalies": (marts.anomalies, ("stg_states",)),
}


def order(wanted: Iterable[str] | None = None) -> list[str]:
    """The models (``wanted`` ones, or all) so that each comes after its inputs."""
    chosen, out = set(GRAPH if wanted is None else wanted), []

    def put(name: str, above: tuple[str, ...] = ()) -> None:
        if name in above:
            raise ValueError(f"models in a circle: {' -> '.join([*above, name])}")
        if name in GRAPH and name not in out:
            for i in GRAPH[name][1]:
                put(i.rstrip("?"), (*above, name))
            out.append(name)

    for name in GRAPH:
        put(name)
    return [n for n in out if n in chosen]


def build(spark: SparkSession, sources: Mapping[str, DataFrame], path: str, wanted: Iterable[str] | None = None, write: Callable[[DataFrame, str], None] | None = None) -> dict[str, DataFrame]:
    """Build models under ``path``, a folder for each, and return them as tables. What was built before is read for models that aren't ``wanted``; models that lack an input are left out."""
    write = write or (lambda df, at: df.write.mode("overwrite").parquet(at))
    tables = dict(sources)
    if wanted is not None:
        wanted = list(wanted)
        need = {i.rstrip("?") for n in wanted for i in GRAPH[n][1]} & set(GRAPH) - set(wanted) - set(tables)
        tables |= {n: spark.read.parquet(f"{path}/{n}") for n in need}
    made = {}
    for name in order(wanted):
        function, inputs = GRAPH[name]
        if any(i not in tables for i in inputs if not i.endswith("?")):
            continue
        df = function(*[tables.get(i.rstrip("?")) for i in inputs])
        write(df, f"{path}/{name}")
        tables[name] = made[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    return made
