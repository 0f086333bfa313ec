"""From opinions of several sources to one record per flight: summaries, opinions, anchors, attachment, consensus, flags, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CONFIG, SOURCES, Config
from ..functions import scalars
from ..functions.geo import haversine
from ..functions.times import seconds_between
from ..operators import aggs, dedup, joins, sequences
from .silver import _jet_flag, with_country

C = F.col


def fact_flights(flights: DataFrame, snapshots: DataFrame, airports: DataFrame, registry: DataFrame) -> DataFrame:
    """Of the copies of (icao24, first_seen) the one with most endpoints, with both airports and the airframe."""
    ends = F.col("est_departure_airport").isNotNull().cast("int") + F.col("est_arrival_airport").isNotNull().cast("int")
    tail = ["window_kind", "captured_for_airport", "direction", "est_departure_airport", "est_arrival_airport", "callsign", "last_seen"]
    one = dedup.top_per_key(flights.where("first_seen is not null"), ["icao24", "first_seen"], [ends.desc(), C("ingested_at").desc_nulls_last(), *[C(c).asc_nulls_last() for c in tail]])
    out = one.withColumnsRenamed({"est_departure_airport": "origin_icao", "est_arrival_airport": "dest_icao"})
    for p in ("origin", "dest"):
        out = with_airport(out, airports, p)
    reg = registry.select("icao24", "registration", "typecode", "model", "operator", "operatoricao", "owner", "country_of_registration")
    seen = snapshots.select("icao24").distinct().withColumn("_seen", F.lit(True))
    out = out.join(reg, "icao24", "left").join(seen, "icao24", "left").withColumn("seen_in_context", F.coalesce("_seen", F.lit(False)))
    places = [f"{p}_{c}" for p in ("origin", "dest") for c in ("icao", "iata", "city", "name", "lat", "lon")]
    return out.select("icao24", "callsign", "first_seen", "last_seen", "flight_duration_seconds", *places, *reg.columns[1:], "seen_in_context", "captured_for_airport", "direction", "window_kind", "committed_at")


def with_airport(df: DataFrame, airports: DataFrame, prefix: str) -> DataFrame:
    """Adds <prefix>_name, _iata, _city, _lat, _lon for <prefix>_icao; blanks are null."""
    blank = lambda c: F.nullif(C(c), F.lit(""))
    a = airports.select(C("icao").alias(f"{prefix}_icao"), C("name").alias(f"{prefix}_name"), blank("iata").alias(f"{prefix}_iata"), blank("city").alias(f"{prefix}_city"), C("lat").alias(f"{prefix}_lat"), C("lon").alias(f"{prefix}_lon"))
    return df.join(a, f"{prefix}_icao", "left")


def _infeasible(airports: DataFrame, cfg: Config, prefix: str, shaped: Column, jet: Column):
    """(airport columns keyed by <prefix>_icao, expression of the gate)."""
    a = airports.select(C("icao").alias(f"{prefix}_icao"), C("runway_length_ft").alias(f"_{prefix}_runway"), C("airport_type").alias(f"_{prefix}_kind"))
    return a, scalars.jet_infeasible(shaped, jet, C(f"_{prefix}_runway"), C(f"_{prefix}_kind"), cfg.jet_min_runway_ft)


def _gate_endpoints(df: DataFrame, airports: DataFrame, jets: DataFrame, callsign: str, cfg: Config) -> DataFrame:
    """Adds origin_gated and dest_gated, and clears the endpoints that the gate holds."""
    out = _jet_flag(df, jets)
    shaped = scalars.airline_shaped(C(callsign))
    for p in ("origin", "dest"):
        a, gate = _infeasible(airports, cfg, p, shaped, C("_jet"))
        out = out.join(a, f"{p}_icao", "left").withColumn(f"{p}_gated", gate.cast("int"))
    for p in ("origin", "dest"):
        out = out.withColumn(f"{p}_icao", F.when(C(f"{p}_gated") == 0, C(f"{p}_icao")))
    return out.drop("_jet", "_origin_runway", "_origin_kind", "_dest_runway", "_dest_kind")


def int_flight_opinions(swim: DataFrame, flights: DataFrame, chains: DataFrame, legs: DataFrame, airports: DataFrame, jets: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """One row per source and window, without windows too long for one flight, and without endpoints that a jet cannot use."""
    def arm(df, rank, start, end):
        rows = df.select(F.lit(SOURCES[rank]).alias("source"), F.lit(rank).alias("source_rank"), "icao24", C(start).alias("win_start"), C(end).alias("win_end"), "callsign", "origin_icao", "dest_icao")
        return rows.where("icao24 is not null and win_start is not null and win_end is not null")

    hours = lambda a, b: seconds_between(C(a), C(b)) / 3600.0
    h = hours("first_seen", "last_seen")
    reach = haversine(C("origin_lat"), C("origin_lon"), C("dest_lat"), C("dest_lon"))
    fused = F.coalesce((h >= 8) & (reach < cfg.fused_speed_kmh * (h - 1.5)), F.lit(False))
    short = lambda a, b: hours(a, b) <= cfg.anchor_max_hours
    rows = arm(swim, 1, "win_start", "win_end").unionByName(arm(flights.where(short("first_seen", "last_seen") & ~fused), 3, "first_seen", "last_seen"))
    rows = rows.unionByName(arm(chains.where(short("chain_start", "chain_end")), 4, "chain_start", "chain_end")).unionByName(arm(legs, 5, "start_time", "end_time"))
    return _gate_endpoints(rows, airports, jets, "callsign", cfg).select("source", "source_rank", "icao24", "win_start", "win_end", "callsign", "origin_icao", "dest_icao", "origin_gated", "dest_gated")


def _compatible(a: Column, b: Column) -> Column:
    return a.isNull() | b.isNull() | (a == b)


def _free(df: DataFrame, taken: DataFrame) -> DataFrame:
    """Windows of ``df`` that no compatible window of ``taken`` overlaps."""
    l, r = df.alias("l"), taken.alias("r")
    on = (C("l.icao24") == C("r.icao24")) & (C("l.win_start") <= C("r.win_end")) & (C("l.win_end") >= C("r.win_start")) & _compatible(C("l.callsign"), C("r.callsign"))
    return l.join(r, on, "left_anti")


def int_flight_spine(opinions: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """The flights: clustered summaries, then chains and then short state legs that no better anchor overlaps."""
    cols = ["icao24", "win_start", "win_end", "callsign"]
    of = lambda s: opinions.where(C("source") == s)
    order = [C("win_start"), C("win_end"), C("callsign").asc_nulls_last(), C("origin_icao").asc_nulls_last(), C("dest_icao").asc_nulls_last()]
    w = Window.partitionBy("icao24").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    gapped = of("opensky_flights").withColumn("_reach", F.max("win_end").over(before))
    gapped = sequences.break_sessions(gapped, ["icao24"], order, C("win_start") > C("_reach") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(cfg.anchor_merge_gap_min)), "_gap")
    inside = Window.partitionBy("icao24", "_gap").orderBy(*order)
    known = F.last("callsign", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    turned = (F.lag("dest_icao").over(inside) == C("origin_icao")) & (C("win_start") >= F.lag("win_end").over(inside))
    renamed = F.trim("callsign") != F.trim(known)
    flagged = gapped.withColumn("_new", F.coalesce(turned, F.lit(False)) | F.coalesce(renamed, F.lit(False)))
    clusters = sequences.break_sessions(flagged, ["icao24", "_gap"], order, C("_new"), "_part")
    summaries = clusters.groupBy("icao24", "_gap", "_part").agg(F.min_by("callsign", F.struct(C("callsign").isNull(), C("win_start"), C("callsign"))).alias("callsign"), F.min("win_start").alias("win_start"), F.max("win_end").alias("win_end")).select(cols)
    chains = _free(of("adsblol").select(cols).distinct(), summaries)
    higher = summaries.unionByName(chains)
    legs = of("opensky_states").where(seconds_between(C("win_start"), C("win_end")) <= cfg.flight_max_hours * 3600).select(cols).distinct()
    anchors = None
    for rank, (name, df) in enumerate((("opensky_flights", summaries), ("adsblol", chains), ("opensky_states", _free(legs, higher))), 1):
        arm = df.withColumn("anchor_source", F.lit(name)).withColumn("anchor_rank", F.lit(rank))
        anchors = arm if anchors is None else anchors.unionByName(arm)
    return anchors.select(F.xxhash64("icao24", C("win_start").cast("string"), "anchor_source").alias("flight_id"), "icao24", C("win_start").alias("flight_start"), C("win_end").alias("flight_end"), C("callsign").alias("anchor_callsign"), "anchor_source", "anchor_rank")


def int_flight_attach(opinions: DataFrame, spine: DataFrame, schedules: DataFrame, airports: DataFrame, jets: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """One vote of each source for a flight: its opinion that overlaps it best; and the schedule's, where it is the only leg or the only one that another source supports."""
    o, s = opinions.alias("o"), spine.alias("s")
    on = (C("o.icao24") == C("s.icao24")) & (C("s.flight_start") <= C("o.win_end")) & (C("s.flight_end") >= C("o.win_start")) & _compatible(C("o.callsign"), C("s.anchor_callsign"))
    pairs = o.join(s, on).select("o.*", "s.flight_id", "s.anchor_rank").join(spine.select("flight_id", "flight_start", "flight_end"), "flight_id")
    pairs = pairs.withColumn("overlap_s", joins.overlap_seconds(C("win_start"), C("win_end"), C("flight_start"), C("flight_end")))
    nulls_last = [C("origin_icao").asc_nulls_last(), C("dest_icao").asc_nulls_last()]
    best = dedup.top_per_key(pairs, ["source", "icao24", "win_start"], [C("overlap_s").desc(), C("anchor_rank"), C("flight_id"), *nulls_last])
    ends = F.when(C("source") == "opensky_flights", C("origin_icao").isNotNull().cast("int") + C("dest_icao").isNotNull().cast("int")).otherwise(0)
    both = Window.partitionBy("flight_id", "source")
    best = best.withColumn("_og", F.max("origin_gated").over(both)).withColumn("_dg", F.max("dest_gated").over(both))
    votes = dedup.top_per_key(best, ["flight_id", "source"], [ends.desc(), C("overlap_s").desc(), C("win_start"), *nulls_last]).select("flight_id", "source", "source_rank", "origin_icao", "dest_icao", C("_og").alias("origin_gated"), C("_dg").alias("dest_gated"))
    legs = spine.withColumn("callsign_norm", scalars.callsign_norm(C("anchor_callsign"))).join(schedules.select("callsign_norm", "origin_icao", "dest_icao", "n_box_legs"), "callsign_norm")
    said = votes.select("flight_id", C("origin_icao").alias("_o"), C("dest_icao").alias("_d"))
    key = ["flight_id", "icao24", "anchor_callsign", "origin_icao", "dest_icao", "n_box_legs"]
    scored = legs.join(said, "flight_id", "left").groupBy(*key).agg((F.count_if(C("_o") == C("origin_icao")) + F.count_if(C("_d") == C("dest_icao"))).alias("support"))
    supported = F.sum((C("support") > 0).cast("int")).over(Window.partitionBy("flight_id"))
    picked = scored.withColumn("_n", supported).where("n_box_legs = 1 or (support > 0 and _n = 1)")
    scheduled = _gate_endpoints(picked, airports, jets, "anchor_callsign", cfg).where("origin_icao is not null or dest_icao is not null")
    return votes.unionByName(scheduled.select("flight_id", F.lit(SOURCES[2]).alias("source"), F.lit(2).alias("source_rank"), "origin_icao", "dest_icao", F.lit(0).alias("origin_gated"), F.lit(0).alias("dest_gated")))


def fct_flights_reconciled(
    spine: DataFrame, attach: DataFrame, jets: DataFrame, airports: DataFrame, aircraft: DataFrame, airlines: DataFrame, ranges: DataFrame, states: DataFrame, overrides: DataFrame, ladd: DataFrame | None = None, cfg: Config = CONFIG
) -> DataFrame:
    """One row per flight that was summarised or seen in the box: endpoints by plurality (curated ones first), votes, agreement, airframe, airline, privacy."""
    shape = _jet_flag(spine, jets).select("flight_id", scalars.airline_shaped(C("anchor_callsign")).alias("_shaped"), "_jet")
    seen = states.where(scalars.in_box(C("latitude"), C("longitude"), cfg.box)).select("icao24", "snapshot_time")
    inside = spine.join(seen, "icao24").where(C("snapshot_time").between(C("flight_start"), C("flight_end"))).select("flight_id").distinct().withColumn("_in", F.lit(True))
    kept = spine.join(inside, "flight_id", "left").where((C("anchor_source") == "opensky_flights") | C("_in")).drop("_in")
    day = F.to_date("flight_start")
    ov = overrides.select(C("callsign").alias("_cs"), "valid_from", "valid_to", C("origin_icao").alias("_co"), C("dest_icao").alias("_cd"))
    curated = spine.join(ov, (F.trim("anchor_callsign") == C("_cs")) & day.between(C("valid_from"), C("valid_to")))
    latest = curated.groupBy("flight_id").agg(F.max_by(F.struct("_co", "_cd"), F.struct("valid_from", "_co", "_cd")).alias("_c")).select("flight_id", "_c.*")
    for c in ("_co", "_cd"):  # an override counts only for an airport that exists
        latest = latest.join(airports.select(C("icao").alias(f"{c}_known")), C(c) == C(f"{c}_known"), "left").drop(c).withColumnRenamed(f"{c}_known", c)
    out = kept
    for p, c in (("origin", "_co"), ("dest", "_cd")):
        ap = airports.select(C("icao").alias(f"{p}_icao"), F.coalesce("scheduled_service", F.lit(False)).alias("_sched"), "runway_length_ft", "airport_type")
        ballots = attach.where(C(f"{p}_icao").isNotNull()).join(ap, f"{p}_icao", "left").join(shape, "flight_id", "left")
        ballots = ballots.where(~scalars.jet_infeasible(C("_shaped"), C("_jet"), C("runway_length_ft"), C("airport_type"), cfg.jet_min_runway_ft)).withColumn("_gate", F.coalesce(C("_shaped") & C("_sched"), F.lit(False)))
        won = aggs.plurality(ballots, ["flight_id"], f"{p}_icao", "source", "source_rank", "_gate")
        out = out.join(won.select("flight_id", C("winner").alias(f"_{p}"), scalars.map_label(C("best_rank"), SOURCES, SOURCES[5]).alias(f"_{p}_src"), C("agreement").alias(f"_{p}_agr"), C("vote_map").alias(f"{p}_votes")), "flight_id", "left")
    totals = attach.groupBy("flight_id").agg(F.count_distinct("source").alias("_n"), F.greatest(F.max("origin_gated"), F.max("dest_gated")).alias("_g"))
    out = out.join(totals, "flight_id", "left").join(latest, "flight_id", "left")
    for p, c in (("origin", "_co"), ("dest", "_cd")):
        cur = C(c).isNotNull()
        out = out.withColumn(f"{p}_icao", F.coalesce(c, f"_{p}")).withColumn(f"{p}_source", F.when(cur, "curated").otherwise(C(f"_{p}_src"))).withColumn(f"{p}_agreement", F.when(cur, "curated").otherwise(C(f"_{p}_agr")))
    out = out.withColumn("callsign", F.trim("anchor_callsign")).withColumn("_airline", F.when(scalars.airline_shaped(C("callsign")), F.substring("callsign", 1, 3)))
    out = out.join(aircraft.select(C("icao24").alias("_k"), "registration", "typecode"), F.lower("icao24") == C("_k"), "left").join(airlines.select(C("icao").alias("_airline"), C("name").alias("airline_name"), C("country").alias("airline_country")), "_airline", "left")
    head = ["flight_id", "icao24", "callsign", C("flight_start").alias("start_time"), C("flight_end").alias("end_time"), "anchor_source", F.coalesce("_n", F.lit(0)).alias("n_sources"), F.coalesce("_g", F.lit(0)).alias("feasibility_gated")]
    sides = [f"{p}_{c}" for p in ("origin", "dest") for c in ("icao", "source", "agreement", "votes")]
    out = with_country(out.select(*head, *sides, "registration", "typecode", "airline_name", "airline_country"), "icao24", ranges, "reg_country")
    for p in ("origin", "dest"):
        out = with_airport(out, airports, p)
    return _mark_private(out, ladd)


def _mark_private(flights: DataFrame, ladd: DataFrame | None) -> DataFrame:
    """is_ladd: the airframe or the callsign is on the privacy list; an open entry covers all history, a closed one what it overlaps. Two equi-joins, not one with OR."""
    if ladd is None:
        return flights.withColumn("is_ladd", F.lit(0))
    src = ladd.select(F.lower(F.trim("icao24")).alias("_hex"), F.upper(F.trim("callsign")).alias("_cs"), "valid_from", "valid_to")
    covers = C("valid_to").isNull() | ((C("valid_from") <= F.to_date("end_time")) & (C("valid_to") >= F.to_date("start_time")))
    hits = None
    for mine, theirs in ((F.lower("icao24"), "_hex"), (F.upper(F.trim("callsign")), "_cs")):
        one = flights.join(src, (mine == C(theirs)) & covers, "left_semi").select("flight_id")
        hits = one if hits is None else hits.unionByName(one)
    return flights.join(hits.distinct().withColumn("_l", F.lit(1)), "flight_id", "left").withColumn("is_ladd", F.coalesce("_l", F.lit(0))).drop("_l")


def fct_flight_recon_tier(flights: DataFrame, summary: DataFrame, path: DataFrame, adsb: DataFrame, community: DataFrame | None = None, cfg: Config = CONFIG) -> DataFrame:
    """How well each flight's path is known: settled, estimated, provisional or none; and whether its airframe is military."""
    mil = adsb.where(scalars.bit_flag(C("db_flags"), 1) & C("hex").isNotNull()).select(F.lower("hex").alias("_m"))
    if community is not None:
        newest = community.agg(F.max("as_of_date").alias("_d"))
        mil = mil.unionByName(community.join(F.broadcast(newest), C("as_of_date") == C("_d")).where("mil = 1 and icao24 is not null").select(F.lower("icao24").alias("_m")))  # one row
    head = path.agg(F.coalesce(F.max("day_key"), F.lit("1970-01-01").cast("date")).alias("_head"))
    r = flights.where("flight_id is not null").select("flight_id", F.lower("icao24").alias("icao24"), "callsign", "start_time", "end_time")
    s = summary.select("flight_id", "n_points", "largest_gap_s", "observed_fraction", "first_fix_ts", "last_fix_ts", F.lit(True).alias("_has"))
    j = r.join(s, "flight_id", "left").join(mil.distinct(), C("icao24") == C("_m"), "left").crossJoin(F.broadcast(head))
    late = F.greatest(F.lit(0), seconds_between(C("start_time"), C("first_fix_ts")))
    early = F.greatest(F.lit(0), seconds_between(C("last_fix_ts"), C("end_time")))
    gap = F.when(C("_has"), F.greatest(F.coalesce("largest_gap_s", F.lit(0)), late, early))
    tier = F.when(gap <= cfg.tier_gap_s, "settled").when(C("_has"), "estimated").when(F.to_date("start_time") > C("_head"), "provisional").otherwise("none")
    return j.select("flight_id", "icao24", "callsign", F.to_date("start_time").alias("start_day"), gap.alias("effective_gap_s"), tier.alias("tier"), "n_points", "largest_gap_s", "observed_fraction", C("_m").isNotNull().cast("int").alias("is_military"))


def fct_flight_flags(flights: DataFrame, tiers: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """(flight_id, icao24, callsign, start_day, flag_class, detail): seven kinds of flights to look at. One pass makes the flags of a row, two joins bring the service's usual destination and the tier."""
    r = flights.where("flight_id is not null").select("flight_id", F.lower("icao24").alias("icao24"), F.trim("callsign").alias("callsign"), F.to_date("start_time").alias("start_day"), "anchor_source", "n_sources", "origin_icao", "origin_agreement", "dest_icao", "dest_agreement", "feasibility_gated")
    full = r.where(scalars.airline_shaped(C("callsign")) & C("origin_icao").isNotNull() & C("dest_icao").isNotNull()).select("flight_id", F.upper("callsign").alias("cs"), C("origin_icao").alias("org"), C("start_day").alias("d"), C("dest_icao").alias("dest"))
    daily = full.groupBy("cs", "org", "d", "dest").agg(F.count("*").alias("n"))
    days = full.select("cs", "org", "d").distinct().alias("a")
    window = days.join(daily.alias("b"), (C("a.cs") == C("b.cs")) & (C("a.org") == C("b.org")) & (C("b.d") <= C("a.d")) & (C("b.d") > F.date_sub(C("a.d"), cfg.diversion_days))).groupBy("a.cs", "a.org", "a.d", "b.dest").agg(F.sum("n").alias("n"))
    modal = window.groupBy("cs", "org", "d").agg(F.max(F.struct("n", "dest")).alias("_m"), F.sum("n").alias("support")).select("cs", "org", "d", C("_m.dest").alias("modal_dest"), C("_m.n").alias("modal_n"), "support")
    known = full.join(modal, ["cs", "org", "d"]).select("flight_id", "modal_dest", "modal_n", "support")
    j = r.join(known, "flight_id", "left").join(tiers.where("is_military = 1").select("flight_id", F.lit(True).alias("_mil")), "flight_id", "left")
    text = lambda c: F.coalesce(C(c), F.lit("-"))
    strong = (C("modal_n") >= cfg.diversion_support) & (C("modal_n") / C("support") >= cfg.diversion_share)
    versus = F.concat(F.lit(" vs modal "), text("modal_dest"), F.lit(" "), C("modal_n").cast("string"), F.lit("/"), C("support").cast("string"))
    one_end = C("origin_icao").isNull() != C("dest_icao").isNull()
    arms = {
        "tiebreak_endpoint": (F.coalesce(C("origin_agreement") == "tiebreak", F.lit(False)) | F.coalesce(C("dest_agreement") == "tiebreak", F.lit(False)), F.concat(F.lit("origin "), text("origin_agreement"), F.lit(" / dest "), text("dest_agreement"))),
        "single_source": (C("n_sources") == 1, F.concat(F.lit("only "), C("anchor_source"))),
        "one_sided_intl": (one_end, F.when(C("origin_icao").isNull(), F.concat(F.lit("origin unresolved / dest "), text("dest_icao"))).otherwise(F.concat(F.lit("origin "), text("origin_icao"), F.lit(" / dest unresolved")))),
        "feasibility_snap": (C("feasibility_gated") == 1, F.lit("SP4 jet runway feasibility gate")),
        "diversion": (strong & (C("dest_icao") != C("modal_dest")) & (C("origin_icao") != C("dest_icao")), F.concat(F.lit("dest "), text("dest_icao"), versus)),
        "same_endpoint": (C("origin_icao") == C("dest_icao"), F.concat(F.lit("at "), text("origin_icao"), F.when(strong & (C("modal_dest") != C("origin_icao")), versus).otherwise(""))),
        "military": (C("_mil"), F.lit("")),
    }
    flags = F.filter(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(k).alias("flag_class"), detail.alias("detail"))) for k, (test, detail) in arms.items()]), lambda x: x.isNotNull())
    return j.select("flight_id", "icao24", "callsign", "start_day", F.explode(flags).alias("_f")).select("flight_id", "icao24", "callsign", "start_day", "_f.*")
