"""Queries over the test tables, one or more for each generic operator, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, scalars, times
from ..operators import aggs, dedup, joins, scd, sequences

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (tables) under its name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


C = F.col
SESSIONS = """
    p AS (SELECT *, lag(ts) OVER w AS pts, lag(event_type) OVER w AS ptype FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    b AS (SELECT *, CASE WHEN pts IS NULL OR date_diff('second', pts, ts) > 5400 OR (event_type <> ptype AND date_diff('second', pts, ts) > 1800) THEN 1 ELSE 0 END AS flag FROM p),
    s AS (SELECT *, sum(flag) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session_id FROM b)"""


def _sessions(t) -> DataFrame:
    return sequences.sessionize(t("events"), "user_id", "ts", "event_type", "event_id", 5400, 1800)


@query(f"""WITH {SESSIONS},
    d AS (SELECT user_id, session_id, event_type AS dominant_type, count(*) AS dominant_n,
        row_number() OVER (PARTITION BY user_id, session_id ORDER BY count(*) DESC, min(ts), event_type) AS rn FROM s GROUP BY user_id, session_id, event_type),
    e AS (SELECT user_id, session_id, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n, arg_min(event_type, (ts, event_id)) AS first_event_type, arg_min(value, (ts, event_id)) AS first_value,
        arg_max(event_type, (ts, event_id)) AS last_event_type, arg_max(value, (ts, event_id)) AS last_value FROM s GROUP BY user_id, session_id)
    SELECT e.*, dominant_type, dominant_n FROM e JOIN d USING (user_id, session_id) WHERE rn = 1""")
def sessionize_events(t):
    rows = _sessions(t)
    ends = sequences.first_last(rows, ["user_id", "session_id"], "ts", "event_id", ["event_type", "value"])
    best = sequences.dominant_value(rows, ["user_id", "session_id"], "event_type", "ts", "dominant_type")
    return ends.join(best.withColumnRenamed("dominant_type_n", "dominant_n"), ["user_id", "session_id"])


@query(f"WITH {SESSIONS} SELECT event_id, user_id, session_id FROM s")
def session_ids(t):
    return _sessions(t).select("event_id", "user_id", C("session_id").cast("long").alias("session_id"))


@query("""SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY user_id""")
def latest_per_key(t):
    return dedup.latest_per_key(t("events").select("user_id", "ts", "event_id"), ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "ts")


@query("""WITH e AS (SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events)
    SELECT user_id, arg_max(v, ts) AS skipping, arg_max_null(v, ts) AS keeping, arg_min(v, ts) AS first_skipping FROM e GROUP BY user_id""")
def argmax_null_rules(t):
    v = F.when(C("event_type") != "error", C("value"))
    return t("events").groupBy("user_id").agg(dedup.argmax(v, C("ts")).alias("skipping"), dedup.argmax(v, C("ts"), skip_null=False).alias("keeping"), dedup.argmin(v, C("ts")).alias("first_skipping"))


@query("""SELECT o_custkey, o_orderpriority, arg_max(struct_pack(o_orderkey, o_totalprice), (o_totalprice, o_orderkey)).o_orderkey AS o_orderkey FROM orders GROUP BY ALL""")
def argmax_tuple(t):
    best = F.max_by(F.struct("o_orderkey", "o_totalprice"), F.struct("o_totalprice", "o_orderkey"))
    return t("orders").groupBy("o_custkey", "o_orderpriority").agg(best["o_orderkey"].alias("o_orderkey"))


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS LAST) = 1""")
def dedup_content_total(t):
    return dedup.limit_by(t("orders"), ["o_custkey", "o_orderstatus"], [C("o_totalprice").desc_nulls_last(), C("o_orderkey").asc_nulls_last()]).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


PURCHASES = "p AS (SELECT * FROM events WHERE event_type = 'purchase'), c AS (SELECT user_id, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events WHERE event_type = 'click' GROUP BY ALL)"


def _sides(t):
    e = t("events").select("event_id", "user_id", "ts", "event_type", "value")
    return e.where("event_type = 'purchase'"), e.where("event_type = 'click'")


@query(f"""WITH {PURCHASES} SELECT p.event_id, p.user_id, c.ts AS asof_ts, c.value AS asof_value FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts >= c.ts""")
def asof_backward(t):
    return joins.asof(*_sides(t), "user_id", "ts", ["value"], "event_id").select("event_id", "user_id", "asof_ts", "asof_value")


@query(f"""WITH {PURCHASES} SELECT p.event_id, p.user_id, CASE WHEN date_diff('second', p.ts, c.ts) <= 86400 THEN c.ts END AS asof_ts,
    CASE WHEN date_diff('second', p.ts, c.ts) <= 86400 THEN c.value END AS asof_value FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts <= c.ts""")
def asof_forward_within(t):
    return joins.asof(*_sides(t), "user_id", "ts", ["value"], "event_id", "forward", 86400).select("event_id", "user_id", "asof_ts", "asof_value")


@query(f"""WITH {PURCHASES}, m AS (SELECT p.event_id, c.ts, c.value, abs(date_diff('second', p.ts, c.ts)) AS d FROM p LEFT JOIN c ON p.user_id = c.user_id AND abs(date_diff('second', p.ts, c.ts)) <= 43200)
    SELECT event_id, ts AS near_ts, value AS near_value FROM m QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY d, ts DESC NULLS LAST) = 1""")
def asof_nearest_two_sided(t):
    return joins.asof_nearest(*_sides(t), "user_id", "ts", "value", "event_id", "event_id", 43200).select("event_id", "near_ts", "near_value")


BANDS = [(0, 49_999, "low"), (50_000, 99_999, "mid"), (100_000, 199_999, "high"), (200_000, 499_999, "top")]
BANDS_SQL = "r(lo, hi, band) AS (VALUES " + ", ".join(f"({a}, {b}, '{c}')" for a, b, c in BANDS) + ")"


@query(f"WITH {BANDS_SQL} SELECT o_orderkey, band FROM orders LEFT JOIN r ON floor(o_totalprice)::BIGINT BETWEEN lo AND hi")
def range_lookup(t):
    orders = t("orders").select("o_orderkey", F.floor("o_totalprice").alias("price"))
    bands = orders.sparkSession.createDataFrame(BANDS, "lo long, hi long, band string")
    return joins.range_lookup(orders, "price", bands, "lo", "hi", "band", 4096).select("o_orderkey", "band")


@query("""SELECT lo::BIGINT AS lo, hi::BIGINT AS hi, label FROM (VALUES (0, 9, 'outer'), (10, 19, 'inner'), (20, 99, 'outer'), (100, 149, 'tail')) v(lo, hi, label)""")
def flatten_ranges(t):
    rows = [(0, 99, "outer", 2), (10, 19, "inner", 1), (50, 149, "tail", 3)]
    return joins.flatten_ranges(t("region").sparkSession.createDataFrame(rows, "lo long, hi long, label string, priority int"), "lo", "hi", "label", "priority")


WINDOWS = """
    a AS (SELECT l_orderkey * 10 + l_linenumber AS a_id, l_suppkey AS k, l_shipdate AS s, l_shipdate + INTERVAL 2 DAY AS e FROM lineitem WHERE l_returnflag = 'R' AND l_quantity <= 5),
    b AS (SELECT l_orderkey * 10 + l_linenumber AS b_id, l_suppkey AS k, l_shipdate AS s, l_shipdate + INTERVAL 3 DAY AS e FROM lineitem WHERE l_returnflag = 'A' AND l_quantity >= 45)"""


def _windows(t):
    l = t("lineitem").withColumn("id", C("l_orderkey") * 10 + C("l_linenumber"))
    make = lambda cond, name, days: l.where(cond).select(C("id").alias(name), C("l_suppkey").alias("k"), C("l_shipdate").alias("s"), (C("l_shipdate") + F.expr(f"INTERVAL {days} DAY")).alias("e"))
    return make("l_returnflag = 'R' and l_quantity <= 5", "a_id", 2), make("l_returnflag = 'A' and l_quantity >= 45", "b_id", 3)


@query(f"""WITH {WINDOWS}, p AS (SELECT a_id, b_id, date_diff('second', greatest(a.s, b.s), least(a.e, b.e)) AS overlap_s FROM a JOIN b ON a.k = b.k AND a.s <= b.e AND a.e >= b.s)
    SELECT a_id, b_id, overlap_s FROM p QUALIFY row_number() OVER (PARTITION BY a_id ORDER BY overlap_s DESC, b_id) = 1""")
def interval_overlap_best(t):
    return joins.interval_overlap_best(*_windows(t), "k", "a_id", "b_id")


@query(f"WITH {WINDOWS} SELECT a_id, k FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.k = b.k AND a.s <= b.e AND a.e >= b.s)")
def overlap_anti(t):
    return joins.overlap_anti(*_windows(t), "k").select("a_id", "k")


@query(f"""WITH {SESSIONS}, w AS (SELECT user_id, user_id * 1000000 + session_id AS w_id, min(ts) AS s, max(ts) AS e FROM s GROUP BY ALL),
    h AS (SELECT ev.event_id, w_id, abs(2 * epoch(date_trunc('second', ev.ts))::BIGINT - epoch(date_trunc('second', w.s))::BIGINT - epoch(date_trunc('second', w.e))::BIGINT) AS d FROM events ev JOIN w ON ev.user_id = w.user_id
        AND date_diff('second', w.s, ev.ts) >= -7200 AND date_diff('second', ev.ts, w.e) >= -7200)
    SELECT event_id, w_id FROM h QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY d, w_id) = 1""")
def point_in_interval_contest(t):
    w = _sessions(t).groupBy("user_id", (C("user_id") * 1_000_000 + C("session_id")).alias("w_id")).agg(F.min("ts").alias("s"), F.max("ts").alias("e"))
    return joins.contest_nearest_mid(t("events"), w, "user_id", "ts", "event_id", "w_id", pad_s=7200)


PLACES = """
    pt AS (SELECT c_custkey AS p_id, (c_custkey * 37 % 1700) / 10.0 - 85 AS lat, (c_custkey * 91 % 3600) / 10.0 - 180 AS lon FROM customer),
    pl AS (SELECT s_suppkey AS a_id, (s_suppkey * 53 % 1700) / 10.0 - 85 AS lat, (s_suppkey * 127 % 3600) / 10.0 - 180 AS lon FROM supplier)"""


def _places(t):
    at = lambda c, a, b: [((c * a % 1700) / 10.0 - 85).alias("lat"), ((c * b % 3600) / 10.0 - 180).alias("lon")]
    return t("customer").select(C("c_custkey").alias("p_id"), *at(C("c_custkey"), 37, 91)), t("supplier").select(C("s_suppkey").alias("a_id"), *at(C("s_suppkey"), 53, 127))


HAVERSINE = "2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"


@query(f"""WITH {PLACES}, h AS (SELECT p_id, a_id, {HAVERSINE.format(a='pt', b='pl')} AS d FROM pt, pl)
    SELECT p_id, a_id, round(d, 4) AS distance_km FROM h WHERE d <= 900 QUALIFY row_number() OVER (PARTITION BY p_id ORDER BY d, a_id) = 1""")
def nearest_within(t):
    return joins.nearest_place(*_places(t), "p_id", "a_id", 900.0).select("p_id", "a_id", F.round("distance_km", 4).alias("distance_km"))


@query(f"""WITH {PLACES}, h AS (SELECT p_id, a_id, {HAVERSINE.format(a='pt', b='pl')} AS d FROM pt, pl)
    SELECT p_id, a_id, round(d, 4) AS distance_km FROM h WHERE d <= 900
    QUALIFY row_number() OVER (PARTITION BY p_id ORDER BY CASE WHEN a_id % 3 = 0 AND d <= 600 THEN 0 ELSE 1 END, d, a_id) = 1""")
def nearest_preferred(t):
    points, places = _places(t)
    return joins.nearest_place(points, places.withColumn("pref", C("a_id") % 3 == 0), "p_id", "a_id", 900.0, prefer="pref", prefer_km=600.0).select("p_id", "a_id", F.round("distance_km", 4).alias("distance_km"))


TIMED = "e AS (SELECT event_id, ts, (user_id * 7 % 90)::DOUBLE AS lat, (user_id * 13 % 180)::DOUBLE AS lon, event_type FROM events)"


@query(f"""WITH {TIMED} SELECT a.event_id AS a_id, b.event_id AS b_id FROM e a JOIN e b ON a.event_type = 'purchase' AND b.event_type = 'view'
    AND abs(date_diff('second', a.ts, b.ts)) <= 900 AND {HAVERSINE.format(a='a', b='b')} < 3000""")
def near_in_time_and_space(t):
    e = t("events").select("event_id", "ts", (C("user_id") * 7 % 90).cast("double").alias("lat"), (C("user_id") * 13 % 180).cast("double").alias("lon"), "event_type")
    a, b = e.where("event_type = 'purchase'").withColumnRenamed("event_id", "a_id"), e.where("event_type = 'view'").withColumnRenamed("event_id", "b_id")
    return joins.near_in_time_and_space(a, b, "a_id", "b_id", within_s=900, within_km=3000.0)


@query("""WITH x AS (SELECT c_nationkey AS k, max(c_acctbal) AS bal, max(CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END) AS tag FROM customer GROUP BY 1), y AS (SELECT s_nationkey AS k, max(s_name) AS tag FROM supplier GROUP BY 1)
    SELECT coalesce(x.k, y.k) AS k, bal, coalesce(x.tag, y.tag) AS tag FROM x FULL JOIN y ON x.k = y.k""")
def full_outer_fill(t):
    x = t("customer").groupBy(C("c_nationkey").alias("k")).agg(F.max("c_acctbal").alias("bal"), F.max(F.when(C("c_nationkey") % 2 == 0, C("c_mktsegment"))).alias("tag"))
    return joins.full_outer_fill(x, t("supplier").groupBy(C("s_nationkey").alias("k")).agg(F.max("s_name").alias("tag")), ["k"])


@query("""WITH x AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), y AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
    SELECT coalesce(x.k, y.k) AS k, CASE WHEN y.k IS NULL THEN 'left' WHEN x.k IS NULL THEN 'right' ELSE 'changed' END AS side FROM x FULL JOIN y ON x.k = y.k WHERE x.n IS DISTINCT FROM y.n""")
def full_outer_diff(t):
    side = lambda s: t("orders").where(C("o_orderstatus") == s).groupBy(C("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    return joins.full_outer_diff(side("F"), side("O"), ["k"], ["n"])


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def semi_join(t):
    return t("customer").join(t("orders").where("o_totalprice > 300000"), C("c_custkey") == C("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def anti_join(t):
    return t("customer").join(t("orders").where("o_orderstatus = 'P'"), C("c_custkey") == C("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'P') OR EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size = 1)")
def either_key(t):
    l = t("lineitem").withColumn("id", F.struct("l_orderkey", "l_linenumber"))
    targets = t("orders").where("o_orderstatus = 'P'").select("o_orderkey", F.lit(None).cast("long").alias("p_partkey")).unionByName(t("part").where("p_size = 1").select(F.lit(None).cast("long").alias("o_orderkey"), "p_partkey"))
    return joins.either_key(l, targets, "id", [("l_orderkey", "o_orderkey"), ("l_partkey", "p_partkey")]).select("id.*")


@query("SELECT o_orderkey FROM orders WHERE (o_custkey, o_orderpriority) IN (SELECT (o_custkey, min(o_orderpriority)) FROM orders GROUP BY o_custkey)")
def tuple_in(t):
    low = t("orders").groupBy("o_custkey").agg(F.min("o_orderpriority").alias("o_orderpriority"))
    return t("orders").join(low, ["o_custkey", "o_orderpriority"], "left_semi").select("o_orderkey")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY")
def scalar_subquery_filter(t):
    t("orders").createOrReplaceTempView("driftline_orders")
    return t("orders").sparkSession.sql("SELECT o_orderkey, o_orderdate FROM driftline_orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM driftline_orders) - INTERVAL 30 DAY")


@query("""WITH d(k, valid_from, valid_to, rate) AS (VALUES ('1-URGENT', DATE '1992-01-01', DATE '1995-06-30', 'old'), ('1-URGENT', DATE '1995-01-01', NULL, 'new'), ('5-LOW', DATE '1993-01-01', DATE '1993-12-31', 'low'))
    SELECT o_orderkey, rate FROM orders LEFT JOIN d ON o_orderpriority = k AND o_orderdate::DATE >= valid_from AND (valid_to IS NULL OR o_orderdate::DATE <= valid_to)
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY valid_from DESC NULLS LAST) = 1""")
def validity_join(t):
    o = t("orders").select("o_orderkey", C("o_orderpriority").alias("k"), F.to_date("o_orderdate").alias("day"))
    rows = [("1-URGENT", "1992-01-01", "1995-06-30", "old"), ("1-URGENT", "1995-01-01", None, "new"), ("5-LOW", "1993-01-01", "1993-12-31", "low")]
    dim = o.sparkSession.createDataFrame(rows, "k string, f string, t string, rate string").select("k", C("f").cast("date").alias("valid_from"), C("t").cast("date").alias("valid_to"), "rate")
    return joins.validity(o, dim, "k", "day", ["rate"]).select("o_orderkey", "rate")


@query("""WITH a AS (SELECT DISTINCT l_suppkey AS k, l_partkey % 50 AS c FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_suppkey AS k, l_partkey % 50 AS c FROM lineitem WHERE l_returnflag = 'A'),
    keys AS (SELECT k FROM a UNION SELECT k FROM b), m AS (SELECT keys.k, count(b.c) AS n, max(b.c) AS c FROM keys LEFT JOIN a ON a.k = keys.k LEFT JOIN b ON b.k = a.k AND b.c = a.c GROUP BY keys.k)
    SELECT k, CASE WHEN n = 1 THEN 'match' WHEN n > 1 THEN 'ambiguous' ELSE 'pending' END AS status, CASE WHEN n = 1 THEN c END AS c FROM m""")
def candidate_intersection(t):
    side = lambda f: t("lineitem").where(C("l_returnflag") == f).select(C("l_suppkey").alias("k"), (C("l_partkey") % 50).alias("c"))
    return joins.candidate_intersection(side("R"), side("A"), "k", "c")


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, avg(l_quantity) AS avg_qty, count(*) AS n, min(l_shipdate) AS first_ship FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY ALL")
def hash_aggregate(t):
    return t("lineitem").where(C("l_shipdate") <= F.lit("1998-09-02").cast("date")).groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(C("l_extendedprice") * (1 - C("l_discount"))), 2).alias("revenue"), F.avg("l_quantity").alias("avg_qty"), F.count("*").alias("n"), F.min("l_shipdate").alias("first_ship"))


@query("""SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned, count(DISTINCT l_partkey) FILTER (l_discount > 0.05) AS parts, count(DISTINCT (l_returnflag, l_linestatus)) AS kinds,
    max(l_quantity) FILTER (l_tax = 0) AS untaxed, count(DISTINCT l_orderkey) AS orders, avg(l_quantity)::DECIMAL(10, 2) AS avg_qty FROM lineitem GROUP BY l_suppkey HAVING count(*) > 10""")
def filtered_aggregates(t):
    return (
        t("lineitem").groupBy("l_suppkey").agg(
            F.count_if(C("l_returnflag") == "R").alias("returned"), F.count_distinct(F.when(C("l_discount") > 0.05, C("l_partkey"))).alias("parts"), aggs.count_distinct_tuple("l_returnflag", "l_linestatus").alias("kinds"),
            F.max(F.when(C("l_tax") == 0, C("l_quantity"))).alias("untaxed"), F.count_distinct("l_orderkey").alias("orders"), F.avg("l_quantity").cast("decimal(10,2)").alias("avg_qty"), F.count("*").alias("_n"))
        .where("_n > 10").drop("_n")
    )


@query("""WITH s AS (SELECT l_suppkey, list_sort(list(l_extendedprice)) AS l FROM lineitem GROUP BY 1)
    SELECT l_suppkey, l[least(floor(len(l) * 0.5)::INT, len(l) - 1) + 1] AS floor_p50, l[ceil(len(l) * 0.9)::INT] AS rank_p90 FROM s""")
def exact_quantiles(t):
    return t("lineitem").groupBy("l_suppkey").agg(aggs.quantile_floor("l_extendedprice", 0.5).alias("floor_p50"), aggs.quantile_nearest_rank("l_extendedprice", 0.9).alias("rank_p90"))


@query("""WITH p AS (SELECT o_custkey % 20 AS k, o_totalprice AS x FROM orders) SELECT k, quantile_disc(x, 0.5) AS p50, quantile_disc(x, 0.9) AS p90, count(*) AS n FROM p GROUP BY k""")
def pooled_percentiles(t):
    pools = t("orders").groupBy((C("o_custkey") % 20).alias("k"), C("o_custkey").alias("f")).agg(F.collect_list("o_totalprice").alias("pool"))
    return aggs.pooled_quantile(pools, ["k"], "pool", [0.5, 0.9], "f")


@query("""WITH e(bin) AS (VALUES (0), (1000), (5000), (20000), (50000), (900000)), c AS (SELECT (SELECT max(bin) FROM e WHERE bin <= l_extendedprice) AS bin, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT e.bin::INT AS bin, coalesce(n, 0)::BIGINT AS n FROM e LEFT JOIN c ON e.bin = c.bin""")
def fixed_bins(t):
    return aggs.fixed_bins(t("lineitem"), "l_extendedprice", [0, 1000, 5000, 20000, 50000, 900000])


@query("SELECT CASE WHEN l_quantity < 0 THEN 0 WHEN l_quantity >= 60 THEN 41 ELSE floor(l_quantity / 1.5)::BIGINT + 1 END::BIGINT AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def equal_bins(t):
    return aggs.equal_bins(t("lineitem").withColumn("q", C("l_quantity").cast("double")), "q", 0.0, 60.0, 40)


@query("""WITH p AS (SELECT l_orderkey * 10 + l_linenumber AS id, (l_partkey * 7 % 360)::DOUBLE AS brg, l_extendedprice AS d FROM lineitem)
    SELECT (floor(brg / 3) * 3)::INT AS bearing_bin, id, brg, d FROM p QUALIFY row_number() OVER (PARTITION BY floor(brg / 3) ORDER BY d DESC, id DESC) = 1""")
def bearing_envelope(t):
    p = t("lineitem").select((C("l_orderkey") * 10 + C("l_linenumber")).alias("id"), (C("l_partkey") * 7 % 360).cast("double").alias("brg"), C("l_extendedprice").alias("d"))
    return aggs.bearing_envelope(p, "brg", "d")


@query("""SELECT 'type' AS dim, event_type AS val, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'user', user_id::VARCHAR, count(*) FROM events GROUP BY ALL
    UNION ALL SELECT 'hour', hour(ts)::VARCHAR, count(*) FROM events GROUP BY ALL UNION ALL SELECT 'big', 'yes', count(*) FROM events WHERE value > 50 HAVING count(*) > 0""")
def long_counts(t):
    return aggs.long_counts(t("events"), {"type": C("event_type"), "user": C("user_id"), "hour": F.hour("ts"), "big": F.when(C("value") > 50, "yes")})


@query("WITH n AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1) SELECT event_type, n, round(n / sum(n) OVER (), 9) AS share FROM n")
def pie_share(t):
    return aggs.share_of_total(t("events").groupBy("event_type").agg(F.count("*").alias("n")), "n").withColumn("share", F.round("share", 9))


@query("""WITH h AS (SELECT event_type, date_trunc('hour', ts) AS b, user_id, max(value) AS v FROM events GROUP BY ALL)
    SELECT event_type, count(DISTINCT user_id) AS members, round(avg(v), 6) AS avg_value FROM h GROUP BY event_type""")
def hourly_partial_merge(t):
    state = lambda e: aggs.partials(e, ["event_type"], F.date_trunc("hour", C("ts").cast("timestamp")), "user_id", C("value"))
    e = t("events")
    # two overlapping loads: their states merge to the result of one
    both = state(e.where("event_id % 3 < 2")).unionByName(state(e.where("event_id % 3 > 0")))
    return aggs.merge_partials(both, ["event_type"], "user_id").withColumn("avg_value", F.round("avg_value", 6))


@query("""WITH g AS (SELECT user_id, date_diff('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts), ts) AS gap, ts FROM events)
    SELECT user_id, coalesce(max(gap), 0) AS max_gap_s, round(least(1.0, count(*) * 3600.0 / date_diff('second', min(ts), max(ts))), 9) AS observed FROM g GROUP BY user_id""")
def gaps_and_coverage(t):
    seen = t("events").groupBy("user_id").agg(F.round(sequences.observed_fraction(F.count("*"), times.seconds_between(F.min("ts"), F.max("ts")), 3600.0), 9).alias("observed"))
    return sequences.max_gap(t("events"), ["user_id"], "ts").join(seen, "user_id")


ISLANDS = """
    l AS (SELECT l_suppkey AS k, l_orderkey * 10 + l_linenumber AS id, l_shipdate AS s, l_shipdate + to_days(floor(l_quantity / 10)::INT) AS e, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_returnflag END AS tag FROM lineitem),
    r AS (SELECT *, max(e) OVER (PARTITION BY k ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM l),
    i AS (SELECT *, sum(CASE WHEN reach IS NULL OR date_diff('second', reach, s) > 86400 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY s, e, id ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM r)"""


def _spans(t):
    return t("lineitem").select(C("l_suppkey").alias("k"), (C("l_orderkey") * 10 + C("l_linenumber")).alias("id"), C("l_shipdate").alias("s"), (C("l_shipdate") + F.make_dt_interval(F.floor(C("l_quantity") / 10).cast("int"))).alias("e"), F.when(C("l_linenumber") % 3 != 0, C("l_returnflag")).alias("tag"))


@query(f"WITH {ISLANDS} SELECT k, island, count(*) AS n, min(s) AS s, max(e) AS e FROM i GROUP BY ALL")
def islands(t):
    return sequences.islands(_spans(t), "k", "s", "e", "id", 86400).groupBy("k", "island").agg(F.count("*").alias("n"), F.min("s").alias("s"), F.max("e").alias("e"))


@query(f"""WITH {ISLANDS}, c AS (SELECT *, last_value(tag IGNORE NULLS) OVER (PARTITION BY k, island ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known, row_number() OVER (PARTITION BY k, island ORDER BY s, e, id) AS rn FROM i),
    p AS (SELECT *, sum(CASE WHEN rn = 1 OR (tag <> known) IS TRUE THEN 1 ELSE 0 END) OVER (PARTITION BY k, island ORDER BY s, e, id ROWS UNBOUNDED PRECEDING)::BIGINT AS part FROM c)
    SELECT id, k, island, part FROM p""")
def islands_two_stage(t):
    return sequences.islands_two_stage(_spans(t), "k", "s", "e", "tag", "id", 86400).select("id", "k", "island", "part")


@query("""WITH x AS (SELECT event_id, user_id AS k, ts AS s, ts + INTERVAL 10 MINUTE AS e, event_type = 'error' AS g, value FROM events), p AS (SELECT *, lag(e) OVER w AS pe, lag(g) OVER w AS pg, lag(value) OVER w AS pv, row_number() OVER w AS rn FROM x WINDOW w AS (PARTITION BY k ORDER BY s, event_id)),
    f AS (SELECT *, CASE WHEN rn = 1 OR date_diff('second', pe, s) <= 0 OR date_diff('second', pe, s) > 36000 OR pg OR NOT (value + pv BETWEEN 5 AND 80) THEN 1 ELSE 0 END AS flag FROM p)
    SELECT event_id, k, sum(flag) OVER (PARTITION BY k ORDER BY s, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS chain FROM f""")
def chain_breaks(t):
    x = t("events").select("event_id", C("user_id").alias("k"), C("ts").alias("s"), (C("ts") + F.expr("INTERVAL 10 MINUTE")).alias("e"), (C("event_type") == "error").alias("g"), "value")
    return sequences.chain_breaks(x, "k", "s", "e", "event_id", C("value") + C("prev_value"), (5, 80), 36000, "g").select("event_id", "k", "chain")


@query("""WITH e AS (SELECT user_id, event_id, epoch(date_trunc('second', ts))::BIGINT AS t, value, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS tag FROM events),
    c AS (SELECT *, last_value(tag IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM e),
    g AS (SELECT user_id, unnest(range(((min(t) + 21599) // 21600) * 21600, max(t) + 1, 21600)) AS boundary FROM e GROUP BY user_id)
    SELECT g.user_id, g.boundary, c.t AS source_t, c.value, c.carried AS tag FROM g JOIN c ON c.user_id = g.user_id AND c.t <= g.boundary AND g.boundary - c.t <= 7200
    QUALIFY row_number() OVER (PARTITION BY g.user_id, g.boundary ORDER BY c.t DESC, c.event_id DESC) = 1""")
def resample_locf(t):
    e = t("events").withColumn("tag", F.when(C("event_type") != "view", C("event_type")))
    return sequences.resample_locf(e, "user_id", "ts", "event_id", ["value", "tag"], 21600, 7200, carried=["tag"])


@query("""WITH d AS (SELECT DISTINCT ts::DATE AS day FROM events WHERE day(ts) NOT IN (9, 17)), n AS (SELECT day, row_number() OVER (ORDER BY day) AS rn, min(day) OVER () AS d0 FROM d) SELECT day FROM n WHERE date_diff('day', d0, day) = rn - 1""")
def contiguous_run(t):
    return sequences.contiguous_run(t("events").where(~F.dayofmonth("ts").isin(9, 17)).select(F.to_date("ts").alias("day")), "day")


@query("""WITH o AS (SELECT o_custkey AS k, o_orderdate::DATE AS day, o_orderpriority AS v FROM orders), d AS (SELECT DISTINCT k, day FROM o),
    h AS (SELECT d.k, d.day, o.v, count(*) AS n FROM d JOIN o ON o.k = d.k AND o.day < d.day AND o.day >= d.day - 365 GROUP BY ALL), s AS (SELECT *, sum(n) OVER (PARTITION BY k, day)::BIGINT AS total FROM h)
    SELECT k, day, v AS modal, n AS support, total FROM s QUALIFY row_number() OVER (PARTITION BY k, day ORDER BY n DESC, v DESC) = 1 AND n >= 2 AND n >= 0.5 * total""")
def modal_trailing_window(t):
    return sequences.modal_trailing(t("orders").select(C("o_custkey").alias("k"), F.to_date("o_orderdate").alias("day"), C("o_orderpriority").alias("v")), "k", "day", "v", 365, 2, 0.5)


@query("""WITH v AS (SELECT user_id, ts::DATE AS day, event_type AS c, count(DISTINCT hour(ts)) AS votes, min(hour(ts)) AS best_rank, max((value > 40)::INT) AS gate FROM events GROUP BY ALL),
    s AS (SELECT *, sum(votes) OVER p AS total, count(*) OVER p AS k, max(votes) OVER p AS top, count(*) OVER (PARTITION BY user_id, day, votes) AS peers FROM v WINDOW p AS (PARTITION BY user_id, day))
    SELECT user_id, day, c AS winner, votes, total::BIGINT AS total, best_rank::INT AS best_rank, CASE WHEN total = 1 THEN 'single' WHEN k = 1 THEN 'unanimous' WHEN peers > 1 THEN 'tiebreak' ELSE 'majority' END AS agreement
    FROM s QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY votes DESC, gate DESC, best_rank, c) = 1""")
def plurality_vote(t):
    e = t("events").select("user_id", F.to_date("ts").alias("day"), C("event_type").alias("c"), F.hour("ts").alias("voter"), (C("value") > 40).alias("gate"))
    return aggs.plurality(e.withColumn("rank", C("voter")), ["user_id", "day"], "c", "voter", "rank", "gate").drop("vote_map")


@query("SELECT user_id, list_sort(list(event_type || ':' || n)) AS votes FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id")
def vote_maps(t):
    m = aggs.vote_map(t("events"), ["user_id"], "event_type")
    return m.select("user_id", F.array_sort(F.transform(F.map_entries("votes"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))).alias("votes"))


@query("""SELECT user_id, date_trunc('hour', ts) AS h, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END, ts, event_id) = 1""")
def fuse_by_priority(t):
    e = t("events").select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"), "event_type", "value", "ts", "event_id", F.when(C("event_type") == "purchase", 1).when(C("event_type") == "click", 2).otherwise(3).alias("rank"))
    return aggs.fuse_by_priority(e, ["user_id", "h"], "rank", ["ts", "event_id"]).select("user_id", "h", "event_type", "value")


@query("""WITH c AS (SELECT event_type, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS n, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS n_prev FROM events GROUP BY 1)
    SELECT event_type, n, n_prev, round(100.0 * (n - n_prev) / nullif(n_prev, 0), 2)::DOUBLE AS delta_pct, row_number() OVER (ORDER BY n DESC, event_type)::INT AS rank, row_number() OVER (ORDER BY n_prev DESC, event_type)::INT AS rank_prev FROM c""")
def trends_vs_previous(t):
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    return aggs.trend(t("events"), "event_type", C("ts") >= cut, C("ts") < cut).withColumn("delta_pct", C("delta_pct").cast("double"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def top_k(t):
    return dedup.top_k(t("orders").select("o_orderkey", "o_totalprice"), [C("o_totalprice").desc(), C("o_orderkey")], 15)


@query("SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders) WHERE rank <= 3")
def top_k_per_group(t):
    return dedup.top_per_key(t("orders"), ["o_custkey"], [C("o_totalprice").desc(), C("o_orderkey")], 3, "rank").select("o_custkey", "o_orderkey", "rank")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25 OFFSET 50")
def total_page(t):
    return dedup.page(t("orders").select("o_orderkey", "o_orderdate"), [C("o_orderdate"), C("o_orderkey")], 25, 50)


OLD = "a AS (SELECT c_custkey AS k, c_mktsegment AS seg FROM customer WHERE c_custkey % 7 <> 0)"
NEW = "b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN 'MOVED' WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer WHERE c_custkey % 5 <> 0)"


@query(f"""WITH {OLD}, {NEW} SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN a.seg ELSE coalesce(b.seg, a.seg) END AS seg,
    CASE WHEN a.k IS NULL THEN 'open' WHEN b.k IS NULL THEN 'close' ELSE 'reopen' END AS action, DATE '2024-03-01' AS day FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR (b.seg IS NOT NULL AND b.seg IS DISTINCT FROM a.seg)""")
def scd2_diff(t):
    c = t("customer").select(C("c_custkey").alias("k"), C("c_mktsegment").alias("seg"))
    new = c.where("k % 5 <> 0").withColumn("seg", F.when(C("k") % 11 == 0, "MOVED").when(C("k") % 13 != 0, C("seg")))
    return scd.scd2_diff(c.where("k % 7 <> 0"), new, "k", ["seg"], "2024-03-01")


@query("SELECT event_id, CASE WHEN event_type = 'error' AND value > 50 THEN 'severe' WHEN event_type = 'error' THEN 'error' WHEN value > 95 THEN 'spike' END AS anomaly_type FROM events WHERE anomaly_type IS NOT NULL")
def case_classify(t):
    kind = scalars.first_match(((C("event_type") == "error") & (C("value") > 50), "severe"), (C("event_type") == "error", "error"), (C("value") > 95, "spike"))
    return t("events").select("event_id", kind.alias("anomaly_type")).where("anomaly_type is not null")


@query("""SELECT event_id, CASE WHEN s = 'ground' THEN 0.0 ELSE TRY_CAST(s AS DOUBLE) END AS alt, s = 'ground' AS on_ground, (coalesce(f, 0) & 1) <> 0 AS f1, (coalesce(f, 0) & 4) <> 0 AS f4
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'ground' WHEN event_type = 'view' THEN 'n/a' ELSE value::VARCHAR END AS s, CASE WHEN event_type = 'click' THEN NULL ELSE user_id END AS f FROM events)""")
def sentinel_and_flags(t):
    e = t("events").select("event_id", F.when(C("event_type") == "error", "ground").when(C("event_type") == "view", "n/a").otherwise(C("value").cast("string")).alias("s"), F.when(C("event_type") != "click", C("user_id")).alias("f"))
    return e.select("event_id", scalars.sentinel_numeric(C("s")).alias("alt"), (C("s") == "ground").alias("on_ground"), scalars.bit_flag(C("f"), 1).alias("f1"), scalars.bit_flag(C("f"), 4).alias("f4"))


@query("""SELECT c_custkey, regexp_replace('ABC' || substr(c_name, 10), '^([A-Z]{3})0+([0-9])', '\\1\\2') AS callsign, regexp_matches(upper(c_name), '^[A-Z]{3}[0-9]') AS shaped, regexp_extract(c_name, '([0-9]+)', 1) AS digits,
    nullif(trim(CASE WHEN c_custkey % 4 = 0 THEN '  ' ELSE ' ' || c_mktsegment || ' ' END), '') AS seg, contains(lower(c_name), 'mer#') AS has, starts_with(c_name, 'Cust') AS starts, replace(c_name, '#', '-') AS dashed FROM customer""")
def string_functions(t):
    return t("customer").select(
        "c_custkey", scalars.callsign_norm(F.concat(F.lit("ABC"), F.substring("c_name", 10, 99))).alias("callsign"), scalars.airline_shaped(F.upper("c_name")).alias("shaped"), F.regexp_extract("c_name", "([0-9]+)", 1).alias("digits"),
        scalars.blank_null(F.when(C("c_custkey") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), C("c_mktsegment"), F.lit(" ")))).alias("seg"), F.lower("c_name").contains("mer#").alias("has"), C("c_name").startswith("Cust").alias("starts"), F.replace("c_name", F.lit("#"), F.lit("-")).alias("dashed"),
    )


@query("SELECT event_id, (props ->> '$.k')::BIGINT AS k, len(json_keys(props)) AS n_keys FROM events")
def json_extract(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.size(F.json_object_keys("props")).cast("long").alias("n_keys"))


@query("WITH k AS (SELECT unnest(json_keys(CASE WHEN event_id % 50 = 0 THEN '{\"k\": 1, \"zz\": 2}' ELSE props END)) AS key FROM events) SELECT key, count(*) AS n FROM k WHERE key NOT IN ('k') GROUP BY key")
def drift_keys(t):
    keys = F.explode(F.json_object_keys(F.when(C("event_id") % 50 == 0, '{"k": 1, "zz": 2}').otherwise(C("props"))))
    return t("events").select(keys.alias("key")).where(~C("key").isin("k")).groupBy("key").agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS ws FROM part), n AS (SELECT p_partkey, ws, unnest(range(1, len(ws))) AS i FROM w) SELECT p_partkey, i::INT AS i, ws[i] AS a, ws[i + 1] AS b FROM n""")
def explode_adjacent_pairs(t):
    w = t("part").select("p_partkey", F.split("p_name", " ").alias("ws"))
    pairs = F.arrays_zip(F.slice("ws", 1, F.size("ws") - 1).alias("a"), F.slice("ws", 2, F.size("ws") - 1).alias("b"))
    return w.where(F.size("ws") > 1).select("p_partkey", F.posexplode(pairs)).select("p_partkey", (C("pos") + 1).alias("i"), C("col.a").alias("a"), C("col.b").alias("b"))


@query("""SELECT o_orderkey, 'OK' AS status, o_orderpriority AS priority FROM orders""")
def xml_parse(t):
    body = F.concat(F.lit("<m><order key='"), C("o_orderkey"), F.lit("'><status>OK</status><priority>"), C("o_orderpriority"), F.lit("</priority></order></m>"))
    x = t("orders").select(body.alias("x"))
    return x.select(F.xpath_long("x", F.lit("m/order/@key")).alias("o_orderkey"), F.xpath_string("x", F.lit("m/order/status")).alias("status"), F.xpath_string("x", F.lit("m/order/priority")).alias("priority"))


@query("""SELECT o_orderkey, o_orderdate::DATE AS day, date_trunc('month', o_orderdate)::DATE AS month, (o_orderdate + INTERVAL 9 HOUR)::DATE AS jst_day, date_diff('day', DATE '1995-01-01', o_orderdate::DATE)::INT AS d,
    epoch(o_orderdate)::BIGINT AS epoch_s, strftime(o_orderdate, '%Y%m') AS ym FROM orders""")
def time_functions(t):
    return t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.date_trunc("month", "o_orderdate").cast("date").alias("month"), times.zone_day(C("o_orderdate"), "Asia/Tokyo").alias("jst_day"), times.days_between(F.lit("1995-01-01").cast("date"), C("o_orderdate")).alias("d"), F.unix_seconds(C("o_orderdate").cast("timestamp")).alias("epoch_s"), F.date_format("o_orderdate", "yyyyMM").alias("ym"))


@query(f"""WITH {PLACES} SELECT p_id, a_id, round({HAVERSINE.format(a='pt', b='pl')}, 4) AS km,
    round((degrees(atan2(sin(radians(pl.lon - pt.lon)) * cos(radians(pl.lat)), cos(radians(pt.lat)) * sin(radians(pl.lat)) - sin(radians(pt.lat)) * cos(radians(pl.lat)) * cos(radians(pl.lon - pt.lon)))) + 360) % 360, 4) AS brg
    FROM pt JOIN customer ON c_custkey = p_id JOIN supplier ON s_nationkey = c_nationkey JOIN pl ON a_id = s_suppkey AND (pt.lat, pt.lon) <> (pl.lat, pl.lon)""")
def geo_functions(t):
    nations = t("customer").select(C("c_custkey").alias("p_id"), C("c_nationkey").alias("m")), t("supplier").select(C("s_suppkey").alias("a_id"), C("s_nationkey").alias("m"))
    a, b = (x.join(own, i).select(i, C("lat").alias(f"lat{n}"), C("lon").alias(f"lon{n}"), "m") for n, (x, own, i) in enumerate(zip(_places(t), nations, ("p_id", "a_id"), strict=True), 1))
    at = [C("lat1"), C("lon1"), C("lat2"), C("lon2")]
    return joins.dealt_pairs(a, b, "m", ["lat1", "lon1"], ["lat2", "lon2"]).where("lat1 <> lat2 or lon1 <> lon2").select("p_id", "a_id", geo.haversine(*at).alias("km"), geo.bearing(*at).alias("brg")).select("p_id", "a_id", *[scalars.round_places(C(c), 4).alias(c) for c in ("km", "brg")])


@query("""SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS kinds, len(list(o_orderkey)) AS n, list_sort(list_filter(list(o_totalprice), lambda x: x > 200000)) AS big, list_max(list(o_totalprice)) AS most FROM orders GROUP BY o_custkey""")
def array_functions(t):
    return t("orders").groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderpriority")).alias("kinds"), F.size(F.collect_list("o_orderkey")).cast("long").alias("n"), F.array_sort(F.filter(F.collect_list("o_totalprice"), lambda x: x > 200000)).alias("big"), F.array_max(F.collect_list("o_totalprice")).alias("most"))


@query("SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(t):
    return t("customer").select(C("c_nationkey").alias("k")).unionByName(t("supplier").select(C("s_nationkey").alias("k")))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return union_all(t).distinct()


@query("SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 25")
def except_rows(t):
    l = t("lineitem")
    return l.where("l_returnflag = 'R'").select(C("l_partkey").alias("k")).distinct().exceptAll(l.where("l_returnflag = 'A' and l_quantity > 25").select(C("l_partkey").alias("k")).distinct())


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def intersect_rows(t):
    return t("customer").select(C("c_nationkey").alias("k")).intersect(t("supplier").select(C("s_nationkey").alias("k")))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube(t):
    return t("lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup(t):
    return t("lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("""SELECT event_id, rank() OVER w::INT AS r, dense_rank() OVER w::INT AS dr, ntile(4) OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS q, first_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS f,
    lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS m3 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_type)""")
def window_family(t):
    w, o = Window.partitionBy("user_id").orderBy("event_type"), Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t("events").select("event_id", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("dr"), F.ntile(4).over(o).alias("q"), F.first("value").over(o).alias("f"), F.lead("value").over(o).alias("nx"), F.round(F.avg("value").over(o.rowsBetween(-2, 0)), 6).alias("m3"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' ELSE 'other' END AS label, round(o_totalprice * 0.3048, 6) AS m, floor(o_totalprice + 0.5)::BIGINT AS r FROM orders""")
def projections(t):
    return t("orders").select("o_orderkey", scalars.map_label(C("o_orderpriority"), {"1-URGENT": "urgent", "2-HIGH": "high"}, "other").alias("label"), F.round(scalars.feet_to_metres(C("o_totalprice")), 6).alias("m"), scalars.round_half_up(C("o_totalprice")).alias("r"))


@query("""WITH h AS (SELECT o_orderkey, printf('%x', o_orderkey % 16777216) AS hex FROM orders) SELECT o_orderkey, o_orderkey % 16777216 AS address FROM h""")
def hex_numbers(t):
    return t("orders").select("o_orderkey", scalars.hex_to_number(F.lower(F.hex(C("o_orderkey") % 16777216))).alias("address"))


@query("""WITH b AS (SELECT p_id, lat, lon FROM (SELECT c_custkey AS p_id, (c_custkey * 37 % 1700) / 10.0 - 85 AS lat, (c_custkey * 91 % 3600) / 10.0 - 180 AS lon FROM customer)) SELECT p_id, (lat BETWEEN 24 AND 46 AND lon BETWEEN 122 AND 146) AS inside FROM b""")
def box_filter(t):
    p, _ = _places(t)
    return p.select("p_id", scalars.in_box(C("lat"), C("lon"), (24, 122, 46, 146)).alias("inside"))
