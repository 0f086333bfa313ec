"""Each query over the small tables equals its SQL; run at the smallest scale."""

import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.plans import bindings, model_queries, streams

QUERIES, SQL = bindings.QUERIES | model_queries.QUERIES | streams.QUERIES, bindings.ORACLE_SQL | model_queries.ORACLE_SQL | streams.ORACLE_SQL

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        at = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{at}{'/*.parquet' if os.path.isdir(at) else ''}')")
    return con


def shown(x):
    if isinstance(x, (list, tuple)) or type(x).__name__ == "ndarray":
        return str([shown(y) for y in x])
    if x is None or x is pd.NaT or x is pd.NA or x != x:
        return "-"
    if type(x).__name__ in ("date", "datetime", "Timestamp"):
        return str(pd.Timestamp(x))
    if isinstance(x, bool) or type(x).__name__ in ("bool_", "bool"):
        return str(bool(x))
    try:
        return x if isinstance(x, str) else f"{float(x):.7g}"
    except (TypeError, ValueError):
        return str(x)


def rows(df):
    return sorted(tuple(map(shown, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: One row on one side: a scalar, or the newest time of the data.
ONE_ROW = {"scalar_subquery_filter", "model_agg_country_traffic"}


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_no_nested_loops(spark, sf, name):
    text = plan(bindings.QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and (name in ONE_ROW or "NestedLoop" not in text)


def test_scans_read_what_they_use(spark, sf):
    text = plan(bindings.QUERIES["semi_join"](spark, sf))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,300000.0)" in text and "o_orderdate" not in text


def test_repeated_rows_stay_rows(spark):
    import datetime as dt

    from driftline.operators import aggs, joins

    day = dt.date(2024, 1, 5)
    df = spark.createDataFrame([(1, "k", day), (1, "k", day), (2, None, day)], "id int, k string, day date")
    dim = spark.createDataFrame([("k", dt.date(2024, 1, 1), None, "a"), ("k", dt.date(2024, 1, 4), dt.date(2024, 1, 5), "b"), ("k", dt.date(2024, 1, 6), None, "c")], "k string, valid_from date, valid_to date, rate string")
    assert sorted((r.id, r.rate) for r in joins.validity(df, dim, "k", "day", ["rate"]).collect()) == [(1, "b"), (1, "b"), (2, None)]
    ranges = spark.createDataFrame([(0, 9, "a", 1), (0, 9, "a", 1), (5, 20, "b", 2), (-7, -7, "c", 1)], "lo long, hi long, label string, p int")
    assert sorted(tuple(r) for r in joins.flatten_ranges(ranges, "lo", "hi", "label", "p").collect()) == [(-7, -7, "c"), (0, 9, "a"), (10, 20, "b")]
    places = spark.createDataFrame([(1, 89.9, 0.0), (1, 89.9, 0.0), (2, 0.0, 179.9), (3, 0.0, 0.0)], "a_id int, lat double, lon double")
    points = spark.createDataFrame([(1, 89.9, 180.0), (2, 0.0, -179.9), (2, 0.0, -179.9), (4, None, 1.0)], "p_id int, lat double, lon double")
    assert {(r.p_id, r.a_id) for r in joins.nearest_place(points, places, "p_id", "a_id", 50.0).collect()} == {(1, 1), (2, 2)}
    ts = dt.datetime(2024, 1, 1)
    near = joins.near_in_time_and_space(points.withColumn("ts", F.lit(ts)), places.withColumn("ts", F.lit(ts)), "p_id", "a_id", within_km=50.0)
    assert sorted((r.p_id, r.a_id) for r in near.collect()) == [(1, 1), (1, 1), (2, 2), (2, 2)]
    values = spark.createDataFrame([(k, float(v)) for k, n in ((1, 1), (2, 2), (3, 10), (4, 11)) for v in range(n)] + [(5, None)], "k int, v double")
    for p in (0.0, 0.5, 0.9, 1.0):
        got = {r.k: r.q for r in values.groupBy("k").agg(aggs.quantile_floor("v", p).alias("q")).collect()}
        assert got == {k: float(min(int(p * n), n - 1)) for k, n in ((1, 1), (2, 2), (3, 10), (4, 11))} | {5: None}


def test_pairs_of_one_key_are_dealt_to_tasks(spark, sf, tmp_path, monkeypatch):
    from driftline.operators import joins

    monkeypatch.setattr(joins, "PAIRS", 50, raising=False)
    con = duckdb.connect()
    for table, nation in (("customer", "c_nationkey"), ("supplier", "s_nationkey")):  # one nation, and rows of none
        spark.read.parquet(f"{sf}/{table}.parquet").withColumn(nation, F.when(F.col(nation) % 5 > 0, 3).cast("int")).unionByName(spark.read.parquet(f"{sf}/{table}.parquet").limit(2)).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    got, want = QUERIES["geo_functions"](spark, str(tmp_path)), con.execute(SQL["geo_functions"]).df()
    assert len(want) > 1000 and rows(got.toPandas()) == rows(want)
    each = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(each) > 1 and max(each) < 0.6 * sum(each)


def test_pairs_of_like_places_share_a_task(spark, tmp_path, monkeypatch):
    from driftline.operators import joins

    monkeypatch.setattr(joins, "PAIRS", 4000)
    con = duckdb.connect()
    for table, key, nation, latitudes, each in (("customer", "c_custkey", "c_nationkey", 20, 60), ("supplier", "s_suppkey", "s_nationkey", 10, 20)):  # 18 longitudes at most for a latitude
        row = spark.range(latitudes * each).select((F.col("id") % latitudes + F.floor(F.col("id") / latitudes) * 1700).alias(key), F.pmod(F.xxhash64("id"), F.lit(5)).cast("int").alias(nation))
        row.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    got, want = QUERIES["geo_functions"](spark, str(tmp_path)), con.execute(SQL["geo_functions"]).df()
    assert len(want) > 40_000 and rows(got.toPandas()) == rows(want)
    each = got.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.countDistinct("km", "brg").alias("values")).collect()
    assert len(each) > 8 and max(r["n"] for r in each) < 8000
    assert sum(r["values"] for r in each) < 2 * got.select("km", "brg").distinct().count()


def test_round_places_is_round(spark):
    from driftline.functions import scalars

    x = spark.range(20_000).select((F.col("id") / 20_000 - 0.3).alias("x")).union(spark.createDataFrame([(v,) for v in (None, float("nan"), float("inf"), -0.0, 1e300, -123456.78905, 2.00005, 99999.99995)], "x double"))
    assert x.where(~F.round("x", 4).eqNullSafe(scalars.round_places(F.col("x"), 4))).count() == 0


def test_entry_imports_and_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())


def test_estimator_runs(spark, sf):
    got = streams.estimator(spark, sf)
    assert got.where("kind = 'head'").count() == got.select("flight_id").distinct().count() > 0 and got.where("kind = 'gap'").count() > 0


def test_nearest_by_whole_seconds(spark):
    import datetime as dt

    from driftline.operators import joins

    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    left = spark.createDataFrame([(1, 1, at(10.5)), (2, 1, at(20.5)), (3, 2, at(10.5)), (4, 1, None), (5, None, at(10.5)), (6, 3, at(10.5))], "id int, k int, ts timestamp_ntz")
    # of one second the latest row counts, on either side; as near on both sides, the later one
    rows = [(1, 11.2, 1.0), (1, 11.4, 2.0), (1, 9.9, 3.0), (1, 20.1, 4.0), (1, 20.9, 5.0), (1, 20.9, 6.0), (2, 8.5, 7.0), (2, 8.7, 8.0), (3, 13.5, 9.0)]
    right = spark.createDataFrame([(n, k, at(s), v) for n, (k, s, v) in enumerate(rows)], "id int, k int, ts timestamp_ntz, value double")
    got = {r.id: (r.near_ts, r.near_value) for r in joins.asof_nearest(left, right, "k", "ts", "value", "id", "id", 2).collect()}
    assert got == {1: (at(11.4), 2.0), 2: (at(20.9), 6.0), 3: (at(8.7), 8.0), 4: (None, None), 5: (None, None), 6: (None, None)}
