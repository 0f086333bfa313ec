"""Aggregates: exact quantiles, histograms, mergeable partials, votes, long counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_distinct_tuple(*columns: str) -> Column:
    """Distinct tuples; one with a null member counts too."""
    return F.count_distinct(F.struct(*columns))


def quantile_floor(column: str, p: float) -> Column:
    """Element floor(p * n), from 0 and clamped, of the sorted values; nulls are left out."""
    # one more than floor(p * n), from 1, is ceil of a little more than p * n; counts of distinct values suffice
    return F.expr(f"percentile_disc({min(1.0, p + 1e-12):.12f}) WITHIN GROUP (ORDER BY `{column}`)")


def quantile_nearest_rank(column: str, p: float) -> Column:
    """Element ceil(p * n), from 1, of the sorted values; null for none."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{column}`)")


def pooled_quantile(df: DataFrame, keys: Sequence[str], pool: str, p: Sequence[float], fingerprint: str | None = None) -> DataFrame:
    """Nearest-rank quantiles over the elements of array columns; rows with a repeated fingerprint count once."""
    rows = df.dropDuplicates([*keys, fingerprint]) if fingerprint else df
    each = rows.select(*keys, F.explode(pool).alias("_x"))
    return each.groupBy(*keys).agg(*[quantile_nearest_rank("_x", q).alias(f"p{round(q * 100)}") for q in p], F.count("_x").alias("n"))


def fixed_bins(df: DataFrame, column: str, edges: Sequence[float], out: str = "bin") -> DataFrame:
    """(bin, n): counts by the last edge at or below a value; every bin is there, values under the first edge are left out."""
    at = F.element_at(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col(column)), -1)
    # filter of no edge gives an empty array, where element_at has nothing to return
    counted = df.where(F.col(column) >= edges[0]).groupBy(at.alias(out)).agg(F.count("*").alias("n"))
    every = df.sparkSession.createDataFrame([(e,) for e in edges], f"{out} {'int' if all(isinstance(e, int) for e in edges) else 'double'}")
    return every.join(counted, out, "left").select(out, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def equal_bins(df: DataFrame, column: str, low: float, high: float, n: int) -> DataFrame:
    """(bin, n): counts in n equal bins from 1; 0 and n + 1 hold what is outside."""
    return df.where(F.col(column).isNotNull()).groupBy(F.width_bucket(column, F.lit(low), F.lit(high), F.lit(n)).alias("bin")).agg(F.count("*").alias("n"))


def bearing_envelope(df: DataFrame, bearing: str, distance: str, width: int = 3) -> DataFrame:
    """The farthest point of each bearing bin."""
    at = (F.floor(F.col(bearing) / width) * width).cast("int")
    rest = [c for c in df.columns]
    return df.where(F.col(bearing).isNotNull() & F.col(distance).isNotNull()).groupBy(at.alias("bearing_bin")).agg(F.max(F.struct(distance, *[c for c in rest if c != distance])).alias("_b")).select("bearing_bin", *[F.col(f"_b.{c}").alias(c) for c in rest])


def long_counts(df: DataFrame, dims: Mapping[str, Column]) -> DataFrame:
    """(dim, val, n) of several groupings of one table, in one pass."""
    items = F.explode(F.array(*[F.struct(F.lit(name).alias("dim"), c.cast("string").alias("val")) for name, c in dims.items()]))
    return df.select(items.alias("_i")).where("_i.val is not null").groupBy("_i.dim", "_i.val").agg(F.count("*").alias("n"))


def share_of_total(df: DataFrame, n: str, by: Sequence[str] = (), out: str = "share") -> DataFrame:
    return df.withColumn(out, F.col(n) / F.sum(n).over(Window.partitionBy(*by)))


def partials(df: DataFrame, keys: Sequence[str], bucket: Column, member: str, value: Column | None = None) -> DataFrame:
    """The mergeable state of an exact distinct count (and of an average that repeats do not change): one row per (keys, bucket, member) with the largest value."""
    return df.where(F.col(member).isNotNull()).groupBy(*keys, bucket.alias("bucket"), member).agg(F.max(value if value is not None else F.lit(None).cast("double")).alias("value"))


def merge_partials(states: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Of states that may overlap: distinct members, and the average of the largest values of each (bucket, member)."""
    one = states.groupBy(*keys, "bucket", member).agg(F.max("value").alias("value"))
    return one.groupBy(*keys).agg(F.count_distinct(member).alias("members"), F.avg("value").alias("avg_value"))


def vote_map(df: DataFrame, keys: Sequence[str], candidate: str) -> DataFrame:
    """keys, votes map<candidate, n>."""
    n = df.where(F.col(candidate).isNotNull()).groupBy(*keys, candidate).agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(candidate, "n")))).alias("votes"))


def plurality(ballots: DataFrame, keys: Sequence[str], candidate: str, voter: str, rank: str, gate: str | None = None) -> DataFrame:
    """The winner of each key: most distinct voters, then gated candidates, then the best (least) rank, then the smaller candidate.

    ``agreement``: single (one vote), unanimous (one candidate), tiebreak (several have the most votes) or majority.
    """
    votes = ballots.where(F.col(candidate).isNotNull()).groupBy(*keys, candidate).agg(F.count_distinct(voter).alias("votes"), F.min(rank).alias("best_rank"), (F.max(F.col(gate).cast("int")) if gate else F.lit(0)).alias("gate"))
    order = F.struct(-F.col("votes"), -F.col("gate"), F.col("best_rank"), F.col(candidate))
    out = votes.groupBy(*keys).agg(
        F.min_by(F.struct(F.col(candidate).alias("c"), "votes", "best_rank"), order).alias("_w"), F.sum("votes").alias("total"), F.count("*").alias("candidates"), F.collect_list("votes").alias("_all"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(candidate, "votes")))).alias("vote_map"),
    )
    top = F.size(F.filter("_all", lambda v: v == F.col("_w.votes")))
    agreement = F.when(F.col("total") == 1, "single").when(F.col("candidates") == 1, "unanimous").when(top > 1, "tiebreak").otherwise("majority")
    return out.select(*keys, F.col("_w.c").alias("winner"), F.col("_w.votes").alias("votes"), "total", F.col("_w.best_rank").alias("best_rank"), agreement.alias("agreement"), "vote_map")


def fuse_by_priority(rows: DataFrame, keys: Sequence[str], rank: str, order: Sequence[str]) -> DataFrame:
    """One row per key from overlapping sources: the least rank, then the content's order."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(rank, *order)).alias("_b")).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def total_rank(df: DataFrame, n: str, key: str, out: str) -> DataFrame:
    """Adds the rank by ``n`` descending, then ``key``, over all rows. Only the distinct counts meet in one task; rows are numbered within their count."""
    sizes = df.groupBy(n).agg(F.count("*").alias("_k"))
    above = F.coalesce(F.sum("_k").over(Window.orderBy(F.col(n).desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = df.join(sizes.select(n, above.alias("_above")), n)
    return ranked.withColumn(out, (F.col("_above") + F.row_number().over(Window.partitionBy(n).orderBy(key))).cast("int")).drop("_above")


def trend(df: DataFrame, key: str, current: Column, previous: Column) -> DataFrame:
    """Counts and ranks of a window against the one before: n, n_prev, delta_pct, rank, rank_prev."""
    c = df.groupBy(key).agg(F.count_if(current).alias("n"), F.count_if(previous).alias("n_prev")).where("n > 0 or n_prev > 0")
    pct = F.round(100.0 * (F.col("n") - F.col("n_prev")) / F.nullif(F.col("n_prev"), F.lit(0)), 2)
    ranked = total_rank(total_rank(c, "n", key, "rank"), "n_prev", key, "rank_prev")
    return ranked.select(key, "n", "n_prev", pct.alias("delta_pct"), "rank", "rank_prev")
