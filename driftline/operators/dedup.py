"""Latest rows, argmax families, deduplication by total orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Order, k: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each key in an order, which should be total. The rank is limited within tasks before the shuffle."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the largest version of each key, as an aggregate: no key's rows meet in a sort. Ties go to the largest other columns, nulls last."""
    rest = [c for c in df.columns if c not in {*keys, version, *ties}]
    order = [version, *ties, *rest]
    present = [F.struct(F.col(c).isNotNull().alias("set"), F.col(c).alias("value")).alias(f"o{i}") for i, c in enumerate(order)]
    best = df.groupBy(*keys).agg(F.max(F.struct(*present)).alias("_best"))
    picked = [F.col(f"_best.o{i}.value").alias(c) for i, c in enumerate(order)]
    return best.select(*keys, *picked).select(*df.columns)


def argmax(value: Column, key: Column, skip_null: bool = True) -> Column:
    """The value at the largest key; null values are passed over unless they should be kept."""
    return F.max_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), key)) if skip_null else F.max_by(value, key)


def argmin(value: Column, key: Column, skip_null: bool = True) -> Column:
    return F.min_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), key)) if skip_null else F.min_by(value, key)


def limit_by(df: DataFrame, keys: Sequence[str], order: Order, n: int = 1) -> DataFrame:
    """LIMIT n BY: the first rows of each key."""
    return top_per_key(df, keys, order, n)


def page(df: DataFrame, order: Order, limit: int, offset: int = 0, cap: int = 1000) -> DataFrame:
    """A page in a total order; the limit is clamped to [0, cap], the offset to 0 and more."""
    return df.orderBy(*order).offset(max(0, offset)).limit(max(0, min(limit, cap)))


def top_k(df: DataFrame, order: Order, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
