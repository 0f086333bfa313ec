"""Slowly changing dimensions: a list against the open intervals, as opens and closes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MassClose(ValueError):
    """A list would close more of the open intervals than is believable."""


def scd2_diff(current: DataFrame, incoming: DataFrame, key: str, attrs: Sequence[str], day) -> DataFrame:
    """Actions of a list: key, attrs, action (``open``: new key; ``close``: missing key; ``reopen``: changed attrs, which closes the old interval and opens one).

    ``current`` holds open intervals (key, attrs). A null attr of the list does not overwrite a known one.
    """
    a = current.select(key, *[F.col(c).alias(f"_o_{c}") for c in attrs], F.lit(True).alias("_had"))
    b = incoming.select(key, *[F.col(c).alias(f"_n_{c}") for c in attrs], F.lit(True).alias("_has"))
    j = a.join(b, key, "full")
    changed = F.lit(False)
    for c in attrs:
        changed = changed | (F.col(f"_n_{c}").isNotNull() & ~F.col(f"_n_{c}").eqNullSafe(F.col(f"_o_{c}")))
    action = F.when(F.col("_had").isNull(), "open").when(F.col("_has").isNull(), "close").when(changed, "reopen")
    merged = [F.when(F.col("_has").isNull(), F.col(f"_o_{c}")).otherwise(F.coalesce(f"_n_{c}", f"_o_{c}")).alias(c) for c in attrs]
    return j.select(key, *merged, action.alias("action"), F.lit(day).cast("date").alias("day")).where("action is not null")


def apply_scd2(history: DataFrame, actions: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """The history (key, attrs, valid_from, valid_to) after the actions: closes end the day before, opens start on the day."""
    ends = actions.where("action in ('close', 'reopen')").select(key, F.col("day").alias("_day"))
    closed = history.join(ends, key, "left").withColumn("valid_to", F.when(F.col("valid_to").isNull() & F.col("_day").isNotNull(), F.date_sub("_day", 1)).otherwise(F.col("valid_to"))).drop("_day")
    opened = actions.where("action in ('open', 'reopen')").select(key, *attrs, F.col("day").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return closed.select(key, *attrs, "valid_from", "valid_to").unionByName(opened)


def guard_mass_close(actions: DataFrame, open_count: int, most: float = 0.2) -> DataFrame:
    closes = actions.where("action = 'close'").count()
    if open_count and closes > most * open_count:
        raise MassClose(f"{closes} of {open_count} open intervals would close")
    return actions
