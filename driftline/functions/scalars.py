"""Column expressions of the domain: cleaning, predicates, units, labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_null(c: Column) -> Column:
    """An empty or blank string is no value."""
    return F.nullif(F.trim(c), F.lit(""))


def airline_shaped(c: Column) -> Column:
    """Three capital letters and a digit first: an airline's callsign. False for null."""
    return F.coalesce(F.trim(c).rlike("^[A-Z]{3}[0-9]"), F.lit(False))


def callsign_norm(c: Column) -> Column:
    """Trimmed capitals without leading zeros of the flight number: " abc012" is ABC12."""
    return F.regexp_replace(F.upper(F.trim(c)), "^([A-Z]{3})0+([0-9])", "$1$2")


def sentinel_numeric(c: Column, word: str = "ground", value: float = 0.0) -> Column:
    """A number in text; ``word`` stands for ``value``, anything else that is no number for null."""
    return F.when(c == word, F.lit(value)).otherwise(c.try_cast("double"))


def bit_flag(c: Column, bit: int) -> Column:
    return F.coalesce(c, F.lit(0)).bitwiseAND(F.lit(bit)) != 0


# Factors between units.
FEET_TO_M, KNOTS_TO_MS, FPM_TO_MS = 0.3048, 0.514444, 0.00508


def feet_to_metres(c: Column) -> Column:
    return c * FEET_TO_M


def metres_to_feet(c: Column) -> Column:
    return c / FEET_TO_M


def knots_to_ms(c: Column) -> Column:
    return c * KNOTS_TO_MS


def fpm_to_ms(c: Column) -> Column:
    return c * FPM_TO_MS


def map_label(c: Column, labels: Mapping, default: str | None = None) -> Column:
    """A label for each value, ``default`` for the others."""
    out = None
    for value, label in labels.items():
        out = (F.when(c == value, F.lit(label)) if out is None else out.when(c == value, F.lit(label)))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def first_match(*arms: tuple[Column, str], default: str | None = None) -> Column:
    """The label of the first arm that holds; a null condition does not hold."""
    out = None
    for condition, label in arms:
        out = F.when(condition, F.lit(label)) if out is None else out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """South, west, north, east; null where a coordinate is null."""
    s, w, n, e = box
    return lat.between(s, n) & lon.between(w, e)


def hex_to_number(c: Column, digits: tuple[int, int] = (1, 6)) -> Column:
    """The number of a hexadecimal address; null unless it has as many digits as ``digits`` allows."""
    return F.when(c.rlike(f"^[0-9A-Fa-f]{{{digits[0]},{digits[1]}}}$"), F.conv(c, 16, 10).cast("long"))


def jet_infeasible(shaped: Column, jet: Column, runway_ft: Column, kind: Column, least_ft: int) -> Column:
    """An airline jet at a field it cannot use: a runway known to be too short, or a small airport whose runway is unknown (0). An unknown airport is feasible."""
    length = F.coalesce(runway_ft, F.lit(0))
    unfit = ((length > 0) & (length < least_ft)) | ((length == 0) & (F.coalesce(kind, F.lit("")) == "small_airport"))
    return F.coalesce(shaped, F.lit(False)) & F.coalesce(jet, F.lit(False)) & unfit


def round_half_up(c: Column) -> Column:
    return F.floor(c + 0.5)


def round_places(x: Column, places: int) -> Column:
    """``F.round`` for numbers without end: the same value, but decimal arithmetic only for those near a tie or large. ``x`` is to be a column, not an expression, since it is named several times."""
    ten = 10.0**places
    up = x * ten
    plain = (F.abs(up) < 1e9) & (F.abs(up - F.floor(up) - 0.5) > 1e-5)
    return F.when(plain, F.floor(up + 0.5) / ten).otherwise(F.round(x, places))
