"""Identities: registrations and their addresses, callsigns, names, coordinates in filed routes, kinds of aircraft, zones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The letters of US registrations, and the first address of their block.
LETTERS = "ABCDEFGHJKLMNPQRSTUVWXYZ"
FIRST_ADDRESS = 0xA00001
_PAIRS = 1 + len(LETTERS) * (1 + len(LETTERS))  # nothing, a letter, or two
_SINGLES = 1 + len(LETTERS)
#: Registrations count like pages of a tree: after one to three digits come nothing or up to two letters, after four up to one, after five none; then the ten longer numbers.
_OWN = {1: _PAIRS, 2: _PAIRS, 3: _PAIRS, 4: _SINGLES, 5: 1}
_SIZE = {5: 1}
for _k in (4, 3, 2, 1):
    _SIZE[_k] = _OWN[_k] + 10 * _SIZE[_k + 1]
ADDRESSES = 9 * _SIZE[1]


def _letter(k: Column) -> Column:
    """The letter at a place from 1; nothing at 0."""
    return F.substring(F.lit("-" + LETTERS), (k + 1).cast("int"), F.lit(1))


def registration_of(address: Column) -> Column:
    """The US registration of a hexadecimal address; null outside the block."""
    n = F.conv(address, 16, 10).cast("long") - FIRST_ADDRESS
    whole = lambda a, b: F.floor(a / b).cast("long")

    def suffix(rest: Column, digits: int) -> Column:
        if digits == 4:
            return F.when(rest == 0, "").otherwise(_letter(rest))
        first, second = whole(rest - 1, _SINGLES), (rest - 1) % _SINGLES
        return F.when(rest == 0, "").otherwise(F.concat(_letter(first + 1), F.when(second == 0, "").otherwise(_letter(second))))

    def below(rest: Column, digits: int) -> Column:
        """What follows ``digits`` digits."""
        if digits == 5:
            return F.lit("")
        longer, size = rest - _OWN[digits], _SIZE[digits + 1]
        return F.when(rest < _OWN[digits], suffix(rest, digits)).otherwise(F.concat(whole(longer, size).cast("string"), below(longer % size, digits + 1)))

    text = F.concat(F.lit("N"), (whole(n, _SIZE[1]) + 1).cast("string"), below(n % _SIZE[1], 1))
    return F.when((n >= 0) & (n < ADDRESSES), text)


def address_of(registration: Column) -> Column:
    """The hexadecimal address of a US registration (lower case, six digits); null for what is none."""
    r = F.upper(F.trim(registration))
    digits, tail = F.regexp_extract(r, "^N([0-9]+)", 1), F.regexp_extract(r, "^N[0-9]+([A-Z]*)$", 1)
    place = lambda c: F.instr(F.lit(LETTERS), c).cast("long")  # noqa: E731  from 1
    digit = lambda k: F.substring(digits, k, 1).cast("long")
    n = F.length(digits)
    offset = (digit(1) - 1) * _SIZE[1]
    for k in range(2, 6):
        offset = offset + F.when(n >= k, _OWN[k - 1] + digit(k) * _SIZE[k]).otherwise(0)
    first, second = place(F.substring(tail, 1, 1)), place(F.substring(tail, 2, 1))
    after = F.when(tail == "", F.lit(0)).when(n == 4, first).otherwise(1 + (first - 1) * _SINGLES + F.when(F.length(tail) == 2, second).otherwise(0))
    letters = f"[{LETTERS}]"
    valid = r.rlike(f"^N[1-9]([0-9]{{0,2}}{letters}{{0,2}}|[0-9]{{3}}{letters}?|[0-9]{{4}})$")
    return F.when(valid, F.lower(F.lpad(F.hex(offset + after + FIRST_ADDRESS), 6, "0")))


_QUOTES = r"^['\"]+|['\"]+$"


def _bare(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.upper(F.regexp_replace(F.trim(c), _QUOTES, "")), r"[\s ]+", ""), F.lit(""))


def registration_norm(c: Column) -> Column:
    """Capitals without blanks and quotes; a number alone gets its N."""
    r = _bare(c)
    return F.when(r.rlike("^[0-9]"), F.concat(F.lit("N"), r)).otherwise(r)


def callsign_plain(c: Column) -> Column:
    return F.nullif(F.upper(F.trim(c)), F.lit(""))


def bare_identity(c: Column) -> Column:
    """Capitals and digits alone, as they are; null for anything else."""
    b = _bare(c)
    return F.when(b.rlike("^[A-Z0-9]+$"), b)


def route_points(route: Column) -> Column:
    """array<struct<lat, lon>> of the coordinates in a filed route (DDMM[NS]/DDDMM[EW]); minutes under 60, and no place beyond the poles or the date line."""
    found = F.regexp_extract_all(F.coalesce(route, F.lit("")), F.lit(r"\b(\d{2}[0-5]\d[NS]/\d{3}[0-5]\d[EW])\b"), F.lit(1))

    def point(p: Column) -> Column:
        number = lambda at, size: F.substring(p, at, size).cast("double")
        lat, lon = number(1, 2) + number(3, 2) / 60.0, number(7, 3) + number(10, 2) / 60.0
        return F.struct(F.when(F.substring(p, 5, 1) == "S", 0.0 - lat).otherwise(lat).alias("lat"), F.when(F.substring(p, 12, 1) == "W", 0.0 - lon).otherwise(lon).alias("lon"))

    return F.filter(F.transform(found, point), lambda x: (F.abs(x["lat"]) <= 90.0) & (F.abs(x["lon"]) <= 180.0))


def body_class(typecode: Column, kind: Column, engines: Column, engine_type: Column, rotor_kinds: Sequence[str], wide: Sequence[str]) -> Column:
    """The silhouette of a type: by what it is (rotors), then by its engines, twin jets by a list of wide ones; empty where nothing tells."""
    twin = F.when(F.contains(engine_type, F.lit("Jet")), F.when(typecode.isin(*wide), "widebody").otherwise("narrowbody")).otherwise("regional")
    by_engines = F.when(engines >= 4, "quad").when(engines == 3, "widebody").when(engines == 2, twin).when(engines == 1, "ga").otherwise("")
    return F.when(kind.isin(*rotor_kinds), "heli").otherwise(by_engines)


def zone_of(lat: Column, lon: Column, zones: Mapping[str, tuple[float, float, float, float]]) -> Column:
    """The first zone (south, west, north, east), in their order, that holds a place; null for none."""
    out = None
    for name, (south, west, north, east) in zones.items():
        inside = lat.between(south, north) & lon.between(west, east)
        out = F.when(inside, F.lit(name)) if out is None else out.when(inside, F.lit(name))
    return F.lit(None).cast("string") if out is None else out


def best_airports(airports: DataFrame, runways: DataFrame, ranks: Mapping[str, int]) -> DataFrame:
    """One airport for each ICAO code of four capitals or digits: the kind of least rank, with scheduled service first, then by name; with its longest open runway (0: unknown). Kinds without a rank are left out."""
    length = F.col("length_ft").try_cast("int")
    longest = runways.where((length > 0) & ~F.coalesce(F.lower(F.trim("closed")).isin("1", "true", "yes"), F.lit(False))).groupBy(F.col("airport_ident").alias("ident")).agg(F.max(length).alias("runway_length_ft"))
    code = F.coalesce(F.nullif(F.col("icao_code"), F.lit("")), F.col("ident"))
    rank = F.element_at(F.create_map(*[x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))]), F.col("type"))
    rows = airports.select("*", code.alias("icao"), rank.alias("_rank"), (F.col("scheduled_service") == "yes").alias("_scheduled")).where("_rank is not null").where(F.col("icao").rlike("^[A-Z0-9]{4}$"))
    first = Window.partitionBy("icao").orderBy("_rank", F.col("_scheduled").desc_nulls_last(), "name", "ident")
    one = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").join(longest, "ident", "left")
    return one.select("icao", "iata_code", "name", "municipality", "iso_country", "latitude_deg", "longitude_deg", F.col("type").alias("airport_type"), F.coalesce("_scheduled", F.lit(False)).alias("scheduled_service"), F.coalesce("runway_length_ft", F.lit(0)).alias("runway_length_ft"))


def name_verdict(name: Column, label: Column, noise: Sequence[str], meaning: Sequence[str]) -> Column:
    """How a name relates to a label: casing, suffix (only legal forms more), mashed, ambiguous, or empty for not at all."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    n, l = plain(name), plain(label)
    rest = F.substring(n, F.length(l) + 1, F.length(n))
    empty = F.coalesce((n == "") | (l == ""), F.lit(True))
    only_noise = rest.rlike("^(" + "|".join(noise) + ")+$") if noise else F.lit(False)
    weighty = rest.rlike("|".join(meaning)) if meaning else F.lit(False)
    mashed = ~F.contains(name, F.lit(" ")) & (F.length(l) >= 0.5 * F.length(n))
    related = F.when(only_noise, "suffix").when(weighty, "ambiguous").when(mashed, "mashed").otherwise("ambiguous")
    return F.when(empty, "").when(n == l, F.when(name != label, "casing").otherwise("")).when(~F.startswith(n, l), "").otherwise(related)
