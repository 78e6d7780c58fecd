"""Cleaning expressions: every value keeps its row; what cannot be read becomes null and a FALSE flag.

Casts are try_cast, ratios try_divide, so nothing depends on the session's ANSI mode; times stay
TIMESTAMP_NTZ throughout, so nothing depends on its zone either.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "-1"
POINT_SENTINELS = ("-1", "0", "")
ENVELOPE = (0, 700_000, 0, 1_300_000)


@dataclass(frozen=True)
class Field:
    """A column of the manifest: kind is identity, geo, datetime, coded, numeric or text."""

    name: str
    kind: str
    type: str = "string"


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def first_present(df: DataFrame, candidates: Sequence[str]) -> Column:
    """Coalesce of those candidate columns that exist; null if none does."""
    have = {c.lower() for c in df.columns}
    found = [F.col(c) for c in candidates if c.lower() in have]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def coded(c: str | Column, missing: Iterable[str] = ()) -> Column:
    """The integer code; null for -1, a code marked missing, or text that is no integer."""
    c = col(c)
    gone = c.isin(MISSING, *missing)
    return F.when(gone, F.lit(None)).otherwise(c.try_cast("int"))


def numeric(c: str | Column, type_: str = "int") -> Column:
    """The number; null for -1, blank or unreadable text. Integers are read strictly: a fraction is malformed."""
    c = col(c)
    return F.when(c.isin(MISSING, ""), F.lit(None)).otherwise(c.try_cast(type_))


def lenient_int(c: str | Column) -> Column:
    """For columns that hold whole numbers written as decimals."""
    return F.round(col(c).try_cast("double")).try_cast("int")


def placeholder(type_: str) -> Column:
    return F.lit(None).cast(type_)


def broad(df: DataFrame, manifest: Sequence[Field], missing: dict[str, Sequence[str]] | None = None, exclude: Iterable[str] = ()) -> list[Column]:
    """Every manifest column once, in name order, cleaned by kind; a typed null where the source lacks it."""
    have, missing, left_out = {c.lower() for c in df.columns}, missing or {}, set(exclude)
    out = []
    for f in sorted(manifest, key=lambda f: f.name):
        if f.name in left_out:
            continue
        if f.name.lower() not in have:
            c = placeholder("int" if f.kind == "coded" else f.type)
        elif f.kind == "coded":
            c = coded(f.name, missing.get(f.name, ()))
        elif f.kind == "numeric":
            c = numeric(f.name, f.type)
        else:
            c = F.col(f.name)
        out.append(c.alias(f.name))
    return out


def audited(df: DataFrame, name: str, aliases: Sequence[str] = (), missing: Iterable[str] = ()) -> list[Column]:
    """<name>_raw, <name> and <name>_valid; null, null, TRUE if the source has no such column."""
    have = {c.lower() for c in df.columns}
    if not any(c.lower() in have for c in (name, *aliases)):
        return [placeholder("string").alias(f"{name}_raw"), placeholder("int").alias(name), F.lit(True).alias(f"{name}_valid")]
    raw = first_present(df, [name, *aliases])
    value = coded(raw, missing)
    return [raw.alias(f"{name}_raw"), value.alias(name), value.isNotNull().alias(f"{name}_valid")]


def coordinate(c: str | Column) -> Column:
    """A coordinate; the texts -1, 0 and blank, NaN and anything unreadable are null."""
    c = col(c)
    value = c.try_cast("double")
    return F.when(c.isin(*POINT_SENTINELS) | F.isnan(value), F.lit(None)).otherwise(value)


def sentinel_point(easting: str | Column, northing: str | Column) -> list[Column]:
    e, n = coordinate(easting), coordinate(northing)
    return [e.alias("easting"), n.alias("northing"), (e.isNotNull() & n.isNotNull()).alias("geom_valid")]


def envelope_point(easting: str | Column, northing: str | Column, envelope=ENVELOPE) -> list[Column]:
    """Integers are kept as read; the flag is TRUE within the envelope, bounds included."""
    e, n = col(easting).try_cast("int"), col(northing).try_cast("int")
    inside = e.between(*envelope[:2]) & n.between(*envelope[2:])
    return [e.alias("easting"), n.alias("northing"), F.coalesce(inside, F.lit(False)).alias("geom_valid")]


def event_time(date: str | Column, time: str | Column) -> list[Column]:
    """datetime_local, datetime_valid, time_imputed: a day without a readable time counts as midnight."""
    d = F.try_to_date(F.trim(col(date)), "d/M/yyyy")
    hour = F.regexp_extract(F.trim(col(time)), r"^(\d{1,2}):(\d{1,2})$", 1).try_cast("int")
    minute = F.regexp_extract(F.trim(col(time)), r"^(\d{1,2}):(\d{1,2})$", 2).try_cast("int")
    exact = F.try_make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), hour, minute, F.lit(0))
    return [
        F.coalesce(exact, d.cast("timestamp_ntz")).alias("datetime_local"),
        d.isNotNull().alias("datetime_valid"),
        (d.isNotNull() & exact.isNull()).alias("time_imputed"),
    ]


def row_key(*parts: str | Column) -> Column:
    """Parts joined by |; null if any part is."""
    out = []
    for p in parts:
        out += [F.lit("|"), col(p).cast("string")]
    return F.concat(*out[1:])


def count_field(c: str | Column, name: str) -> list[Column]:
    """<name>_raw, the count as read, and <name>_valid: present and not negative."""
    value = col(c).try_cast("bigint")
    return [col(c).alias(f"{name}_raw"), value.alias(name), F.coalesce(value >= 0, F.lit(False)).alias(f"{name}_valid")]


def settled(df: DataFrame) -> DataFrame:
    """The same rows, with every column made once: a filter on a derived flag looks at the flag and does not repeat what made it.

    For derived columns that are filtered before they are written. Repeated expressions grow methods beyond what the JVM compiles.
    Not for tables that are read, whose filters should reach the scan.
    """
    return df.select(F.inline(F.array(F.struct(*(F.col(f"`{c}`") for c in df.columns)))))


def gold(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows of which all flags are TRUE; a null flag leaves the row out, no flags keep all."""
    return df.filter(reduce(lambda a, b: a & b, (F.col(f) for f in flags), F.lit(True)))


def measured(c: str | Column, scale: float = 1.0, offset: float = 0.0) -> Column:
    """A grid metric in other units; NaN and null stand for cells outside the domain."""
    c = col(c)
    return F.when(c.isNull() | F.isnan(c), F.lit(None)).otherwise(c * scale + offset)


def grid_index(c: str | Column, per_degree: int = 10) -> Column:
    return F.round(col(c) * per_degree).cast("int")


def division(area_code: str | Column) -> Column:
    """Bank holiday division by the nation that begins an area code."""
    first = F.substring(col(area_code), 1, 1)
    return F.when(first.isin("E", "W"), "england-and-wales").when(first == "S", "scotland").when(first == "N", "northern-ireland")


def bearing(code: str | Column) -> Column:
    """Degrees of a compass code 1 (north-east) to 8 (north); null for others."""
    c = col(code)
    return F.when(c.between(1, 8), (c * 45) % 360)


def angle_between(a: Column, b: Column) -> Column:
    """Circular difference, 0 to 180 degrees."""
    return 180 - F.abs(F.abs(a - b) - 180)


MOST_VARIABLES = 10_000


def missing_codes(codebook: DataFrame) -> dict[str, list[str]]:
    """Codes marked missing, per variable. A codebook is a lookup of about a thousand rows; a much larger one is refused."""
    rows = codebook.filter("is_missing").groupBy("variable").agg(F.sort_array(F.collect_set("code")).alias("codes"))
    found = rows.limit(MOST_VARIABLES + 1).collect()
    if len(found) > MOST_VARIABLES:
        raise ValueError(f"codebook of more than {MOST_VARIABLES} variables")
    return {r.variable: list(r.codes) for r in found}
