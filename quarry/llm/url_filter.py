"""Exact block lists from a cascade of Bloom filters.

Level 1 encodes the listed keys; level 2 the unlisted keys of the universe that level 1 passes by mistake;
level 3 the listed keys that level 2 passes; and so on until a level makes no mistake. Over that universe
membership is then exact: the first level that misses a key tells on which side it is.

The filters are split into segments by key hash. Up to LITERAL_BITS in all they stand in the plan as
literals, and a lookup is a plain expression without a join. Larger lists keep one row of filters per
segment and meet the keys by an equi-join on the segment, so nothing of unbounded size is broadcast.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.storage import removed, saved
from quarry.llm.tables import whole

LITERAL_BITS = 1 << 21
SEGMENT_KEYS = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
LISTED_WORDS = ("spam", "casino", "pills")


def split_url(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without `://`."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    text = whole(url)
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, f"{h}{p}").otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def places(key: Column, level: int, n_bits: int, n_hashes: int) -> list[Column]:
    """Bit positions of a key at a level: two halves of hashes, combined without overflow."""
    low = F.lit((1 << 32) - 1)
    a, b = (F.xxhash64(key, F.lit(level), F.lit(x)).bitwiseAND(low) for x in (1, 2))
    return [(a + b * i) % n_bits for i in range(n_hashes)]


class Cascade:
    """The levels built for one list: sizes, and either literal bits or a table of segments."""

    def __init__(self, shapes: list[tuple[int, int]], segments: int, table: DataFrame | None, literal: list | None):
        self.shapes, self.segments, self.table, self.literal = shapes, segments, table, literal


def segment_of(key: Column, segments: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("segment")), F.lit(segments)).cast("int")


def passes(key: Column, level: int, shape: tuple[int, int], bits: Column) -> Column:
    """True where all bits of the key are set; a segment without that level passes nothing."""
    found = [
        F.getbit(F.get(bits, F.floor(p / 64).cast("int")), (p % 64).cast("int")).eqNullSafe(1)
        for p in places(key, level, *shape)
    ]
    return reduce(lambda a, b: a & b, found)


def filled(keys: DataFrame, level: int, shape: tuple[int, int]) -> DataFrame:
    """One row per segment: the level's bits as an array of 64-bit words."""
    words = (
        keys.select("seg", F.explode(F.array(*places(F.col("key"), level, *shape))).alias("p"))
        .select("seg", F.floor(F.col("p") / 64).cast("int").alias("w"), (F.col("p") % 64).cast("int").alias("i"))
        .groupBy("seg", "w")
        .agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("bits"))
    )
    packed = words.groupBy("seg").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(shape[0] // 64 - 1)), lambda w: F.coalesce(F.col("m")[w], F.lit(0).cast("long")))
    return packed.select("seg", dense.alias(f"level{level}"))


def build(universe: DataFrame, literal_bits: int = LITERAL_BITS) -> Cascade:
    """Cascade over a universe of (key, listed): distinct keys, each marked. An empty list has no level."""
    n_listed, most = universe.agg(F.count_if("listed"), F.count("*")).first()
    segments = max(1, math.ceil(n_listed / SEGMENT_KEYS))
    left = saved(universe.select("key", "listed", segment_of(F.col("key"), segments).alias("seg")), "keys")
    shapes, tables, level, spent = [], [], 1, [left]
    encode = True
    while True:
        own = left.filter(F.col("listed") == encode)
        n = own.groupBy("seg").count().agg(F.max("count")).first()[0] or 0
        if not n:
            break
        per_key, hashes = (10, 5) if level == 1 else (5, 3)
        shape = (64 * max(1, math.ceil(n * per_key / 64)), hashes)
        bits = saved(filled(own, level, shape), "filter")
        shapes.append(shape)
        tables.append(bits)
        other = left.filter(F.col("listed") != encode).join(bits, "seg", "left")
        wrong = other.filter(passes(F.col("key"), level, shape, F.col(f"level{level}"))).select("key", "listed", "seg")
        left = saved(own.unionByName(wrong), "keys")
        spent.append(left)
        if not left.filter(F.col("listed") != encode).limit(1).count():
            break
        encode, level = not encode, level + 1
    for df in spent:
        removed(df)
    if not shapes:
        return Cascade([], 1, None, [])
    table = reduce(lambda a, b: a.join(b, "seg", "full"), tables)
    if segments == 1 and sum(s[0] for s in shapes) <= literal_bits:
        row = table.first()
        return Cascade(shapes, 1, None, [row[f"level{k + 1}"] for k in range(len(shapes))])
    return Cascade(shapes, segments, table, None)


def is_listed(key: Column, cascade: Cascade, bits: list[Column]) -> Column:
    """Walk the levels from the last: a key is listed if it passes a level and is not taken back by the next."""
    result = F.lit(False)
    for level in range(len(cascade.shapes), 0, -1):
        result = passes(key, level, cascade.shapes[level - 1], bits[level - 1]) & ~result
    return result


def lookup(rows: DataFrame, key: str, cascade: Cascade) -> DataFrame:
    """Rows with a column `listed`; exact for every key of the universe."""
    if cascade.literal is not None:
        return rows.withColumn("listed", is_listed(F.col(key), cascade, [F.lit(x) for x in cascade.literal]))
    keyed = rows.withColumn("seg", segment_of(F.col(key), cascade.segments)).join(cascade.table, "seg", "left")
    levels = [f"level{k + 1}" for k in range(len(cascade.shapes))]
    return keyed.withColumn("listed", is_listed(F.col(key), cascade, [F.col(x) for x in levels])).drop("seg", *levels)


def judged(pages: DataFrame, listed_words=LISTED_WORDS, rules=RULES, listed: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    The universe is every host of the table; listed are hosts that hold one of the words, and those of the column `host` of
    `listed`, a table of any size in which nulls and repeats count for nothing and A-Z are as a-z. The list meets the distinct hosts once, when the
    filter is built; pages are judged by its bits. The rule decides where one fits, the cascade elsewhere. A null url, or one without `://`, has empty host and path and is
    judged like any key; repeated rows are judged again; an empty table gives none. Only page_id and url are read.
    """
    host, path = split_url()
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    marked = reduce(lambda a, b: a | b, (F.contains(F.col("key"), F.lit(w)) for w in listed_words))
    hosts = rows.select(F.col("host").alias("key")).distinct()
    if listed is not None:
        named = listed.select(F.translate("host", UPPER, LOWER).alias("key")).filter("key is not null").distinct().withColumn("named", F.lit(True))
        hosts = hosts.join(named, "key", "left")
        marked = marked | F.coalesce("named", F.lit(False))
    cascade = build(hosts.select("key", marked.alias("listed")))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    said = F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow"))
    return lookup(rows, "host", cascade).select("page_id", "host", "path", rule.alias("rule"), said.alias("verdict"))
