"""Whether polygons are valid, by joins of their segments: no shape is searched all against all.

A shape is an array of polygons, each an array of rings of (x, y): a shell, then holes. Every segment becomes a row. Segments
of one shape that may meet are found on nested grids: a segment lies on the grid whose tiles are about as large as itself, and
looks for others there and on all coarser grids in use, so that a pair meets on the grid of the longer one. A segment
covers at most four tiles of a grid, whatever its length, so rows grow with the number of vertices. Shapes of few sides stay in
their row: all of it is judged there, and nothing of them is dealt out.

Rings that neither cross nor overlap lie apart or one within the other. That is told by one point of each ring and the
segments of the others in the same horizontal strip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Faults, by name.
EMPTY, RING, CROSSING, OVERLAP, SELF_TOUCH = "empty", "ring", "crossing", "overlap", "self-touch"
HOLE_OUTSIDE, NESTED_HOLES, NESTED_SHELLS = "hole outside", "nested holes", "nested shells"
#: Where on a ring's longest side its point is taken: no simple fraction, so that no vertex is likely to be there.
PART = 0.381966
#: Sides up to which a shape is judged within its row; the pairs looked at there grow with the square.
FEW = 128


def corners(ring: Column) -> Column:
    """The ring without vertices that repeat the one before."""
    return F.filter(ring, lambda p, i: (i == 0) | (p["x"] != F.get(ring, i - 1)["x"]) | (p["y"] != F.get(ring, i - 1)["y"]))


def sound(ring: Column) -> Column:
    """Four vertices or more, the last equal to the first, all numbers finite."""
    finite = F.forall(ring, lambda p: p["x"].isNotNull() & p["y"].isNotNull() & (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")))
    first, last = F.try_element_at(ring, F.lit(1)), F.try_element_at(ring, F.lit(-1))
    return F.coalesce(finite & (F.size(corners(ring)) >= 4) & (first["x"] == last["x"]) & (first["y"] == last["y"]), F.lit(False))


SIDE = ("i", "m", "x0", "y0", "x1", "y1", "x2", "y2")


def rings_of(shapes: DataFrame) -> DataFrame:
    """(_id, p, r, c): ring r of polygon p as the array of its corners, where it is sound. shapes: _id, polygons."""
    rows = shapes.select("_id", F.posexplode("polygons").alias("p", "rings")).select("_id", "p", F.posexplode("rings").alias("r", "ring"))
    return rows.filter(sound(F.col("ring"))).select("_id", "p", "r", F.inline(F.array(F.struct(corners(F.col("ring")).alias("c")))))


def sides_of(rings: DataFrame) -> DataFrame:
    """(_id, p, r, i, m, x0, y0, x1, y1, x2, y2): side i of m of a ring, with the corner before it. No row carries the ring."""
    m = F.size("c") - 1
    at = lambda j, n: [F.get("c", j)[k].alias(f"{k}{n}") for k in ("x", "y")]
    side = lambda i: F.struct(i.alias("i"), m.alias("m"), *at(F.when(i == 0, m - 1).otherwise(i - 1), 0), *at(i, 1), *at(i + 1, 2))
    return rings.select("_id", "p", "r", F.inline(F.transform(F.sequence(F.lit(0), m - 1), side)))


def level(p: Column, q: Column) -> Column:
    """Power of two above the longer extent of the side from p to q."""
    return F.ceil(F.log2(F.greatest(F.abs(q["x"] - p["x"]), F.abs(q["y"] - p["y"])))).cast("int")


def tiles(df: DataFrame) -> DataFrame:
    """A row per tile of grid `lvl` that the box of the side touches."""
    width = F.pow(F.lit(2.0), F.col("lvl"))
    span = lambda k: F.explode(F.sequence(F.floor(F.least(f"{k}1", f"{k}2") / width), F.floor(F.greatest(f"{k}1", f"{k}2") / width)))
    return df.withColumn("tx", span("x")).withColumn("ty", span("y"))


def turn(ax, ay, bx, by, cx, cy) -> Column:
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def pairs_on_grids(rows: DataFrame) -> DataFrame:
    """(_id, s, t): pairs of sides whose boxes meet. rows: _id, grids, and the columns of sides."""
    end = lambda n: {k: F.col(f"{k}{n}") for k in ("x", "y")}
    numbered = rows.withColumn("lvl", level(end(1), end(2)))
    names = ["p", "r", *SIDE]
    held = tiles(numbered).select("_id", "lvl", "tx", "ty", F.struct(*names).alias("t"))
    seeking = numbered.withColumn("own", F.col("lvl")).withColumn("lvl", F.explode(F.filter("grids", lambda g: g >= F.col("own"))))
    seeking = tiles(seeking).select("_id", "lvl", "tx", "ty", "own", F.struct(*names).alias("s"))
    s, t = (lambda k: F.col(f"s.{k}")), (lambda k: F.col(f"t.{k}"))
    later = (F.col("own") < F.col("lvl")) | (F.struct(s("p"), s("r"), s("i")) < F.struct(t("p"), t("r"), t("i")))
    return seeking.join(held, ["_id", "lvl", "tx", "ty"]).filter(later & near(s, t)).select("_id", "s", "t")


def near(s, t) -> Column:
    """Whether the boxes of two sides meet."""
    low, high = (lambda a, k: F.least(a(f"{k}1"), a(f"{k}2"))), (lambda a, k: F.greatest(a(f"{k}1"), a(f"{k}2")))
    return (high(s, "x") >= low(t, "x")) & (high(s, "y") >= low(t, "y")) & (high(t, "x") >= low(s, "x")) & (high(t, "y") >= low(s, "y"))


def pairs_within(sides: Column) -> Column:
    """The same of the sides of one shape, as an array of (s, t)."""
    of = lambda v: lambda k: v[k]
    met = lambda s, k: F.transform(F.filter(F.slice(sides, k + 2, F.size(sides)), lambda t: near(of(s), of(t))), lambda t: F.struct(s.alias("s"), t.alias("t")))
    return F.flatten(F.transform(sides, met))


def pair_faults(pairs: Column) -> Column:
    """Faults of the pairs of sides (s, t) that meet where they must not, each once. pairs: an array, each pair of sides once."""
    sides = lambda x: ((lambda k: x["s"][k]), (lambda k: x["t"][k]))

    def turned(x: Column) -> Column:
        s, t = sides(x)
        turns = [turn(s("x1"), s("y1"), s("x2"), s("y2"), t(f"x{k}"), t(f"y{k}")).alias(f"t{k}") for k in (1, 2)]
        turns += [turn(t("x1"), t("y1"), t("x2"), t("y2"), s(f"x{k}"), s(f"y{k}")).alias(f"s{k}") for k in (1, 2)]
        return F.struct(x["s"].alias("s"), x["t"].alias("t"), *turns)

    def flagged(x: Column) -> Column:
        s, t = sides(x)
        proper = (x["s1"] * x["s2"] < 0) & (x["t1"] * x["t2"] < 0)
        longer = lambda k: F.least(F.greatest(s(f"{k}1"), s(f"{k}2")), F.greatest(t(f"{k}1"), t(f"{k}2"))) > F.greatest(F.least(s(f"{k}1"), s(f"{k}2")), F.least(t(f"{k}1"), t(f"{k}2")))
        overlap = (x["t1"] == 0) & (x["t2"] == 0) & (longer("x") | longer("y"))
        on = lambda a, n, b, k: (x[f"{n}{k}"] == 0) & a(f"x{k}").between(F.least(b("x1"), b("x2")), F.greatest(b("x1"), b("x2"))) & a(f"y{k}").between(F.least(b("y1"), b("y2")), F.greatest(b("y1"), b("y2")))
        flags = [on(a, n, b, k).alias(f"{n}{k}_on") for a, n, b in ((s, "s", t), (t, "t", s)) for k in (1, 2)]
        return F.struct(x["s"].alias("s"), x["t"].alias("t"), proper.alias("proper"), overlap.alias("overlap"), *flags)

    def named(x: Column) -> Column:
        s, t = sides(x)
        same = (s("p") == t("p")) & (s("r") == t("r"))
        gap = F.abs(s("i") - t("i"))
        neighbours = (gap == 1) | (gap == s("m") - 1)
        touch = x["s1_on"] | x["s2_on"] | x["t1_on"] | x["t2_on"]
        crosses = F.when(~same & touch, F.exists(meetings(s, t, x), passes_through))
        return F.when(x["proper"], CROSSING).when(x["overlap"], OVERLAP).when(same & ~neighbours & touch, SELF_TOUCH).when(crosses, CROSSING)

    met = F.filter(F.transform(pairs, turned), lambda x: (x["s1"] * x["s2"] <= 0) & (x["t1"] * x["t2"] <= 0))
    return F.array_distinct(F.array_compact(F.transform(F.transform(met, flagged), named)))


def meetings(s, t, flags: Column) -> Column:
    """array<struct<ax, ay, bx, by, cx, cy, dx, dy>>: directions in which two rings leave a point that they share and at which one begins a side."""
    equal = lambda a, i, b, j: (a(f"x{i}") == b(f"x{j}")) & (a(f"y{i}") == b(f"y{j}"))

    def leave(at, first, second) -> Column:
        return F.struct(*((w(f"{k}{n}") - at(f"{k}1")).alias(f"{v}{k}") for (w, n), v in zip([*first, *second], "abcd") for k in "xy"))

    corner, whole = (lambda a: [(a, 0), (a, 2)]), (lambda a: [(a, 1), (a, 2)])
    inner = lambda flag, a, b: flags[flag] & ~equal(a, 1, b, 1) & ~equal(a, 1, b, 2)
    return F.array_compact(
        F.array(
            F.when(equal(s, 1, t, 1), leave(s, corner(s), corner(t))),
            F.when(inner("s1_on", s, t), leave(s, corner(s), whole(t))),
            F.when(inner("t1_on", t, s), leave(t, corner(t), whole(s))),
        )
    )


def passes_through(x: Column) -> Column:
    """Of the directions c and d exactly one lies between a and b."""
    cross = lambda u, v: x[f"{u}x"] * x[f"{v}y"] - x[f"{u}y"] * x[f"{v}x"]

    def between(v: str) -> Column:
        narrow = (cross("a", v) > 0) & (cross(v, "b") > 0)
        wide = ~((cross("b", v) >= 0) & (cross(v, "a") >= 0))
        return F.when(cross("a", "b") > 0, narrow).when(cross("a", "b") < 0, wide).otherwise(cross("a", v) > 0)

    return between("c") != between("d")


def nesting_faults(rows: DataFrame) -> DataFrame:
    """(_id, fault) of rings on the wrong side of others. rows: _id, strip, and the columns of sides; of no meaning where rings cross."""
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    longest = rows.groupBy("_id", "strip", "p", "r").agg(F.max(F.struct(length.alias("length"), "x1", "y1", "x2", "y2")).alias("e"))
    along = lambda k: F.col(f"e.{k}1") + PART * (F.col(f"e.{k}2") - F.col(f"e.{k}1"))
    points = longest.select("_id", "p", "r", along("x").alias("px"), along("y").alias("py"), F.floor(along("y") / F.col("strip")).alias("ty"))
    reach = F.sequence(F.floor(F.least("y1", "y2") / F.col("strip")), F.floor(F.greatest("y1", "y2") / F.col("strip")))
    others = rows.select("_id", F.col("p").alias("q"), F.col("r").alias("o"), "x1", "y1", "x2", "y2", F.explode(reach).alias("ty"))
    met = points.join(others, ["_id", "ty"]).filter("(p <> q or r <> o) and (y1 > py) <> (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1")
    within = met.groupBy("_id", "p", "r", "q", "o").count().filter("count % 2 = 1").drop("count")
    own = points.select("_id", "p", "r", F.col("p").alias("q"), F.lit(-1).alias("o"))
    judged = within.unionByName(own).groupBy("_id", "p", "r", "q").agg(F.max(F.col("o") == 0).alias("shell"), F.max(F.col("o") > 0).alias("hole"))
    fault = (
        F.when(F.expr("r > 0 and q = p and hole"), NESTED_HOLES).when(F.expr("r > 0 and q = p and not shell"), HOLE_OUTSIDE).when(F.expr("r = 0 and q <> p and shell and not hole"), NESTED_SHELLS)
    )
    return judged.select("_id", fault.alias("fault")).filter("fault is not null").distinct()


def nesting_within(rings: Column) -> Column:
    """Faults of the rings of one shape (p, r, sides) that are on the wrong side of others."""
    length = lambda e: F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"])
    longest = lambda g: F.array_max(F.transform(g["sides"], lambda e: F.struct(length(e).alias("length"), *(e[k].alias(k) for k in ("x1", "y1", "x2", "y2")))))
    along = lambda e, k: e[f"{k}1"] + PART * (e[f"{k}2"] - e[f"{k}1"])
    own = lambda g: (g["p"].alias("p"), g["r"].alias("r"))
    points = F.transform(F.transform(rings, lambda g: F.struct(*own(g), longest(g).alias("e"))), lambda g: F.struct(*own(g), along(g["e"], "x").alias("x"), along(g["e"], "y").alias("y")))

    def held(v: Column) -> Column:
        right = lambda e: F.when((e["y1"] > v["y"]) != (e["y2"] > v["y"]), v["x"] < (e["x2"] - e["x1"]) * (v["y"] - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
        around = F.filter(rings, lambda g: ((g["p"] != v["p"]) | (g["r"] != v["r"])) & (F.size(F.filter(g["sides"], right)) % 2 == 1))
        return F.struct(*own(v), F.transform(around, lambda g: F.struct(*own(g))).alias("by"))

    def named(v: Column) -> Column:
        shell = F.exists(v["by"], lambda h: (h["p"] == v["p"]) & (h["r"] == 0))
        hole = F.exists(v["by"], lambda h: (h["p"] == v["p"]) & (h["r"] > 0))
        other = F.exists(v["by"], lambda h: (h["p"] != v["p"]) & (h["r"] == 0) & ~F.exists(v["by"], lambda g: (g["p"] == h["p"]) & (g["r"] > 0)))
        return F.when((v["r"] > 0) & hole, NESTED_HOLES).when((v["r"] > 0) & ~shell, HOLE_OUTSIDE).when((v["r"] == 0) & other, NESTED_SHELLS)

    return F.array_distinct(F.array_compact(F.transform(F.transform(points, held), named)))


def ring_sides(g: Column) -> Column:
    """The sides of a ring (p, r, c) as an array."""
    m = F.size(g["c"]) - 1
    at = lambda j, n: [F.get(g["c"], j)[k].alias(f"{k}{n}") for k in ("x", "y")]
    return F.transform(
        F.sequence(F.lit(0), m - 1),
        lambda i: F.struct(g["p"].alias("p"), g["r"].alias("r"), i.alias("i"), m.alias("m"), *at(F.when(i == 0, m - 1).otherwise(i - 1), 0), *at(i, 1), *at(i + 1, 2)),
    )


def with_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column by a generator, so that later steps do not repeat how it was reckoned."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def sound_rings(polygons: Column) -> Column:
    """The sound rings of a shape as an array of (p, r, c)."""
    numbered = lambda ring, p, r: F.struct(p.alias("p"), r.alias("r"), F.when(sound(ring), corners(ring)).alias("c"))
    rings = F.flatten(F.transform(F.filter(polygons, lambda x: x.isNotNull()), lambda rings, p: F.transform(rings, lambda ring, r: numbered(ring, p, r))))
    return F.filter(rings, lambda g: g["c"].isNotNull())


def faults_of_few(few: DataFrame) -> DataFrame:
    """Adds _crossed and _nested, the faults of sides and of rings of shapes of few sides, and drops _sound. few: _sound and any other columns."""
    ringed = F.transform("_sound", lambda g: F.struct(g["p"].alias("p"), g["r"].alias("r"), ring_sides(g).alias("sides")))
    rows = with_column(few, "_rings", ringed).drop("_sound")
    rows = with_column(rows, "_sides", F.flatten(F.transform("_rings", lambda g: g["sides"])))
    rows = with_column(rows, "_crossed", pair_faults(pairs_within(F.col("_sides")))).drop("_sides")
    nested = F.when((F.size("_crossed") == 0) & (F.size("_rings") > 1), nesting_within(F.col("_rings")))  # rings that cross are not asked where they lie
    return with_column(rows, "_nested", nested).drop("_rings")


def faults_of_many(shapes: DataFrame) -> DataFrame:
    """(_id, _crossed, _nested) of shapes of any number of sides, by joins. shapes: _id, polygons; those without faults give no row."""
    rings = rings_of(shapes)
    grids = F.array_distinct(F.transform("c", lambda q, i: F.when(i > 0, level(F.get("c", i - 1), q))))
    ys = F.transform("c", lambda q: q["y"])
    facts = rings.select("_id", F.array_compact(grids).alias("grids"), F.array_min(ys).alias("low"), F.array_max(ys).alias("high"), F.size("c").alias("n"))
    strip = F.coalesce(F.nullif((F.max("high") - F.min("low")) / F.sqrt(F.sum("n")), F.lit(0.0)), F.lit(1.0))  # flat shapes have no height
    facts = facts.groupBy("_id").agg(F.array_distinct(F.flatten(F.collect_list("grids"))).alias("grids"), F.count("*").alias("n_rings"), strip.alias("strip"))
    rows = sides_of(rings)
    met = pairs_on_grids(rows.join(facts.select("_id", "grids"), "_id"))
    crossed = met.select("_id", F.explode(pair_faults(F.array(F.struct("s", "t")))).alias("crossed"), F.lit(None).cast("string").alias("nested")).distinct()
    nested = nesting_faults(rows.join(facts.filter("n_rings > 1").select("_id", "strip"), "_id")).select("_id", F.lit(None).cast("string").alias("crossed"), F.col("fault").alias("nested"))
    return crossed.unionByName(nested).groupBy("_id").agg(F.collect_set("crossed").alias("_crossed"), F.collect_set("nested").alias("_nested"))


def with_validity(areas: DataFrame, key: str, polygons: str = "polygons", few: int = FEW) -> DataFrame:
    """Adds geom_faults (array of names, sorted, empty if none) and geom_valid.

    Valid shapes have a polygon, every ring is closed and simple, rings cross and overlap nowhere, holes lie in their shell and
    not in each other, and no shell lies in another polygon but in a hole of it. Rings may touch each other at points; that touches cut an
    interior in two is not looked for. Vertices that repeat the one before count once. No polygons, null or none, are the fault
    `empty`. Rows of equal key and shape share a verdict, other rows of a key have their own; a null key is a key. Shapes of up to `few` sides are judged
    within their rows, larger ones by joins; the verdict is the same.
    """
    shape = F.col(polygons)
    rows = with_column(with_column(areas, "_sound", sound_rings(shape)), "_n", F.coalesce(F.aggregate("_sound", F.lit(0), lambda n, g: n + F.size(g["c"]) - 1), F.lit(0)))
    within = faults_of_few(rows.filter(F.col("_n") <= few)).drop("_n")
    large = rows.filter(F.col("_n") > few).drop("_sound", "_n")
    large = large.withColumn("_id", F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.xxhash64(polygons).cast("string")))
    found = faults_of_many(large.select("_id", shape.alias("polygons")).dropDuplicates(["_id"]))
    joined = within.unionByName(large.join(found, "_id", "left").drop("_id"))
    met = F.when(F.size("_crossed") > 0, F.col("_crossed")).otherwise(F.col("_nested"))  # rings that cross are not asked where they lie
    bare = shape.isNull() | (F.size(shape) == 0) | F.exists(shape, lambda p: p.isNull() | (F.size(p) == 0))
    alone = F.array_compact(F.array(F.when(F.coalesce(bare, F.lit(True)), EMPTY), F.when(F.coalesce(~F.forall(F.flatten(shape), sound), F.lit(False)), RING)))
    faults = F.sort_array(F.concat(alone, F.coalesce(met, F.array().cast("array<string>"))))
    return joined.withColumn("geom_faults", faults).withColumn("geom_valid", F.size("geom_faults") == 0).drop("_crossed", "_nested")
