"""Point-in-polygon stamps as one equi-join on tiles, with the edges of an area cut up by tile.

A cover lists, for each area, the tiles that lie inside it, which need no test, and the tiles that its edges pass, which carry
only those edges. Whether a point of such a tile is inside follows from the tile's lower left corner: walk from the point
to the left side and down to the corner, and count the edges on the way. The corner itself is counted once, from the
crossings of the line at its height.

All areas that a tile meets travel in one row, so every point meets one row at most and keeps its own: a stamp is a left
join, without a second pass that would bring points together again. Validity windows are dealt to periods that stand beside the tile
in the key, so that former editions are not even looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.geo import inside
from quarry.operators import shapes
from quarry.operators.vintages import in_window

TILE = 10_000
#: The tile side grows if boxes of all areas together have more tiles than this.
MOST_TILES = 4_000_000
#: Validity windows are dealt to this many periods at most, whatever the number of editions.
MOST_PERIODS = 64

EDGE = "array<struct<x1:double,y1:double,x2:double,y2:double,right1:boolean,right2:boolean>>"


def above(y: str, at: Column) -> Column:
    return F.col(y) > at


def left_of(px: Column, py: Column, e=F.col) -> Column:
    """The ray to the right of (px, py) meets the edge; the same rule as in `inside`."""
    return (((e("y1") > py) != (e("y2") > py))) & (px < F.try_divide((e("x2") - e("x1")) * (py - e("y1")), e("y2") - e("y1")) + e("x1"))


def side_of_tiles(areas: DataFrame, tile: int) -> Column:
    """The side in use, as a scalar subquery: `tile`, doubled until the boxes of all areas have MOST_TILES tiles at most."""
    low, high = (lambda k: F.array_min(F.transform("edges", lambda e: F.least(e[f"{k}1"], e[f"{k}2"])))), (lambda k: F.array_max(F.transform("edges", lambda e: F.greatest(e[f"{k}1"], e[f"{k}2"]))))
    tiles = lambda k: (high(k) - low(k)) / tile + 1
    twice = F.greatest(F.lit(0.0), F.ceil(F.log2(F.sum(tiles("x") * tiles("y")) / MOST_TILES) / 2).cast("double"))
    return areas.agg(F.coalesce(tile * F.pow(F.lit(2.0), twice), F.lit(float(tile))).alias("side")).scalar()


def cover(areas: DataFrame, tile: int = TILE) -> DataFrame:
    """One row per area and tile that it meets: the area's columns but edges, tx, ty, base (boolean), edges (EDGE).

    areas: area_code, valid_from, valid_to, edges. Rows that repeat all four count once. A tile inside an area has base TRUE
    and no edges. base takes up all that an edge adds to the count whatever the point is; `holds` adds the rest.
    """
    keys = ["area_code", "valid_from", "valid_to", "_shape"]
    known = areas.select("area_code", "valid_from", "valid_to", "edges", F.xxhash64("edges").alias("_shape")).dropDuplicates(keys)
    side = side_of_tiles(areas, tile)
    rows = known.select(*keys, F.inline("edges")).withColumn("side", side)
    pad = F.col("side") * 2.0**-20  # edges this near count as in the tile; one too many changes nothing
    at = lambda c: F.floor(c / F.col("side"))
    # Tiles by column: within a column of tiles an edge spans a range of heights.
    columns = rows.withColumn("tx", F.explode(F.sequence(at(F.least("x1", "x2") - pad), at(F.greatest("x1", "x2") + pad))))
    slope = F.coalesce(F.try_divide(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")), F.lit(0.0))
    low_y, high_y = F.least("y1", "y2"), F.greatest("y1", "y2")
    level = lambda x: F.greatest(low_y, F.least(high_y, F.col("y1") + slope * (x - F.col("x1"))))
    ends = [level(F.greatest(F.least("x1", "x2"), F.col("tx") * F.col("side") - pad)), level(F.least(F.greatest("x1", "x2"), (F.col("tx") + 1) * F.col("side") + pad))]
    steep = F.col("x1") == F.col("x2")
    from_y, to_y = F.when(steep, low_y).otherwise(F.least(*ends)) - pad, F.when(steep, high_y).otherwise(F.greatest(*ends)) + pad
    borders = columns.withColumn("ty", F.explode(F.sequence(at(from_y), at(to_y))))
    x0, y0 = F.col("tx") * F.col("side"), F.col("ty") * F.col("side")
    right = [F.col(f"x{k}") > x0 for k in (1, 2)]
    turned = left_of(x0, y0).cast("int") + (right[0] & above("y1", y0)).cast("int") + (right[1] & above("y2", y0)).cast("int")
    edge = F.struct("x1", "y1", "x2", "y2", right[0].alias("right1"), right[1].alias("right2"))
    borders = borders.select(*keys, "tx", "ty", edge.alias("edge"), turned.alias("odd"))
    # Corners: where the line at the foot of a row of tiles is crossed, and which corners have an odd number to their right.
    lines = rows.withColumn("ty", F.explode(F.sequence(at(low_y), at(high_y) + 1))).filter(above("y1", y0) != above("y2", y0))
    crossed = F.try_divide((F.col("x2") - F.col("x1")) * (y0 - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1")
    lines = lines.groupBy(*keys, "side", "ty").agg(F.collect_list(crossed).alias("xs"))
    corners = lines.withColumn("tx", F.explode(F.sequence(at(F.array_min("xs")) - 1, at(F.array_max("xs")) + 1)))
    corners = corners.filter(F.size(F.filter("xs", lambda x: F.col("tx") * F.col("side") < x)) % 2 == 1)
    corners = corners.select(*keys, "tx", "ty", F.lit(None).cast(EDGE[6:-1]).alias("edge"), F.lit(1).alias("odd"))
    met = borders.unionByName(corners).groupBy(*keys, "tx", "ty").agg((F.sum("odd") % 2 == 1).alias("base"), F.collect_list("edge").alias("edges"))
    return met.filter("base or size(edges) > 0").drop("_shape")


def holds(c: Column, x: Column, y: Column) -> Column:
    """Whether the area of a tile's candidate holds a point of the tile."""

    def crossed(n: Column, e: Column) -> Column:
        up1, up2 = e["y1"] > y, e["y2"] > y
        return n + left_of(x, y, lambda k: e[k]).cast("int") + (e["right1"] & up1).cast("int") + (e["right2"] & up2).cast("int")

    return F.aggregate(c["edges"], c["base"].cast("int"), crossed) % 2 == 1


def periods(areas: DataFrame) -> Column:
    """First days of the periods, as a scalar subquery: days on which windows begin or end, thinned out evenly to MOST_PERIODS."""
    days = areas.select(F.explode(F.array("valid_from", "valid_to")).alias("day")).filter("day is not null").distinct()
    every = F.ceil(F.size("days") / F.lit(MOST_PERIODS)).cast("int")
    found = days.agg(F.sort_array(F.collect_list("day")).alias("days"))
    return found.select(F.filter("days", lambda d, i: i % F.greatest(every, F.lit(1)) == 0)).scalar()


def period_of(day: Column, first_days: Column) -> Column:
    """How many periods have begun by the day; 0 before all."""
    return F.size(F.filter(first_days, lambda d: d <= day))


def with_area(points: DataFrame, areas: DataFrame, key: str, name: str, mode: str = "snapshot", day: Column | None = None, tile: int = TILE) -> DataFrame:
    """Every point, with the least code of the areas that hold it as `name`, or null.

    points: key, easting, northing, and what `day` reads; rows that repeat a key, or have none, are stamped each on its own. Points
    on an edge belong to the area to the right or above. Nothing is brought to the driver, and no job runs before the result is asked for.
    """
    dated = mode != "snapshot"
    used = areas if dated else areas.filter("valid_to is null")
    cells = cover(used, tile)
    first_days = periods(used) if dated else None
    held = F.struct("area_code", "valid_from", "valid_to", "base", "edges")
    spans = F.sequence(period_of(F.col("valid_from"), F.col("_days")), F.when(F.col("valid_to").isNull(), F.size("_days")).otherwise(period_of(F.date_sub("valid_to", 1), F.col("_days"))))
    if dated:
        cells = cells.filter("valid_from is not null and (valid_to is null or valid_from < valid_to)").withColumn("_days", first_days)
        cells = cells.withColumn("_period", F.explode(spans))
    else:
        cells = cells.withColumn("_period", F.lit(0))
    cells = cells.groupBy(F.col("tx").alias("_tx"), F.col("ty").alias("_ty"), "_period").agg(F.collect_list(held).alias("_held"))
    x, y = F.col("easting").cast("double"), F.col("northing").cast("double")
    placed = x.isNotNull() & y.isNotNull() & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf"))
    when = period_of(day, F.col("_days")) if dated else F.lit(0)
    rows = points.withColumn("_side", side_of_tiles(used, tile))
    rows = rows.withColumn("_days", first_days) if dated else rows
    rows = rows.select(
        *points.columns,
        x.alias("_x"),
        y.alias("_y"),
        (day if dated else F.lit(None).cast("date")).alias("_day"),
        F.when(placed, F.floor(x / F.col("_side"))).otherwise(F.xxhash64(key)).alias("_tx"),  # rows without a place are spread by their key
        F.when(placed, F.floor(y / F.col("_side"))).otherwise(F.lit(-(2**62))).alias("_ty"),
        F.coalesce(when, F.lit(-1)).alias("_period"),
    )

    def fits(c: Column) -> Column:
        there = holds(c, F.col("_x"), F.col("_y"))
        return (c["valid_from"] <= F.col("_day")) & (c["valid_to"].isNull() | (F.col("_day") < c["valid_to"])) & there if dated else there

    least = F.array_min(F.transform(F.filter("_held", fits), lambda c: c["area_code"]))
    return rows.join(cells, ["_tx", "_ty", "_period"], "left").select(*points.columns, least.alias(name))


def area_stamp(points: DataFrame, areas: DataFrame, key: str, mode: str = "snapshot", day: Column | None = None, tile: int = TILE) -> DataFrame:
    """(key, area_code) of the points that an area holds; others give no row."""
    return with_area(points, areas, key, "area_code", mode, day, tile).select(key, "area_code").filter("area_code is not null")


def with_area_brute(points: DataFrame, areas: DataFrame, key: str, name: str, mode: str = "snapshot", day: Column | None = None) -> DataFrame:
    """The same without tiles, for tests on a few areas."""
    x, y = F.col("easting").cast("double"), F.col("northing").cast("double")
    met = points.join(areas, in_window(mode, day) & inside(F.col("edges"), x, y)).groupBy(key).agg(F.min("area_code").alias(name))
    return points.join(met, key, "left")


def boundary_validity(areas: DataFrame, key: str = "area_code") -> DataFrame:
    """Adds geom_faults and geom_valid; see shapes.with_validity."""
    return shapes.with_validity(areas, key)
