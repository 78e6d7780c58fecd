"""Point geometry as columns: reprojection of the British grid, and point in polygon."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ellipsoids, grid and datum shift, as published by the Ordnance Survey.
AIRY_A, AIRY_B = 6377563.396, 6356256.909
WGS_A, WGS_B = 6378137.0, 6356752.314245
SCALE, LAT0, LON0, E0, N0 = 0.9996012717, 49.0, -2.0, 400000.0, -100000.0
SHIFT = (446.448, -125.157, 542.060)
TURN = (0.1502, 0.2470, 0.8421)
PPM = -20.4894


def _meridian(a: float, b: float) -> tuple[float, float, float, float]:
    e2 = 1 - b * b / (a * a)
    return e2, e2 / (1 - e2), (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2)), a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256)


def _arc(lat: float, a: float, e2: float) -> float:
    return a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * lat
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * lat)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * lat)
        - 35 * e2**3 / 3072 * math.sin(6 * lat)
    )


def grid_to_degrees_stages(e: str, n: str) -> list[dict[str, str]]:
    """Column expressions, stage by stage, from grid metres to WGS84 lon and lat (heights are 0).

    Each stage reads the columns of those before. The texts are plain arithmetic that any SQL engine takes.
    """
    e2, ep2, e1, rectified = _meridian(AIRY_A, AIRY_B)
    arc0 = _arc(math.radians(LAT0), AIRY_A, e2)
    w2 = 1 - WGS_B**2 / WGS_A**2
    wp2 = WGS_A**2 / WGS_B**2 - 1
    rx, ry, rz = (math.radians(t / 3600) for t in TURN)
    s = 1 + PPM * 1e-6
    return [
        {"g_mu": f"({arc0!r} + ({n} - {N0!r}) / {SCALE!r}) / {rectified!r}"},
        {
            "g_foot": f"g_mu + {3 * e1 / 2 - 27 * e1**3 / 32!r} * sin(2 * g_mu) + {21 * e1**2 / 16 - 55 * e1**4 / 32!r} * sin(4 * g_mu)"
            f" + {151 * e1**3 / 96!r} * sin(6 * g_mu) + {1097 * e1**4 / 512!r} * sin(8 * g_mu)"
        },
        {"g_sin": "sin(g_foot)", "g_cos": "cos(g_foot)", "g_tan": "tan(g_foot)"},
        {"g_t": "g_tan * g_tan", "g_c": f"{ep2!r} * g_cos * g_cos", "g_w": f"1 - {e2!r} * g_sin * g_sin"},
        {"g_n": f"{AIRY_A!r} / sqrt(g_w)", "g_r": f"{AIRY_A * (1 - e2)!r} / (g_w * sqrt(g_w))"},
        {"g_d": f"({e} - {E0!r}) / (g_n * {SCALE!r})"},
        {
            "g_lat": f"g_foot - (g_n * g_tan / g_r) * (g_d * g_d / 2 - (5 + 3 * g_t + 10 * g_c - 4 * g_c * g_c - {9 * ep2!r}) * pow(g_d, 4) / 24"
            f" + (61 + 90 * g_t + 298 * g_c + 45 * g_t * g_t - {252 * ep2!r} - 3 * g_c * g_c) * pow(g_d, 6) / 720)",
            "g_lon": f"{math.radians(LON0)!r} + (g_d - (1 + 2 * g_t + g_c) * pow(g_d, 3) / 6"
            f" + (5 - 2 * g_c + 28 * g_t - 3 * g_c * g_c + {8 * ep2!r} + 24 * g_t * g_t) * pow(g_d, 5) / 120) / g_cos",
        },
        {"g_v": f"{AIRY_A!r} / sqrt(1 - {e2!r} * sin(g_lat) * sin(g_lat))"},
        {"g_x": "g_v * cos(g_lat) * cos(g_lon)", "g_y": "g_v * cos(g_lat) * sin(g_lon)", "g_z": f"{1 - e2!r} * g_v * sin(g_lat)"},
        {
            "h_x": f"{SHIFT[0]!r} + {s!r} * g_x - {rz!r} * g_y + {ry!r} * g_z",
            "h_y": f"{SHIFT[1]!r} + {rz!r} * g_x + {s!r} * g_y - {rx!r} * g_z",
            "h_z": f"{SHIFT[2]!r} - {ry!r} * g_x + {rx!r} * g_y + {s!r} * g_z",
        },
        {"h_p": "sqrt(h_x * h_x + h_y * h_y)"},
        {"h_a": f"atan2(h_z * {WGS_A!r}, h_p * {WGS_B!r})"},
        {
            "lat": f"degrees(atan2(h_z + {wp2 * WGS_B!r} * pow(sin(h_a), 3), h_p - {w2 * WGS_A!r} * pow(cos(h_a), 3)))",
            "lon": "degrees(atan2(h_y, h_x))",
        },
    ]


def staged(df: DataFrame, stages: list[dict[str, str]], keep: list[str]) -> DataFrame:
    """Apply the stages in turn, then keep the input's columns and the named results."""
    columns = df.columns
    for stage in stages:
        df = df.selectExpr("*", *(f"{e} as {name}" for name, e in stage.items()))
    return df.select(*columns, *keep)


def grid_to_degrees(df: DataFrame, easting: str = "easting", northing: str = "northing") -> DataFrame:
    """Adds lon and lat; null where a coordinate is. Pure arithmetic, good to a few decimetres."""
    return staged(df, grid_to_degrees_stages(easting, northing), ["lon", "lat"])


def degrees_to_grid(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Adds easting and northing, the inverse of grid_to_degrees."""
    e2, ep2, _, _ = _meridian(AIRY_A, AIRY_B)
    w2 = 1 - WGS_B**2 / WGS_A**2
    ap2 = AIRY_A**2 / AIRY_B**2 - 1
    arc0 = _arc(math.radians(LAT0), AIRY_A, e2)
    rx, ry, rz = (-math.radians(t / 3600) for t in TURN)
    s = 1 - PPM * 1e-6
    stages = [
        {"g_p": f"radians({lat})", "g_l": f"radians({lon})"},
        {"g_v": f"{WGS_A!r} / sqrt(1 - {w2!r} * sin(g_p) * sin(g_p))"},
        {"g_x": "g_v * cos(g_p) * cos(g_l)", "g_y": "g_v * cos(g_p) * sin(g_l)", "g_z": f"{1 - w2!r} * g_v * sin(g_p)"},
        {
            "h_x": f"{-SHIFT[0]!r} + {s!r} * g_x - {rz!r} * g_y + {ry!r} * g_z",
            "h_y": f"{-SHIFT[1]!r} + {rz!r} * g_x + {s!r} * g_y - {rx!r} * g_z",
            "h_z": f"{-SHIFT[2]!r} - {ry!r} * g_x + {rx!r} * g_y + {s!r} * g_z",
        },
        {"h_p": "sqrt(h_x * h_x + h_y * h_y)"},
        {"h_a": f"atan2(h_z * {AIRY_A!r}, h_p * {AIRY_B!r})"},
        {"k_p": f"atan2(h_z + {ap2 * AIRY_B!r} * pow(sin(h_a), 3), h_p - {e2 * AIRY_A!r} * pow(cos(h_a), 3))", "k_l": "atan2(h_y, h_x)"},
        {"k_n": f"{AIRY_A!r} / sqrt(1 - {e2!r} * sin(k_p) * sin(k_p))", "k_t": "tan(k_p) * tan(k_p)", "k_c": f"{ep2!r} * cos(k_p) * cos(k_p)", "k_a": f"(k_l - {math.radians(LON0)!r}) * cos(k_p)"},
        {
            "k_m": f"{AIRY_A!r} * ({1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256!r} * k_p - {3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024!r} * sin(2 * k_p)"
            f" + {15 * e2**2 / 256 + 45 * e2**3 / 1024!r} * sin(4 * k_p) - {35 * e2**3 / 3072!r} * sin(6 * k_p))"
        },
        {
            "easting": f"{E0!r} + {SCALE!r} * k_n * (k_a + (1 - k_t + k_c) * pow(k_a, 3) / 6 + (5 - 18 * k_t + k_t * k_t + 72 * k_c - {58 * ep2!r}) * pow(k_a, 5) / 120)",
            "northing": f"{N0!r} + {SCALE!r} * (k_m - {arc0!r} + k_n * tan(k_p) * (k_a * k_a / 2 + (5 - k_t + 9 * k_c + 4 * k_c * k_c) * pow(k_a, 4) / 24"
            f" + (61 - 58 * k_t + k_t * k_t + 600 * k_c - {330 * ep2!r}) * pow(k_a, 6) / 720))",
        },
    ]
    return staged(df, stages, ["easting", "northing"])


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over all edges (x1, y1, x2, y2), holes and parts alike; an upper end belongs to no edge."""
    crossings = F.aggregate(
        edges,
        F.lit(0),
        lambda n, e: n
        + F.when(
            ((e["y1"] > y) != (e["y2"] > y)) & (x < F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"]), 1
        ).otherwise(0),
    )
    return crossings % 2 == 1


def edges_of(polygons: str | Column) -> Column:
    """Edges of array<polygon: array<ring: array<struct<x, y>>>>."""
    rings = F.flatten(F.col(polygons) if isinstance(polygons, str) else polygons)

    def one(ring: Column) -> Column:
        pairs = F.arrays_zip(F.slice(ring, F.lit(1), F.size(ring) - 1).alias("p"), F.slice(ring, F.lit(2), F.size(ring) - 1).alias("q"))
        return F.transform(pairs, lambda s: F.struct(s["p"]["x"].alias("x1"), s["p"]["y"].alias("y1"), s["q"]["x"].alias("x2"), s["q"]["y"].alias("y2")))

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) >= 2), one))
