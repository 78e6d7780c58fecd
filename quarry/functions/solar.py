"""Solar elevation and azimuth by the equations of the NOAA calculator, as staged columns.

Fixed values: all coefficients below are those that the calculator publishes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.geo import staged


def clamped(x: str) -> str:
    """Within -1 and 1; null stays null, as greatest() and least() would not have it."""
    return f"case when {x} > 1 then 1.0 when {x} < -1 then -1.0 else {x} end"


def stages(seconds: str = "epoch_s", lat: str = "lat", lon: str = "lon") -> list[dict[str, str]]:
    """Column texts from UTC epoch seconds and degrees; plain arithmetic that any SQL engine takes."""
    sin, cos = (lambda x, f=f: f"{f}(radians({x}))" for f in ("sin", "cos"))
    return [
        {"s_jc": f"({seconds} / 86400.0 + 2440587.5 - 2451545.0) / 36525.0", "s_min": f"mod({seconds}, 86400) / 60.0"},
        {
            "s_l": "mod(280.46646 + s_jc * (36000.76983 + s_jc * 0.0003032), 360.0)",
            "s_m": "357.52911 + s_jc * (35999.05029 - 0.0001537 * s_jc)",
            "s_e": "0.016708634 - s_jc * (0.000042037 + 0.0000001267 * s_jc)",
            "s_o": "125.04 - 1934.136 * s_jc",
            "s_q": "23.0 + (26.0 + (21.448 - s_jc * (46.815 + s_jc * (0.00059 - s_jc * 0.001813))) / 60.0) / 60.0",
        },
        {"s_c": f"{sin('s_m')} * (1.914602 - s_jc * (0.004817 + 0.000014 * s_jc)) + {sin('2 * s_m')} * (0.019993 - 0.000101 * s_jc) + {sin('3 * s_m')} * 0.000289"},
        {"s_a": f"s_l + s_c - 0.00569 - 0.00478 * {sin('s_o')}", "s_b": f"s_q + 0.00256 * {cos('s_o')}"},
        {"s_decl": f"asin({sin('s_b')} * {sin('s_a')})", "s_y": "pow(tan(radians(s_b / 2)), 2)"},
        {
            "s_eot": f"4 * degrees(s_y * {sin('2 * s_l')} - 2 * s_e * {sin('s_m')} + 4 * s_e * s_y * {sin('s_m')} * {cos('2 * s_l')}"
            f" - 0.5 * s_y * s_y * {sin('4 * s_l')} - 1.25 * s_e * s_e * {sin('2 * s_m')})"
        },
        {"s_t": f"mod(mod(s_min + s_eot + 4 * {lon}, 1440.0) + 1440.0, 1440.0)"},
        {"s_h": "s_t / 4 - 180"},
        {"s_cosz": f"{sin(lat)} * sin(s_decl) + {cos(lat)} * cos(s_decl) * {cos('s_h')}"},
        {"s_z": f"acos({clamped('s_cosz')})"},
        {"s_up": "90 - degrees(s_z)", "s_den": f"{cos(lat)} * sin(s_z)"},
        {"s_rel": f"case when abs(s_den) < 1e-12 then null else ({sin(lat)} * cos(s_z) - sin(s_decl)) / s_den end"},
        {"s_ratio": clamped("s_rel")},
        {
            "s_tan": "tan(radians(s_up))",
            "solar_azimuth": "case when s_h > 0 then mod(degrees(acos(s_ratio)) + 180, 360.0) else mod(540 - degrees(acos(s_ratio)), 360.0) end",
        },
        {
            "solar_elevation": "s_up + case when s_up > 85 then 0.0"
            " when s_up > 5 then 58.1 / s_tan - 0.07 / pow(s_tan, 3) + 0.000086 / pow(s_tan, 5)"
            " when s_up > -0.575 then 1735 + s_up * (-518.2 + s_up * (103.4 + s_up * (-12.79 + s_up * 0.711)))"
            " else -20.772 / s_tan end / 3600.0"
        },
    ]


def solar_position(df: DataFrame, seconds: str = "epoch_s", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Adds solar_elevation (refraction corrected) and solar_azimuth (clockwise from north), in degrees.

    Null time or place gives null; callers leave the time null where it is only imputed.
    """
    done = staged(df, stages(seconds, lat, lon), ["solar_elevation", "solar_azimuth"])
    # a generator is where predicates stop: pushed further down, one would repeat the whole chain of stages
    return done.select(*df.columns, F.inline(F.array(F.struct("solar_elevation", "solar_azimuth"))))
