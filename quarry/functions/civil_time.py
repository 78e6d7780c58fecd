"""Local civil time and UTC on TIMESTAMP_NTZ, whatever the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Europe/London"


def to_local(utc: str | Column, zone: str = ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def to_utc(local: Column, zone: str = ZONE) -> Column:
    """UTC of a local time; of the two instants of an autumn hour the later one."""
    early = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    late = early + F.expr("interval 1 hour")
    return F.when(F.convert_timezone(F.lit("UTC"), F.lit(zone), late) == local, late).otherwise(early)


def hour_key(t: Column) -> Column:
    """Text of the hour, such as 2024-01-05 13; equal for equal hours and free of zones."""
    return F.substring(t.cast("string"), 1, 13)


def epoch_seconds(t: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t)
