"""Editions of a boundary set: chained validity windows, and which of them a build needs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chained(editions: DataFrame) -> DataFrame:
    """Adds valid_to: the next edition's valid_from within a source; the last stays open."""
    by = Window.partitionBy("source_id").orderBy("valid_from")
    return editions.withColumn("valid_to", F.lead("valid_from").over(by).cast("date"))


def selected(windows: DataFrame, mode: str, years: tuple[int, int] | None = None) -> DataFrame:
    """snapshot: open windows. temporal: those that overlap the years; per source the earliest if none does."""
    if mode == "snapshot":
        return windows.filter("valid_to is null")
    if not years:
        return windows
    lo, hi = date(min(years), 1, 1), date(max(years), 12, 31)
    overlaps = (F.col("valid_from") <= F.lit(hi)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(lo)))
    by = Window.partitionBy("source_id")
    marked = windows.withColumn("_any", F.max(overlaps).over(by)).withColumn("_first", F.min("valid_from").over(by))
    return marked.filter(overlaps | (~F.col("_any") & (F.col("valid_from") == F.col("_first")))).drop("_any", "_first")


def in_window(mode: str, day: Column | None) -> Column:
    """Join predicate on valid_from and valid_to; half open."""
    if mode == "snapshot":
        return F.col("valid_to").isNull()
    return (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (day < F.col("valid_to")))


def mid_year(year: str | Column) -> Column:
    return F.make_date(F.col(year) if isinstance(year, str) else year, F.lit(7), F.lit(1))
