"""Enrichment joins that keep the row count: links, weather, calendar, and overwrites from a match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.civil_time import hour_key
from quarry.functions.clean import division, grid_index


def with_link(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str = "link_valid") -> DataFrame:
    """Adds a flag: the child's key exists in the parent. Never null; a null key links to nothing."""
    keys = parent.select(F.col(parent_key).alias("_key")).filter("_key is not null").distinct().withColumn("_hit", F.lit(True))
    joined = child.join(keys, F.col(child_key) == F.col("_key"), "left")
    return joined.withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_key", "_hit")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    keys = parent.select(F.col(parent_key).alias("_key")).filter("_key is not null")
    return child.join(keys, F.col(child_key) == F.col("_key"), "left_anti")


def overwritten(df: DataFrame, match: DataFrame, key: str, column: str) -> DataFrame:
    """`column` takes the value of the matching row; rows without a match keep theirs. match: key, column."""
    new = match.groupBy(key).agg(F.min(column).alias("_new"), F.lit(True).alias("_hit"))
    joined = df.join(new, key, "left")
    return joined.withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))).drop("_new", "_hit")


def with_weather(points: DataFrame, grid: DataFrame, metrics: list[str], time: str = "datetime_local", imputed: str | None = "time_imputed") -> DataFrame:
    """Adds the metrics of the point's 0.1 degree cell and local hour; null without a cell, or if the time is imputed.

    grid: lat_idx, lon_idx, datetime_local and metrics. The two hours that share a local hour in autumn give
    the least of each metric on its own. A grid that files.write_grid wrote has its hours as a column and its cells in buckets, and is not moved.
    """
    own_hour = F.col("hour") if "hour" in grid.columns else hour_key(F.col("datetime_local"))
    cells = grid.groupBy("lat_idx", "lon_idx", own_hour.alias("_hour")).agg(*(F.min(m).alias(m) for m in metrics))
    cells = cells.withColumnsRenamed({"lat_idx": "_lat", "lon_idx": "_lon"})
    hour = hour_key(F.col(time))
    if imputed:
        hour = F.when(~F.coalesce(F.col(imputed), F.lit(False)), hour)
    keyed = points.select("*", grid_index("lat").alias("_lat"), grid_index("lon").alias("_lon"), hour.alias("_hour"))
    return keyed.join(cells, ["_lat", "_lon", "_hour"], "left").drop("_lat", "_lon", "_hour")


def with_holiday(df: DataFrame, holidays: DataFrame, area: str, day: str, name: str = "is_bank_holiday") -> DataFrame:
    """TRUE or FALSE where known; null for an unknown nation, no day, or a year the calendar does not cover.

    holidays: division, holiday_date.
    """
    cover = holidays.groupBy("division").agg(F.min(F.year("holiday_date")).alias("_first"), F.max(F.year("holiday_date")).alias("_last"))
    days = holidays.select("division", "holiday_date").distinct().withColumn("_hit", F.lit(True))
    keyed = df.withColumn("_division", division(area))
    keyed = keyed.join(cover.withColumnRenamed("division", "_division"), "_division", "left")
    match = (F.col("_division") == days["division"]) & (F.to_date(day) == days["holiday_date"])
    keyed = keyed.join(days, match, "left")
    known = F.col(day).isNotNull() & F.year(day).between(F.col("_first"), F.col("_last"))
    return keyed.withColumn(name, F.when(known, F.coalesce("_hit", F.lit(False)))).drop("_division", "_first", "_last", "division", "holiday_date", "_hit")


