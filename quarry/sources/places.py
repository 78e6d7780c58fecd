"""Text in pieces whose place in the file is known, and sums that run through a file in its order.

Spark cuts a file into splits and reads them in many tasks; a piece of text alone cannot tell whether it begins within
quotes or brackets that an earlier piece opened. Each split tells how much it adds; a window over the splits, few as they are,
tells how much stands before each; within a split the pieces are summed in order. No task holds more than a split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def placed(spark: SparkSession, paths: str | Sequence[str], separator: str = "\n") -> DataFrame:
    """(file, block, seq, value): pieces between separators, the split's first byte, and the order of pieces within it.

    seq has no gaps within a block.
    """
    rows = spark.read.option("lineSep", separator).text(paths if isinstance(paths, str) else list(paths))
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), "value")


def before_blocks(rows: DataFrame, **counts: Column) -> DataFrame:
    """(file, block, names of counts): sums over all earlier blocks of the file; one row per split."""
    sums = rows.groupBy("file", "block").agg(*(F.sum(c).alias(n) for n, c in counts.items()))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "block", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in counts))


def running(rows: DataFrame, **counts: Column) -> DataFrame:
    """Adds, for each count, its sum over all earlier rows of the file. One exchange, by split."""
    within = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.select("*", *(F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"_{n}") for n, c in counts.items()))
    offsets = before_blocks(rows, **counts).withColumnsRenamed({n: f"_{n}_before" for n in counts})
    joined = inner.join(offsets, ["file", "block"], "left")
    lost = F.raise_error(F.lit("the splits of a file changed while it was read")).cast("long")
    return joined.select(*rows.columns, *(F.coalesce(F.col(f"_{n}_before"), lost).__add__(F.col(f"_{n}")).alias(n) for n in counts))


def numbered(rows: DataFrame, some: DataFrame) -> DataFrame:
    """Adds line, from 1, to `some` of the rows; only they are moved, as seq counts within a block."""
    starts = rows.groupBy("file", "block").agg(F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("file", "block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return some.join(starts, ["file", "block"], "left").withColumn("line", F.col("_before") + F.col("seq") - F.col("_first") + 1).drop("_first", "_before")


def gathered(rows: DataFrame, key: str, first: Column, last: Column, *columns: str) -> DataFrame:
    """(file, key, ended, parts): rows of one key of a file, in order, as an array of structs of block, seq and columns.

    first and last tell the rows that begin and end what the key stands for. After `running` the rows of a split are together, and
    what begins and ends in one is gathered there; only what lies across splits is moved again.
    """
    inner = rows.groupBy("file", "block", key).agg(F.max(first).alias("_first"), F.max(last).alias("ended"), F.sort_array(F.collect_list(F.struct("block", "seq", *columns))).alias("parts"))
    whole = inner.filter("_first and ended").select("file", key, "ended", "parts")
    across = inner.filter("not (_first and ended)").groupBy("file", key)
    across = across.agg(F.max("ended").alias("ended"), F.sort_array(F.flatten(F.collect_list("parts"))).alias("parts"))
    return whole.unionByName(across)


def occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark)))
