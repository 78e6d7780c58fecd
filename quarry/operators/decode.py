"""Code lists: labels on demand, completeness and undecoded codes in one scan, and deriving a codebook."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labels that mean a missing value.
MISSING_LABELS = ("data missing or out of range", "unknown", "undefined", "not known", "code deprecated")


#: A codebook of more codes than this is no lookup and is refused.
MOST_CODES = 100_000


def codebook_row(codebook: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row: a map from code to label per variable, MOST_CODES at most. Codebooks are lookups; equal codes keep the least label."""
    unique = codebook.filter(F.col("variable").isin(*variables)).groupBy("variable", "code").agg(F.min("label").alias("label"))
    entry = F.struct("code", "label")
    maps = [F.map_from_entries(F.coalesce(F.collect_list(F.when(F.col("variable") == v, entry)), F.array().cast("array<struct<code:string,label:string>>"))).alias(f"_{v}") for v in variables]
    few = unique.limit(MOST_CODES + 1)
    over = F.raise_error(F.lit(f"codebook of more than {MOST_CODES} codes")).cast("boolean")
    return few.agg(*maps, F.count("*").alias("_n")).filter((F.col("_n") <= MOST_CODES) | over).drop("_n")


def labelled(df: DataFrame, codebook: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds <column>_label for coded columns; the row count stays. The maps of all columns travel in one row."""
    maps = codebook_row(codebook, columns)
    rows = df.join(maps, how="left", on=F.lit(True))
    labels = [F.try_element_at(f"_{c}", F.col(c).cast("string")).alias(f"{c}_label") for c in columns]
    return rows.select(*df.columns, *labels)


def undecoded(df: DataFrame, codebook: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, n_undecoded): values that are present but have no label, all columns in one scan."""
    rows = labelled(df, codebook, columns)
    counts = rows.agg(*(F.count_if(F.col(c).isNotNull() & F.col(f"{c}_label").isNull()).alias(c) for c in columns))
    return counts.unpivot([], list(columns), "variable", "n_undecoded")


def completeness(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """(tbl, col, n_total, n_present, n_missing, rate) from one aggregate; the rate of an empty table is 0."""
    counts = df.agg(F.count("*").alias("n_total"), *(F.count(c).alias(c) for c in columns))
    rows = counts.unpivot(["n_total"], list(columns), "col", "n_present")
    return rows.select(
        F.lit(table).alias("tbl"),
        "col",
        "n_total",
        "n_present",
        (F.col("n_total") - F.col("n_present")).alias("n_missing"),
        F.coalesce(F.try_divide("n_present", "n_total"), F.lit(0.0)).alias("rate"),
    )


def derived_codebook(code_list: DataFrame) -> DataFrame:
    """(variable, code, label, is_missing) from a list of (variable, code, label): integer codes only, distinct.

    Sorted for reproducible files; sort again after further joins.
    """
    rows = code_list.select(F.lower(F.trim("variable")).alias("variable"), F.trim("code").alias("code"), F.trim("label").alias("label"))
    rows = rows.filter(F.col("code").try_cast("int").isNotNull())
    gone = (F.col("code") == "-1") | F.lower("label").isin(*MISSING_LABELS)
    return rows.withColumn("is_missing", F.coalesce(gone, F.lit(False))).distinct().orderBy("variable", F.col("code").try_cast("int"), "label")
