"""The audit: an exclusion ledger derived from flags, and checks that stop a build which loses rows."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REJECT_CEILING = 0.05
QUARANTINE_CEILING = 0.005
LEDGER = ("source_id", "source_row_key", "rule_id", "rule_desc", "severity", "column_name", "raw_value", "ingested_at")


class QualityError(Exception):
    """A check failed."""


class MissingTable(QualityError):
    """A declared table was not given."""


class MissingColumn(QualityError):
    """A table lacks a declared column."""


class ConservationError(QualityError):
    """Rows were lost or invented."""


class QuarantineRateError(QualityError):
    """Too many lines could not be read."""


class LedgerError(QualityError):
    """Flags and ledger disagree."""


class RejectRateError(QualityError):
    """Too many rows fail a dimension."""


class CoverageError(QualityError):
    """A source is neither audited nor exempt."""


@dataclass(frozen=True)
class Rule:
    """A flag and what the ledger says where it is FALSE (or, for a warning, where it is TRUE)."""

    rule_id: str
    flag: str
    column: str
    raw: str
    text: str = ""
    warn: bool = False


@dataclass(frozen=True)
class Dimension:
    flag: str
    rules: tuple[str, ...] = ()
    ceiling: float | None = None


@dataclass(frozen=True)
class SourceSpec:
    source_id: str
    key: str
    dimensions: tuple[Dimension, ...] = ()
    quarantine_ceiling: float = QUARANTINE_CEILING


@dataclass
class SourceTables:
    bronze: DataFrame
    silver: DataFrame
    ledger: DataFrame
    quarantine: DataFrame | None = None
    source_rows: DataFrame | None = field(default=None)  # one row, one column: an independent count


def ledger(silver: DataFrame, source_id: str, key: str, rules: Sequence[Rule], stamp: Column | None = None) -> DataFrame:
    """One row per broken rule and row, in one pass: each silver row carries an array of its breaches."""
    breaches = []
    for r in rules:
        broken = F.col(r.flag) if r.warn else ~F.col(r.flag)
        breach = F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(r.text).alias("rule_desc"),
            F.lit("warn" if r.warn else "reject_dimension").alias("severity"),
            F.lit(r.column).alias("column_name"),
            F.expr(r.raw).cast("string").alias("raw_value"),
        )
        breaches.append(F.when(F.coalesce(broken, F.lit(False)), breach))
    rows = silver.select(F.col(key).cast("string").alias("source_row_key"), F.explode(F.array_compact(F.array(*breaches))).alias("b"))
    when = F.current_timestamp() if stamp is None else stamp
    return rows.select(F.lit(source_id).alias("source_id"), "source_row_key", "b.*", when.alias("ingested_at"))


def check_schema(spec: SourceSpec, tables: SourceTables) -> None:
    """Declared key and flags are there; reads metadata only."""
    for name in ("bronze", "silver", "ledger"):
        if getattr(tables, name) is None:
            raise MissingTable(f"{spec.source_id}: {name}")
    have = set(tables.silver.columns)
    for c in (spec.key, *(d.flag for d in spec.dimensions)):
        if c not in have:
            raise MissingColumn(f"{spec.source_id}: {c}")


def conservation(spec: SourceSpec, tables: SourceTables) -> DataFrame:
    """One row: source_rows, bronze_rows, silver_rows, quarantine_rows, conserved, quarantine_rate."""
    spark = tables.bronze.sparkSession
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    row = count(tables.bronze, "bronze_rows").join(count(tables.silver, "silver_rows"), F.lit(True))
    bad = tables.quarantine if tables.quarantine is not None else spark.range(0)
    row = row.join(count(bad, "quarantine_rows"), F.lit(True))
    if tables.source_rows is not None:
        row = row.join(tables.source_rows.toDF("source_rows"), F.lit(True))
    else:
        row = row.withColumn("source_rows", F.col("bronze_rows") + F.col("quarantine_rows"))
    same = (F.col("bronze_rows") == F.col("silver_rows")) & (F.col("source_rows") == F.col("bronze_rows") + F.col("quarantine_rows"))
    rate = F.coalesce(F.try_divide("quarantine_rows", "source_rows"), F.lit(0.0))
    return row.select(F.lit(spec.source_id).alias("source_id"), "source_rows", "bronze_rows", "silver_rows", "quarantine_rows", same.alias("conserved"), rate.alias("quarantine_rate"))


def flag_ledger_agreement(spec: SourceSpec, silver: DataFrame, entries: DataFrame) -> DataFrame:
    """(flag, n_flag_only, n_ledger_only) per dimension that has rules, all in one join; warnings do not count."""
    ruled = [d for d in spec.dimensions if d.rules]
    spark = silver.sparkSession
    if not ruled:
        return spark.createDataFrame([], "flag string, n_flag_only long, n_ledger_only long")
    failing = F.array_compact(F.array(*(F.when(~F.col(d.flag), F.lit(d.flag)) for d in ruled)))
    failed = silver.select(F.coalesce(F.col(spec.key).cast("string"), F.lit("")).alias("k"), F.col(spec.key).isNull().alias("null_key"), F.explode(failing).alias("flag"))
    flag_of = F.create_map(*(F.lit(x) for d in ruled for r in d.rules for x in (r, d.flag)))
    logged = entries.filter((F.col("source_id") == spec.source_id) & (F.col("severity") != "warn"))
    logged = logged.select(F.coalesce("source_row_key", F.lit("")).alias("k"), F.col("source_row_key").isNull().alias("null_key"), F.try_element_at(flag_of, "rule_id").alias("flag")).filter("flag is not null")
    both = failed.withColumn("a", F.lit(True)).withColumn("b", F.lit(False)).unionByName(logged.withColumn("a", F.lit(False)).withColumn("b", F.lit(True)))
    keys = both.groupBy("flag", "k", "null_key").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    counts = keys.groupBy("flag").agg(F.count_if(F.expr("a and not b")).alias("n_flag_only"), F.count_if(F.expr("b and not a")).alias("n_ledger_only"))
    flags = spark.createDataFrame([(d.flag,) for d in ruled], "flag string")
    return flags.join(counts, "flag", "left").select("flag", F.coalesce("n_flag_only", F.lit(0)).alias("n_flag_only"), F.coalesce("n_ledger_only", F.lit(0)).alias("n_ledger_only"))


def limit_of(dimension: Dimension, ceiling: float | None = None) -> float:
    """The share of rows that may fail: the dimension's own, or the build's, or REJECT_CEILING. Zero counts as given."""
    if dimension.ceiling is not None:
        return dimension.ceiling
    return REJECT_CEILING if ceiling is None else ceiling


def reject_rates(spec: SourceSpec, silver: DataFrame, ceiling: float | None = None) -> DataFrame:
    """(flag, n_total, n_rejected, rate, ceiling, within) per dimension, all in one aggregate."""
    base = REJECT_CEILING if ceiling is None else ceiling
    flags = [d.flag for d in spec.dimensions]
    counts = silver.agg(F.count(F.lit(1)).alias("n_total"), *(F.count_if(~F.col(f)).alias(f) for f in flags))
    rows = counts.unpivot(["n_total"], flags, "flag", "n_rejected")
    limit = F.lit(base)
    for d in spec.dimensions:
        if d.ceiling is not None:
            limit = F.when(F.col("flag") == d.flag, F.lit(d.ceiling)).otherwise(limit)
    rate = F.coalesce(F.try_divide("n_rejected", "n_total"), F.lit(0.0))
    return rows.select("flag", "n_total", "n_rejected", rate.alias("rate"), limit.cast("double").alias("ceiling"), (rate <= limit).alias("within"))


def run_checks(specs: Sequence[tuple[SourceSpec, SourceTables]], ceiling: float | None = None) -> list[DataFrame]:
    """All checks in order, raising at the first that fails; returns the conservation reports."""
    reports = []
    for spec, tables in specs:
        check_schema(spec, tables)
    for spec, tables in specs:
        report = conservation(spec, tables)
        row = report.first()
        if not row.conserved:
            raise ConservationError(f"{spec.source_id}: {row.asDict()}")
        if row.quarantine_rate > spec.quarantine_ceiling:
            raise QuarantineRateError(f"{spec.source_id}: {row.quarantine_rate:.4f}")
        for r in flag_ledger_agreement(spec, tables.silver, tables.ledger).collect():  # a row per dimension
            if r.n_flag_only or r.n_ledger_only:
                raise LedgerError(f"{spec.source_id}: {r.asDict()}")
        if spec.dimensions:
            for r in reject_rates(spec, tables.silver, ceiling).collect():
                if not r.within:
                    raise RejectRateError(f"{spec.source_id}: {r.asDict()}")
        reports.append(report)
    return reports


def undecided(sources: DataFrame, specs: DataFrame, exemptions: DataFrame) -> DataFrame:
    """Sources that are neither audited nor exempt with a reason; must be empty."""
    excused = exemptions.filter("reason is not null and trim(reason) <> ''")
    return sources.join(specs, "source_id", "left_anti").join(excused, "source_id", "left_anti")


def provenance(spark: SparkSession, version: str, schema_version: int, parameters: dict) -> DataFrame:
    """One row, written last: versions, UTC build time, and the parameters as JSON with sorted keys."""
    said = json.dumps(parameters, sort_keys=True)
    return spark.range(1).select(
        F.lit(version).alias("version"), F.lit(schema_version).alias("schema_version"), F.current_timestamp().alias("built_at_utc"), F.lit(said).alias("parameters")
    )
