"""What a source declares, and a build of any sources: written once, counted while it is written, published as a whole.

A source is a name, the sources it reads, and a function that gives bronze, silver, quarantine and an independent count. The build
writes each table in one pass; the counts that the checks need are observed on the rows as they go by. Sources that do not need
each other run at the same time. All tables of a build lie in a folder of their own; once every check has passed, one rename makes
it the current one, so a build that fails leaves the former tables and their provenance as they were.
"""

from __future__ import annotations

import json
import uuid
import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.operators import audit, decode

VERSION, SCHEMA_VERSION = "0.2.0", 2
CURRENT = "CURRENT"
KEPT_BUILDS = 2


@dataclass
class SourceResult:
    """Frames of one source. `silver` gets the bronze as it was written; without it the source is kept as it is and must be exempt.

    measured: further aggregates to observe on silver, by name. cleaned: kind of each column whose completeness is
    reported. coded: columns that a codebook decodes. advice: from what was observed, warnings to give.
    """

    bronze: DataFrame
    silver: Callable[[DataFrame], DataFrame] | None = None
    quarantine: DataFrame | None = None
    source_rows: DataFrame | None = None
    cleaned: dict[str, str] = field(default_factory=dict)
    coded: Sequence[str] = ()
    measured: dict[str, Column] = field(default_factory=dict)
    advice: Callable[[dict], list[str]] = lambda found: []


@dataclass(frozen=True)
class Source:
    """spec: the audit's declaration, or None with a reason to be exempt. needs: sources whose silver `make` reads where they are given. table: name of the silver table."""

    source_id: str
    make: Callable[[Context], SourceResult]
    spec: audit.SourceSpec | None = None
    rules: Sequence[audit.Rule] = ()
    needs: Sequence[str] = ()
    table: str | None = None
    exempt: str = ""


@dataclass
class Context:
    """What a source may read: parameters, and the silver of sources that it needs, or None where such a source is not part of the build."""

    spark: SparkSession
    parameters: dict
    codebook: DataFrame | None = None
    missing: dict[str, list[str]] = field(default_factory=dict)
    done: dict[str, DataFrame] = field(default_factory=dict)

    def silver(self, source_id: str) -> DataFrame | None:
        return self.done.get(source_id)


@dataclass
class Counts:
    """Numbers observed while the tables of a source were written."""

    bronze: int = 0
    silver: dict = field(default_factory=dict)
    quarantine: int = 0
    source_rows: int | None = None


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_observed(df: DataFrame, path: str, **aggregates: Column) -> dict:
    """Write a table in one pass and return the aggregates over its rows, reckoned in that pass."""
    seen = Observation(f"written-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("n"), *(c.alias(n) for n, c in aggregates.items())).write.mode("overwrite").parquet(path)
    return seen.get


def build_source(source: Source, context: Context, folder: str) -> tuple[SourceResult, Counts, DataFrame | None]:
    """Write bronze, quarantine, silver and ledger of one source; the counts come from the same passes."""
    spark, name = context.spark, source.source_id
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
    result, counts = source.make(context), Counts()
    counts.bronze = write_observed(result.bronze, f"{folder}/{name}_raw")["n"]
    if result.quarantine is not None:
        counts.quarantine = write_observed(result.quarantine, f"{folder}/{name}_quarantine")["n"]
    if result.source_rows is not None:
        counts.source_rows = result.source_rows.first()[0]
    if result.silver is None:
        return result, counts, None
    silver = result.silver(spark.read.parquet(f"{folder}/{name}_raw"))
    flags = {f"rejected_{d.flag}": F.count_if(~F.col(d.flag)) for d in source.spec.dimensions} if source.spec else {}
    if source.spec:
        audit.check_schema(source.spec, audit.SourceTables(result.bronze, silver, result.bronze))
    present = {f"present_{c}": F.count(c) for c in result.cleaned if c in silver.columns}
    table = f"{folder}/{source.table or name}"
    counts.silver = write_observed(silver, table, **flags, **present, **result.measured)
    written = spark.read.parquet(table)
    if source.rules:
        entries = audit.ledger(written, name, source.spec.key, source.rules).drop("source_id")
        write_observed(entries, f"{folder}/data_quality_log/source_id={name}")
    return result, counts, written


def check(source: Source, counts: Counts, agreement: DataFrame | None, ceiling: float | None) -> None:
    """Conservation, quarantine, agreement and rejection, in this order; the first that fails raises."""
    spec, n = source.spec, counts.silver["n"]
    expected = counts.bronze + counts.quarantine if counts.source_rows is None else counts.source_rows
    if counts.bronze != n or expected != counts.bronze + counts.quarantine:
        raise audit.ConservationError(f"{spec.source_id}: {expected} records, {counts.bronze} in bronze, {n} in silver, {counts.quarantine} set apart")
    if expected and counts.quarantine / expected > spec.quarantine_ceiling:
        raise audit.QuarantineRateError(f"{spec.source_id}: {counts.quarantine / expected:.4f}")
    for r in agreement.collect() if agreement is not None else ():  # a row per dimension
        if r.n_flag_only or r.n_ledger_only:
            raise audit.LedgerError(f"{spec.source_id}: {r.asDict()}")
    for d in spec.dimensions:
        rejected, limit = counts.silver[f"rejected_{d.flag}"], audit.limit_of(d, ceiling)
        if n and rejected / n > limit:
            raise audit.RejectRateError(f"{spec.source_id}: {d.flag} fails in {rejected} of {n} rows, ceiling {limit}")


INGEST = "source_id string, source_rows long, bronze_rows long, silver_rows long, quarantine_rows long, conserved boolean, quarantine_rate double"
REJECTS = "source_id string, flag string, n_total long, n_rejected long, rate double, ceiling double"
COMPLETE = "tbl string, col string, kind string, n_total long, n_present long, n_missing long, rate double"


def reports(spark: SparkSession, done: dict[str, tuple[Source, SourceResult, Counts]], ceiling: float | None) -> dict[str, DataFrame]:
    """The reports of a build, a row per source, dimension or column, from what was observed."""
    ingest, rejects, complete = [], [], []
    for name, (source, result, c) in done.items():
        if source.spec is None or result.silver is None:
            continue
        n = c.silver["n"]
        total = c.bronze + c.quarantine if c.source_rows is None else c.source_rows
        ingest.append((name, total, c.bronze, n, c.quarantine, c.bronze == n and total == c.bronze + c.quarantine, c.quarantine / total if total else 0.0))
        for d in source.spec.dimensions:
            k = c.silver[f"rejected_{d.flag}"]
            rejects.append((name, d.flag, n, k, k / n if n else 0.0, float(audit.limit_of(d, ceiling))))
        for col, kind in result.cleaned.items():
            if f"present_{col}" in c.silver:
                k = c.silver[f"present_{col}"]
                complete.append((source.table or name, col, kind, n, k, n - k, (n - k) / n if n else 0.0))
    made = {"ingest_report": (ingest, INGEST), "reject_report": (rejects, REJECTS), "completeness": (complete, COMPLETE)}
    return {k: spark.createDataFrame(rows, schema) for k, (rows, schema) in made.items()}


def run(
    spark: SparkSession, sources: Sequence[Source], path: str, parameters: dict | None = None, codebook: DataFrame | None = None, missing: dict[str, list[str]] | None = None, ceiling: float | None = None
) -> dict[str, DataFrame]:
    """Build the sources under `path`, check them, publish them; returns the published tables and labelled views."""
    undecided = sorted(s.source_id for s in sources if s.spec is None and not s.exempt.strip())
    if undecided:
        raise audit.CoverageError(f"neither audited nor exempt: {undecided}")
    known = {s.source_id: s for s in sources}
    if len(known) < len(sources):
        raise ValueError("a source is declared twice")
    context = Context(spark, parameters or {}, codebook, missing or {})
    folder = f"{path.rstrip('/')}/builds/{uuid.uuid4().hex}"
    done: dict[str, tuple[Source, SourceResult, Counts]] = {}
    try:
        order = TopologicalSorter({n: [x for x in s.needs if x in known] for n, s in known.items()})
        order.prepare()
        while order.is_active():
            ready = sorted(order.get_ready())  # all of them need only what is done
            with ThreadPoolExecutor(len(ready)) as pool:
                # Each thread keeps its own job properties, so that a fair scheduler shares the cluster between sources.
                jobs = {n: pool.submit(inheritable_thread_target(spark)(partial(build_source, known[n], context, folder))) for n in ready}
                for n, job in jobs.items():
                    result, counts, silver = job.result()
                    done[n] = (known[n], result, counts)
                    if silver is not None:
                        context.done[n] = silver
            order.done(*ready)
        ledger = ledger_of(spark, folder) if any(s.rules for s in sources) else None
        for source, _, counts in done.values():
            if source.spec is None:
                continue
            ruled = any(d.rules for d in source.spec.dimensions)
            agreement = audit.flag_ledger_agreement(source.spec, context.done[source.source_id], ledger) if ruled and ledger is not None else None
            check(source, counts, agreement, ceiling)
        for _, result, counts in done.values():
            for text in result.advice(counts.silver):
                warnings.warn(text, stacklevel=2)
        for name, report in reports(spark, done, ceiling).items():
            write_observed(report, f"{folder}/{name}")
        exempt = spark.createDataFrame([(s.source_id, s.exempt) for s in sources if s.spec is None], "source_id string, reason string")
        write_observed(exempt, f"{folder}/quality_exemptions")
        if codebook is not None:
            warn_undecoded(context, done, folder)
        write_observed(audit.provenance(spark, VERSION, SCHEMA_VERSION, context.parameters), f"{folder}/build_meta")
        publish(spark, path, folder)
    except BaseException:
        _, at, fs = filesystem(spark, folder)
        fs.delete(at, True)
        raise
    return published(spark, path, codebook, {(s.table or n): r.coded for n, (s, r, _) in done.items() if r.coded})


def warn_undecoded(context: Context, done: dict[str, tuple[Source, SourceResult, Counts]], folder: str) -> None:
    """Codes without a label, by table and column, for columns that the codebook covers: written as a report, and warned of."""
    spark, rows = context.spark, []
    covered = {r.variable for r in context.codebook.select("variable").distinct().limit(decode.MOST_CODES).collect()}
    for name, (source, result, _) in done.items():
        silver = context.done.get(name)
        columns = [c for c in result.coded if silver is not None and c in silver.columns and c in covered]
        if columns:
            rows += [(source.table or name, r.variable, r.n_undecoded) for r in decode.undecoded(silver, context.codebook, columns).collect()]  # a row per column
    write_observed(spark.createDataFrame(rows, "tbl string, variable string, n_undecoded long"), f"{folder}/undecoded")
    lost = [f"{t}.{c}={n}" for t, c, n in rows if n]
    if lost:
        warnings.warn(f"codes without a label: {', '.join(lost)}", stacklevel=2)


def ledger_of(spark: SparkSession, folder: str) -> DataFrame:
    fields = ", ".join(f"{c} {'timestamp' if c == 'ingested_at' else 'string'}" for c in audit.LEDGER)
    return spark.read.schema(fields).parquet(f"{folder}/data_quality_log").select(*audit.LEDGER)


def publish(spark: SparkSession, path: str, folder: str) -> None:
    """Make a finished build the current one: a pointer beside the old is renamed over it. Older builds but the one before are deleted."""
    jvm, root, fs = filesystem(spark, path)
    before = current(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(root, f"{CURRENT}.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps({"build": folder.rpartition("/")[2], "before": before}).encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(root, CURRENT)), overwrite)
    kept = {folder.rpartition("/")[2], before}
    for status in fs.listStatus(jvm.org.apache.hadoop.fs.Path(root, "builds")):
        if status.getPath().getName() not in kept:
            fs.delete(status.getPath(), True)


def current(spark: SparkSession, path: str) -> str | None:
    """Name of the current build, or None before the first."""
    jvm, root, fs = filesystem(spark, path)
    at = jvm.org.apache.hadoop.fs.Path(root, CURRENT)
    if not fs.exists(at):
        return None
    return json.loads(spark.read.text(f"{path.rstrip('/')}/{CURRENT}", wholetext=True).first()[0])["build"]


def published(spark: SparkSession, path: str, codebook: DataFrame | None = None, coded: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """Tables of the current build by name, and with a codebook <table>_labelled for tables with coded columns, decoded only when read."""
    name = current(spark, path)
    if name is None:
        return {}
    jvm, root, fs = filesystem(spark, f"{path.rstrip('/')}/builds/{name}")
    found = {}
    for status in fs.listStatus(root):
        table = status.getPath().getName()
        found[table] = ledger_of(spark, root.toString()) if table == "data_quality_log" else spark.read.parquet(status.getPath().toString())
    for table, columns in (coded or {}).items() if codebook is not None else ():
        found[f"{table}_labelled"] = decode.labelled(found[table], codebook, [c for c in columns if c in found[table].columns])
    return found
