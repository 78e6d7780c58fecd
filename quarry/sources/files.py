"""Reading raw files: all-text bronze with quarantine, nested JSON, GeoJSON, cubes, lookups; and sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.civil_time import hour_key
from quarry.functions.clean import Field
from quarry.operators.vintages import chained
from quarry.sources import places

BAD = "_bad"
QUARANTINE = ("source_id", "raw_text", "reason", "file", "line")


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Names in the first line of a file; the line alone is read."""
    line = spark.read.text(path).limit(1).first()
    return [c.strip().strip('"') for c in line[0].lstrip("\ufeff").split(",")] if line else []


def csv_bronze(spark: SparkSession, paths: Sequence[str], source_id: str, multi_line: bool = False, names: Sequence[str] | None = None, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """(bronze, quarantine): every column as text, files united by name; records that do not fit the header set apart.

    The header is the first line of each file, or `names` if files have none; later lines that repeat it are data. Blank lines
    do not count. Quarantined records keep their file and the line, from 1, on which they begin, so equal ones stay apart. A quote within a quoted
    field is doubled. multi_line: fields in quotes may hold line ends. However large a file, its splits are read by
    many tasks; whether a line begins within quotes is told by the quotes before it. once: records of several lines are cut now and
    kept in the shared folder, for callers that write both tables; else each table cuts them again.
    """
    good, bad = [], []
    for path in paths:
        known = list(names) if names else csv_header(spark, path)
        lines, records = csv_lines(spark, path), None
        if multi_line:
            records = csv_records(lines, names is None)
            if once:
                cut = scratch(spark, "records")
                records.write.parquet(cut)
                records = spark.read.schema(records.schema).parquet(cut)
        else:
            records = without_header(lines) if names is None else lines
            records = records.select("file", "block", "seq", tidy("value").alias("value")).filter("length(trim(value)) > 0")
        never_closed = places.occurrences(F.col("value"), '"') % 2 == 1 if multi_line else F.lit(False)  # the last record of its file
        fits, lost = split_lines(records, "value", known, source_id, never_closed)
        good.append(fits)
        if multi_line:
            bad.append(lost.select(*QUARANTINE))
        else:
            bad.append(places.numbered(lines, lost).select(*QUARANTINE))
    return united(good), united(bad).withColumn("ingested_at", F.current_timestamp())


def csv_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return places.placed(spark, paths)


def tidy(value: str) -> Column:
    """Without the carriage return of a line's end, and the mark of byte order."""
    return F.regexp_replace(F.regexp_replace(value, r"\r$", ""), "^\ufeff", "")


def without_header(lines: DataFrame) -> DataFrame:
    """Lines but the first of each file. The places of first lines, one per file, are broadcast."""
    first = lines.filter("block = 0").groupBy("file").agg(F.min("seq").alias("seq"))
    return lines.join(F.broadcast(first), ["file", "seq"], "left_anti").select(*lines.columns)


def csv_records(lines: DataFrame, header: bool = True) -> DataFrame:
    """(file, line, value): records, joined again where quotes hold line ends; blank ones and headers left out.

    Lines are moved once, to be counted by split; after that only records that lie across splits are.
    """
    known = places.running(lines.withColumn("quotes", places.occurrences(F.col("value"), '"')), opened=F.col("quotes"), line=F.lit(1))
    known = known.withColumn("begins", F.col("opened") % 2 == 0).withColumn("ends", (F.col("opened") + F.col("quotes")) % 2 == 0)
    known = known.withColumn("line", F.col("line") + 1)
    alone = known.filter("begins and ends").select("file", "line", "value")
    parts = places.running(known.filter("not (begins and ends)"), record=F.col("begins").cast("int"))
    parts = parts.withColumn("record", F.col("record") + F.col("begins").cast("int"))
    whole = places.gathered(parts, "record", F.col("begins"), F.col("ends"), "line", "value")
    whole = whole.select("file", F.col("parts")[0]["line"].alias("line"), F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    rows = alone.unionByName(whole).select("file", "line", tidy("value").alias("value")).filter("length(trim(value)) > 0")
    return rows.filter("line > 1") if header else rows


def csv_source_rows(spark: SparkSession, paths: Sequence[str], multi_line: bool = False, header: bool = True) -> DataFrame:
    """Records by a second read path, without parsing or joining any: lines that are not blank and begin outside of quotes, less a header per file."""
    lines = csv_lines(spark, paths)
    if multi_line:
        # A split counts both ways, as if it began within quotes and not; the splits before it say which holds.
        within = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        quotes = places.occurrences(F.col("value"), '"')
        odd = F.coalesce(F.sum(quotes).over(within), F.lit(0)) % 2
        filled = F.length(F.trim(tidy("value"))) > 0
        counted = lines.select("file", "block", quotes.alias("quotes"), odd.alias("odd"), filled.alias("filled"))
        ways = counted.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.count_if(F.expr("filled and odd = 0")).alias("outside"), F.count_if(F.expr("filled and odd = 1")).alias("inside"))
        earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        turned = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
        counts = ways.select("file", F.when(turned == 0, F.col("outside")).otherwise(F.col("inside")).alias("n"))
        counts = counts.groupBy("file").agg(F.sum("n").alias("count"))
    else:
        counts = lines.filter(F.length(F.trim(tidy("value"))) > 0).groupBy("file").count()
    return counts.agg(F.coalesce(F.sum(F.col("count") - int(header)), F.lit(0)).alias("source_rows"))


def split_lines(lines: DataFrame, column: str, names: Sequence[str], source_id: str, broken: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(bronze, quarantine) of records that are already rows, `broken` ones apart; quarantined ones keep the other columns of `lines`."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "escape": '"', "multiLine": "true"}
    schema = ", ".join(f"`{n}` string" for n in [*names, BAD])
    others = [c for c in lines.columns if c != column]
    broken = F.lit(False) if broken is None else broken
    parsed = lines.select(*others, F.col(column).alias("line_"), F.from_csv(column, schema, options).alias("r"), broken.alias("broken_"))
    bad = F.col("broken_") | F.col("r").isNull() | F.col(f"r.{BAD}").isNotNull()
    good = parsed.filter(~bad).select(*(F.col(f"r.`{n}`").alias(n) for n in names))
    return good, parsed.filter(bad).select(F.lit(source_id).alias("source_id"), F.col("line_").alias("raw_text"), F.lit("malformed line").alias("reason"), *others)


def united(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; what a part lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


POSITION = "array<double>"
GEO = "features array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>"


def geojson_features(spark: SparkSession, paths: str | Sequence[str], code: str, name: str, vintage: str) -> DataFrame:
    """One row per feature, as geojson_rows; each feature is parsed on its own, however long the file or its only line."""
    one = F.concat(F.lit('{"features":['), F.col("feature"), F.lit("]}")).alias("value")
    return geojson_rows(features_of(spark, paths).select(one), code, name, vintage)


#: What may stand before a brace: text without braces, and whole strings.
BEFORE_BRACE = r'^(?:[^{"]|"(?:[^"\\]|\\.)*+")*+'


def closings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Pieces of JSON text up to each closing brace: file, block, seq, value, ended (the brace is not in a string), opens.

    Whether a piece begins within a string is told by the quotes before it in the file. Braces in strings do not count.
    """
    pieces = places.placed(spark, paths, "}")
    plain = pieces.withColumn("plain", F.regexp_replace("value", r"\\.", ""))  # an escaped sign is never split from its backslash
    known = places.running(plain.withColumn("quotes", places.occurrences(F.col("plain"), '"')), marks=F.col("quotes"))
    bare = F.concat(F.when(F.col("marks") % 2 == 1, '"').otherwise(""), F.col("plain"))
    bare = F.regexp_replace(F.regexp_replace(bare, '"[^"]*"', ""), '"[^"]*$', "")
    return known.select("file", "block", "seq", "value", ((F.col("marks") + F.col("quotes")) % 2 == 0).alias("ended"), places.occurrences(bare, "{").alias("opens"))


def features_of(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, feature): the text of each object that stands directly in a list of the outermost object and is a feature."""
    deep = places.running(closings(spark, paths), depth=F.col("opens") - F.col("ended").cast("int"))
    after = F.col("depth") + F.col("opens") - F.col("ended").cast("int")
    deep = deep.withColumn("last", F.col("ended") & (after == 1)).filter("opens > 0 or depth > 1")
    told = places.running(deep, number=F.col("last").cast("int"))
    whole = places.gathered(told, "number", F.col("depth") <= 1, F.col("last"), "depth", "value")
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}"))
    text = F.when(F.col("parts")[0]["depth"] == 0, F.regexp_replace(text, BEFORE_BRACE + r"\{", "")).otherwise(text)
    cut = whole.filter("ended").select("file", F.regexp_replace(text, BEFORE_BRACE, "").alias("feature"))
    return cut.filter(F.get_json_object("feature", "$.type") == "Feature")


def geojson_rows(texts: DataFrame, code: str, name: str, vintage: str) -> DataFrame:
    """One row per feature of the texts in `value`: area_code, area_name, vintage, polygons (array of rings of (x, y) per polygon)."""
    whole = texts.select(F.from_json("value", GEO).alias("d"))
    rows = whole.select(F.explode("d.features").alias("f"))
    points = "array<array<array<array<double>>>>"
    many = F.from_json(F.col("f.geometry.coordinates"), points)
    one = F.from_json(F.concat(F.lit("["), F.col("f.geometry.coordinates"), F.lit("]")), points)
    shape = F.when(F.col("f.geometry.type") == "Polygon", one).when(F.col("f.geometry.type") == "MultiPolygon", many)
    xy = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    polygons = F.transform(shape, lambda poly: F.transform(poly, lambda ring: F.transform(ring, xy)))
    return rows.select(F.col("f.properties")[code].alias("area_code"), F.col("f.properties")[name].alias("area_name"), F.lit(vintage).alias("vintage"), polygons.alias("polygons"))


def geojson_source_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Features counted by a second path: occurrences of the member that marks one, without cutting, joining or parsing any.

    A text that says the same within a string has escaped quotes and does not count; an object among the properties of a feature that calls itself one does.
    """
    n = F.regexp_count("value", F.lit(r'"type"\s*:\s*"Feature"'))
    return places.placed(spark, paths, "}").agg(F.coalesce(F.sum(n).cast("long"), F.lit(0)).alias("source_rows"))


CALENDAR = "map<string, struct<division: string, events: array<struct<title: string, date: string, notes: string, bunting: boolean>>>>"


def holidays(json_text: DataFrame, column: str) -> DataFrame:
    """One row per division and event; notes default to blank, a missing bunting is null."""
    rows = json_text.select(F.explode(F.from_json(column, CALENDAR)).alias("key", "d"))
    rows = rows.select(F.coalesce("d.division", "key").alias("division"), F.explode("d.events").alias("e"))
    return rows.select("division", F.col("e.title").alias("title"), F.col("e.date").alias("date_raw"), F.coalesce("e.notes", F.lit("")).alias("notes"), F.col("e.bunting").alias("bunting"))


def calendar_days(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("holiday_date", F.col("date_raw").try_cast("date"))


def cube_rows(cubes: DataFrame, metrics: Sequence[str], time: str = "times") -> DataFrame:
    """One row per cell and hour. cubes: a time axis (`times`, or another name), lats, lons, and flat values per metric."""
    axis = time if time in cubes.columns else "valid_time"
    ny, nx = F.size("lats"), F.size("lons")
    at = cubes.select(axis, "lats", "lons", F.posexplode(F.arrays_zip(*metrics)).alias("i", "v"))
    cell = ny * nx
    return at.select(
        F.get(axis, F.floor(F.col("i") / cell).cast("int")).alias("time_utc"),
        F.get("lats", F.floor((F.col("i") % cell) / nx).cast("int")).alias("lat"),
        F.get("lons", (F.col("i") % nx).cast("int")).alias("lon"),
        *(F.col(f"v.{m}").alias(m) for m in metrics),
    )


def cube_source_rows(cubes: DataFrame, time: str = "times") -> DataFrame:
    """Cells by the axes alone."""
    axis = time if time in cubes.columns else "valid_time"
    return cubes.agg(F.coalesce(F.sum((F.size(axis) * F.size("lats") * F.size("lons")).cast("long")), F.lit(0)).alias("source_rows"))


def lookup(spark: SparkSession, path: str) -> DataFrame:
    """A codebook: text kept exact, is_missing as boolean; (variable, code) must be unique."""
    rows = spark.read.option("header", True).csv(path).withColumn("is_missing", F.coalesce(F.col("is_missing").try_cast("boolean"), F.lit(False)))
    twice = rows.groupBy("variable", "code").count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"code listed twice: {twice[0].asDict()}")
    return rows


def manifest(spark: SparkSession, path: str) -> dict[str, list[Field]]:
    """Columns to clean, by table, from a CSV of table, column, kind and dtype; a table's column must stand once.

    A numeric column without a type is an integer. Manifests are read whole by the driver: MOST_FIELDS rows at most.
    """
    rows = spark.read.option("header", True).csv(path).limit(MOST_FIELDS + 1).collect()
    if len(rows) > MOST_FIELDS:
        raise ValueError(f"manifest of more than {MOST_FIELDS} columns")
    out: dict[str, list[Field]] = {}
    for r in rows:
        if r["kind"] not in KINDS:
            raise ValueError(f"unknown kind {r['kind']} of {r['table']}.{r['column']}")
        fields = out.setdefault(r["table"], [])
        if any(f.name.lower() == r["column"].lower() for f in fields):
            raise ValueError(f"column listed twice: {r['table']}.{r['column']}")
        fields.append(Field(r["column"], r["kind"], (r["dtype"] or "int").lower() if r["kind"] == "numeric" else "string"))
    return out


def editions(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, label, source_file, code_col, name_col, valid_from, valid_to) from a JSON registry: a list of editions for each source, chained."""
    entry = "struct<label: string, source_file: string, code_col: string, name_col: string, valid_from: string>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string, array<{entry}>>")).alias("source_id", "list"))
    listed = rows.select("source_id", F.inline("list")).withColumn("valid_from", F.col("valid_from").cast("date"))
    return chained(listed)


MOST_FIELDS = 10_000
KINDS = ("identity", "geo", "datetime", "coded", "numeric", "text")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share; a session in one process may lack one and gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str) -> None:
    """Replace a table; running again gives the same table."""
    df.write.mode("overwrite").parquet(path)


def write_audit(df: DataFrame, path: str, sources: Sequence[str] = ()) -> None:
    """Replace the rows of `sources`, and of those in `df`, in a shared audit table; other sources are left alone.

    A source without a row in `df` has none afterwards: its partition of an earlier build is deleted.
    """
    spark = df.sparkSession
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for source in sources:
        name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(source)
        old = jvm.org.apache.hadoop.fs.Path(f"{path}/source_id={name}")
        old.getFileSystem(hadoop).delete(old, True)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id").parquet(path)


def write_sorted_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def write_months(df: DataFrame, path: str, time: str) -> None:
    """Grid rows by year and month, ordered in time within each file; months that `df` does not hold stay as they are."""
    rows = df.withColumn("year", F.year(time)).withColumn("month", F.month(time))
    ordered = rows.repartition("year", "month").sortWithinPartitions("year", "month", time)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


def merge_months(months: Sequence[DataFrame], metrics: Sequence[str], path: str) -> None:
    """Monthly cubes as one grid on the time axis, whichever name it has in each: cells by year and month, ordered in time.

    The months given replace those of the table, others stay; months that share an hour keep the cells of both.
    """
    if not months:
        raise ValueError("no months to merge")
    axis = lambda c: next(n for n in ("times", "valid_time", "time") if n in c.columns)
    write_months(united([cube_rows(c, metrics, axis(c)) for c in months]), path, "time_utc")


CELL = ("lat_idx", "lon_idx", "hour")


def write_grid(cells: DataFrame, table: str, path: str, buckets: int) -> None:
    """Cells (lat_idx, lon_idx, datetime_local, metrics) as a table in buckets of cell and hour, by year and month.

    A stamp then deals the points to the buckets and leaves the grid, far larger, where it lies. If the table exists, the months given
    replace its own, and others stay; its columns must be the same.
    """
    spark = cells.sparkSession
    rows = cells.withColumn("hour", hour_key(F.col("datetime_local"))).withColumn("year", F.year("datetime_local")).withColumn("month", F.month("datetime_local"))
    dealt = rows.repartition(buckets, *CELL)
    if not spark.catalog.tableExists(table):
        dealt.write.partitionBy("year", "month").bucketBy(buckets, *CELL).sortBy(*CELL).option("path", path).saveAsTable(table)
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        dealt.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
