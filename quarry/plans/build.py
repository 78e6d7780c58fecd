"""The road-event build: seven declared sources, composed by the contract of any source.

A user's source joins by being listed in `Inputs.sources`; nothing here or in the contract changes for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import clean
from quarry.functions.civil_time import epoch_seconds, to_local, to_utc
from quarry.functions.geo import edges_of, grid_to_degrees
from quarry.functions.solar import solar_position
from quarry.operators import audit, spatial, stamps, vintages
from quarry.plans import contract
from quarry.plans.contract import Context, Source, SourceResult
from quarry.sources import files


@dataclass
class Inputs:
    """Raw frames: all-text events, vehicles, casualties and counts; boundaries with polygons and validity; cubes; holidays.

    upper: a second layer of boundaries, shaped like the first. manifest: columns to clean by kind, of the events, or of each
    table by name as files.manifest reads them. sources: further declared sources. extra: sources that are kept as they are; each needs a
    reason in `exempt`, or the build stops. quarantine and source_rows, by source: records set apart, and records counted by a second
    read; `from_csv` fills both, and without them the check of conservation starts at bronze.
    """

    events: DataFrame
    vehicles: DataFrame
    counts: DataFrame
    boundaries: DataFrame
    cubes: DataFrame | None = None
    holidays: DataFrame | None = None
    codebook: DataFrame | None = None
    casualties: DataFrame | None = None
    upper: DataFrame | None = None
    manifest: Sequence[clean.Field] | dict[str, Sequence[clean.Field]] = ()
    sources: Sequence[Source] = ()
    extra: dict[str, DataFrame] = field(default_factory=dict)
    exempt: dict[str, str] = field(default_factory=lambda: {"codebook": "a lookup, checked to be unique when it is read"})
    quarantine: dict[str, DataFrame] = field(default_factory=dict)
    source_rows: dict[str, DataFrame] = field(default_factory=dict)


def from_csv(spark: SparkSession, paths: dict[str, Sequence[str]], multi_line: bool = False, **others) -> Inputs:
    """Inputs whose events, vehicles, counts and casualties, as far as named, are read from files; `others` are the remaining fields."""
    read = {n: files.csv_bronze(spark, p, n, multi_line) for n, p in paths.items()}
    counted = {n: files.csv_source_rows(spark, p, multi_line) for n, p in paths.items()}
    return Inputs(**{n: good for n, (good, _) in read.items()}, **others, quarantine={n: bad for n, (_, bad) in read.items()}, source_rows=counted)


EVENT_RULES = (
    audit.Rule("event_coord", "geom_valid", "easting,northing", "concat_ws(',', coalesce(easting_raw, ''), coalesce(northing_raw, ''))", "no usable coordinate"),
    audit.Rule("event_datetime", "datetime_valid", "date", "date_raw", "no usable date"),
    audit.Rule("event_severity", "severity_valid", "severity", "severity_raw", "no usable severity"),
    audit.Rule("event_time", "time_imputed", "time", "time_raw", "time imputed", warn=True),
)
VEHICLE_RULES = (audit.Rule("vehicle_orphan", "link_valid", "event_id", "event_id", "no such event"),)
CASUALTY_RULES = (
    audit.Rule("casualty_orphan", "link_valid", "event_id", "event_id", "no such event"),
    audit.Rule("casualty_vehicle", "vehicle_valid", "vehicle_reference", "vehicle_key", "no such vehicle"),
    audit.Rule("casualty_severity", "severity_valid", "severity", "severity_raw", "no usable severity"),
)
AREA_RULES = (audit.Rule("area_shape", "geom_valid", "polygons", "cast(size(polygons) as string)", "no valid rings"),)
DAY_RULES = (audit.Rule("holiday_date", "date_valid", "holiday_date", "division", "no usable date"),)
COUNT_RULES = (
    audit.Rule("count_coord", "geom_valid", "easting,northing", "concat_ws(',', coalesce(easting_raw, ''), coalesce(northing_raw, ''))", "outside the envelope"),
    audit.Rule("count_volume", "volume_valid", "volume", "volume_raw", "no usable volume"),
)
EVENTS = audit.SourceSpec(
    "events", "event_id", (audit.Dimension("geom_valid", ("event_coord",)), audit.Dimension("datetime_valid", ("event_datetime",)), audit.Dimension("severity_valid", ("event_severity",)))
)
VEHICLES = audit.SourceSpec("vehicles", "vehicle_key", (audit.Dimension("link_valid", ("vehicle_orphan",)),))
CASUALTIES = audit.SourceSpec(
    "casualties",
    "casualty_key",
    (audit.Dimension("link_valid", ("casualty_orphan",)), audit.Dimension("vehicle_valid", ("casualty_vehicle",)), audit.Dimension("severity_valid", ("casualty_severity",))),
)
AREAS, UPPER = (audit.SourceSpec(n, "area_key", (audit.Dimension("geom_valid", ("area_shape",)),)) for n in ("boundaries", "upper"))
WEATHER = audit.SourceSpec("cubes", "cell_key")
DAYS = audit.SourceSpec("holidays", "day_key", (audit.Dimension("date_valid", ("holiday_date",)),))
COUNTS = audit.SourceSpec("counts", "count_key", (audit.Dimension("geom_valid", ("count_coord",)), audit.Dimension("volume_valid", ("count_volume",))))


INDEX = ("event_id", "collision_index", "accident_index")
YEAR = ("collision_year", "accident_year")
REFERENCE = ("collision_ref_no", "collision_reference", "accident_reference")
#: Columns that are derived below, under any of their names; the manifest's loop leaves them out.
EVENT_COLUMNS = {
    *INDEX, "easting_raw", "northing_raw", "date_raw", "time_raw", "road_name", "easting", "northing", "location_easting_osgr", "location_northing_osgr", "geom_valid",
    "datetime_local", "datetime_valid", "time_imputed", "severity", "severity_raw", "severity_valid", "accident_severity", "collision_severity", "date", "time",
    "lon", "lat",
}
CHILD_COLUMNS = {*INDEX, *YEAR, *REFERENCE, "vehicle_reference", "casualty_reference", "casualty_severity", "severity"}
VOLUMES = ("pedal_cycles", "two_wheeled_motor_vehicles", "cars_and_taxis", "buses_and_coaches", "lgvs", "all_hgvs")
COUNT_TEXTS = ("region_name", "local_authority_name", "road_name", "road_type", "start_junction_road_name", "end_junction_road_name", "estimation_method", "estimation_method_detailed")


def events_silver(raw: DataFrame, missing: dict[str, list[str]], manifest: Sequence[clean.Field] = ()) -> DataFrame:
    """Events with a place, a time and a severity, and the manifest's other columns by their kinds."""
    easting, northing = (clean.first_present(raw, [c, f"location_{c}_osgr"]) for c in ("easting", "northing"))
    return raw.select(
        clean.first_present(raw, INDEX).alias("event_id"),
        easting.alias("easting_raw"),
        northing.alias("northing_raw"),
        F.col("date").alias("date_raw"),
        F.col("time").alias("time_raw"),
        clean.first_present(raw, ["road_name"]).alias("road_name"),
        *clean.sentinel_point(easting, northing),
        *clean.event_time("date", "time"),
        *clean.audited(raw, "severity", ["accident_severity", "collision_severity"], missing.get("severity", ())),
        *clean.broad(raw, manifest, missing, EVENT_COLUMNS),
    )


def child_columns(raw: DataFrame, manifest: Sequence[clean.Field], missing: dict[str, list[str]]) -> list[Column]:
    """Identity of a child row under whichever names its year has, and every other column of the manifest by its kind."""
    return [
        clean.first_present(raw, INDEX).alias("event_id"),
        clean.first_present(raw, YEAR).alias("event_year"),
        clean.first_present(raw, REFERENCE).alias("event_reference"),
        F.col("vehicle_reference"),
        *clean.broad(raw, manifest, missing, CHILD_COLUMNS),
    ]


def vehicles_silver(raw: DataFrame, events: DataFrame, missing: dict[str, list[str]] | None = None, manifest: Sequence[clean.Field] = ()) -> DataFrame:
    own = list(manifest) if any(f.name == "direction_to" for f in manifest) else [*manifest, clean.Field("direction_to", "coded")]
    keyed = raw.select(*child_columns(raw, own, missing or {})).withColumn("vehicle_key", clean.row_key("event_id", "vehicle_reference"))
    return stamps.with_link(keyed, events.select(F.col("event_id").alias("parent")), "event_id", "parent")


def casualties_silver(raw: DataFrame, events: DataFrame, vehicles: DataFrame, missing: dict[str, list[str]], manifest: Sequence[clean.Field] = ()) -> DataFrame:
    """Linked to their event and to the vehicle they were in or hit by."""
    severity = clean.audited(raw, "severity", ["casualty_severity"], missing.get("casualty_severity", ()))
    keyed = raw.select(*child_columns(raw, manifest, missing), "casualty_reference", *severity)
    keyed = keyed.withColumn("vehicle_key", clean.row_key("event_id", "vehicle_reference")).withColumn("casualty_key", clean.row_key("vehicle_key", "casualty_reference"))
    linked = stamps.with_link(keyed, events.select(F.col("event_id").alias("parent")), "event_id", "parent")
    return stamps.with_link(linked, vehicles.select(F.col("vehicle_key").alias("parent")), "vehicle_key", "parent", "vehicle_valid")


def areas_silver(raw: DataFrame) -> DataFrame:
    """Boundaries with their edges, and the faults of their shapes."""
    keyed = raw.withColumn("area_key", clean.row_key("area_code", F.coalesce(F.col("valid_from").cast("string"), F.lit(""))))
    return spatial.boundary_validity(keyed.withColumn("edges", edges_of("polygons")), "area_key")


def areas_used(silver: DataFrame, source_id: str, mode: str, years: Sequence[int]) -> DataFrame:
    """Valid areas of the editions that the build needs."""
    windows = vintages.selected(clean.gold(silver, ["geom_valid"]).withColumn("source_id", F.lit(source_id)), mode, (min(years), max(years)))
    return windows.select("area_code", "valid_from", "valid_to", "edges")


def counts_silver(raw: DataFrame) -> DataFrame:
    """Traffic counts: typed identifiers with their texts, place, and every volume with the text it was read from; volume is the headline, all motor vehicles."""
    have = {c.lower() for c in raw.columns}
    number = lambda c, t: F.col(c).try_cast(t) if c in have else clean.placeholder(t)
    others = [x for v in VOLUMES for x in (clean.first_present(raw, [v]).alias(f"{v}_raw"), number(v, "bigint").alias(v))]
    return raw.select(
        clean.row_key("count_point_id", "year").alias("count_key"),
        F.col("count_point_id").alias("count_point_id_raw"),
        F.col("year").alias("year_raw"),
        F.col("count_point_id").try_cast("int").alias("count_point_id"),
        F.col("year").try_cast("int").alias("year"),
        *(clean.first_present(raw, [c]).alias(c) for c in COUNT_TEXTS),
        number("link_length_km", "double").alias("link_length_km"),
        F.col("easting").alias("easting_raw"),
        F.col("northing").alias("northing_raw"),
        *clean.envelope_point("easting", "northing"),
        *clean.count_field(clean.first_present(raw, ["all_motor_vehicles", "volume"]), "volume"),
        *others,
    )


def weather_silver(cubes: DataFrame) -> DataFrame:
    return weather_cells(files.cube_rows(cubes, ["t2m", "tp"]))


def weather_cells(rows: DataFrame) -> DataFrame:
    return rows.select(
        clean.row_key("lat", "lon", "time_utc").alias("cell_key"),
        clean.grid_index("lat").alias("lat_idx"),
        clean.grid_index("lon").alias("lon_idx"),
        to_local("time_utc").alias("datetime_local"),
        clean.measured("t2m", offset=-273.15).alias("temperature_c"),
        clean.measured("tp", scale=1000.0).alias("precipitation_mm"),
    )


def with_areas(points: DataFrame, layers: dict[str, DataFrame | None], key: str, mode: str, day: Column) -> DataFrame:
    """The code of each layer's area as a column; a layer that is not given leaves its column null."""
    for name, areas in layers.items():
        points = points.withColumn(name, clean.placeholder("string")) if areas is None else spatial.with_area(points, areas, key, name, mode, day)
    return points


def enriched(silver: DataFrame, layers: dict[str, DataFrame | None], weather: DataFrame | None, holidays: DataFrame | None, mode: str) -> DataFrame:
    """All stamps in one plan; each keeps the row count. A source that is not given leaves its columns null."""
    out = with_areas(silver, layers, "event_id", mode, F.col("datetime_local").cast("date"))
    out = grid_to_degrees(out)
    if weather is None:
        out = out.withColumns({c: clean.placeholder("double") for c in ("temperature_c", "precipitation_mm")})
    else:
        out = stamps.with_weather(out, weather, ["temperature_c", "precipitation_mm"])
    exact = F.when(~F.col("time_imputed"), epoch_seconds(to_utc(F.col("datetime_local"))).cast("double"))
    out = solar_position(out.withColumn("epoch_s", exact)).drop("epoch_s")
    if holidays is None:
        return out.withColumn("is_bank_holiday", clean.placeholder("boolean"))
    return stamps.with_holiday(out, holidays, "lad_code", "datetime_local")


LAYERS = {"lad_code": "boundaries", "ctyua_code": "upper"}


def layers_of(context: Context) -> dict[str, DataFrame | None]:
    mode, years = context.parameters["mode"], context.parameters["years"]
    return {column: None if context.silver(n) is None else areas_used(context.silver(n), n, mode, years) for column, n in LAYERS.items()}


def cleaned(manifest: Sequence[clean.Field], *derived: str) -> dict[str, str]:
    """Columns whose completeness is reported: those derived, and the coded and numeric ones of the manifest."""
    return {c: "derived" for c in derived} | {f.name: f.kind for f in sorted(manifest, key=lambda f: f.name) if f.kind in ("coded", "numeric")}


def coded(manifest: Sequence[clean.Field], *derived: str) -> list[str]:
    return [*derived, *sorted(f.name for f in manifest if f.kind == "coded")]


def sources_of(inputs: Inputs) -> list[Source]:
    """The build's sources as declarations: those of the inputs that are given, the user's, and those kept as they are."""
    manifest = inputs.manifest if isinstance(inputs.manifest, dict) else {"events": inputs.manifest}
    own = lambda n: manifest.get(n, ())

    def result(name: str, bronze: DataFrame, silver, **more) -> SourceResult:
        return SourceResult(bronze, silver, quarantine=inputs.quarantine.get(name), **{"source_rows": inputs.source_rows.get(name)} | more)

    def areas(name: str):
        def make(c: Context) -> SourceResult:
            start = f"{min(c.parameters['years'])}-01-01"

            def advice(found: dict) -> list[str]:
                first = found["first_day"]
                late = c.parameters["mode"] == "temporal" and first is not None and str(first) > start
                return [f"{name}: years from {start[:4]}, but the earliest edition begins on {first}"] if late else []

            return result(name, getattr(inputs, name), areas_silver, measured={"first_day": F.min("valid_from")}, advice=advice)

        return make

    def cubes(c: Context) -> SourceResult:
        return result("cubes", files.cube_rows(inputs.cubes, ["t2m", "tp"]), weather_cells, source_rows=inputs.source_rows.get("cubes", files.cube_source_rows(inputs.cubes)))

    def days(c: Context) -> SourceResult:
        keyed = lambda b: b.withColumn("day_key", clean.row_key("division", F.coalesce(F.col("holiday_date").cast("string"), F.lit(""))))
        return result("holidays", inputs.holidays, lambda b: keyed(b).withColumn("date_valid", F.col("holiday_date").isNotNull()))

    def events(c: Context) -> SourceResult:
        fields = own("events")
        silver = lambda b: enriched(events_silver(b, c.missing, fields), layers_of(c), c.silver("cubes"), c.silver("holidays"), c.parameters["mode"])
        derived = ("easting", "northing", "datetime_local", "severity", "lad_code", "ctyua_code", "temperature_c", "precipitation_mm", "solar_elevation", "is_bank_holiday")
        return result("events", inputs.events, silver, cleaned=cleaned(fields, *derived), coded=coded(fields, "severity"))

    def vehicles(c: Context) -> SourceResult:
        fields = own("vehicles")
        silver = lambda b: vehicles_silver(b, c.silver("events"), c.missing, fields)
        return result("vehicles", inputs.vehicles, silver, cleaned={"direction_to": "coded"} | cleaned(fields), coded=sorted({"direction_to", *coded(fields)}))

    def casualties(c: Context) -> SourceResult:
        fields = own("casualties")
        silver = lambda b: casualties_silver(b, c.silver("events"), c.silver("vehicles"), c.missing, fields)
        return result("casualties", inputs.casualties, silver, cleaned=cleaned(fields, "severity"), coded=coded(fields, "severity"))

    def counts(c: Context) -> SourceResult:
        silver = lambda b: with_areas(counts_silver(b), layers_of(c), "count_key", c.parameters["mode"], vintages.mid_year("year"))
        return result("counts", inputs.counts, silver, cleaned={x: "numeric" for x in ("easting", "northing", "link_length_km", "volume", *VOLUMES)})

    stamped = ("boundaries", "upper", "cubes", "holidays")
    declared = [
        Source("boundaries", areas("boundaries"), AREAS, AREA_RULES),
        Source("upper", areas("upper"), UPPER, AREA_RULES),
        Source("cubes", cubes, WEATHER, table="weather"),
        Source("holidays", days, DAYS, DAY_RULES),
        Source("events", events, EVENTS, EVENT_RULES, needs=stamped),
        Source("vehicles", vehicles, VEHICLES, VEHICLE_RULES, needs=("events",)),
        Source("casualties", casualties, CASUALTIES, CASUALTY_RULES, needs=("events", "vehicles")),
        Source("counts", counts, COUNTS, COUNT_RULES, needs=stamped[:2]),
    ]
    kept = dict(inputs.extra) | ({"codebook": inputs.codebook} if inputs.codebook is not None else {})
    as_it_is = lambda df: lambda c: SourceResult(df)
    extras = [Source(n, as_it_is(df), exempt=inputs.exempt.get(n, "")) for n, df in kept.items()]
    return [*(s for s in declared if getattr(inputs, s.source_id) is not None), *inputs.sources, *extras]


def build(spark: SparkSession, inputs: Inputs, path: str, years: Sequence[int], mode: str = "snapshot", ceiling: float | None = None) -> dict[str, DataFrame]:
    """Write, check and publish all tables under `path`; running again gives the same tables, and a run that fails changes none."""
    missing = clean.missing_codes(inputs.codebook) if inputs.codebook is not None else {}
    return contract.run(spark, sources_of(inputs), path, {"years": list(years), "mode": mode}, inputs.codebook, missing, ceiling)


def exposure_rates(tables: dict[str, DataFrame], year: int) -> DataFrame:
    """Events per million vehicle-kilometres by road and area; a pair without traffic counts gives no row."""
    events = clean.gold(tables["events"], ["geom_valid", "datetime_valid"]).filter(F.year("datetime_local") == year)
    events = events.groupBy("road_name", "lad_code").agg(F.count("*").alias("n_events"))
    traffic = clean.gold(tables["counts"], ["geom_valid", "volume_valid"]).filter(F.col("year") == year)
    traffic = traffic.groupBy("road_name", "lad_code").agg(F.sum(F.col("volume") * F.col("link_length_km")).alias("daily_vkm"), F.countDistinct("count_point_id").alias("n_points"))
    rate = F.try_divide(F.col("n_events").cast("double"), F.col("daily_vkm") * 365 / 1e6)
    return traffic.join(events, ["road_name", "lad_code"]).withColumn("rate", rate).orderBy(F.desc("rate"), "road_name", "lad_code")
