import json
from datetime import date, datetime

import pytest

from pyspark.sql import functions as F

from quarry.functions.clean import Field, gold
from quarry.operators import audit
from quarry.plans import build, contract
from quarry.sources import files

EVENT = "accident_index string, easting string, northing string, date string, time string, road_name string, accident_severity string"
AREA = "area_code string, valid_from date, valid_to date, polygons array<array<array<struct<x: double, y: double>>>>"


def inputs(spark, bad_severity=0):
    square = lambda x: [[[(x, 500000.0), (x + 9000, 500000.0), (x + 9000, 540000.0), (x, 540000.0), (x, 500000.0)]]]
    events = [(f"c{i}", str(441000 + i * 100), "529755", "02/01/2023", "12:00" if i % 9 else "", "A1", "9" if i < bad_severity else "3") for i in range(60)]
    events.append(("cx", "-1", "-1", "30/06/2023", "10:30", "A1", "2"))
    cube = [([datetime(2023, 1, 2, 12)], [54.7], [-1.4, -1.3], [280.15, float("nan")], [0.001, 0.002])]
    return build.Inputs(
        events=spark.createDataFrame(events, EVENT),
        vehicles=spark.createDataFrame([(f"c{i % 60}", str(i // 60), "3") for i in range(100)] + [("lost", "1", "9")], "accident_index string, vehicle_reference string, direction_to string"),
        counts=spark.createDataFrame([(str(k), "2023", "A1", "4.0", "442000", "520000", "1000") for k in range(25)] + [("99", "2023", "A1", "1", "", "1", "7")], "count_point_id string, year string, road_name string, link_length_km string, easting string, northing string, volume string"),
        boundaries=spark.createDataFrame([("E01", date(2010, 1, 1), date(2023, 4, 1), square(440000.0)), ("E02", date(2023, 4, 1), None, square(440000.0))], AREA),
        cubes=spark.createDataFrame(cube, "times array<timestamp_ntz>, lats array<double>, lons array<double>, t2m array<double>, tp array<double>"),
        holidays=spark.createDataFrame([("england-and-wales", date(2023, 1, 2)), ("england-and-wales", date(2023, 12, 25))], "division string, holiday_date date"),
        codebook=spark.createDataFrame([("severity", "9", "Unknown", True)], "variable string, code string, label string, is_missing boolean"),
    )


def test_build_is_complete_enriched_and_repeatable(spark, tmp_path):
    for _ in range(2):
        t = build.build(spark, inputs(spark), str(tmp_path), [2023], "temporal", ceiling=0.1)
    rows = {r.event_id: r for r in t["events"].collect()}
    assert len(rows) == 61 == t["events_raw"].count()
    r = rows["c1"]
    assert r.lad_code == "E01" and r.is_bank_holiday is True and r.severity == 3
    assert 5 < r.solar_elevation < 15 and abs(r.solar_azimuth - 178) < 5
    assert abs(r.temperature_c - 7.0) < 1e-6 and abs(r.precipitation_mm - 1.0) < 1e-9
    assert rows["c0"].time_imputed and rows["c0"].temperature_c is None and rows["c0"].solar_elevation is None
    assert rows["cx"].lad_code is None and not rows["cx"].geom_valid
    log = {(x.source_id, x.source_row_key, x.rule_id) for x in t["data_quality_log"].collect()}
    assert ("events", "cx", "event_coord") in log and ("vehicles", "lost|1", "vehicle_orphan") in log and ("counts", "99|2023", "count_coord") in log
    assert t["data_quality_log"].count() == len(log)
    assert gold(t["vehicles"], ["link_valid"]).count() == 100
    assert t["build_meta"].count() == 1 and t["ingest_report"].count() == 6
    complete = {(r.tbl, r.col): (r.n_total, r.n_missing) for r in t["completeness"].collect()}
    assert complete["events", "easting"] == (61, 1) and complete["vehicles", "direction_to"] == (101, 0) and complete["counts", "volume"] == (26, 0)
    rejects = {(r.source_id, r.flag): r.n_rejected for r in t["reject_report"].collect()}
    assert rejects["events", "geom_valid"] == 1 and rejects["vehicles", "link_valid"] == 1
    rates = build.exposure_rates(t, 2023).collect()
    assert [(x.road_name, x.lad_code, x.n_points) for x in rates] == []  # counted in the new edition, events in the old one
    snap = build.build(spark, inputs(spark), str(tmp_path / "snap"), [2023], "snapshot", ceiling=0.1)
    rate = build.exposure_rates(snap, 2023).first()
    assert (rate.lad_code, rate.n_events, rate.n_points) == ("E02", 60, 25)
    assert abs(rate.rate - 60 / (25 * 4000 * 365 / 1e6)) < 1e-9


def test_build_stops_and_leaves_no_provenance(spark, tmp_path):
    with pytest.raises(audit.RejectRateError):
        build.build(spark, inputs(spark, bad_severity=20), str(tmp_path), [2023], "temporal", ceiling=0.1)
    assert contract.published(spark, str(tmp_path)) == {} and not list((tmp_path / "builds").iterdir())


def test_a_rebuild_that_fails_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    first = build.build(spark, inputs(spark), path, [2023], ceiling=0.1)
    meta, name = first["build_meta"].collect(), contract.current(spark, path)
    with pytest.raises(audit.RejectRateError):
        build.build(spark, inputs(spark, bad_severity=20), path, [2023], ceiling=0.1)
    now = contract.published(spark, path)
    assert contract.current(spark, path) == name and now["build_meta"].collect() == meta
    assert now["events"].filter("not severity_valid").count() == 0 == now["data_quality_log"].filter("rule_id = 'event_severity'").count()
    build.build(spark, inputs(spark, bad_severity=2), path, [2023], ceiling=0.1)
    assert contract.current(spark, path) != name and first["events"].count() == 61  # who reads the build before can read on
    assert contract.published(spark, path)["events"].filter("not severity_valid").count() == 2
    build.build(spark, inputs(spark), path, [2023], ceiling=0.1)
    assert len(list((tmp_path / "builds").iterdir())) == contract.KEPT_BUILDS


def signals(spark, rows=40, bad=1):
    """A source that the package knows nothing of."""
    raw = spark.createDataFrame([(str(k), "x" if k < bad else str(k), f"c{k}") for k in range(rows)], "id string, phase string, event string")
    rule = audit.Rule("signal_phase", "phase_valid", "phase", "phase_raw", "no usable phase")
    spec = audit.SourceSpec("signals", "id", (audit.Dimension("phase_valid", ("signal_phase",)),))

    def silver(bronze):
        value = F.col("phase").try_cast("int")
        return bronze.select("id", "event", F.col("phase").alias("phase_raw"), value.alias("phase"), value.isNotNull().alias("phase_valid"))

    def make(context):
        events = context.silver("events")
        near = (lambda b: silver(b).join(events.select(F.col("event_id").alias("event"), "lad_code"), "event", "left")) if events is not None else silver
        return contract.SourceResult(raw, near, source_rows=spark.range(1).select(F.lit(rows).cast("long").alias("n")), cleaned={"phase": "numeric"})

    return contract.Source("signals", make, spec, (rule,), needs=("events",))


def test_a_users_source_is_built_and_audited_like_the_others(spark, tmp_path):
    made = inputs(spark)
    made.sources = [signals(spark)]
    t = build.build(spark, made, str(tmp_path), [2023], ceiling=0.1)
    assert t["signals"].filter("lad_code = 'E02'").count() == 40
    assert [(r.source_row_key, r.raw_value) for r in t["data_quality_log"].filter("source_id = 'signals'").collect()] == [("0", "x")]
    assert {r.source_id: r.source_rows for r in t["ingest_report"].collect()}["signals"] == 40
    assert t["completeness"].filter("tbl = 'signals'").first().n_missing == 1
    made.sources = [signals(spark, bad=20)]
    with pytest.raises(audit.RejectRateError, match="signals"):
        build.build(spark, made, str(tmp_path), [2023], ceiling=0.1)
    good = signals(spark)
    lost = contract.Source("signals", lambda c: contract.SourceResult(good.make(c).bronze, lambda b: good.make(c).silver(b).limit(5)), good.spec, good.rules)
    with pytest.raises(audit.ConservationError, match="signals"):
        contract.run(spark, [lost], str(tmp_path / "alone"), ceiling=0.1)


def test_counts_come_from_the_passes_that_write(spark, tmp_path):
    source = signals(spark)
    plain = contract.Source("signals", lambda c: contract.SourceResult(source.make(c).bronze, source.make(c).silver, cleaned={"phase": "numeric"}), source.spec)
    context = contract.Context(spark, {})
    spark.sparkContext.setJobGroup("observed", "one source")
    _, counts, _ = contract.build_source(plain, context, str(tmp_path / "one"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("observed")
    spark.sparkContext.setJobGroup("", "")
    assert (counts.bronze, counts.silver["n"], counts.silver["rejected_phase_valid"], counts.silver["present_phase"]) == (40, 40, 1, 39)
    reads = 2  # each table read back looks at one file's footer for its columns
    assert len(jobs) <= 2 + reads


def test_sources_declared_wrongly(spark, tmp_path):
    s = signals(spark)
    with pytest.raises(ValueError, match="twice"):
        contract.run(spark, [s, s], str(tmp_path))
    with pytest.raises(audit.MissingColumn):
        bare = contract.Source("signals", lambda c: contract.SourceResult(s.make(c).bronze, lambda b: b.drop("phase")), s.spec)
        contract.run(spark, [bare], str(tmp_path))


MANIFEST = """table,column,kind,dtype
events,road_type,coded,INTEGER
events,longitude,numeric,DOUBLE
events,gone,coded,INTEGER
vehicles,vehicle_type,coded,INTEGER
vehicles,age_of_driver,numeric,
vehicles,generic_make_model,text,
casualties,sex_of_casualty,coded,INTEGER
casualties,age_of_casualty,numeric,INTEGER
"""


def test_all_tables_are_cleaned_labelled_and_reported_by_manifest(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MANIFEST)
    made = inputs(spark)
    made.manifest = files.manifest(spark, str(tmp_path / "m.csv"))
    assert [f.type for f in made.manifest["vehicles"]] == ["string", "int", "string"]
    made.events = made.events.withColumns({"road_type": F.lit("6"), "longitude": F.lit("-1.25")})
    extra = {"vehicle_type": F.lit("9"), "age_of_driver": F.when(F.col("vehicle_reference") == "0", "-1").otherwise("44"), "generic_make_model": F.lit("-1"), "collision_year": F.lit("2023"), "collision_ref_no": F.lit("r")}
    made.vehicles = made.vehicles.withColumns(extra)
    made.casualties = spark.createDataFrame([(f"c{i}", "0", "1", "3", "1", "x" if i else "30") for i in range(60)], "accident_index string, vehicle_reference string, casualty_reference string, casualty_severity string, sex_of_casualty string, age_of_casualty string")
    book = [("vehicle_type", "9", "Car", False), ("sex_of_casualty", "1", "Male", False), ("road_type", "1", "Roundabout", False), ("direction_to", "3", "East", False)]
    made.codebook = made.codebook.union(spark.createDataFrame(book, made.codebook.schema))
    with pytest.warns(UserWarning, match="events.road_type=61"):
        t = build.build(spark, made, str(tmp_path / "a"), [2023], ceiling=0.1)
    v = t["vehicles_labelled"].filter("vehicle_key = 'c1|0'").first()
    assert (v.vehicle_type_label, v.direction_to_label, v.age_of_driver, v.generic_make_model, v.event_year, v.event_reference) == ("Car", "East", None, "-1", "2023", "r")
    c = t["casualties_labelled"].filter("casualty_key = 'c0|0|1'").first()
    assert (c.sex_of_casualty_label, c.age_of_casualty, c.severity) == ("Male", 30, 3)
    e = t["events"].first()
    assert (e.road_type, e.longitude, e.gone) == (6, -1.25, None)
    complete = {(r.tbl, r.col): (r.kind, r.n_missing) for r in t["completeness"].collect()}
    assert complete["vehicles", "age_of_driver"] == ("numeric", 60) and complete["casualties", "age_of_casualty"] == ("numeric", 59) and complete["events", "gone"] == ("coded", 61)
    assert {(r.tbl, r.variable): r.n_undecoded for r in t["undecoded"].collect()}["events", "road_type"] == 61
    assert not list((tmp_path / "a").glob("builds/*/*_labelled"))  # labels are decoded when read, not stored
    (tmp_path / "m.csv").write_text("table,column,kind,dtype\na,x,coded,\na,X,text,\n")
    with pytest.raises(ValueError, match="twice"):
        files.manifest(spark, str(tmp_path / "m.csv"))


def test_traffic_counts_keep_every_volume_with_its_text(spark):
    columns = ["count_point_id", "year", "road_name", "easting", "northing", "link_length_km", "all_motor_vehicles", "pedal_cycles", "LGVs", "region_name"]
    raw = spark.createDataFrame([("7", "2023", "A1", "1", "2", "1.5", "100", "x", "3", "North"), ("y", "2023", "A1", "1", "2", "", "-4", "", "", None)], ", ".join(f"{c} string" for c in columns))
    a, b = build.counts_silver(raw).collect()
    assert (a.count_key, a.count_point_id, a.volume_raw, a.volume, a.volume_valid, a.pedal_cycles_raw, a.pedal_cycles, a.lgvs, a.all_hgvs, a.region_name, a.road_type) == ("7|2023", 7, "100", 100, True, "x", None, 3, None, "North", None)
    assert (b.count_key, b.count_point_id, b.count_point_id_raw, b.volume, b.volume_valid, b.link_length_km) == ("y|2023", None, "y", -4, False, None)


def test_years_before_all_editions_are_warned_of(spark, tmp_path):
    made = inputs(spark)
    with pytest.warns(UserWarning, match="boundaries: years from 2009, but the earliest edition begins on 2010-01-01"):
        build.build(spark, made, str(tmp_path), [2009, 2023], "temporal", ceiling=0.1)


def test_registry_of_editions(spark, tmp_path):
    edition = lambda label, day: {"label": label, "source_file": f"{label}.geojson", "code_col": "CD", "name_col": "NM", "valid_from": day}
    (tmp_path / "e.json").write_text(json.dumps({"lad": [edition("b", "2021-04-01"), edition("a", "2019-04-01")], "upper": [edition("u", "2020-01-01")]}, indent=1))
    rows = {(r.source_id, r.label): r.valid_to for r in files.editions(spark, str(tmp_path / "e.json")).collect()}
    assert rows == {("lad", "a"): date(2021, 4, 1), ("lad", "b"): None, ("upper", "u"): None}


def test_build_from_files_stops_at_lost_and_malformed_lines(spark, tmp_path):
    frames = inputs(spark)
    paths = {}
    for name in ("events", "vehicles", "counts"):
        df = getattr(frames, name)
        lines = [",".join(df.columns), *(",".join(r) for r in df.collect())]
        paths[name] = tmp_path / f"{name}.csv"
        paths[name].write_text("\n".join(lines) + "\n")
    made = lambda **x: build.from_csv(spark, {n: [str(p)] for n, p in paths.items()}, boundaries=frames.boundaries, codebook=frames.codebook, **x)
    t = build.build(spark, made(), str(tmp_path / "good"), [2023], ceiling=0.1)
    assert t["events"].count() == 61 and t["events_quarantine"].count() == 0
    lost = made()
    lost.events = lost.events.filter("accident_index <> 'c5'")  # a row that vanishes between the file and bronze
    with pytest.raises(audit.ConservationError):
        build.build(spark, lost, str(tmp_path / "lost"), [2023], ceiling=0.1)
    paths["events"].write_text(paths["events"].read_text() + "c98,1\nc99,2\n")
    with pytest.raises(audit.QuarantineRateError):
        build.build(spark, made(), str(tmp_path / "bad"), [2023], ceiling=0.1)


def test_build_audits_every_source(spark, tmp_path):
    made = inputs(spark)
    made.upper = made.boundaries.filter("valid_to is not null").replace({"E01": "E10"}, subset=["area_code"])
    made.casualties = spark.createDataFrame(
        [(f"c{i}", "0", "1", "3") for i in range(60)] + [("c1", "7", "2", "3"), ("lost", "1", "1", "x")],
        "accident_index string, vehicle_reference string, casualty_reference string, casualty_severity string",
    )
    made.events = made.events.withColumn("road_type", F.lit("6")).withColumn("speed", F.lit("40"))
    made.manifest = [Field("road_type", "coded"), Field("speed", "numeric", "int")]
    made.codebook = made.codebook.union(spark.createDataFrame([("road_type", "6", "Single carriageway", False)], made.codebook.schema))
    t = build.build(spark, made, str(tmp_path / "a"), [2023], "temporal", ceiling=0.1)
    c = {r.casualty_key: (r.link_valid, r.vehicle_valid, r.severity_valid) for r in t["casualties"].collect()}
    assert c["c1|0|1"] == (True, True, True) and c["c1|7|2"] == (True, False, True) and c["lost|1|1"] == (False, True, False)
    log = {(x.source_id, x.source_row_key, x.rule_id) for x in t["data_quality_log"].filter("source_id = 'casualties'").collect()}
    assert log == {("casualties", "c1|7|2", "casualty_vehicle"), ("casualties", "lost|1|1", "casualty_orphan"), ("casualties", "lost|1|1", "casualty_severity")}
    e = t["events_labelled"].filter("event_id = 'c1'").first()
    assert (e.lad_code, e.ctyua_code, e.speed, e.road_type_label) == ("E01", "E10", 40, "Single carriageway")
    report = {r.source_id: r for r in t["ingest_report"].collect()}
    assert set(report) == {"events", "vehicles", "casualties", "counts", "boundaries", "upper", "cubes", "holidays"}
    assert report["cubes"].source_rows == 2 == report["cubes"].silver_rows
    assert t["weather"].count() == 2


def test_build_stops_at_a_source_nobody_decided_on(spark, tmp_path):
    made = inputs(spark)
    made.extra = {"signals": spark.range(3)}
    with pytest.raises(audit.CoverageError, match="signals"):
        build.build(spark, made, str(tmp_path / "a"), [2023], ceiling=0.1)
    assert contract.published(spark, str(tmp_path / "a")) == {}
    made.exempt = made.exempt | {"signals": "kept as read"}
    assert build.build(spark, made, str(tmp_path / "b"), [2023], ceiling=0.1)["signals_raw"].count() == 3


def test_invalid_boundaries_are_logged_and_stamp_nothing(spark, tmp_path):
    made = inputs(spark)
    bow = [[[(440000.0, 500000.0), (449000.0, 540000.0), (449000.0, 500000.0), (440000.0, 540000.0), (440000.0, 500000.0)]]]
    made.boundaries = made.boundaries.union(spark.createDataFrame([("A00", date(2010, 1, 1), None, bow)], AREA))
    t = build.build(spark, made, str(tmp_path), [2023], "snapshot", ceiling=0.5)
    assert {r.lad_code for r in t["events"].collect()} == {"E02", None}
    assert [r.source_row_key for r in t["data_quality_log"].filter("source_id = 'boundaries'").collect()] == ["A00|2010-01-01"]
