import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quarry.operators import audit, decode, stamps
from quarry.sources import files

BOOK = "variable string, code string, label string, is_missing boolean"


def test_links_are_never_null(spark):
    parent = spark.createDataFrame([("c1",), (None,)], "k string")
    child = spark.createDataFrame([("c1", 1), ("cX", 1), (None, 2)], "k string, n int")
    linked = stamps.with_link(child.withColumnRenamed("k", "ck"), parent, "ck", "k")
    assert {(r.ck, r.link_valid) for r in linked.collect()} == {("c1", True), ("cX", False), (None, False)}
    assert {r.ck for r in stamps.orphans(child.withColumnRenamed("k", "ck"), parent, "ck", "k").collect()} == {"cX", None}


def test_overwritten_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    match = spark.createDataFrame([(1, "z"), (1, "y"), (3, "q")], "k int, v string")
    assert {(r.k, r.v) for r in stamps.overwritten(df, match, "k", "v").collect()} == {(1, "y"), (2, "b")}


def test_weather_hit_wrong_hour_wrong_cell_imputed(spark):
    grid = spark.createDataFrame([(515, -1, datetime(2023, 6, 1, 13), 15.0), (515, -1, datetime(2023, 6, 1, 13), 14.0)], "lat_idx int, lon_idx int, datetime_local timestamp_ntz, t double")
    pts = spark.createDataFrame(
        [(1, 51.5, -0.1, datetime(2023, 6, 1, 13, 40), False), (2, 51.5, -0.1, datetime(2023, 6, 1, 14), False), (3, 51.6, -0.1, datetime(2023, 6, 1, 13), False), (4, 51.5, -0.1, datetime(2023, 6, 1, 13), True)],
        "id int, lat double, lon double, datetime_local timestamp_ntz, time_imputed boolean",
    )
    assert {r.id: r.t for r in stamps.with_weather(pts, grid, ["t"]).collect()} == {1: 14.0, 2: None, 3: None, 4: None}


def test_holiday_is_true_false_or_unknown(spark):
    hol = spark.createDataFrame([("england-and-wales", date(2023, 4, 10)), ("scotland", date(2023, 1, 2))], "division string, holiday_date date")
    rows = [("A", "E1", date(2023, 4, 10)), ("B", "S1", date(2023, 4, 10)), ("C", "W1", date(2023, 4, 11)), ("D", "X1", date(2023, 4, 10)), ("E", "E1", date(2024, 4, 10)), ("F", "S1", date(2023, 1, 2)), ("G", "E1", None), ("H", None, date(2023, 4, 10))]
    df = spark.createDataFrame(rows, "id string, area string, day date")
    got = {r.id: r.is_bank_holiday for r in stamps.with_holiday(df, hol, "area", "day").collect()}
    assert got == {"A": True, "B": False, "C": False, "D": None, "E": None, "F": True, "G": None, "H": None}


def test_labels_and_undecoded(spark):
    book = spark.createDataFrame([("road", "6", "Single", False), ("road", "9", "Unknown", True)], BOOK)
    df = spark.createDataFrame([(6, 1), (7, None), (None, 2)], "road int, light int")
    rows = decode.labelled(df, book, ["road", "light"])
    assert [r.road_label for r in rows.collect()] == ["Single", None, None] and rows.count() == 3
    assert {(r.variable, r.n_undecoded) for r in decode.undecoded(df, book, ["road", "light"]).collect()} == {("road", 1), ("light", 2)}
    assert decode.labelled(df, book.limit(0), ["road"]).count() == 3


def test_completeness(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (None, None)], "a int, b int")
    assert {r.col: (r.n_present, r.n_missing, round(r.rate, 4)) for r in decode.completeness(df, ["a", "b"], "t").collect()} == {"a": (2, 1, 0.6667), "b": (1, 2, 0.3333)}
    assert {r.rate for r in decode.completeness(df.limit(0), ["a"], "t").collect()} == {0.0}


def silver(spark):
    return spark.createDataFrame([("k1", True, "x"), ("k2", False, None), ("k3", None, "y")], "k string, ok boolean, raw string")


RULES = (audit.Rule("r1", "ok", "c", "raw"),)


def tables(spark, **changes):
    s = silver(spark)
    return audit.SourceTables(**({"bronze": s, "silver": s, "ledger": audit.ledger(s, "src", "k", RULES)} | changes))


def spec(**changes):
    return audit.SourceSpec("src", "k", (audit.Dimension("ok", ("r1",), changes.pop("ceiling", 0.9)),), **changes)


def test_ledger_lists_false_flags_only(spark):
    rows = audit.ledger(silver(spark), "src", "k", RULES).collect()
    assert [(r.source_row_key, r.rule_id, r.severity, r.raw_value) for r in rows] == [("k2", "r1", "reject_dimension", None)]
    assert tuple(audit.ledger(silver(spark), "src", "k", RULES).columns) == audit.LEDGER


def test_all_checks_pass(spark):
    assert len(audit.run_checks([(spec(), tables(spark))])) == 1


@pytest.mark.parametrize(
    "error, change",
    [
        (audit.MissingTable, lambda s: {"silver": None}),
        (audit.MissingColumn, lambda s: {"silver": silver(s).drop("ok")}),
        (audit.ConservationError, lambda s: {"silver": silver(s).limit(2)}),
        (audit.ConservationError, lambda s: {"source_rows": s.range(1).selectExpr("4L as n")}),
        (audit.QuarantineRateError, lambda s: {"quarantine": s.range(1)}),
        (audit.LedgerError, lambda s: {"ledger": audit.ledger(silver(s), "src", "k", RULES).limit(0)}),
    ],
)
def test_each_failure_has_its_error(spark, error, change):
    with pytest.raises(error):
        audit.run_checks([(spec(), tables(spark, **change(spark)))])


def test_reject_rate_and_zero_ceiling(spark):
    with pytest.raises(audit.RejectRateError):
        audit.run_checks([(spec(ceiling=0.1), tables(spark))])
    with pytest.raises(audit.RejectRateError):
        audit.run_checks([(audit.SourceSpec("src", "k", (audit.Dimension("ok", ("r1",)),)), tables(spark))], ceiling=0)
    empty = silver(spark).limit(0)
    audit.run_checks([(spec(ceiling=0.0), tables(spark, bronze=empty, silver=empty, ledger=audit.ledger(empty, "src", "k", RULES)))])


def test_undecided_sources(spark):
    s = lambda *n: spark.createDataFrame([(x,) for x in n], "source_id string")
    ex = spark.createDataFrame([("b", "static"), ("c", " ")], "source_id string, reason string")
    assert [r.source_id for r in audit.undecided(s("a", "b", "c"), s("a"), ex).collect()] == ["c"]


def test_provenance(spark):
    row = audit.provenance(spark, "1.0", 3, {"years": [2023], "a": 1}).first()
    assert json.loads(row.parameters) == {"a": 1, "years": [2023]} and row.parameters.startswith('{"a"')


def test_csv_quarantine_and_counts(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text('id,street,km,lanes\n"k 1","High, St",0.5,2\nk2,"Mill, Ln"\nk2,"Mill, Ln"\n\nk3,Dock Rd,1.25,\n')
    b.write_text("street,toll\nPier,no\nQuay,yes,maybe\n")
    good, bad = files.csv_bronze(spark, [str(a), str(b)], "src")
    assert set(good.columns) == {"id", "street", "km", "lanes", "toll"}
    assert sorted(r.street for r in good.select("street").collect()) == ["Dock Rd", "High, St", "Pier"]  # pruned read
    assert good.count() == 3 and bad.count() == 3
    assert sorted(r.raw_text for r in bad.select("raw_text").collect()) == ["Quay,yes,maybe", 'k2,"Mill, Ln"', 'k2,"Mill, Ln"']
    assert files.csv_source_rows(spark, [str(a), str(b)]).first().source_rows == 6


def test_csv_records_over_lines(spark, tmp_path):
    a = tmp_path / "a.csv"
    a.write_text('id,note\n1,"two\nlines"\n2,one\n3\n')
    good, bad = files.csv_bronze(spark, [str(a)], "src", multi_line=True)
    assert good.count() == 2 and bad.count() == 1
    assert sorted(r.note for r in good.select("note").collect()) == ["one", "two\nlines"]
    assert files.csv_source_rows(spark, [str(a)], multi_line=True).first().source_rows == 3


def test_audit_rows_of_a_source_go_with_the_next_build(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = lambda *ids: spark.createDataFrame([(i, "r") for i in ids], "source_id string, rule string")
    files.write_audit(rows("a", "b", "c"), path, ["a", "b"])
    files.write_audit(rows("a"), path, ["a", "b"])
    assert sorted(r.source_id for r in spark.read.parquet(path).collect()) == ["a", "c"]


def test_geojson(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    feature = lambda kind, c, k: {"type": "Feature", "properties": {"LAD24CD": k, "LAD24NM": "n" + k}, "geometry": {"type": kind, "coordinates": c}}
    p = tmp_path / "a.geojson"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": [feature("Polygon", [ring], "A"), feature("MultiPolygon", [[ring], [ring]], "B")]}))
    rows = {r.area_code: r for r in files.geojson_features(spark, str(p), "LAD24CD", "LAD24NM", "2024").collect()}
    assert rows["A"].area_name == "nA" and len(rows["A"].polygons) == 1 and len(rows["B"].polygons) == 2
    assert rows["A"].polygons[0][0][1].x == 1.0
    assert files.geojson_source_rows(spark, str(p)).first().source_rows == 2


def test_calendar_json(spark):
    text = json.dumps({"scotland": {"division": "scotland", "events": [{"title": "t", "date": "2023-01-02", "notes": "n", "bunting": True}, {"title": "u", "date": "bad"}]}})
    rows = files.calendar_days(files.holidays(spark.createDataFrame([(text,)], "j string"), "j")).orderBy("title").collect()
    assert [(r.holiday_date, r.notes, r.bunting) for r in rows] == [(date(2023, 1, 2), "n", True), (None, "", None)]


def test_cube(spark):
    cube = spark.createDataFrame([([datetime(2023, 1, 1, h) for h in range(2)], [1.0, 2.0], [5.0, 6.0, 7.0], [float(i) for i in range(12)])], "valid_time array<timestamp_ntz>, lats array<double>, lons array<double>, t2m array<double>")
    rows = files.cube_rows(cube, ["t2m"]).collect()
    assert len(rows) == 12 == files.cube_source_rows(cube).first().source_rows
    r = next(r for r in rows if r.t2m == 10.0)
    assert (r.time_utc, r.lat, r.lon) == (datetime(2023, 1, 1, 1), 2.0, 6.0)


def test_lookup_must_be_unique(spark, tmp_path):
    p = tmp_path / "book.csv"
    p.write_text("variable,code,label,is_missing\na,01,x,true\na,1,y,false\n")
    rows = files.lookup(spark, str(p)).collect()
    assert [(r.code, r.is_missing) for r in rows] == [("01", True), ("1", False)]
    p.write_text("variable,code,label,is_missing\na,1,x,true\na,1,y,false\n")
    with pytest.raises(ValueError):
        files.lookup(spark, str(p))


def test_sinks_are_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "source_id string, n int")
    path = str(tmp_path / "audit")
    for _ in range(2):
        files.write_audit(df, path)
    files.write_audit(df.filter("source_id = 'a'").withColumn("n", F.lit(9)), path)
    assert {(r.source_id, r.n) for r in spark.read.parquet(path).collect()} == {("a", 9), ("b", 2)}
    files.write_sorted_csv(df, str(tmp_path / "csv"), ["n"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    grid = spark.createDataFrame([(datetime(2023, 1, 2, 3), 1.0), (datetime(2023, 2, 2, 3), 2.0)], "t timestamp_ntz, v double")
    files.write_months(grid, str(tmp_path / "grid"), "t")
    assert spark.read.parquet(str(tmp_path / "grid")).filter("month = 2").count() == 1


def test_derived_codebook(spark):
    src = spark.createDataFrame([(" Road ", "1", "One"), ("road", "1", "One"), ("road", "x", "No"), ("road", "9", "Unknown"), ("road", "-1", "z")], "variable string, code string, label string")
    rows = decode.derived_codebook(src).collect()
    assert [(r.variable, r.code, r.is_missing) for r in rows] == [("road", "-1", True), ("road", "1", False), ("road", "9", True)]


def test_months_merge_whatever_their_time_axis_is_called(spark, tmp_path):
    day = lambda m, d: datetime(2023, m, d, 6)
    month = lambda name, times, v: spark.createDataFrame([(times, [50.0], [1.0, 2.0], v)], f"{name} array<timestamp_ntz>, lats array<double>, lons array<double>, t double")
    cube = lambda name, times, v: month(name, times, 0.0).withColumn("t", F.array(*(F.lit(x) for x in v)))
    feb, jan = cube("valid_time", [day(2, 3), day(2, 1)], [5.0, 6.0, 7.0, 8.0]), cube("time", [day(1, 9)], [1.0, 2.0])
    for _ in range(2):
        files.merge_months([feb, jan], ["t"], str(tmp_path / "grid"))
    got = spark.read.parquet(str(tmp_path / "grid"))
    assert sorted((r.month, r.time_utc.day, r.lon, r.t) for r in got.collect()) == [(1, 9, 1.0, 1.0), (1, 9, 2.0, 2.0), (2, 1, 1.0, 7.0), (2, 1, 2.0, 8.0), (2, 3, 1.0, 5.0), (2, 3, 2.0, 6.0)]
    in_file = spark.read.parquet(str(tmp_path / "grid" / "year=2023" / "month=2")).coalesce(1).collect()
    assert [r.time_utc for r in in_file] == sorted(r.time_utc for r in in_file)


def cells_of(spark, month, value):
    rows = [(500 + k % 7, -10 + k % 5, datetime(2023, month, 1 + k % 28, k % 24), value + k) for k in range(400)]
    return spark.createDataFrame(rows, "lat_idx int, lon_idx int, datetime_local timestamp_ntz, t double")


def test_a_grid_in_buckets_is_not_moved_and_months_replace_their_own(spark, tmp_path):
    table, path = "grid_of_test", tmp_path / "grid"
    spark.sql(f"drop table if exists {table}")
    january, february = cells_of(spark, 1, 0.0), cells_of(spark, 2, 100.0)
    files.write_grid(january.union(february), table, str(path), 8)
    kept = {f: f.stat().st_mtime_ns for f in path.glob("year=2023/month=1/*.parquet")}
    files.write_grid(cells_of(spark, 2, 900.0), table, str(path), 8)
    assert kept and kept == {f: f.stat().st_mtime_ns for f in path.glob("year=2023/month=1/*.parquet")}
    grid = spark.table(table)
    assert grid.count() == 800 and grid.filter("month = 2").agg(F.min("t")).first()[0] == 900.0
    points = spark.createDataFrame([(k, 50.0 + k % 7 / 10, -1.0 + k % 5 / 10, datetime(2023, 1, 1 + k % 28, k % 24, 31), False) for k in range(60)], "id int, lat double, lon double, datetime_local timestamp_ntz, time_imputed boolean")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stamped = stamps.with_weather(points, grid, ["t"])
        plain = stamps.with_weather(points, january, ["t"])
        moved = [line for line in stamped._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
        assert len(moved) == 1 and "hashpartitioning(_lat" in moved[0]  # the points
        assert sorted((r.id, r.t) for r in stamped.collect()) == sorted((r.id, r.t) for r in plain.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"drop table {table}")


def test_merged_months_leave_others_alone(spark, tmp_path):
    cube = lambda m, v: spark.createDataFrame([([datetime(2023, m, 3)], [50.0], [1.0], [v])], "times array<timestamp_ntz>, lats array<double>, lons array<double>, t array<double>")
    path = str(tmp_path / "grid")
    files.merge_months([cube(1, 1.0), cube(2, 2.0)], ["t"], path)
    kept = {f: f.stat().st_mtime_ns for f in (tmp_path / "grid").glob("year=2023/month=1/*.parquet")}
    files.merge_months([cube(2, 5.0)], ["t"], path)
    assert kept == {f: f.stat().st_mtime_ns for f in (tmp_path / "grid").glob("year=2023/month=1/*.parquet")}
    assert sorted((r.month, r.t) for r in spark.read.parquet(path).collect()) == [(1, 1.0), (2, 5.0)]


def test_a_codebook_without_bound_is_refused(spark):
    book = spark.range(decode.MOST_CODES + 1).select(F.lit("road").alias("variable"), F.col("id").cast("string").alias("code"), F.lit("x").alias("label"), F.lit(False).alias("is_missing"))
    with pytest.raises(Exception, match="codebook of more than"):
        decode.labelled(spark.createDataFrame([(6,)], "road int"), book, ["road"]).collect()
