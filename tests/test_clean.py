from datetime import datetime

from pyspark.sql import functions as F

from quarry.functions import clean
from quarry.functions.civil_time import to_local, to_utc
from quarry.functions.clean import Field


def test_sentinels_and_bad_dates_keep_their_rows(spark):
    raw = spark.createDataFrame(
        [("c1", "450000", "530000", "02/01/2023", "14:55"), ("c2", "-1", "-1", "3/9/2023", ""), ("c3", "450000", "530000", "not-a-date", "10:00")],
        "id string, e string, n string, d string, t string",
    )
    got = {r.id: r for r in raw.select("id", *clean.sentinel_point("e", "n"), *clean.event_time("d", "t")).collect()}
    assert (got["c1"].geom_valid, got["c1"].datetime_local, got["c1"].time_imputed) == (True, datetime(2023, 1, 2, 14, 55), False)
    assert (got["c2"].geom_valid, got["c2"].easting) == (False, None)
    assert (got["c2"].datetime_local, got["c2"].datetime_valid, got["c2"].time_imputed) == (datetime(2023, 9, 3), True, True)
    assert (got["c3"].datetime_local, got["c3"].datetime_valid, got["c3"].time_imputed) == (None, False, False)


def test_time_in_a_gap_of_the_session_zone(spark):
    raw = spark.createDataFrame([("12/03/2023", "02:30")], "d string, t string")
    assert raw.select(*clean.event_time("d", "t")).first().datetime_local == datetime(2023, 3, 12, 2, 30)


def test_coded_numeric_and_lenient(spark):
    raw = spark.createDataFrame([("6", "4.7"), ("9", " 5 "), ("x", ""), ("-1", "-1"), (None, None)], "c string, n string")
    rows = raw.select(clean.coded("c", ["9"]).alias("c"), clean.numeric("n").alias("n"), clean.lenient_int("n").alias("l")).collect()
    assert [r.c for r in rows] == [6, None, None, None, None]
    assert [r.n for r in rows] == [None, 5, None, None, None]
    assert [r.l for r in rows] == [5, 5, None, -1, None]


def test_audited_triple_and_absent_column(spark):
    raw = spark.createDataFrame([("2",), ("-1",), ("9",), ("x",)], "accident_severity string")
    rows = raw.select(*clean.audited(raw, "severity", ["accident_severity"], ["9"])).collect()
    assert [r.severity_valid for r in rows] == [True, False, False, False]
    assert [r.severity_raw for r in rows] == ["2", "-1", "9", "x"]
    row = raw.select(*clean.audited(raw, "light")).first()
    assert (row.light_raw, row.light, row.light_valid) == (None, None, True)


def test_broad_projection_is_stable(spark):
    raw = spark.createDataFrame([("1", "7")], "B string, a string")
    manifest = [Field("b", "coded"), Field("a", "numeric", "int"), Field("z", "coded"), Field("y", "numeric", "double")]
    df = raw.select(*clean.broad(raw, manifest, exclude=["y"]))
    assert df.columns == ["a", "b", "z"] and df.dtypes[2] == ("z", "int")


def test_counts_and_envelope(spark):
    raw = spark.createDataFrame([("1", "2", "5"), ("", "2", "x"), ("700000", "1300001", "-5"), ("700000", "1300000", None)], "e string, n string, v string")
    rows = raw.select(*clean.envelope_point("e", "n"), *clean.count_field("v", "v")).collect()
    assert [r.geom_valid for r in rows] == [True, False, False, True]
    assert [(r.v, r.v_valid) for r in rows] == [(5, True), (None, False), (-5, False), (None, False)]


def test_gold(spark):
    df = spark.createDataFrame([(1, True, True), (2, True, None), (3, False, True)], "k int, a boolean, b boolean")
    assert [r.k for r in clean.gold(df, ["a", "b"]).collect()] == [1]
    assert clean.gold(df, []).count() == 3


def test_row_key_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("a", "1"), ("b", None)], "x string, y string")
    assert [r[0] for r in df.select(clean.row_key("x", "y")).collect()] == ["a|1", None]


def test_angles(spark):
    row = spark.range(1).select(clean.angle_between(F.lit(350), F.lit(10)).alias("d"), clean.bearing(F.lit(3)).alias("b"), clean.bearing(F.lit(0)).alias("n")).first()
    assert (row.d, row.b, row.n) == (20, 135, None)


def test_measured(spark):
    df = spark.createDataFrame([(288.15,), (float("nan"),), (None,)], "t double")
    assert [None if r[0] is None else round(r[0], 6) for r in df.select(clean.measured("t", offset=-273.15)).collect()] == [15.0, None, None]


def test_civil_time(spark):
    cases = [(datetime(2023, 10, 29, 1, 30), datetime(2023, 10, 29, 1, 30)), (datetime(2023, 6, 21, 13), datetime(2023, 6, 21, 12)), (datetime(2023, 1, 5, 8), datetime(2023, 1, 5, 8))]
    df = spark.createDataFrame(cases, "l timestamp_ntz, u timestamp_ntz")
    rows = df.select("l", "u", to_utc(F.col("l")).alias("got"), to_local("u").alias("back")).collect()
    assert all(r.got == r.u and r.back == r.l for r in rows)


def test_missing_codes(spark):
    book = spark.createDataFrame([("a", "9", "x", True), ("a", "1", "y", False), ("b", "-1", "z", True)], "variable string, code string, label string, is_missing boolean")
    assert clean.missing_codes(book) == {"a": ["9"], "b": ["-1"]}
