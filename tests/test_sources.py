"""Files read in many splits: quoted records, places of bad lines, features of one long line."""

import csv
import io
import json
import random

import pytest

from quarry.sources import files, places


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that quotes and brackets lie across many."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k in keys:
        spark.conf.unset(k)


def records(rnd, n):
    pool = ["plain", 'say "so"', "two\nlines", "", "a,b", "\n\n", '"', "back\\slash\\", "x" * 700, "end\r\nmid", "é日"]
    return [[str(i), rnd.choice(pool), rnd.choice(pool)] for i in range(n)]


def test_quoted_records_over_many_splits(small_splits, tmp_path):
    rows = records(random.Random(3), 400)
    out = io.StringIO()
    csv.writer(out, lineterminator="\r\n", quoting=csv.QUOTE_ALL).writerows([["id", "a", "b"], *rows])
    text, bad = out.getvalue().split("\r\n", 201), '"7","only two"'
    path = tmp_path / "a.csv"
    path.write_bytes((out.getvalue() + f"\r\n{bad}\r\n{bad}\r\n").encode())
    lines = files.csv_lines(small_splits, str(path))
    assert lines.select("block").distinct().count() > 30 and len(text) > 1
    good, lost = files.csv_bronze(small_splits, [str(path)], "src", multi_line=True)
    got = sorted(((r.id, r.a or "", r.b or "") for r in good.collect()), key=lambda r: int(r[0]))
    assert got == [tuple(r) for r in rows]
    at = out.getvalue().count("\n") + 2  # after the blank line
    assert sorted((r.raw_text, r.line) for r in lost.collect()) == [(bad, at), (bad, at + 1)]
    assert {r.file.rpartition("/")[2] for r in lost.collect()} == {"a.csv"}
    assert files.csv_source_rows(small_splits, [str(path)], multi_line=True).first().source_rows == 402
    assert "Exchange" not in good.limit(0)._jdf.queryExecution().optimizedPlan().toString()


def test_an_open_quote_takes_the_rest_of_its_file_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,x\n2,"open\n3,y\n')
    (tmp_path / "b.csv").write_text("id,t\n4,z\n")
    good, bad = files.csv_bronze(spark, [str(tmp_path)], "src", multi_line=True)
    assert sorted(r.id for r in good.collect()) == ["1", "4"]
    assert [(r.raw_text.rstrip("\n"), r.line) for r in bad.collect()] == [('2,"open\n3,y', 3)]


def test_lines_keep_their_places_and_header_like_rows_stay(small_splits, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("﻿a,b\r\n" + "".join(f"{i},v\r\n" for i in range(300)) + "a,b\r\n\r\n1\r\n1\r\n" + "2,w\r\n" * 50 + "3,4,5")
    good, bad = files.csv_bronze(small_splits, [str(path)], "src")
    assert good.columns == ["a", "b"] and good.count() == 351
    assert good.filter("a = 'a'").count() == 1  # a row that looks like the header
    assert sorted((r.line, r.raw_text) for r in bad.collect()) == [(304, "1"), (305, "1"), (356, "3,4,5")]
    assert files.csv_source_rows(small_splits, [str(path)]).first().source_rows == 354


def test_files_without_header_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2\n3,4\n")
    (tmp_path / "b.csv").write_text("")
    for multi in (False, True):
        good, bad = files.csv_bronze(spark, [str(tmp_path)], "src", multi, names=["x", "y"])
        assert sorted(r.x for r in good.collect()) == ["1", "3"] and bad.count() == 0
        assert files.csv_source_rows(spark, [str(tmp_path)], multi, header=False).first().source_rows == 2


def collection(n, rnd):
    ring = lambda: [[rnd.random(), rnd.random()] for _ in range(rnd.randrange(4, 30))]
    odd = ['br{ace', 'br}ace', 'quo"te', "back\\", '\\"}', '{"type":"Feature"}', "plain"]

    def feature(k):
        many = k % 3 == 0
        shape = {"type": "MultiPolygon", "coordinates": [[ring()], [ring(), ring()]]} if many else {"type": "Polygon", "coordinates": [ring()]}
        body = {"properties": {"CD": f"A{k}", "NM": rnd.choice(odd)}, "geometry": shape}
        return {"type": "Feature"} | body if k % 2 else body | {"type": "Feature"}

    return {"type": "FeatureCollection", "na{me": 'x{"', "crs": {"type": "name", "properties": {"name": "g}"}}, "features": [feature(k) for k in range(n)]}


@pytest.mark.parametrize("indent", [None, 1])
def test_features_of_one_file_in_many_splits(small_splits, tmp_path, indent):
    rnd = random.Random(indent)
    made = {}
    for name, n in (("a", 60), ("b", 1), ("c", 0)):
        made[name] = collection(n, rnd)
        (tmp_path / f"{name}.geojson").write_text(json.dumps(made[name], indent=indent, ensure_ascii=False) + "\n")
    for name, doc in made.items():
        path = str(tmp_path / f"{name}.geojson")
        got = {r.area_code: r for r in files.geojson_features(small_splits, path, "CD", "NM", "2024").collect()}
        assert len(got) == len(doc["features"]) == files.geojson_source_rows(small_splits, path).first().source_rows
        for f in doc["features"]:
            r, shape = got[f["properties"]["CD"]], f["geometry"]["coordinates"]
            shape = shape if f["geometry"]["type"] == "MultiPolygon" else [shape]
            assert r.area_name == f["properties"]["NM"]
            assert [[[[p.x, p.y] for p in ring] for ring in poly] for poly in r.polygons] == shape
    assert places.placed(small_splits, str(tmp_path / "a.geojson"), "}").select("block").distinct().count() > 20


def test_records_of_several_lines_are_cut_once_for_both_tables(spark, tmp_path):
    path = tmp_path / "cut.csv"
    path.write_text('1,"a\nb"\n2\n3,"c ""d"""\n4,"open\n')
    tables = files.csv_bronze(spark, [str(path)], "cut", multi_line=True, names=["k", "v"], once=True)
    plain = files.csv_bronze(spark, [str(path)], "cut", multi_line=True, names=["k", "v"])
    path.unlink()  # both tables come from what was cut
    good, bad = (t.collect() for t in tables)
    assert sorted((r.k, r.v) for r in good) == [("1", "a\nb"), ("3", 'c "d"')]
    assert sorted((r.raw_text, r.line) for r in bad) == [("2", 3), ('4,"open', 5)]
    assert tables[0].dtypes == plain[0].dtypes and tables[1].dtypes == plain[1].dtypes
