from quarry.functions import clean
from quarry.operators.audit import Rule
from quarry.streaming.cleaning import audited_stream


def test_stream_keeps_rows_and_ledger(spark, tmp_path):
    source = str(tmp_path / "in")
    for part, rows in enumerate(([("a", "1"), ("b", "x")], [("c", "-1")])):
        spark.createDataFrame(rows, "k string, v string").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("k string, v string").option("maxFilesPerTrigger", 1).parquet(source)
    cleaned = lambda df: df.select("k", *clean.count_field("v", "v"))
    writer = audited_stream(stream, cleaned, "src", "k", [Rule("count", "v_valid", "v", "v_raw")], str(tmp_path / "silver"), str(tmp_path / "ledger"))
    query = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "silver")).collect()) == ["a", "b", "c"]
    assert sorted(r.source_row_key for r in spark.read.parquet(str(tmp_path / "ledger")).collect()) == ["b", "c"]
