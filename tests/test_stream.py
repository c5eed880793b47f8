from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.streaming import summary

SCHEMA = "doc_id string, voter string, confidence double, loaded_at timestamp"


def stream(spark, tmp_path):
    rows = [("a", "v", 0.5, datetime(2024, 1, 1, 10)), ("a", "w", 1.0, datetime(2024, 1, 1, 11)), ("b", "v", None, datetime(2024, 1, 1, 12)), ("a", "v", 0.1, datetime(2024, 1, 9))]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))


def test_windows_equal_batch(spark, tmp_path):
    q = summary.watch_cells(stream(spark, tmp_path)).writeStream.outputMode("complete").format("memory").queryName("watched").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {(r.doc_id, r.window_start.day): (r.n_cells, r.n_voters, r.mean_confidence) for r in spark.table("watched").collect()}
    assert got == {("a", 1): (2, 2, 0.75), ("b", 1): (1, 1, None), ("a", 9): (1, 1, 0.1)}


def test_sessions(spark, tmp_path):
    q = summary.watch_sessions(stream(spark, tmp_path), gap="2 hours").writeStream.outputMode("complete").format("memory").queryName("bursts").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r.doc_id, r.n_cells) for r in spark.table("bursts").collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_each_batch(spark, tmp_path):
    q = summary.each_batch(stream(spark, tmp_path), lambda b: b.groupBy("doc_id").agg(F.count("*").alias("n")), str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.doc_id: r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"a": 3, "b": 1}
