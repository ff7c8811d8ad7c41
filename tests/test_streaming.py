from datetime import date, datetime

from test_problems import SNAP, snap

from layerline.streaming import watch


def test_watched_snapshots_equal_the_batch(spark, tmp_path):
    inbox, sink = str(tmp_path / "in"), str(tmp_path / "out")
    days = {1: [snap(1, "a"), snap(1, "b")], 2: [snap(2, "a", name="m"), snap(2, "c")], 3: [snap(3, "c")]}
    for rows in days.values():
        spark.createDataFrame(rows, SNAP).coalesce(1).write.mode("append").parquet(inbox)
        stream = watch.snapshot_stream(spark, inbox, spark.createDataFrame([], SNAP).schema)
        watch.watch_snapshots(stream, lambda s: s.read.parquet(inbox), sink, str(tmp_path / "cp")).awaitTermination()
    got = sorted((r.snapshot_date, r.id, r.change) for r in spark.read.parquet(sink).collect())
    assert got == [("2026-02-01", "a", "name"), ("2026-02-01", "b", "removed"), ("2026-02-01", "c", "added"), ("2026-03-01", "a", "removed")]
    assert date(2026, 1, 1)


def test_windows_on_a_stream_equal_the_table(spark, tmp_path):
    rows = [(i, datetime(2026, 1, 1, i % 5, i % 60), i % 3, "t", 1.0) for i in range(200)]
    table = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id int, event_type string, value double")
    table.write.parquet(str(tmp_path / "e"))
    stream = watch.windowed_counts(spark.readStream.schema(table.schema).parquet(str(tmp_path / "e")))
    q = stream.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(spark.table("w")) == key(watch.windowed_counts(table))
    assert watch.sessions(table).count() > 0
