"""Streams: new snapshots as they arrive, and windowed counts of an event stream with late data.

The batch operators do the work; a stream only decides when they run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.snapshots import snapshot_changes


def snapshot_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Parquet snapshots that arrive in a folder, one file at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def watch_snapshots(stream: DataFrame, history: Callable[[SparkSession], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch's builds are compared with their history; the changes that end at the batch's dates are appended to ``sink``."""

    def changes(batch: DataFrame, number: int) -> None:
        fresh = batch.select(F.col("build_id").alias("__b"), F.col("snapshot_date").alias("__d")).distinct()
        known = history(batch.sparkSession)
        touched = known.join(fresh.select("__b").distinct(), F.col("build_id").eqNullSafe(F.col("__b")), "left_semi")
        found = snapshot_changes(touched)
        ends = F.col("build_id").eqNullSafe(F.col("__b")) & (F.col("snapshot_date") == F.date_format("__d", "yyyy-MM-dd"))
        found.join(fresh, ends, "left_semi").withColumn("batch", F.lit(number)).write.mode("append").parquet(sink)

    return stream.writeStream.foreachBatch(changes).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str = "ts", key: str = "event_type", size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per tumbling window and key; works on a stream and on a table alike."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp"))
    timed = timed.withWatermark("__ts", late) if events.isStreaming else timed
    out = timed.groupBy(F.window("__ts", size).alias("w"), key).agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return out.select(F.col("w.start").alias("window_start"), key, "events", "value")


def sessions(events: DataFrame, ts: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Events per session: runs of one key whose events are less than ``gap`` apart."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp"))
    timed = timed.withWatermark("__ts", late) if events.isStreaming else timed
    out = timed.groupBy(F.session_window("__ts", gap).alias("w"), key).agg(F.count("*").alias("events"))
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "events")
