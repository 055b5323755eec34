"""Structured Streaming products over the sensor-event and change feeds.

Every stateful operator carries a watermark so its state is bounded; rows
later than the watermark are dropped by Spark. Sinks are files (or
``foreachBatch`` writes) under a checkpoint location in the shared folder,
so a restarted query resumes exactly where it stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_dedup_events(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated event_id within the watermark delay."""
    return stream.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def stream_activity_windows(stream: DataFrame, size: str = "1 hour", slide: str | None = None,
                            delay: str = "10 minutes") -> DataFrame:
    """Tumbling (or sliding) counts and mean sentiment per pet and activity;
    append mode emits each window once the watermark passes its end."""
    w = F.window("event_ts", size, slide) if slide else F.window("event_ts", size)
    return (stream.withWatermark("event_ts", delay)
            .groupBy(w.alias("w"), "pet_id", "event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("event_sentiment").alias("mean_sentiment"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "pet_id", "event_type", "n", F.round("mean_sentiment", 6).alias("mean_sentiment")))


def stream_sessions(stream: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Activity sessions per pet: events closer than ``gap`` join a session."""
    return (stream.withWatermark("event_ts", delay)
            .groupBy(F.session_window("event_ts", gap).alias("s"), "pet_id")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum("event_duration").cast("long").alias("duration"))
            .select("pet_id", F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"), "n_events", "duration"))


def stream_action_usage(stream: DataFrame, size: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Running per-day action counts per (command, user) from the action log
    stream (update mode)."""
    return (stream.withWatermark("action_ts", delay)
            .groupBy(F.window("action_ts", size).alias("w"), "command", "user")
            .agg(F.count(F.lit(1)).alias("n_actions"),
                 F.count_if(F.col("error").isNotNull()).alias("n_errors"))
            .select(F.col("w.start").alias("day"), "command", "user", "n_actions", "n_errors"))


def run_to_files(df: DataFrame, out: str, checkpoint: str, mode: str = "append",
                 fmt: str = "parquet") -> StreamingQuery:
    """Run a streaming frame over everything available now, writing files
    (append) or, for update mode, each micro-batch through foreachBatch
    keyed by batch id (a re-run batch overwrites its own folder:
    idempotent)."""
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        q = w.outputMode("append").format(fmt).option("path", out).start()
    else:
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").format(fmt).save(f"{out}/batch={batch_id}")
        q = w.outputMode(mode).foreachBatch(write_batch).start()
    q.awaitTermination()
    return q


def stream_catalog_changes(changes: DataFrame, apply_fn, state_dir: str, checkpoint: str) -> StreamingQuery:
    """Apply the change feed per micro-batch: ``apply_fn(batch, batch_id,
    state_dir)`` computes the new state from the previous state version and
    the batch and writes it as version ``batch_id``. Re-running a batch id
    rewrites the same version (idempotent)."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        apply_fn(batch, batch_id, state_dir)
    q = (changes.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(on_batch).start())
    q.awaitTermination()
    return q


def late_rows(query: StreamingQuery) -> dict[str, int]:
    """What a finished query's progress says: rows read, and rows (partial
    groups, for an aggregate) that came after the watermark."""
    done = query.recentProgress
    return {"rows_in": sum(p.numInputRows for p in done),
            "late": sum(o.numRowsDroppedByWatermark for p in done for o in p.stateOperators)}
