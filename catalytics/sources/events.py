"""Event ingestion: JSON-lines sensor events, batch and streaming.

Explicit schema (no inference), PERMISSIVE parsing with a corrupt-record
column, epoch-millis string -> timestamp. Malformed lines and rows whose
time does not parse go to a reject frame instead of failing the job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENSOR_SCHEMA = T.StructType([
    T.StructField("pet_id", T.IntegerType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_sentiment", T.IntegerType()),
    T.StructField("event_duration", T.IntegerType()),
    T.StructField("event_date_time", T.StringType()),
])
_BAD = "_bad_record"


def _reader(spark: SparkSession, schema: T.StructType):
    s = T.StructType(schema.fields + [T.StructField(_BAD, T.StringType())])
    return (spark.read.schema(s).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _BAD))


def _split(raw: DataFrame):
    ts = F.timestamp_millis(F.col("event_date_time").try_cast("long"))
    parsed = raw.withColumn("event_ts", ts)
    ok = parsed.where(F.col(_BAD).isNull() & F.col("event_ts").isNotNull()).drop(_BAD)
    bad = parsed.where(F.col(_BAD).isNotNull() | F.col("event_ts").isNull()).select(
        F.coalesce(F.col(_BAD), F.to_json(F.struct(*[c for c in SENSOR_SCHEMA.fieldNames()])))
        .alias("record"),
        F.when(F.col(_BAD).isNotNull(), F.lit("malformed")).otherwise(F.lit("bad time")).alias("reason"))
    return ok, bad


def ingest_events_batch(spark: SparkSession, path: str):
    """(events, rejects) from JSON lines at ``path``."""
    return _split(_reader(spark, SENSOR_SCHEMA).json(path))


def ingest_events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None):
    """Streaming events from a folder of JSON-lines files (a Kafka source is
    the same plan with ``from_json(value)``). Returns (events, rejects)."""
    s = T.StructType(SENSOR_SCHEMA.fields + [T.StructField(_BAD, T.StringType())])
    r = (spark.readStream.schema(s).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", _BAD))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _split(r.json(path))


def ingest_stream_to(spark: SparkSession, path: str, out: str, checkpoint: str,
                     max_files_per_trigger: int | None = None) -> None:
    """One stream, two sinks: the good rows and the rejects of each
    micro-batch go to ``out/events`` and ``out/rejects``, in a folder named by
    the batch id, so a batch that is run again replaces its own rows."""
    s = T.StructType(SENSOR_SCHEMA.fields + [T.StructField(_BAD, T.StringType())])
    r = (spark.readStream.schema(s).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", _BAD))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def both(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for name, rows in zip(("events", "rejects"), _split(batch)):
            rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")
        batch.unpersist()

    q = (r.json(path).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(both).start())
    q.awaitTermination()


def sensor_json_lines(sensor_events: DataFrame, broken_every: int = 50) -> DataFrame:
    """Sensor events as JSON lines, all of them; beside them a truncated
    (malformed) line for every ``broken_every``-th event id."""
    j = F.to_json(F.struct(*SENSOR_SCHEMA.fieldNames()))
    broken = F.col("event_id").cast("long") % broken_every == 0
    lines = F.when(broken, F.array(j, F.substring(j, 1, 20))).otherwise(F.array(j))
    return sensor_events.select(F.explode(lines).alias("value"))


def deliver(sensor_events: DataFrame, path: str, deliveries: int = 1, order: list[int] | None = None,
            files: int = 2) -> None:
    """Write sensor events as JSON lines in ``deliveries`` appended parts, the
    k-th holding the k-th of as many equal spans of event time (or the spans
    in ``order``). Each part has ``files`` files, so a stream that takes that
    many files per trigger reads one part per micro-batch, in turn."""
    at = F.col("event_date_time").cast("long")
    span = sensor_events.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    if span["lo"] is None:
        sensor_json_lines(sensor_events).write.mode("append").text(path)
        return
    width = (span["hi"] - span["lo"]) // deliveries + 1
    for k in order or range(deliveries):
        part = sensor_events.where(F.floor((at - F.lit(span["lo"])) / F.lit(width)) == k)
        sensor_json_lines(part).repartition(files).write.mode("append").text(path)


def deliver_end(spark: SparkSession, path: str, at_ms: int) -> None:
    """Append the end marker of a finite input: one event far enough ahead to
    carry the watermark past every open window. Its own window stays open, so
    no windowed result holds it; it has no pet and the id ``end``."""
    line = f'{{"event_id":"end","event_date_time":"{at_ms}"}}'
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)
