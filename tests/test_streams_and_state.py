"""Streams in several micro-batches, their late rows, and bucketed state."""

from pyspark.sql import functions as F

from catalytics.session import scratch_path
from catalytics.sources import events as EV
from catalytics.streaming import events as ST
from catalytics.streaming.state import BucketedState, CatalogState, stream_into

DAY = 86_400_000


def _events(spark, n=120):
    rows = [(i % 5, str(i), ["walk", "eat", None][i % 3], i % 50, 10 + i, str(1_000 * DAY + i * DAY // 7)) for i in range(n)]
    return spark.createDataFrame(rows, EV.SENSOR_SCHEMA)


def _windows(spark, deliveries, build, order=None):
    path, out = scratch_path(spark, "t-in"), scratch_path(spark, "t-out")
    ev = _events(spark)
    EV.deliver(ev, path, deliveries, order, files=1)
    EV.deliver_end(spark, path, 2_000 * DAY)
    ok, _ = EV.ingest_events_stream(spark, path, 1)
    q = ST.run_to_files(build(ok), out, scratch_path(spark, "t-chk"))
    return sorted(map(str, spark.read.parquet(out).collect())), ST.late_rows(q)


def test_one_and_five_batches_agree(spark):
    for build in (lambda s: ST.stream_activity_windows(s, "1 day", None, "1 hour"),
                  lambda s: ST.stream_activity_windows(s, "2 days", "1 day", "1 hour"),
                  lambda s: ST.stream_sessions(s, "6 hours", "1 hour")):
        one, late1 = _windows(spark, 1, build)
        five, late5 = _windows(spark, 5, build)
        assert one == five and one
        assert late1["late"] == late5["late"] == 0
        assert late1["rows_in"] >= 121


def test_disordered_input_counts_its_late_rows(spark):
    rows, late = _windows(spark, 3, lambda s: ST.stream_activity_windows(s, "1 day", None, "1 hour"), [1, 2, 0])
    one, _ = _windows(spark, 1, lambda s: ST.stream_activity_windows(s, "1 day", None, "1 hour"))
    assert late["late"] > 0 and len(rows) < len(one)


def test_two_sinks_hold_every_line_and_rerun_alike(spark):
    path, out = scratch_path(spark, "t-in"), scratch_path(spark, "t-out")
    EV.deliver(_events(spark), path, 3, files=1)
    for _ in range(2):  # a new checkpoint: every batch is run again
        EV.ingest_stream_to(spark, path, out, scratch_path(spark, "t-chk"), 1)
        assert spark.read.parquet(f"{out}/events").count() == 120
        assert spark.read.parquet(f"{out}/rejects").where(F.col("reason") == "malformed").count() == 3


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_bucketed_state_touches_only_named_buckets(spark):
    schema = spark.createDataFrame([], "resource_key string, description string").schema
    state = BucketedState(spark, scratch_path(spark, "t-state"), schema, buckets=8)
    assert _rows(state.read()) == []
    state.start(spark.createDataFrame([(f"r{i}", "old") for i in range(50)], schema))

    def replace(rows, batch):
        return rows.join(batch, "resource_key", "left_anti").unionByName(batch.where(F.col("description") != "gone"))

    batch = spark.createDataFrame([("r1", "new"), ("r2", "gone"), ("x", "new")], schema)
    assert 0 < state.apply(7, batch, replace) <= 3  # ids need not follow each other
    want = sorted([(f"r{i}", "old") for i in range(50) if i not in (1, 2)] + [("r1", "new"), ("x", "new")])
    assert _rows(state.read()) == want
    assert state.apply(7, batch.withColumn("description", F.lit("again")), replace) == 0  # a rerun batch changes nothing
    assert _rows(state.read()) == want
    # a version that was never committed is not read
    spark.createDataFrame([("bad", "bad")], schema).write.parquet(f"{state.path}/v=9/data/bucket=0")
    assert _rows(state.read()) == want
    # buckets can become empty
    everything = state.read().select("resource_key", F.lit("gone").alias("description"))
    state.apply(12, everything, replace)
    assert _rows(state.read()) == []


def test_catalog_state_in_batches_equals_one_batch(spark):
    keys = [f"t{i}" for i in range(6)]
    feed = [(i, "delete" if i % 7 == 0 else "put", (keys + ["missing"])[i % 7], kind, f"v{i % 4}", "size" if kind == "badge" else None)
            for i in range(60) for kind in ("description", "owner", "tag", "badge", "follow")]
    schema = "seq long, op string, resource_key string, kind string, value string, category string"
    resources = spark.createDataFrame([(k,) for k in keys], "key string")
    allowed = spark.createDataFrame([("v1", "size"), ("v2", "size")], "badge_name string, category string")
    frames = {"description": spark.createDataFrame([("t0", "d")], "resource_key string, description string"),
              "owner": spark.createDataFrame([("t1", "v3"), ("t5", "o")], "resource_key string, user_key string"),
              "tag": spark.createDataFrame([("t2", "v0", "default")], "resource_key string, tag string, tag_type string"),
              "badge": spark.createDataFrame([("t3", "v1", "size")], "resource_key string, badge_name string, category string"),
              "follow": spark.createDataFrame([("v2", "t4")], "user_key string, resource_key string")}

    def state():
        return CatalogState(spark, scratch_path(spark, "t-cat"), resources, allowed, ["v9"], buckets=4).start(**frames)

    whole = state()
    whole.apply(0, spark.createDataFrame(feed, schema))
    parts, path, chk = state(), scratch_path(spark, "t-feed"), scratch_path(spark, "t-chk")
    for at in (0, 150):
        spark.createDataFrame(feed[at:at + 150], schema).coalesce(1).write.mode("append").parquet(path)
        stream_into(parts, spark.readStream.schema(schema).parquet(path), chk)
    for kind in frames:
        assert _rows(parts.read(kind)) == _rows(whole.read(kind)) != []
