"""Streaming restart behaviour, request-sized personal popularity and a
hand-computed BM25 score."""

import math

from pyspark.sql import functions as F

from catalytics.operators import changes as C
from catalytics.operators import search as S
from catalytics.operators import usage as U
from catalytics.session import scratch_path
from catalytics.streaming import events as ST


def test_change_stream_resumes_and_is_idempotent(spark):
    res = spark.createDataFrame([("t1",), ("t2",)], "key string")
    schema = "seq long, op string, resource_key string, kind string, value string, category string"
    feed = scratch_path(spark, "test-feed")
    state = scratch_path(spark, "test-state")
    chk = scratch_path(spark, "test-chk")
    spark.createDataFrame([("t1", "a")], "resource_key string, description string").write.parquet(f"{state}/v=-1")

    def apply(batch, batch_id, state_dir):
        prev = batch.sparkSession.read.parquet(f"{state_dir}/v={batch_id - 1}")
        new, _ = C.apply_descriptions(prev, batch, res)
        new.write.mode("overwrite").parquet(f"{state_dir}/v={batch_id}")

    spark.createDataFrame([(1, "put", "t1", "description", "b", None)], schema).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(schema).parquet(feed)
    ST.stream_catalog_changes(stream, apply, state, chk)
    # second run with the same checkpoint: only the new file is processed
    spark.createDataFrame([(2, "put", "t2", "description", "c", None)], schema).write.mode("append").parquet(feed)
    ST.stream_catalog_changes(spark.readStream.schema(schema).parquet(feed), apply, state, chk)
    final = {tuple(r) for r in spark.read.parquet(f"{state}/v=1").collect()}
    assert final == {("t1", "b"), ("t2", "c")}
    # a third run with nothing new leaves the state untouched
    ST.stream_catalog_changes(spark.readStream.schema(schema).parquet(feed), apply, state, chk)
    assert {tuple(r) for r in spark.read.parquet(f"{state}/v=1").collect()} == final


def test_personal_popular_for_requesting_users_equals_full_run(spark):
    rows = [(f"u{u}", f"t{t}", 1 + (u * 3 + t) % 4) for u in range(15) for t in range(10) if (u * t + u) % 4 != 1]
    reads = spark.createDataFrame(rows, "user_key string, table_key string, read_count long")
    tables = spark.createDataFrame([(f"t{t}",) for t in range(10)], "key string")
    full = U.personal_popular_tables(reads, tables, n=3, min_readers=2)
    asking = spark.createDataFrame([("u1",), ("u7",)], "user_key string")
    part = U.personal_popular_tables(reads, tables, n=3, min_readers=2, users=asking)
    want = {tuple(r) for r in full.where(F.col("user_key").isin("u1", "u7")).collect()}
    assert {tuple(r) for r in part.collect()} == want and want


def test_bm25_single_field_by_hand(spark):
    docs = spark.createDataFrame([("d1", "red ring red", 0), ("d2", "blue ring", 0), ("d3", "green box", 0)],
                                 "key string, description string, total_usage long")
    idx = S.build_inverted_index(docs, ["description"])
    q = spark.createDataFrame([("q", "red")], "query_id string, query string")
    hits = S.search_tables(idx, docs, q, n=5, boosts={"description": 1.0}).collect()
    assert [h.doc_key for h in hits] == ["d1"]
    n, df, tf, dl, avgdl = 3, 1, 2, 3, (3 + 2 + 2) / 3
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    expect = idf * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl)) * math.log10(2)
    assert abs(hits[0].score - round(expect, 6)) < 1e-6


def test_windows_drop_rows_later_than_the_watermark(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("pet_id", T.IntegerType()), T.StructField("event_type", T.StringType()),
                           T.StructField("event_sentiment", T.IntegerType()),
                           T.StructField("event_ts", T.TimestampType())])
    src, out, chk = (scratch_path(spark, n) for n in ("late-src", "late-out", "late-chk"))

    def add(rows):
        spark.createDataFrame(rows, "pet_id int, event_type string, event_sentiment int, event_ts string") \
            .selectExpr("pet_id", "event_type", "event_sentiment", "cast(event_ts as timestamp) as event_ts") \
            .write.mode("append").parquet(src)

    def run():
        s = spark.readStream.schema(schema).parquet(src)
        ST.run_to_files(ST.stream_activity_windows(s, "1 hour", None, "10 minutes"), out, chk)

    add([(1, "walk", 10, "2024-01-01 00:10:00"), (1, "walk", 20, "2024-01-01 02:30:00")])
    run()   # watermark -> 02:20: window [00:00, 01:00) is final
    add([(1, "walk", 99, "2024-01-01 00:20:00"),   # later than the watermark: dropped
         (1, "walk", 30, "2024-01-01 05:00:00")])
    run()   # watermark -> 04:50: window [02:00, 03:00) is final
    got = {(str(r.window_start), r.n, r.mean_sentiment) for r in spark.read.parquet(out).collect()}
    assert got == {("2024-01-01 00:00:00", 1, 10.0), ("2024-01-01 02:00:00", 1, 20.0)}
