"""Filter requests as a table, committed snapshots, edges by label, details
in one grouping."""

import pytest
from pyspark.sql import functions as F

from catalytics.operators import details as D
from catalytics.operators import filters as FL
from catalytics.plans import gather_children
from catalytics.session import scratch_path
from catalytics.sources import preview as PV

DOCS = ("key string, database string, cluster string, schema string, name string, description string, "
        "column_names array<string>, column_descriptions array<string>, tags array<string>, badges array<string>")


def test_filter_sets_equal_single_requests(spark):
    docs = spark.createDataFrame(
        [("k1", "hive", "gold", "s1", "orders", "about orders", ["id"], [], ["Red"], []),
         ("k2", "bq", "gold", "s2", "users", None, ["email", "a+b"], ["an ID"], [], ["beta"]),
         ("k3", "bq", None, "S1", "or.ders", "x", [], [], ["red", "blue"], ["Beta", "old"])], DOCS)
    requests = {
        "one": {"database": ["hive", "bq"]}, "two": {"database": ["hive"], "tag": ["red"]}, "wild": {"table": ["*or*d*"]},
        "dot": {"table": ["or.*"]}, "bad": {"schema": ["s1/x"], "tag": ["red"]}, "unknown": {"nothing": ["x"]},
        "half": {"nothing": ["x"], "badges": ["BETA"]}, "empty": {"schema": [""], "tag": ["blue"]}, "case": {"schema": ["s1"]},
        "term": {"term": ["id"]}, "both": {"term": ["ORDERS"], "database": ["hive", "none"]}, "plus": {"column": ["a+b"]}}
    rows = [(q, c, v) for q, f in requests.items() for c, vs in f.items() for v in vs]
    got = {tuple(r) for r in FL.faceted_filter_sets(docs, spark.createDataFrame(rows, "query_id string, category string, value string")).collect()}
    want = set()
    for q, f in requests.items():
        f = dict(f)
        term = f.pop("term", [None])[0]
        want |= {(q, r.key) for r in FL.faceted_filter(docs, f, term).collect()}
    assert got == want and {q for q, _ in got} >= {"one", "wild", "term", "both", "plus", "half"}


def test_failed_publish_leaves_the_old_version(spark):
    path = scratch_path(spark, "t-snap")
    with pytest.raises(ValueError):
        PV.read_current_snapshot(spark, path)
    PV.index_snapshot_publish(spark.createDataFrame([(1,)], "key int"), path, 1)
    fails = spark.range(1).select(F.raise_error(F.lit("no")).cast("int").alias("key"))
    with pytest.raises(Exception, match="no"):
        PV.index_snapshot_publish(fails, path, 2)
    assert [r.key for r in PV.read_current_snapshot(spark, path).collect()] == [1]
    PV.index_snapshot_publish(spark.createDataFrame([(2,)], "key int"), path, 2)  # the failed one again
    assert [r.key for r in PV.read_current_snapshot(spark, path).collect()] == [2]
    with pytest.raises(ValueError):
        PV.index_snapshot_publish(spark.createDataFrame([(3,)], "key int"), path, 2)


def test_edges_are_pruned_by_label(spark):
    path = scratch_path(spark, "t-edges")
    PV.write_edges({"read": spark.createDataFrame([("u", "t", 3)], "src string, dst string, n long"),
                    "owner": spark.createDataFrame([("u", "t"), ("v", "t")], "src string, dst string")}, path)
    df = PV.scan_edges(spark, path, ["owner"])
    assert sorted((r.src, r.n, r.label) for r in df.collect()) == [("u", None, "owner"), ("v", None, "owner")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "label" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert PV.scan_edges(spark, path).count() == 3


def test_gather_children(spark):
    a = spark.createDataFrame([("p", "x"), ("p", "x"), ("p", None), ("q", "z"), ("q", "y")], "k string, c string")
    b = spark.createDataFrame([("p", 3, 2), ("r", 5, None), ("p", 9, 4)], "parent string, ts int, n int")
    out = {r["id"]: r.asDict() for r in gather_children(
        "id", {"cs": (a, "k", "c"), "ns": (b, "parent", F.struct("n"))}, {"ts": (b, "parent", "ts")}, {"total": (b, "parent", "n")}).collect()}
    assert out["p"]["cs"] == ["x"] and out["q"]["cs"] == ["y", "z"] and out["r"]["cs"] is None
    assert [x["n"] for x in out["p"]["ns"]] == [2, 4] and (out["p"]["ts"], out["p"]["total"]) == (9, 6)
    assert out["q"]["ns"] is None and out["q"]["ts"] is None and out["r"]["total"] is None


def test_table_detail_fields(spark):
    t = spark.createDataFrame([("h://c.s/t", "h", "c", "s", "t", "d", True)],
                              "key string, database string, cluster string, schema string, name string, description string, is_view boolean")
    key = "h://c.s/t"
    cols = spark.createDataFrame([(f"{key}/a", key, "a", "int", 0, None)],
                                 "key string, table_key string, name string, col_type string, sort_order int, description string")
    stats = spark.createDataFrame([], "column_key string, stat_type string, stat_val string, start_epoch long, end_epoch long")
    reads = spark.createDataFrame([("u", key, 4)], "user_key string, table_key string, read_count long")
    pairs = "resource_key string, user_key string"
    r = D.table_detail(
        t, cols, stats, reads, spark.createDataFrame([(key, "o")], pairs), spark.createDataFrame([(key, "x", "default"), (key, "y", "badge")],
        "resource_key string, tag string, tag_type string"), spark.createDataFrame([], "resource_key string, badge_name string, category string"),
        spark.createDataFrame([], "table_key string, watermark_type string, partition_key string, partition_value string, create_time string"),
        spark.createDataFrame([(key, "b", "2"), (key, "a", "1"), (key, None, "0")], "resource_key string, source string, text string"),
        column_badges=spark.createDataFrame([(f"{key}/a", "pk", "column")], "resource_key string, badge_name string, category string"),
        writers=spark.createDataFrame([(key, "dag/task", "Airflow", "url", "desc")],
                                      "table_key string, id string, name string, application_url string, description string"),
        updates=spark.createDataFrame([(key, 5), (key, 7)], "table_key string, last_updated_timestamp long"),
        sources=spark.createDataFrame([(key, "github", "link")], "table_key string, source_type string, source string")).collect()[0]
    assert r.is_view and r.last_updated_timestamp == 7 and r.table_writer.id == "dag/task" and r.source.source == "link"
    assert [(d.source, d.text) for d in r.programmatic_descriptions] == [("a", "1"), ("b", "2")]
    assert r.tags == ["x"] and r.owners == ["o"] and r.badges is None and r.columns[0].badges[0].badge_name == "pk"
    assert [(x.user_key, x.read_count) for x in r.table_readers] == [("u", 4)]


def test_value_counts_are_exact_and_complete(spark):
    from catalytics.operators import profile as P

    rows = [(i, "a" if i % 3 == 0 else "b" if i % 3 == 1 else None, i % 40, f"2020-01-0{i % 9 + 1}") for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, x string, k int, d string").withColumn("d", F.to_timestamp("d"))
    got = {(r.column_name, r.value): r.n for r in P.column_value_counts(df, 0.025, ["id", "x", "k"], "d").collect()}
    assert got == {("x", "a"): 2000, ("x", "b"): 2000} | {("k", str(k)): 150 for k in range(40)}
    row = P.column_value_counts(df, 0.3, ["x"], "d").first()
    assert (row.end_epoch - row.start_epoch) == 8 * 86400
    assert P.column_value_counts(df, 0.5, ["id"]).count() == 0
