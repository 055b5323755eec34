"""Edge cases from the reference's own unit tests, re-expressed as rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from catalytics.functions import keys as K
from catalytics.operators import changes as C
from catalytics.operators import details as D
from catalytics.operators import filters as FL
from catalytics.operators import lineage as L
from catalytics.operators import partitions as PT
from catalytics.operators import profile as P
from catalytics.operators import search as S
from catalytics.operators import usage as U


def _tables(spark, keys):
    rows = []
    for k in keys:
        db, rest = k.split("://")
        cl, rest = rest.split(".", 1)
        sc, nm = rest.split("/")
        rows.append((k, db, cl, sc, nm, f"desc {nm}", "ACTIVE", 1.0))
    return spark.createDataFrame(rows, "key string, database string, cluster string, schema string, "
                                       "name string, description string, status string, popularity_score double")


def test_popular_tables_top5_of_six(spark):
    # six tables with total reads 0, 1000, ..., 5000 by ten readers each
    keys = [f"hive://gold.s/t{i}" for i in range(6)]
    reads = [(f"u{u}", keys[i], (i * 1000) // 10, date(2020, 1, 1), None)
             for i in range(6) for u in range(10)]
    r = spark.createDataFrame(reads, "user_key string, table_key string, read_count long, "
                                     "read_date date, published_tag string")
    out = U.popular_tables(r, _tables(spark, keys), n=5, min_readers=10)
    got = [x.table_key for x in out.orderBy(F.desc("score")).collect()]
    assert got == [keys[5], keys[4], keys[3], keys[2], keys[1]]


def test_watermark_formats(spark):
    parts = spark.createDataFrame(
        [("t", "20200908", "INACTIVE"), ("t", "20200909", "ACTIVE"), ("t", "20200910", "ACTIVE"),
         ("t", "2020,8", "ACTIVE")], "table_key string, name string, status string")
    cases = [(["%Y%m%d"], 2, "2020-09"), (["%Y,%m"], 2, "2020-08"), (["%Y-%m-%d"], 0, None), ([], 0, None)]
    for formats, n, low_prefix in cases:
        w = PT.partition_watermarks(parts, formats).collect()
        assert len(w) == n, formats
        if low_prefix:
            low = [x for x in w if x.watermark_type == "low_watermark"][0]
            assert low.partition_value.startswith(low_prefix)
            assert low.create_time == 0


def test_watermarks_no_partitions(spark):
    parts = spark.createDataFrame([("t", "20200908", "INACTIVE")], "table_key string, name string, status string")
    assert PT.partition_watermarks(parts, ["%Y%m%d"]).count() == 0


def test_editable_rules(spark):
    rows = [("ops_raw", "orders"), ("ops_core", "orders"), ("core", "locked_orders"), ("core", "open_orders"),
            ("lake1", "tmp_load"), ("lake1", "old_tmp_load"), ("lake1", "load"), ("my_lake1", "tmp_load"),
            ("vault", "orders")]
    df = spark.createDataFrame(rows, "schema string, name string")
    rules = [(r"^(ops_raw)", None), (None, r"^locked_\w+"), (r"^lake\d", r".*tmp.*")]
    got = {(r.schema, r.name): r.is_editable for r in FL.editable_flag(df, ["vault"], rules).collect()}
    closed = {("ops_raw", "orders"), ("core", "locked_orders"), ("lake1", "tmp_load"), ("lake1", "old_tmp_load"),
              ("vault", "orders")}
    assert got == {r: r not in closed for r in rows}
    assert FL.editable_flag(df, [], []).where(~F.col("is_editable")).count() == 0


def test_description_layout(spark):
    cfg = {"LEFT": {"owner notes": {"display_order": 7}, "glossary": {"display_order": 2}},
           "RIGHT": {"lint": {}, "freshness": {"display_order": 3}}, "cost": {"display_order": 1}}
    sources = ["unlisted", "cost", "lint", "owner notes", "freshness", "glossary"]
    d = spark.createDataFrame([("r", x, f"about {x}") for x in sources],
                              "resource_key string, source string, text string")
    by = {}
    for r in sorted(P.description_layout(d, cfg).collect(), key=lambda r: r.position):
        by.setdefault(r.side, []).append(r.source)
    assert by == {"left": ["glossary", "owner notes"], "right": ["lint", "freshness"], "other": ["cost", "unlisted"]}


def test_table_key_round_trip(spark):
    params = [("pg", "east", "sales", "orders"), ("pg_replica", "east.zone.2", "sales", "orders/2024/q1"),
              ("lake.v2", "eu.west", "raw", "clicks.daily"), ("delta", "prod", "web_events", "page_views")]
    df = spark.createDataFrame([(f"{a}://{b}.{c}/{d}",) for a, b, c, d in params], "key string")
    got = [(r.database, r.cluster, r.schema, r.name) for r in K.parse_table_key(df, "key").collect()]
    assert got == params
    bad = K.parse_table_key(spark.createDataFrame([("nothing here",)], "key string"), "key").first()
    assert bad.database is None


def test_inline_topk_keeps_every_query(spark):
    from catalytics.operators import search as S
    hits = spark.createDataFrame([("q1", "a", 3.0), ("q1", "b", 2.0), ("q1", "c", 2.0), ("q2", "a", 0.5)],
                                 "query_id string, key string, score double")
    got = S.inline_topk(S.search_all(table=hits, user=hits.where("key = 'a'")), k=2).collect()
    assert sorted((r.query_id, r.resource_type, r.key, r.position) for r in got) == [
        ("q1", "table", "a", 1), ("q1", "table", "b", 2), ("q1", "user", "a", 1), ("q2", "table", "a", 1), ("q2", "user", "a", 1)]


def test_property_diff_compares_arrays_as_sets(spark):
    from catalytics.operators import changes as C
    kind = "key string, tags array<string>, name string"
    old = spark.createDataFrame([("1", ["a", "b"], "x"), ("2", ["a"], "x"), ("3", ["a"], "x")], kind)
    new = spark.createDataFrame([("1", ["b", "a", "a"], "x"), ("2", ["a", "c"], "x"), ("3", None, "y")], kind)
    got = {r.key: (r.changed, r.dropped) for r in C.property_diff(old, new, "key", ["tags", "name"]).collect()}
    assert got == {"2": (["tags"], []), "3": (["name"], ["tags"])}


def test_link_if_absent_with_null_property(spark):
    from catalytics.operators import changes as C
    kind = "s string, d string, role string"
    edges = spark.createDataFrame([("a", "b", None)], kind)
    new = spark.createDataFrame([("a", "b", None), ("a", "b", "own"), ("a", "z", None)], kind)
    nodes = spark.createDataFrame([("a",), ("b",)], "key string")
    got = [(r.s, r.d, r.role) for r in C.link_if_absent(edges, new, nodes, nodes, "s", "d").collect()]
    assert got == [("a", "b", "own")]


def test_unset_shared_folder_raises_on_a_cluster():
    from catalytics.session import fallback_dir

    class Unset:
        def getCheckpointDir(self):
            return None

    class Chosen:
        def getCheckpointDir(self):
            return "hdfs://x/shared/0f3a"

    with pytest.raises(ValueError):
        fallback_dir(Unset(), "spark://host:7077")
    assert fallback_dir(Chosen(), "spark://host:7077") == "hdfs://x/shared"


def test_lineage_items_with_badges_and_usage(spark):
    k = {n: f"hive://gold.s/{n}" for n in ["alpha", "beta", "gamma", "delta"]}
    edges = spark.createDataFrame([(k["beta"], k["alpha"]), (k["gamma"], k["alpha"]), (k["alpha"], k["delta"])],
                                  "upstream_key string, downstream_key string")
    reads = spark.createDataFrame([("u", k["beta"], 100), ("u", k["gamma"], 200), ("u", k["delta"], 50)],
                                  "user_key string, table_key string, read_count long")
    badges = spark.createDataFrame([(k["gamma"], "badge1", "default"), (k["gamma"], "badge2", "default")],
                                   "resource_key string, badge_name string, category string")
    starts = spark.createDataFrame([(k["alpha"],)], "key string")
    items = {(r.direction, r.key): r for r in L.lineage(edges, starts, "both", 1, reads, badges).collect()}
    assert set(items) == {("upstream", k["beta"]), ("upstream", k["gamma"]), ("downstream", k["delta"])}
    assert items[("upstream", k["gamma"])].badges == ["badge1", "badge2"]
    assert items[("upstream", k["beta"])].usage == 100 and items[("downstream", k["delta"])].usage == 50
    assert all(r.level == 1 and r.source == "hive" for r in items.values())


def test_lineage_cycle_terminates(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "upstream_key string, downstream_key string")
    starts = spark.createDataFrame([("a",)], "key string")
    got = sorted((r.level, r.key) for r in L.lineage_trails(edges, starts, "downstream", 5).collect())
    # no edge is reused inside a trail: a->b->c->a and stop
    assert got == [(1, "b"), (2, "c"), (3, "a")]
    lv = sorted((r.level, r.node) for r in L.lineage_edges_levels(edges, starts, "downstream", 5).collect())
    assert lv == [(1, "b"), (2, "c")]


def test_personal_popular_matches_path_enumeration(spark):
    """Weighted rewrite == brute-force path enumeration on a small fixture."""
    rows = [(f"u{u}", f"t{t}", 1 + (u * 7 + t) % 5) for u in range(12) for t in range(9) if (u + 2 * t) % 3 != 0]
    rows += [(f"u{u}", f"t{u % 9}", 3) for u in range(12)] * 2 + [("solo", "t1", 1), ("solo", "t1", 2)]  # repeated edges
    reads = spark.createDataFrame(rows, "user_key string, table_key string, read_count long")
    tables = _tables(spark, [f"x://c.s/t{t}" for t in range(9)])
    fast = {(r.user_key, r.table_key): (r.co_readers, r.total_co_reads)
            for r in U.personal_popular_tables(reads, tables, n=100, min_readers=1).collect()}
    paths = D.co_reader_paths(reads)
    brute = {(r.u, r.t): (r.c, r.s) for r in paths.groupBy("u", "t").agg(
        F.countDistinct("co").alias("c"), F.sum("rc").alias("s")).collect()}
    assert fast == brute
    stats = {r.user_key: (r.n_paths, r.path_reads) for r in D.co_reader_path_stats(reads).collect()}
    per_user = {r.u: (r.n, r.s) for r in paths.groupBy("u").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rc").alias("s")).collect()}
    assert stats == per_user


def test_faceted_filter_rules(spark):
    docs = spark.createDataFrame(
        [("k1", "hive", "gold", "s1", "orders", "about orders", ["id"], [], ["Red"], []),
         ("k2", "bq", "gold", "s2", "users", None, ["email"], [], [], ["beta"])],
        "key string, database string, cluster string, schema string, name string, description string, "
        "column_names array<string>, column_descriptions array<string>, tags array<string>, badges array<string>")
    assert FL.faceted_filter(docs, {"database": ["hive", "bq"]}).count() == 2
    assert FL.faceted_filter(docs, {"database": ["hive"], "tag": ["red"]}).count() == 1
    assert FL.faceted_filter(docs, {"table": ["*ord*"]}).count() == 1
    assert FL.faceted_filter(docs, {"schema": ["s1/x"]}).count() == 0      # invalid char
    assert FL.faceted_filter(docs, {"unknown": ["x"]}).count() == 0        # nothing usable
    assert FL.faceted_filter(docs, {"schema": [""]}, "user").count() == 1  # empty value ignored
    assert FL.faceted_filter(docs, None, None).count() == 0


def test_user_search_requires_all_terms_in_one_field(spark):
    docs = spark.createDataFrame([("a@x.com", "Ann Lee", "Ann", "Lee", "a@x.com"),
                                  ("b@x.com", "Bob Ann", "Bob", "Ann", "b@x.com")],
                                 "key string, full_name string, first_name string, last_name string, email string")
    idx = S.build_inverted_index(docs, list(S.USER_BOOSTS))
    q = spark.createDataFrame([("q1", "ann lee"), ("q2", "ann")], "query_id string, query string")
    hits = {(r.query_id, r.doc_key) for r in S.search_users(idx, docs, q).collect()}
    assert hits == {("q1", "a@x.com"), ("q2", "a@x.com"), ("q2", "b@x.com")}


def test_change_application_is_idempotent(spark):
    cur = spark.createDataFrame([("t1", "old"), ("t2", "keep")], "resource_key string, description string")
    res = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "key string")
    ch = spark.createDataFrame(
        [(1, "put", "t1", "description", "v1", None), (2, "put", "t1", "description", "v2", None),
         (3, "put", "t3", "description", "new", None), (4, "put", "nope", "description", "x", None),
         (5, "delete", "t2", "description", None, None)],
        "seq long, op string, resource_key string, kind string, value string, category string")
    once, rej = C.apply_descriptions(cur, ch, res)
    twice, _ = C.apply_descriptions(once, ch, res)
    want = {("t1", "v2"), ("t3", "new")}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in twice.collect()}
    assert [r.resource_key for r in rej.collect()] == ["nope"]


def test_update_doc_tags_order(spark):
    docs = spark.createDataFrame([("d", ["a", "b", "c"])], "key string, tags array<string>")
    ch = spark.createDataFrame([("d", "a", 1, "put"), ("d", "b", 2, "delete"), ("d", "z", 3, "put")],
                               "key string, tag string, seq long, op string")
    assert C.update_doc_tags(docs, ch).first().tags == ["c", "a", "z"]


def test_upsert_users_truthy_only(spark):
    users = spark.createDataFrame([("a@x", "Ann", "Lee")], "email string, first_name string, last_name string")
    inc = spark.createDataFrame([("a@x", "", "Li"), ("b@x", "Bob", None)],
                                "email string, first_name string, last_name string")
    got = {r.email: r for r in C.upsert_users(users, inc, ["first_name", "last_name"], "2024-01-01").collect()}
    assert (got["a@x"].first_name, got["a@x"].last_name, got["a@x"].created) == ("Ann", "Li", False)
    assert got["b@x"].created is True


def test_column_stats_spec_and_unique_values(spark):
    stats = spark.createDataFrame(
        [("c", "min", "0.5678", 0, 1), ("c", "max", "100.1234", 0, 1),
         ("c", "unique_values", "{'x': 3, 'y': 9}", 0, 1)],
        "column_key string, stat_type string, stat_val string, start_epoch long, end_epoch long")
    spec = {"min": {"format": "%.2f", "new_name": "minimum"}, "max": {"drop": True}}
    got = {(r.stat_type, r.stat_val) for r in FL.format_column_stats(stats, spec).collect()}
    assert ("minimum", "0.57") in got and not any(t == "max" for t, _ in got)
    top = [(r.value, r["count"]) for r in P.unique_values_summary(stats).orderBy("position").collect()]
    assert top == [("y", 9), ("x", 3)]


def test_apply_tags_sequential_type_rules(spark):
    edges = spark.createDataFrame([("r", "a", "default"), ("r", "b", "default")],
                                  "resource_key string, tag string, tag_type string")
    nodes = edges.select("tag", "tag_type")
    res = spark.createDataFrame([("r",)], "key string")
    ch = spark.createDataFrame(
        [(1, "put", "r", "tag", "c", "default"), (2, "delete", "r", "tag", "c", "other"),   # stays
         (3, "delete", "r", "tag", "a", "other"),                                           # a stays
         (4, "delete", "r", "tag", "b", "default"),                                         # b goes
         (5, "put", "r", "tag", "d", "default"), (6, "delete", "r", "tag", "d", "default"), # d goes
         (7, "put", "r", "tag", "x", "badge"), (8, "put", "r", "tag", "tiny", "default")],  # rejected
        "seq long, op string, resource_key string, kind string, value string, category string")
    new, _, rej = C.apply_tags(edges, nodes, ch, res, ["tiny"])
    assert {(r.tag, r.tag_type) for r in new.collect()} == {("a", "default"), ("c", "default")}
    assert sorted(r.reason for r in rej.collect()) == ["reserved badge name", "tag type badge"]



def test_basic_filter_and_paging(spark):
    docs = spark.createDataFrame(
        [(f"k{i}", f"s{i % 2}.t{i}@gold", float(i), ["hot"] if i % 3 == 0 else []) for i in range(12)],
        "key string, qualified_name string, popularity_score double, tags array<string>")
    got = [r.key for r in FL.basic_filter(docs, {"database": ["s0"], "cluster": ["gold"]}, 0, 3).collect()]
    assert got == ["k10", "k8", "k6"]
    assert [r.key for r in FL.basic_filter(docs, {"tag": ["hot"]}, 1, 2).collect()] == ["k3", "k0"]
    assert FL.basic_filter(docs, {}).count() == 0
    page = FL.page_with_total(docs, [F.desc("popularity_score")], 5, 2).collect()
    assert [r.key for r in page] == ["k1", "k0"] and page[0].total_results == 12
