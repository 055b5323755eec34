"""Joins and searches whose memory and driver traffic must not follow the
number of rows: against plain forms, and by their plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalytics.operators import filters as FL
from catalytics.operators import search as S
from catalytics.registry import QUERIES
from catalytics.session import scratch_path

BOOSTS = {"name.raw": 9.0, "name": 2.0, "words": 1.0}
DOCS = "key string, name string, words array<string>, total_usage long"


def _docs(spark):
    rows = [(f"d{i:03d}", ["red ring", "blue ring", "red", None][i % 4], [f"w{i % 3}", "red bolt"] if i % 5 else None, [i % 7, None, -5, 0][i % 4])
            for i in range(60)]
    rows += [("d001", "blue ring", ["red"], 3), ("d001", "blue ring", ["red"], 3), ("d002", "other red ring", ["w1"], 4), (None, "red", ["red"], 1)]
    return spark.createDataFrame(rows, DOCS)


def _queries(spark):
    return spark.createDataFrame([("a", "red ring"), ("b", "red"), ("b", "red ring w1"), ("c", "RED red bolt"), ("d", "none"), ("e", None),
                                  ("f", "  "), ("g", "w0 w1 w2"), ("g", "w0 w1 w2")], "query_id string, query string")


def _rows(df):
    return sorted(map(tuple, df.select("query_id", "doc_key", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("usage, every", [("total_usage", False), (None, False), (None, True)])
@pytest.mark.parametrize("block", [256, 2])
def test_hits_scored_by_document_match_hits_scored_by_join(spark, usage, every, block):
    docs, queries = _docs(spark), _queries(spark)
    index = S.build_inverted_index(docs, list(BOOSTS))
    asked = S.query_terms(queries, list(BOOSTS)).select("field", "term")
    few = S.build_inverted_index(docs, list(BOOSTS), terms=asked)
    assert 0 < few.count() < index.count()
    want = S.rank_hits(S.bm25_field_scores(index, queries, BOOSTS), docs, 5, usage, every)
    got = S.top_hits(few, docs, queries, BOOSTS, 5, usage, every, S.document_lengths(docs, list(BOOSTS)), block=block)
    assert got.schema["score"].dataType == want.schema["score"].dataType
    by_query = {q for q, *_ in _rows(want)}
    assert _rows(got) == _rows(want) and {"a", "b", "c", "g"} <= by_query


def test_document_lengths_are_those_of_the_index(spark):
    docs = _docs(spark)
    want = S.field_stats(S.build_inverted_index(docs, list(BOOSTS)))
    assert sorted(map(tuple, S.document_lengths(docs, list(BOOSTS)).collect())) == sorted(map(tuple, want.collect()))


def test_ties_across_many_batches_go_to_the_smallest_key(spark):
    docs = spark.range(30_000).select(F.format_string("k%06d", "id").alias("key"), F.lit("same words").alias("name"),
                                      F.array(F.lit("x")).alias("words"), F.lit(1).cast("long").alias("total_usage"))
    q = spark.createDataFrame([("q", "same words")], "query_id string, query string")
    got = S.top_hits(S.build_inverted_index(docs, list(BOOSTS)), docs, q, BOOSTS, 3, "total_usage")
    assert "MapInArrow" in got._jdf.queryExecution().optimizedPlan().toString()
    assert [r.doc_key for r in got.orderBy("rank").collect()] == ["k000000", "k000001", "k000002"]


def test_requests_are_decided_once_for_documents_with_the_same_values(spark):
    """No join by category alone: every pair of a value and a request would meet there."""
    docs = spark.createDataFrame([(f"k{i}", f"n{i}", ["s0", "s1"][i % 2], ["red", "Blue"][: i % 3]) for i in range(40)] + [(None, "n1", "s1", ["red"])],
                                 "key string, name string, schema string, tags array<string>")
    rows = [(f"q{i}", "schema", f"s{i % 3}") for i in range(9)] + [("q1", "tag", "BL*"), ("q3", "term", "N1"), ("q4", "tag", "red"), (None, "tag", "red")]
    filters = spark.createDataFrame(rows, "query_id string, category string, value string")
    df = FL.faceted_filter_sets(docs, filters)
    got = {tuple(r) for r in df.collect()}
    want = set()
    for q in {r[0] for r in rows} - {None}:
        asked = {c: [v for p, k, v in rows if p == q and k == c] for c in ("schema", "tag", "term")}
        one = FL.faceted_filter(docs, {c: v for c, v in asked.items() if v and c != "term"}, next(iter(asked["term"]), None))
        want |= {(q, r.key) for r in one.collect()}
    assert got == want and df.count() == len(got) and len(got) > 40
    assert "has" in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def made(spark):
    """A small folder of driver tables, all of which Spark would broadcast."""
    path, day = scratch_path(spark, "made-tables"), dt.datetime(1999, 1, 1)
    tables = {
        "part": ([(i, f"red p{i}", f"Brand#{i % 3}", ["LARGE", "SMALL"][i % 2], i % 20, 1.0 * i) for i in range(40)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(i, i % 9, "O", 1.0, day, "1-URGENT") for i in range(30)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(i % 30, i % 40, i % 5, i // 30 % 4, 1.0, 1.0, 0.0, 0.0, "RN"[i % 2], "F", day + dt.timedelta(i % 11)) for i in range(300)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "customer": ([(i, f"c{i}", i % 3, 1.0, "X") for i in range(9)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", ["column_type_census", "user_resources_own", "partition_watermarks", "partition_watermarks_active_only",
                                  "watermarks_from_nodes", "collapse_processes", "lineage", "lineage_edges_levels", "lineage_marshall"])
def test_growing_tables_are_not_broadcast(spark, made, name):
    df = QUERIES[name](spark, made)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert df.count() > 0


@pytest.mark.parametrize("name", ["restrict_description_sources", "description_layout"])
def test_descriptions_meet_by_key_before_they_are_grouped(spark, made, name):
    """One exchange by resource below the grouping, so no partial groups of all rows in a scan."""
    df = QUERIES[name](spark, made)
    below = df._jdf.queryExecution().sparkPlan().toString().split("HashAggregate")[-1]
    assert "Repartition" in below or "REPARTITION" in below or "Exchange hashpartitioning(resource_key" in below
    assert df.count() == 40 * (3 if name.startswith("restrict") else 5) and df.where("position = 1").count() >= 40
