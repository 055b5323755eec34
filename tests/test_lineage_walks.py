"""Lineage walks, edge items and block products against brute force."""

import random

from pyspark.sql import functions as F

from catalytics.operators import details as D
from catalytics.operators import lineage as L


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "upstream_key string, downstream_key string")


def _trails(pairs, starts, depth):
    out, edges = set(), set(pairs)

    def walk(start, node, used):
        for a, b in edges:
            if a == node and (a, b) not in used:
                out.add((start, len(used) + 1, b, a))
                if len(used) + 1 < depth:
                    walk(start, b, used | {(a, b)})

    for s in starts:
        walk(s, s, frozenset())
    return out


def test_trails_of_random_graphs(spark):
    rng = random.Random(4)
    for n, m, depth in ((6, 9, 5), (5, 12, 4), (8, 8, 3), (4, 6, 2)):
        pairs = sorted({(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(m)})  # loops and cycles included
        starts = [f"n{i}" for i in range(n)]
        got = L.lineage_trails(_edges(spark, pairs), spark.createDataFrame([(s,) for s in starts], "key string"), L.DOWN, depth)
        assert {(r.start_key, r.level, r.key, r.parent) for r in got.collect()} == _trails(pairs, starts, depth)
        assert got.count() == got.distinct().count()


def test_acyclic_walks_carry_no_paths(spark):
    rng = random.Random(5)
    pairs = sorted({(f"n{a}", f"n{b}") for a, b in ((rng.randrange(9), rng.randrange(9)) for _ in range(25)) if a < b})
    starts = spark.createDataFrame([(f"n{i}",) for i in range(9)], "key string")
    got = L.lineage_trails(_edges(spark, pairs), starts, L.DOWN, 4, checkpoint_every=0)
    assert "array" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.start_key, r.level, r.key, r.parent) for r in got.collect()} == _trails(pairs, [f"n{i}" for i in range(9)], 4)


def test_edge_items_levels_and_unreachable(spark):
    # r -> a -> b -> c and r -> c; x -> d is met through r -> x, an edge that is no item
    pairs = [("r", "a"), ("a", "b"), ("b", "c"), ("r", "x"), ("x", "d"), ("c", "r")]
    roots = spark.createDataFrame([("r",)], "key string")
    items = {(r.upstream_key, r.downstream_key): r for r in L.lineage_edge_items(
        _edges(spark, pairs), roots, L.DOWN, 3, F.col("downstream_key") != "x").collect()}
    assert set(items) == {("r", "a"), ("a", "b"), ("b", "c"), ("x", "d")}
    assert [items[e].level for e in (("r", "a"), ("a", "b"), ("b", "c"), ("x", "d"))] == [1, 2, 3, -1]
    assert items["x", "d"].parent == "x" and items["a", "b"].parent == "a" and items["r", "a"].usage == 0
    up = {(r.upstream_key, r.downstream_key): r for r in L.lineage_edge_items(
        _edges(spark, pairs), spark.createDataFrame([("c",)], "key string"), L.UP, 2).collect()}
    assert {(k, r.key, r.level, r.parent) for k, r in up.items()} == {(("b", "c"), "b", 1, "a"), (("a", "b"), "a", 2, "")}
    # with a depth of three the edge into a is met as well, so a has a predecessor
    deeper = L.lineage_edge_items(_edges(spark, pairs), spark.createDataFrame([("c",)], "key string"), L.UP, 3)
    assert {(r.key, r.level, r.parent) for r in deeper.collect()} == {("b", 1, "a"), ("a", 2, "r"), ("r", 3, "")}
    assert L.lineage_edge_items(_edges(spark, pairs), roots, L.DOWN, 0).count() == 0


def test_collapse_of_a_hot_process_in_blocks(spark):
    ins = [(f"i{k}", "hot") for k in range(70)] + [("i1", "p2"), ("i1", "p3")]
    outs = [("hot", f"o{k}") for k in range(45)] + [("p2", "o1"), ("p2", "v")]
    guids = {g for r in ins + outs for g in r}
    kind = {g: "Process" if g in ("hot", "p2", "p3") else "view" if g == "v" else "table" for g in guids}
    entities = spark.createDataFrame([(g, k, f"q{g}") for g, k in kind.items()], "guid string, type_name string, qualified_name string")
    relations = spark.createDataFrame(ins + outs, "from_guid string, to_guid string")
    want = {(f"qi{a}", f"qo{b}") for a in range(70) for b in range(45)}
    for block in (7, 1000):
        got = L.collapse_processes(relations, entities, "table", block)
        assert sorted((r.upstream_key, r.downstream_key) for r in got.collect()) == sorted(want)


def test_owner_prefixes_by_length(spark):
    users = spark.createDataFrame([("Al",), ("alice",), ("bob",), ("",)], "email string")
    res = spark.createDataFrame([("k1", "alice smith"), ("k2", "AL"), ("k3", None), ("k4", "a"), ("k5", "bobby")], "key string, owner string")
    edges = spark.createDataFrame([("bob", "k1"), ("bob", "k5")], "user_key string, resource_key string")
    got = {tuple(r) for r in D.owned_resources_union(edges, res, users).select("user_key", "key").collect()}
    assert got == {("bob", "k1"), ("bob", "k5"), ("Al", "k1"), ("alice", "k1"), ("Al", "k2")}
