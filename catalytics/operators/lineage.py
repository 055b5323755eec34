"""Lineage operators.

Variable-length traversal is a driver loop of ``depth`` equi-joins (the
only driver state is the hop counter). Each hop joins the frontier with the
edge table on the node key -- a shuffle join on the node key; the edge table
is not assumed small. Every two hops the frontier is checkpointed to the
shared checkpoint folder to keep the plan short and recovery cheap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics.plans import cut_lineage, spread, written

UP, DOWN, BOTH = "upstream", "downstream", "both"


def _oriented(edges: DataFrame, direction: str) -> DataFrame:
    """(src, dst) in traversal order: upstream walks downstream->upstream."""
    if direction == UP:
        return edges.select(F.col("downstream_key").alias("src"), F.col("upstream_key").alias("dst"))
    return edges.select(F.col("upstream_key").alias("src"), F.col("downstream_key").alias("dst"))


def looping_edges(e: DataFrame, depth: int) -> DataFrame:
    """Edges (src, dst) that a walk of at most ``depth`` edges can use twice:
    those on a closed walk of at most ``depth - 1`` edges. Reached pairs are
    kept distinct, so the cost is that of distinct (start, node) pairs."""
    closed = e.where(F.col("src") == F.col("dst")) if depth > 1 else e.limit(0)
    # (src, dst, node): node is some steps behind the edge; closed when it is src
    reach = e.select("src", "dst", F.col("dst").alias("node"))
    step = e.select(F.col("src").alias("node"), F.col("dst").alias("next"))
    for length in range(2, depth):
        if length == 2:
            found = e.join(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_semi")
        else:
            found = reach.join(e.select(F.col("src").alias("node"), F.col("dst").alias("src")), ["node", "src"], "left_semi")
        closed = closed.unionByName(found.select("src", "dst"))
        if length + 1 < depth:
            reach = written(reach.join(step, "node").select("src", "dst", F.col("next").alias("node")).distinct(), "reach")
    return closed.distinct()


def lineage_trails(edges: DataFrame, starts: DataFrame, direction: str, depth: int = 1,
                   checkpoint_every: int = 2) -> DataFrame:
    """Every trail of length 1..depth from each start (no edge repeated in a
    trail, so cycles terminate). Returns distinct
    (start_key, direction, level, key, parent).

    Only edges on short closed walks can repeat. Where there are none, as in
    any acyclic graph, every walk is a trail and the frontier is the distinct
    (start, node) pairs of a level; else it carries the used ones of those
    edges and no others."""
    if direction == BOTH:
        return lineage_trails(edges, starts, UP, depth, checkpoint_every).unionByName(
            lineage_trails(edges, starts, DOWN, depth, checkpoint_every))
    e = _oriented(edges, direction).distinct()
    loops = looping_edges(e, depth)
    cyclic = not loops.isEmpty()
    frontier = starts.select(F.col("key").alias("start_key"), F.col("key").alias("node")).distinct()
    if cyclic:
        used = F.concat_ws("\u0001", "src", "dst").alias("eid")
        e = e.join(loops.select("src", "dst", used), ["src", "dst"], "left")
        frontier = frontier.withColumn("path", F.array().cast("array<string>"))
    carried = ["path"] if cyclic else []
    items = None
    for level in range(1, depth + 1):
        step = spread(frontier).join(e, frontier.node == e.src)
        if cyclic:
            step = step.where(F.col("eid").isNull() | ~F.array_contains("path", F.col("eid"))) \
                .withColumn("path", F.when(F.col("eid").isNull(), F.col("path")).otherwise(
                    F.array_sort(F.concat("path", F.array("eid")))))
        step = step.select("start_key", F.col("dst").alias("node"), F.col("src").alias("parent"), *carried).distinct()
        if checkpoint_every and level % checkpoint_every == 0 and level < depth:
            step = cut_lineage(step)
        lv = step.select("start_key", F.lit(level).alias("level"), F.col("node").alias("key"), "parent")
        if cyclic:
            lv = lv.distinct()
        items = lv if items is None else items.unionByName(lv)
        frontier = step.select("start_key", "node", *carried).distinct()
    return items.withColumn("direction", F.lit(direction))


def lineage(edges: DataFrame, starts: DataFrame, direction: str = BOTH, depth: int = 1,
            reads: DataFrame | None = None, badges: DataFrame | None = None) -> DataFrame:
    """Lineage items with level, parent, source (text before '://'), usage
    (sum of reads of the item, 0 if none) and its badges."""
    items = lineage_trails(edges, starts, direction, depth)
    items = items.withColumn("source", F.substring_index("key", "://", 1))
    if reads is not None:
        usage = reads.groupBy(F.col("table_key").alias("key")).agg(
            F.sum("read_count").cast("long").alias("usage"))
        items = items.join(spread(usage), "key", "left").withColumn(
            "usage", F.coalesce("usage", F.lit(0).cast("long")))
    if badges is not None:
        b = badges.groupBy(F.col("resource_key").alias("key")).agg(
            F.array_sort(F.collect_set("badge_name")).alias("badges"))
        items = items.join(spread(b), "key", "left").withColumn(
            "badges", F.coalesce("badges", F.array().cast("array<string>")))
    return items


def lineage_edges_levels(edges: DataFrame, roots: DataFrame, direction: str,
                         depth: int) -> DataFrame:
    """Shortest-level form: per root, each node reachable within ``depth``
    hops with its shortest distance and the smallest predecessor on a
    shortest path. Frontier BFS: each hop joins only newly reached nodes
    and removes visited ones with an anti join, so work is linear in the
    reachable edges, not in the number of trails. depth 0 => empty."""
    e = _oriented(edges, direction).distinct()
    visited = roots.select(F.col("key").alias("root_key"), F.col("key").alias("node"),
                           F.lit(0).alias("level"))
    frontier = visited.select("root_key", "node")
    out = None
    for level in range(1, depth + 1):
        nxt = (spread(frontier).join(e, frontier.node == e.src)
               .groupBy("root_key", F.col("dst").alias("node"))
               .agg(F.min("src").alias("parent")))
        nxt = nxt.join(spread(visited.select("root_key", "node")), ["root_key", "node"], "left_anti")
        if level % 2 == 0 and level < depth:
            nxt = cut_lineage(nxt)
        lv = nxt.withColumn("level", F.lit(level))
        out = lv if out is None else out.unionByName(lv)
        visited = visited.unionByName(lv.select("root_key", "node", "level"))
        frontier = nxt.select("root_key", "node")
    if out is None:
        return roots.sparkSession.createDataFrame(
            [], "root_key string, node string, parent string, level int, direction string")
    return out.withColumn("direction", F.lit(direction))


def lineage_edge_items(edges: DataFrame, roots: DataFrame, direction: str, depth: int,
                       keep: Column | None = None) -> DataFrame:
    """One item per edge of each root's lineage graph. The graph is all edges
    met within ``depth`` hops; of these the edges that satisfy ``keep`` (a
    column over upstream_key and downstream_key; all, if not given) are items.
    level = shortest distance from the root over kept edges, however long, or
    -1 if none leads there; parent = smallest predecessor of the key among the
    kept edges, '' if it has none; usage 0. depth 0 => empty.

    Shortest levels of all roots at once: each round joins the nodes of the
    last one with the root's own edges and stops when it adds no row."""
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    up, down = ("dst", "src") if direction == UP else ("src", "dst")
    e = edges.select("upstream_key", "downstream_key", kept.alias("kept")).distinct().select(
        F.col("upstream_key").alias(up), F.col("downstream_key").alias(down), "kept")
    frontier = seen = roots.select(F.col("key").alias("root_key"), F.col("key").alias("node")).distinct()
    graph = None
    for hop in range(depth):
        met = written(spread(frontier).join(e, frontier.node == e.src).select("root_key", "src", "dst", "kept"), "graph-edges")
        graph = met if graph is None else graph.unionByName(met)
        frontier = met.select("root_key", F.col("dst").alias("node")).distinct().join(spread(seen), ["root_key", "node"], "left_anti")
        frontier = written(frontier, "graph-nodes") if hop + 1 < depth else frontier
        seen = seen.unionByName(frontier)
    if graph is None:
        return roots.sparkSession.createDataFrame([], _EDGE_ITEM)
    graph = written(graph.where("kept").select("root_key", "src", "dst"), "graph-kept")
    levels = frontier = roots.select(F.col("key").alias("root_key"), F.col("key").alias("node"), F.lit(0).alias("level")).distinct()
    hop = 0
    while True:
        hop += 1
        on = (frontier["root_key"] == graph["root_key"]) & (frontier["node"] == graph["src"])
        new = spread(graph).join(frontier.select("root_key", "node"), on).select(graph["root_key"], F.col("dst").alias("node")).distinct()
        frontier = written(new.join(spread(levels), ["root_key", "node"], "left_anti").withColumn("level", F.lit(hop)), "graph-level")
        if frontier.isEmpty():
            break
        levels = levels.unionByName(frontier)
    before = graph.select("root_key", F.col("src" if direction == UP else "dst").alias("key"),
                          F.col("dst" if direction == UP else "src").alias("p"))
    parents = before.groupBy("root_key", "key").agg(F.min("p").alias("parent"))
    items = graph.select("root_key", F.col(up).alias("upstream_key"), F.col(down).alias("downstream_key"), F.col("dst").alias("key"))
    return spread(items).join(levels.withColumnRenamed("node", "key"), ["root_key", "key"], "left") \
        .join(spread(parents), ["root_key", "key"], "left").select(
            "root_key", F.lit(direction).alias("direction"), "upstream_key", "downstream_key", "key",
            F.coalesce("level", F.lit(-1)).alias("level"), F.coalesce("parent", F.lit("")).alias("parent"),
            F.substring_index("key", "://", 1).alias("source"), F.lit(0).cast("long").alias("usage"))


_EDGE_ITEM = ("root_key string, direction string, upstream_key string, downstream_key string, key string, "
              "level int, parent string, source string, usage long")


def collapse_processes(relations: DataFrame, entities: DataFrame,
                       type_suffix: str = "table", block: int = 1000) -> DataFrame:
    """Dataset -> process -> dataset to direct dataset edges (inputs x
    outputs of each process), keeping only datasets whose type name ends
    with ``type_suffix``. Inputs and outputs are de-duplicated per process
    before the pairing join, and dealt into blocks of about ``block``: a pair
    of blocks is a join key, so a process with very many of either is spread
    over as many tasks as its product has blocks."""
    ds = spread(entities.where(F.col("type_name").endswith(type_suffix)).select(
        F.col("guid"), F.col("qualified_name")))
    proc = spread(entities.where(F.col("type_name") == "Process").select(F.col("guid").alias("proc")))
    ins = (relations.join(proc, relations.to_guid == proc.proc, "inner")
           .join(ds, relations.from_guid == ds.guid)
           .select("proc", F.col("qualified_name").alias("upstream_key")).distinct())
    outs = (relations.join(proc, relations.from_guid == proc.proc, "inner")
            .join(ds, relations.to_guid == ds.guid)
            .select("proc", F.col("qualified_name").alias("downstream_key")).distinct())
    sides = ins.select("proc", F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(
        outs.select("proc", F.lit(0).alias("i"), F.lit(1).alias("o")))
    blocks = sides.groupBy("proc").agg(F.ceil(F.sum("i") / block).cast("int").alias("ni"), F.ceil(F.sum("o") / block).cast("int").alias("no")) \
        .where((F.col("ni") > 0) & (F.col("no") > 0))

    def dealt(side: DataFrame, key: str, mine: str, other: str) -> DataFrame:
        at = side.join(spread(blocks), "proc").withColumn(f"b{mine}", F.pmod(F.hash(key), F.col(mine)))
        return at.select("proc", key, f"b{mine}", F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"b{other}"))

    pairs = dealt(ins, "upstream_key", "ni", "no").join(dealt(outs, "downstream_key", "no", "ni"), ["proc", "bni", "bno"])
    return pairs.select("upstream_key", "downstream_key").distinct()


def relationship_edges(edges: DataFrame, pairs: DataFrame, a: str = "upstream_key",
                       b: str = "downstream_key") -> DataFrame:
    """All edges between the two nodes of each pair, either direction."""
    fwd = edges.select(F.col(a).alias("x"), F.col(b).alias("y"), F.lit("out").alias("orientation"))
    rev = edges.select(F.col(b).alias("x"), F.col(a).alias("y"), F.lit("in").alias("orientation"))
    return pairs.select("x", "y").join(fwd.unionByName(rev), ["x", "y"])


def lineage_marshall(items: DataFrame, per_direction: int = 5) -> DataFrame:
    """Add database/cluster/schema/name parsed from the key and keep the
    first ``per_direction`` items per (start, direction) by (level, key)."""
    from catalytics.functions.keys import parse_table_key
    from catalytics.plans import topk_per_key
    top = topk_per_key(items, ["start_key", "direction"],
                       [F.asc("level"), F.asc("key"), F.asc("parent")], per_direction,
                       rank_col="position")
    return parse_table_key(top, "key")
