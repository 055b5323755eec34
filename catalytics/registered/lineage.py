"""Registered lineage queries: every table is a start, depth 3."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalytics.operators import lineage as L
from catalytics.plans import written
from catalytics.registry import _catalog, register

DEPTH = 3


def _starts(c):
    return c.tables.select("key")


@register("lineage")
def lineage(spark, sf):
    c = _catalog(spark, sf)
    items = L.lineage(c.lineage, _starts(c), L.BOTH, DEPTH, c.reads, c.badges)
    return items.select("start_key", "direction", "level", "key", "parent", "source", "usage",
                        F.array_join("badges", "|").alias("badges"))


@register("lineage_edges_levels")
def lineage_edges_levels(spark, sf):
    c = _catalog(spark, sf)
    return L.lineage_edges_levels(c.lineage, _starts(c), L.DOWN, DEPTH)


@register("lineage_edge_items")
def lineage_edge_items(spark, sf):
    """Both directions; edges with a view at an end are no items, which cuts
    what lies behind them off the root."""
    c = _catalog(spark, sf)
    view = c.tables.select("key", "is_view")
    e = c.lineage.join(view.withColumnRenamed("key", "upstream_key").withColumnRenamed("is_view", "uv"), "upstream_key") \
        .join(view.withColumnRenamed("key", "downstream_key").withColumnRenamed("is_view", "dv"), "downstream_key")
    keep = ~F.col("uv") & ~F.col("dv")
    return L.lineage_edge_items(e, _starts(c), L.UP, DEPTH, keep).unionByName(
        L.lineage_edge_items(e, _starts(c), L.DOWN, DEPTH, keep))


@register("collapse_processes")
def collapse_processes(spark, sf):
    c = _catalog(spark, sf)
    return L.collapse_processes(c.process_relations, c.process_entities, "table")


@register("relationship_edges")
def relationship_edges(spark, sf):
    """All edges between any two linked tables, either way."""
    c = _catalog(spark, sf)
    e = written(c.lineage, "lineage-edges")
    pairs = e.select(F.col("downstream_key").alias("x"), F.col("upstream_key").alias("y")).union(
        e.select(F.col("upstream_key").alias("x"), F.col("downstream_key").alias("y"))).distinct()
    return L.relationship_edges(e, pairs)


@register("lineage_marshall")
def lineage_marshall(spark, sf):
    c = _catalog(spark, sf)
    items = L.lineage_trails(c.lineage, _starts(c), L.BOTH, 2)
    return L.lineage_marshall(items, 5)
