"""Registered detail / join queries (flat renderings of the roll-ups)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalytics.operators import details as D
from catalytics.operators.partitions import partition_flag, partition_watermarks
from catalytics.registry import _catalog, register

WATERMARK_FORMATS = ["%Y-%m-%d", "%Y%m%d"]


def _sorted_join(arr, sep="|"):
    return F.array_join(F.array_sort(arr), sep)


def _watermarks(c):
    return partition_watermarks(c.partitions, WATERMARK_FORMATS, c.partition_keys)


@register("table_hierarchy")
def table_hierarchy(spark, sf):
    c = _catalog(spark, sf)
    return D.table_hierarchy(c.tables, c.table_schema_edges, c.schemas, c.clusters, c.databases)


@register("table_columns")
def table_columns(spark, sf):
    c = _catalog(spark, sf)
    df = D.table_columns(c.tables, c.columns, c.column_stats, c.column_badges)
    return df.select(
        "table_key", "database", "cluster", "schema", "name", "description",
        F.size("columns").alias("n_columns"),
        F.array_join(F.transform("columns", lambda x: x["name"]), ",").alias("column_names"),
        F.array_join(F.transform("columns", lambda x: x["col_type"]), ",").alias("column_types"),
        F.aggregate("columns", F.lit(0), lambda a, x: a + F.size(x["stats"])).alias("n_stats"),
        _column_badges())


def _column_badges():
    named = F.flatten(F.transform("columns", lambda x: F.transform(
        x["badges"], lambda b: F.concat(x["name"], F.lit(":"), b["badge_name"]))))
    return F.array_join(named, ",").alias("column_badges")


@register("table_detail")
def table_detail(spark, sf):
    c = _catalog(spark, sf)
    from catalytics.registered.misc import prog_descriptions
    df = D.table_detail(c.tables, c.columns, c.column_stats, c.reads, c.owners, c.tags, c.badges,
                        _watermarks(c), prog_descriptions(c), column_badges=c.column_badges,
                        writers=c.table_writers, updates=c.table_updates, sources=c.table_sources)
    wm = F.col("watermarks")
    return df.select(
        "table_key", "database", "cluster", "schema", "name", "description",
        F.array_join(F.transform("columns", lambda x: x["name"]), ",").alias("column_names"),
        F.aggregate("columns", F.lit(0), lambda a, x: a + F.size(x["stats"])).alias("n_stats"),
        F.array_join(F.transform("table_readers", lambda r: F.concat(
            r["user_key"], F.lit(":"), r["read_count"].cast("string"))), ",").alias("readers"),
        F.array_join("owners", "|").alias("owners"),
        F.array_join("tags", "|").alias("tags"),
        _sorted_join(F.transform("badges", lambda b: F.concat(b["badge_name"], F.lit(":"),
                                                              b["category"]))).alias("badges"),
        F.filter(wm, lambda w: w["watermark_type"] == "low_watermark")[0]["partition_value"]
        .alias("low_watermark"),
        F.filter(wm, lambda w: w["watermark_type"] == "high_watermark")[0]["partition_value"]
        .alias("high_watermark"),
        "is_view", "last_updated_timestamp", F.col("table_writer.id").alias("writer_id"),
        F.col("table_writer.name").alias("writer_name"), F.col("table_writer.application_url").alias("writer_url"),
        F.col("table_writer.description").alias("writer_description"), F.col("source.source_type").alias("source_type"),
        F.col("source.source").alias("source"), _column_badges(),
        F.array_join(F.transform("programmatic_descriptions", lambda d: F.concat(d["source"], F.lit("="), d["text"])), "|")
        .alias("programmatic_descriptions"))


@register("partition_watermarks")
def partition_watermarks_q(spark, sf):
    return _watermarks(_catalog(spark, sf))


@register("partition_watermarks_active_only")
def partition_watermarks_active(spark, sf):
    c = _catalog(spark, sf)
    return partition_watermarks(c.partitions, ["%Y%m%d"], c.partition_keys, include_deleted=False)


@register("partition_flag")
def partition_flag_q(spark, sf):
    c = _catalog(spark, sf)
    return partition_flag(_watermarks(c), c.tables)


@register("last_executions")
def last_executions(spark, sf):
    return D.last_executions(_catalog(spark, sf).dashboard_executions)


@register("dashboard_detail")
def dashboard_detail(spark, sf):
    c = _catalog(spark, sf)
    df = D.dashboard_detail(c.dashboards, c.dashboard_executions, c.dashboard_reads,
                            c.dashboard_owners, c.tags, c.dashboard_badges, c.dashboard_queries,
                            c.dashboard_charts, c.dashboard_tables, c.dashboard_updates)
    return df.select(
        "dashboard_key", "name", "url", "group_name", "cluster", "product", "description",
        "created_timestamp", "last_run_timestamp", "last_run_state", "last_successful_run_timestamp",
        "updated_timestamp", F.array_join(F.transform("badges", lambda b: b["badge_name"]), "|").alias("badges"),
        "recent_view_count", F.array_join("owners", "|").alias("owners"),
        F.array_join("tags", "|").alias("tags"),
        _sorted_join(F.transform("queries", lambda q: F.concat_ws(
            ";", q["name"], F.coalesce(q["url"], F.lit("")), F.coalesce(q["query_text"], F.lit(""))))
        ).alias("queries"),
        F.array_join("chart_names", "|").alias("chart_names"),
        F.array_join("tables", "|").alias("tables"))


@register("dashboards_using_table")
def dashboards_using_table(spark, sf):
    c = _catalog(spark, sf)
    return D.dashboards_using_table(c.dashboards, c.dashboard_tables, c.dashboard_reads,
                                    c.dashboard_executions)


@register("feature_detail")
def feature_detail(spark, sf):
    c = _catalog(spark, sf)
    df = D.feature_detail(c.features, c.feature_databases, c.feature_owners, c.feature_tags, c.feature_badges,
                          c.feature_watermarks)
    return df.select(
        "feature_key", "name", "version", "feature_group", "data_type", "entity", "status",
        "description", F.array_join("availability", "|").alias("availability"),
        F.array_join("owners", "|").alias("owners"), F.array_join("tags", "|").alias("tags"),
        _sorted_join(F.transform("watermarks", lambda w: F.concat(
            w["watermark_type"], F.lit(":"), w["time"].cast("string")))).alias("watermarks"),
        F.array_join(F.transform("badges", lambda b: b["badge_name"]), "|").alias("badges"))


@register("feature_generation_code")
def feature_generation_code(spark, sf):
    c = _catalog(spark, sf)
    return D.feature_generation_code(c.features, c.feature_generation_code)


@register("user_profile")
def user_profile(spark, sf):
    return D.user_profile(_catalog(spark, sf).users)


@register("active_users")
def active_users(spark, sf):
    return D.active_users(_catalog(spark, sf).users).select("email", "full_name", "team_name")


@register("resource_description")
def resource_description(spark, sf):
    c = _catalog(spark, sf)
    t = c.tables.select("key", F.col("key").alias("resource_key"), "description").where(
        F.col("description").isNotNull())
    return D.resource_description(c.tables, t).select(
        F.col("key").alias("resource_key"), "description")


@register("column_description")
def column_description(spark, sf):
    c = _catalog(spark, sf)
    d = c.columns.where(F.col("description").isNotNull()).select(
        F.col("key").alias("resource_key"), "description")
    return D.resource_description(c.columns, d).select(F.col("key").alias("resource_key"),
                                                       "description")


@register("column_parent")
def column_parent(spark, sf):
    c = _catalog(spark, sf)
    return D.column_parent(c.columns, c.tables)


@register("table_reports")
def table_reports(spark, sf):
    c = _catalog(spark, sf)
    df = D.table_reports(c.reports)
    return df.select("table_key", F.size("reports").alias("n_reports"),
                     F.array_join(F.transform("reports", lambda r: r["name"]), "|").alias("reports"))


@register("user_resources_read")
def user_resources_read(spark, sf):
    c = _catalog(spark, sf)
    edges = c.reads.select("user_key", F.col("table_key").alias("resource_key"))
    res = c.tables.select("key", "database", "cluster", "schema", "name", "description")
    return D.user_resources(edges, res, "read")


@register("user_resources_own_dashboards")
def user_resources_own_dashboards(spark, sf):
    c = _catalog(spark, sf)
    ex = D.last_executions(c.dashboard_executions).select(
        F.col("dashboard_key").alias("key"), "last_successful_run_timestamp")
    res = c.dashboards.select("key", "name", "group_name", "product", "description").join(
        ex, "key", "left")
    return D.user_resources(c.dashboard_owners, res, "own")


@register("user_resources_own")
def user_resources_own(spark, sf):
    c = _catalog(spark, sf)
    return D.user_resources(c.owners, c.tables.select("key", "database", "cluster", "schema", "name", "description"), "own")


@register("user_resources_read_dashboards")
def user_resources_read_dashboards(spark, sf):
    c = _catalog(spark, sf)
    ex = D.last_executions(c.dashboard_executions).select(
        F.col("dashboard_key").alias("key"), "last_successful_run_timestamp")
    res = c.dashboards.select("key", "name", "group_name", "product", "description").join(ex, "key", "left")
    return D.user_resources(c.dashboard_reads.select("user_key", F.col("dashboard_key").alias("resource_key")), res, "read")


@register("owned_resources_union")
def owned_resources_union(spark, sf):
    c = _catalog(spark, sf)
    return D.owned_resources_union(c.owners, c.tables.where(F.col("status") == "ACTIVE"), c.users)


@register("owners_with_fallback")
def owners_with_fallback(spark, sf):
    c = _catalog(spark, sf)
    df = D.owners_with_fallback(c.owners, c.users, c.tables)
    return df.select("resource_key", F.array_join("owners", "|").alias("owners"))


@register("co_reader_paths")
def co_reader_paths(spark, sf):
    """Path statistics per user (weighted form; no path enumeration)."""
    return D.co_reader_path_stats(_catalog(spark, sf).read_edges)


@register("orphan_check")
def orphan_check(spark, sf):
    c = _catalog(spark, sf)
    ok, rejected = D.orphan_check(c.change_feed, c.tables)
    return ok.withColumn("accepted", F.lit(True)).unionByName(
        rejected.withColumn("accepted", F.lit(False))).select("seq", "resource_key", "accepted")


@register("event_registration_join")
def event_registration_join(spark, sf):
    c = _catalog(spark, sf)
    return D.event_registration_join(c.sensor_events, c.pet_registry)


@register("recipients_except_sender")
def recipients_except_sender(spark, sf):
    c = _catalog(spark, sf)
    return D.recipients_except_sender(c.change_feed, c.owners, c.users)


@register("last_runs_from_nodes")
def last_runs_from_nodes(spark, sf):
    """Last runs written as reserved-key execution nodes and read back by
    key segment (round trip of the graph form)."""
    c = _catalog(spark, sf)
    return D.last_runs_from_nodes(D.execution_nodes(c.dashboard_executions))


@register("watermarks_from_nodes")
def watermarks_from_nodes(spark, sf):
    c = _catalog(spark, sf)
    return D.watermarks_from_nodes(D.watermark_nodes(_watermarks(c)))
