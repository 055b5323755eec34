"""Registered usage queries (popularity, readers, tags, statistics...)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalytics.operators import usage as U
from catalytics.registry import AS_OF, MIN_READERS, PERSONAL_N, POPULAR_N, _catalog, r6, register

_HYD = ["table_key", "database", "cluster", "schema", "name", "description"]


@register("popular_tables")
def popular_tables(spark, sf):
    c = _catalog(spark, sf)
    df = U.popular_tables(c.reads, c.tables, n=POPULAR_N, min_readers=MIN_READERS)
    return df.select(*_HYD, "readers", F.col("total_reads").cast("long").alias("total_reads"),
                     r6(F.col("score")).alias("score"))


@register("popular_tables_by_rows")
def popular_tables_by_rows(spark, sf):
    c = _catalog(spark, sf)
    df = U.popular_tables_by_rows(c.reads, c.tables, n=POPULAR_N, min_readers=MIN_READERS)
    return df.select(*_HYD, "readers", F.col("total_reads").cast("long").alias("total_reads"),
                     r6(F.col("score")).alias("score"))


@register("popular_tables_by_total")
def popular_tables_by_total(spark, sf):
    c = _catalog(spark, sf)
    return U.popular_tables_by_total(c.reads, c.tables, n=POPULAR_N).select(*_HYD, "total_reads")


@register("popular_tables_by_stored_score")
def popular_tables_by_stored_score(spark, sf):
    c = _catalog(spark, sf)
    return U.popular_tables_by_stored_score(c.tables, n=POPULAR_N)


@register("personal_popular_tables")
def personal_popular_tables(spark, sf):
    c = _catalog(spark, sf)
    df = U.personal_popular_tables(c.read_edges, c.tables, n=PERSONAL_N, min_readers=MIN_READERS)
    return df.withColumn("score", r6(F.col("score")))


@register("personal_tables_own_reads")
def personal_tables_own_reads(spark, sf):
    c = _catalog(spark, sf)
    # threshold 1 so the variant's rows are visible (default 10 removes all)
    df = U.personal_tables_own_reads(c.reads, n=PERSONAL_N, min_readers=1)
    return df.select("user_key", "table_key", "readers",
                     F.col("total_reads").cast("long").alias("total_reads"),
                     r6(F.col("score")).alias("score"), "rank")


@register("top_readers_per_table")
def top_readers_per_table(spark, sf):
    c = _catalog(spark, sf)
    return U.top_readers_per_table(c.reads, c.users, n=5)


@register("top_readers_active_min")
def top_readers_active_min(spark, sf):
    c = _catalog(spark, sf)
    return U.top_readers_per_table(c.reads, c.users, n=15, min_count=2, active_only=True)


@register("top_readers_recent")
def top_readers_recent(spark, sf):
    """Readers since a date."""
    c = _catalog(spark, sf)
    return U.top_readers_per_table(c.reads, c.users, n=5, since="1997-01-01")


@register("top_readers_ascending")
def top_readers_ascending(spark, sf):
    """The relational store's order: fewest reads first."""
    c = _catalog(spark, sf)
    return U.top_readers_per_table(c.reads, c.users, n=5, ascending=True)


@register("reads_last_n_days")
def reads_last_n_days(spark, sf):
    c = _catalog(spark, sf)
    return U.reads_last_n_days(c.reads, AS_OF, days=5)


@register("frequently_used_tables")
def frequently_used_tables(spark, sf):
    c = _catalog(spark, sf)
    return U.frequently_used_tables(c.reads, c.tables, n=50)


@register("frequently_used_by_count")
def frequently_used_by_count(spark, sf):
    c = _catalog(spark, sf)
    return U.frequently_used_by_count(c.reads)


@register("tag_usage")
def tag_usage(spark, sf):
    c = _catalog(spark, sf)
    return U.tag_usage(c.tags)


@register("badge_list")
def badge_list(spark, sf):
    c = _catalog(spark, sf)
    return U.badge_list(c.badges)


@register("catalog_statistics")
def catalog_statistics(spark, sf):
    c = _catalog(spark, sf)
    owners = c.owners.unionByName(c.dashboard_owners).unionByName(c.feature_owners)
    return U.catalog_statistics(c.tables, c.columns, owners)


@register("dashboard_view_count")
def dashboard_view_count(spark, sf):
    c = _catalog(spark, sf)
    return U.dashboard_view_count(c.dashboards, c.dashboard_reads)


@register("latest_updated")
def latest_updated(spark, sf):
    c = _catalog(spark, sf)
    return U.latest_updated(c.dashboards, "created_timestamp")


@register("action_usage")
def action_usage(spark, sf):
    c = _catalog(spark, sf)
    return U.action_usage(c.action_log)


@register("data_issue_rollup")
def data_issue_rollup(spark, sf):
    c = _catalog(spark, sf)
    return U.data_issue_rollup(c.issues)


@register("personal_popular_for_active_users")
def personal_popular_for_active_users(spark, sf):
    """The request-sized path: recommendations computed only for the users
    asking (here every active user)."""
    c = _catalog(spark, sf)
    asking = c.users.where(F.col("is_active")).select(F.col("email").alias("user_key"))
    df = U.personal_popular_tables(c.read_edges, c.tables, n=PERSONAL_N, min_readers=MIN_READERS, users=asking)
    return df.withColumn("score", r6(F.col("score")))
