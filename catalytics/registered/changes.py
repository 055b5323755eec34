"""Registered change-feed queries (feed derived from ``events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalytics.operators import changes as C
from catalytics.operators.search import assemble_table_docs
from catalytics.operators.usage import tag_usage
from catalytics.registry import _catalog, register

# Badge whitelist (name, category) of the registered queries.
BADGE_WHITELIST = [("tiny", "size"), ("medium", "size"), ("large", "size"),
                   ("beta", "table_status"), ("tag3", "table_status")]
USER_PROPS = ["first_name", "last_name", "full_name", "team_name", "is_active"]


def _whitelist(spark):
    return spark.createDataFrame(BADGE_WHITELIST, "badge_name string, category string")


def _descs(c):
    return c.tables.where(F.col("description").isNotNull()).select(
        F.col("key").alias("resource_key"), "description")


@register("apply_descriptions")
def apply_descriptions(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_descriptions(_descs(c), c.change_feed, c.tables)[0]


@register("apply_descriptions_rejects")
def apply_descriptions_rejects(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_descriptions(_descs(c), c.change_feed, c.tables)[1]


@register("apply_owners")
def apply_owners(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_owners(c.owners, c.users, c.change_feed, c.tables)[0]


@register("apply_owners_created_users")
def apply_owners_created_users(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_owners(c.owners, c.users, c.change_feed, c.tables)[1]


@register("apply_owners_rejects")
def apply_owners_rejects(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_owners(c.owners, c.users, c.change_feed, c.tables)[2]


@register("apply_user_relations_rejects")
def apply_user_relations_rejects(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_user_relations(_follows(c), c.users, c.change_feed, c.tables, "follow")[2]


def _tags(c):
    nodes = c.tags.select("tag", "tag_type").distinct()
    return C.apply_tags(c.tags, nodes, c.change_feed, c.tables, [b for b, _ in BADGE_WHITELIST])


@register("apply_tags")
def apply_tags(spark, sf):
    return _tags(_catalog(spark, sf))[0]


@register("apply_tags_nodes")
def apply_tags_nodes(spark, sf):
    return _tags(_catalog(spark, sf))[1]


@register("apply_tags_rejects")
def apply_tags_rejects(spark, sf):
    return _tags(_catalog(spark, sf))[2]


@register("apply_badges")
def apply_badges(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_badges(c.badges, c.change_feed, c.tables, _whitelist(spark))[0]


@register("apply_badges_rejects")
def apply_badges_rejects(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_badges(c.badges, c.change_feed, c.tables, _whitelist(spark))[1]


def _follows(c):
    return c.reads.where(F.col("read_count") >= 3).select("user_key", F.col("table_key").alias("resource_key"))


@register("apply_user_relations")
def apply_user_relations(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_user_relations(_follows(c), c.users, c.change_feed, c.tables, "follow")[0]


@register("apply_user_relations_soft")
def apply_user_relations_soft(spark, sf):
    c = _catalog(spark, sf)
    return C.apply_user_relations(_follows(c), c.users, c.change_feed, c.tables, "follow",
                                  soft_delete=True)[0]


def _incoming(c):
    cu = c.raw("customer")
    k = cu.c_custkey + 1000
    return cu.select(
        F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(cu.c_custkey % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("First"), k.cast("string")))
        .alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.upper(cu.c_name).alias("full_name"),
        F.when(cu.c_custkey % 3 == 0, F.lit(None).cast("string")).otherwise(F.lower(cu.c_mktsegment))
        .alias("team_name"),
        F.when(cu.c_custkey % 5 == 0, F.lit(None).cast("boolean")).otherwise(cu.c_acctbal > 1000)
        .alias("is_active"))


@register("upsert_users")
def upsert_users(spark, sf):
    c = _catalog(spark, sf)
    return C.upsert_users(c.users, _incoming(c), USER_PROPS, audit_ts="2024-01-01 00:00:00")


@register("property_diff")
def property_diff(spark, sf):
    c = _catalog(spark, sf)
    new = C.upsert_users(c.users, _incoming(c), USER_PROPS, audit_ts="2024-01-01 00:00:00")
    d = C.property_diff(c.users, new, "email", USER_PROPS)
    return d.select("email", F.array_join("changed", "|").alias("changed"),
                    F.array_join("dropped", "|").alias("dropped"))


def _owner_puts(c):
    ch = c.change_feed.where((F.col("kind") == "owner") & (F.col("op") == "put"))
    return C.latest_per_identity(ch.select("resource_key", "seq", F.col("value").alias("user_key")),
                                 ["resource_key"]).select("resource_key", "user_key")


@register("expire_other_links")
def expire_other_links(spark, sf):
    c = _catalog(spark, sf)
    return C.expire_other_links(c.owners, _owner_puts(c), "resource_key", "user_key")


@register("expire_link")
def expire_link(spark, sf):
    c = _catalog(spark, sf)
    return C.expire_link(c.owners, _owner_puts(c), "resource_key", "user_key")


@register("link_if_absent")
def link_if_absent(spark, sf):
    c = _catalog(spark, sf)
    new = c.change_feed.where((F.col("kind") == "owner") & (F.col("op") == "put")).select(
        "resource_key", F.col("value").alias("user_key"))
    return C.link_if_absent(c.owners, new, c.tables.select("key"), c.users.select("email"),
                            "resource_key", "user_key")


def _docs(c):
    return assemble_table_docs(c.tables, c.columns, c.tags, c.badges, c.reads).select(
        "key", "name", "description", "total_usage", "tags")


@register("upsert_documents")
def upsert_documents(spark, sf):
    c = _catalog(spark, sf)
    ch = c.change_feed.where(F.col("kind") == "description").select(
        F.col("resource_key").alias("key"), "seq", "op", F.lit(None).cast("string").alias("name"),
        F.col("value").alias("description"), F.lit(None).cast("long").alias("total_usage"))
    return C.upsert_documents(_docs(c).drop("tags"), ch)


@register("delete_documents")
def delete_documents(spark, sf):
    c = _catalog(spark, sf)
    ids = c.change_feed.where(F.col("op") == "delete").select(F.col("resource_key").alias("key"))
    return C.delete_documents(_docs(c).drop("tags"), ids)


@register("update_doc_tags")
def update_doc_tags(spark, sf):
    c = _catalog(spark, sf)
    ch = c.change_feed.where(F.col("kind") == "tag").select(
        F.col("resource_key").alias("key"), F.col("value").alias("tag"), "seq", "op")
    out = C.update_doc_tags(_docs(c).select("key", "tags"), ch)
    return out.select("key", F.array_join("tags", "|").alias("tags"))


@register("tag_partition")
def tag_partition(spark, sf):
    c = _catalog(spark, sf)
    return C.tag_partition(tag_usage(c.tags), None, n=5)


@register("tag_partition_curated")
def tag_partition_curated(spark, sf):
    c = _catalog(spark, sf)
    return C.tag_partition(tag_usage(c.tags), ["red", "blue", "nonexistent"], n=5)
