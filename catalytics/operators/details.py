"""Detail roll-ups and relationship joins.

The reference answers one key per request with pattern matches; here each
operator answers every key at once. Every child collection is aggregated to
one row per parent *before* it is joined to the parent (collect-then-join),
so parent x child_a x child_b never fans out. All aggregates are keyed on
the parent key, so the joins that follow reuse that hash partitioning
instead of re-shuffling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.operators.co_readers import dense_ids
from catalytics.plans import collect_distinct_children, gather_children, spread, topk_per_key, written


# ------------------------------------------------------------------ tables
def table_hierarchy(tables: DataFrame, table_schema_edges: DataFrame, schemas: DataFrame,
                    clusters: DataFrame, databases: DataFrame) -> DataFrame:
    """Database -> Cluster -> Schema -> Table inner path (a table missing a
    level is dropped). The three upper levels are tiny (one row per
    schema), so Spark broadcasts them at runtime."""
    s = schemas.select(F.col("key").alias("schema_key"), F.col("name").alias("schema_name"),
                       "cluster_key")
    c = clusters.select(F.col("key").alias("cluster_key"), F.col("name").alias("cluster_name"),
                        "database_key")
    d = databases.select(F.col("key").alias("database_key"), F.col("name").alias("database_name"))
    t = tables.select(F.col("key").alias("table_key"), F.col("name").alias("table_name"))
    return (t.join(table_schema_edges, "table_key").join(s, "schema_key").join(c, "cluster_key")
            .join(d, "database_key")
            .select("table_key", "database_name", "cluster_name", "schema_name", "table_name"))


def column_children(columns: DataFrame, column_stats: DataFrame,
                    column_badges: DataFrame | None = None) -> DataFrame:
    """Columns with their stats and badges folded in (one row per column)."""
    sets = {"stats": (column_stats, "column_key", F.struct("stat_type", "stat_val", "start_epoch", "end_epoch"))}
    if column_badges is not None:
        sets["badges"] = (column_badges, "resource_key", F.struct("badge_name", "category"))
    cols = columns.join(spread(gather_children("key", sets)), "key", "left")
    if column_badges is None:
        cols = cols.withColumn("badges", F.lit(None).cast("array<struct<badge_name:string,category:string>>"))
    return cols


def table_columns(tables: DataFrame, columns: DataFrame, column_stats: DataFrame,
                  column_badges: DataFrame | None = None) -> DataFrame:
    """Per table: its columns ordered by sort_order with description, stats
    and badges. Inner on columns: a table without columns is not found."""
    cols = column_children(columns, column_stats, column_badges)
    per_table = cols.groupBy("table_key").agg(
        F.array_sort(F.collect_list(F.struct(
            "sort_order", "name", "col_type", "description",
            F.coalesce("stats", F.array()).alias("stats"),
            F.coalesce("badges", F.array()).alias("badges")))).alias("columns"))
    return tables.select(F.col("key").alias("table_key"), "database", "cluster", "schema",
                         "name", "description").join(spread(per_table), "table_key")


def table_detail(tables: DataFrame, columns: DataFrame, column_stats: DataFrame,
                 reads: DataFrame, owners: DataFrame, tags: DataFrame, badges: DataFrame,
                 watermarks: DataFrame, prog_descriptions: DataFrame | None = None,
                 n_readers: int = 5, column_badges: DataFrame | None = None,
                 writers: DataFrame | None = None, updates: DataFrame | None = None,
                 sources: DataFrame | None = None) -> DataFrame:
    """One row per table with everything the detail page shows: hierarchy,
    is_view, columns, top readers, owners, default tags, badges, watermarks
    and, where their frames are given, ``programmatic_descriptions`` (null
    sources skipped, sorted by source), ``table_writer`` (the application that
    generates it), ``last_updated_timestamp`` (newest) and ``source``. A table
    with several writers or sources shows the smallest."""
    base = table_columns(tables, columns, column_stats, column_badges)
    readers = topk_per_key(reads, "table_key", [F.desc("read_count"), F.asc("user_key")],
                           n_readers, rank_col="rank")
    sets = {
        "table_readers": (readers, "table_key", F.struct("rank", "user_key", "read_count")),
        "owners": (owners, "resource_key", "user_key"),
        "tags": (tags.where(F.col("tag_type") == "default"), "resource_key", "tag"),
        "badges": (badges, "resource_key", F.struct("badge_name", "category")),
        "watermarks": (watermarks, "table_key", F.struct("watermark_type", "partition_key", "partition_value", "create_time")),
    }
    single = {}
    if prog_descriptions is not None:
        sets["programmatic_descriptions"] = (prog_descriptions.where(F.col("source").isNotNull()), "resource_key",
                                             F.struct("source", "text"))
    if writers is not None:
        sets["table_writer"] = (writers, "table_key", F.struct("id", "name", "application_url", "description"))
        single["table_writer"] = F.get("table_writer", F.lit(0))
    if sources is not None:
        sets["source"] = (sources, "table_key", F.struct("source_type", "source"))
        single["source"] = F.get("source", F.lit(0))
    latest = {"last_updated_timestamp": (updates, "table_key", "last_updated_timestamp")} if updates is not None else None
    children = gather_children("table_key", sets, latest).withColumns(single)
    if "is_view" in tables.columns:
        base = base.join(spread(tables.select(F.col("key").alias("table_key"), "is_view")), "table_key")
    return base.join(spread(children), "table_key", "left")


# -------------------------------------------------------------- dashboards
def last_executions(executions: DataFrame) -> DataFrame:
    """Per dashboard: last run (ts, state) and last successful run ts.
    Ties on ts are broken by state so the result is deterministic."""
    g = executions.groupBy("dashboard_key").agg(
        F.max(F.struct("ts", "state")).alias("last"),
        F.max(F.when(F.col("state") == "succeeded", F.col("ts"))).alias("last_successful_run_timestamp"))
    return g.select("dashboard_key", F.col("last.ts").alias("last_run_timestamp"),
                    F.col("last.state").alias("last_run_state"), "last_successful_run_timestamp")


def execution_nodes(executions: DataFrame) -> DataFrame:
    """Graph form of the last runs: two execution nodes per dashboard under
    reserved keys ``<dashboard>/_execution/_last_execution`` and
    ``.../_last_successful_execution`` with (timestamp, state)."""
    last = last_executions(executions)
    run = last.select(F.concat("dashboard_key", F.lit("/_execution/_last_execution")).alias("key"),
                      F.col("last_run_timestamp").alias("timestamp"), F.col("last_run_state").alias("state"))
    ok = last.where(F.col("last_successful_run_timestamp").isNotNull()).select(
        F.concat("dashboard_key", F.lit("/_execution/_last_successful_execution")).alias("key"),
        F.col("last_successful_run_timestamp").alias("timestamp"), F.lit("succeeded").alias("state"))
    return run.unionByName(ok)


def last_runs_from_nodes(nodes: DataFrame) -> DataFrame:
    """Read execution nodes back: the kind is key segment 5 (0-based), the
    dashboard is everything before '/_execution'."""
    from catalytics.functions.keys import key_segment
    x = nodes.select(F.substring_index("key", "/_execution", 1).alias("dashboard_key"),
                     key_segment(F.col("key"), 5).alias("kind"), "timestamp", "state")
    return x.groupBy("dashboard_key").agg(
        F.max(F.when(F.col("kind") == "_last_execution", F.col("timestamp"))).alias("last_run_timestamp"),
        F.max(F.when(F.col("kind") == "_last_execution", F.col("state"))).alias("last_run_state"),
        F.max(F.when(F.col("kind") == "_last_successful_execution", F.col("timestamp")))
        .alias("last_successful_run_timestamp"))


def watermark_nodes(watermarks: DataFrame) -> DataFrame:
    """Graph form of table watermarks: key ``<table>/<type>/``."""
    return watermarks.select(F.concat("table_key", F.lit("/"), "watermark_type", F.lit("/")).alias("key"),
                             "partition_key", "partition_value", "create_time")


def watermarks_from_nodes(nodes: DataFrame) -> DataFrame:
    """Watermark type = second-last key segment (table form)."""
    from catalytics.functions.keys import key_segment
    t = key_segment(F.col("key"), -2)
    return nodes.select(F.regexp_extract("key", r"^(.*)/[^/]*/$", 1).alias("table_key"),
                        t.alias("watermark_type"), "partition_key", "partition_value")


def dashboard_detail(dashboards: DataFrame, executions: DataFrame, dashboard_reads: DataFrame,
                     owners: DataFrame, tags: DataFrame, badges: DataFrame | None,
                     queries: DataFrame, charts: DataFrame, dashboard_tables: DataFrame,
                     updates: DataFrame | None = None) -> DataFrame:
    """One row per dashboard: runs, updated timestamp, view count, owners,
    default tags, badges, queries (kept if any of name/url/text is present),
    non-empty chart names, tables used."""
    q = queries.where(F.col("name").isNotNull() | F.col("url").isNotNull()
                      | F.col("query_text").isNotNull())
    sets = [
        (owners, "resource_key", "user_key", "owners"),
        (tags.where(F.col("tag_type") == "default"), "resource_key", "tag", "tags"),
        (q, "dashboard_key", F.struct("name", "url", "query_text"), "queries"),
        (charts.where(F.length("chart_name") > 0), "dashboard_key", "chart_name", "chart_names"),
        (dashboard_tables, "dashboard_key", "table_key", "tables"),
    ]
    if badges is not None:
        sets.append((badges, "resource_key", F.struct("badge_name", "category"), "badges"))
    views = dashboard_reads.groupBy("dashboard_key").agg(F.sum("read_count").alias("v"))
    out = dashboards.select(F.col("key").alias("dashboard_key"), "name", "url", "group_name",
                            "cluster", "product", "description", "created_timestamp",
                            *[c for c in ("group_url",) if c in dashboards.columns])
    out = (out.join(last_executions(executions), "dashboard_key", "left").join(views, "dashboard_key", "left")
           .withColumn("recent_view_count", F.coalesce(F.col("v"), F.lit(0)).cast("long")).drop("v"))
    if updates is not None:
        newest = updates.groupBy("dashboard_key").agg(F.max("updated_timestamp").alias("updated_timestamp"))
        out = out.join(newest, "dashboard_key", "left")
    # millions of children of many kinds: one aggregate a kind is measurably faster here than one set of all
    for df, key, child, name in sets:
        out = out.join(collect_distinct_children(df, key, child, name).withColumnRenamed(key, "dashboard_key"), "dashboard_key", "left")
    return out


def dashboards_using_table(dashboards: DataFrame, dashboard_tables: DataFrame,
                           dashboard_reads: DataFrame, executions: DataFrame) -> DataFrame:
    """Per table: dashboards that use it with summary columns and total
    reads (0 when unread -- left join), sorted by table, reads desc, key."""
    views = dashboard_reads.groupBy("dashboard_key").agg(F.sum("read_count").alias("v"))
    ex = last_executions(executions).select("dashboard_key", "last_successful_run_timestamp")
    d = dashboards.select(F.col("key").alias("dashboard_key"), "name", "group_name", "product",
                          "description")
    x = (dashboard_tables.join(d, "dashboard_key").join(views, "dashboard_key", "left")
         .join(ex, "dashboard_key", "left")
         .withColumn("total_reads", F.coalesce(F.col("v"), F.lit(0)).cast("long")).drop("v"))
    # A global range sort (not a per-table window): a table used by a third
    # of all dashboards is split across range partitions by its second key.
    return x.orderBy("table_key", F.desc("total_reads"), "dashboard_key")


# ---------------------------------------------------------------- features
def feature_detail(features: DataFrame, feature_databases: DataFrame, owners: DataFrame,
                   tags: DataFrame, badges: DataFrame | None, watermarks: DataFrame) -> DataFrame:
    """Feature + group, availability, owners, tags (any type), badges,
    description, watermarks (type = last key segment)."""
    sets = {
        "availability": (feature_databases, "feature_key", "database"),
        "owners": (owners, "resource_key", "user_key"),
        "tags": (tags, "resource_key", "tag"),
        "watermarks": (watermarks.withColumn("watermark_type", F.element_at(F.split("key", "/"), -1)), "feature_key",
                       F.struct("watermark_type", "time")),
    }
    if badges is not None:
        sets["badges"] = (badges, "resource_key", F.struct("badge_name", "category"))
    f = features.select(F.col("key").alias("feature_key"), "name", "version", "feature_group",
                        "data_type", "entity", "status", "description")
    return f.join(gather_children("feature_key", sets), "feature_key", "left")


def feature_generation_code(features: DataFrame, code: DataFrame) -> DataFrame:
    """Generation code per feature; features without code are dropped."""
    return features.select(F.col("key").alias("feature_key")).join(code, "feature_key")


# ------------------------------------------------------------------- users
def user_profile(users: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """User left-joined to its manager: manager name '' when absent unless a
    stored manager_fullname exists; is_active defaults to false."""
    m = users.select(F.col("email").alias("manager_email"),
                     F.col("full_name").alias("_mgr_name"))
    cols = ["email", "first_name", "last_name", "full_name", "team_name", "employee_type",
            "github_username", "slack_id", "role_name", "manager_email"]
    cols += list(extra_keys or [])
    return users.join(m, "manager_email", "left").select(
        *cols,
        F.coalesce(F.col("manager_fullname"), F.col("_mgr_name"), F.lit("")).alias("manager_fullname"),
        F.coalesce(F.col("is_active"), F.lit(False)).alias("is_active"))


def active_users(users: DataFrame) -> DataFrame:
    return users.where(F.col("is_active"))


def resource_description(resources: DataFrame, descriptions: DataFrame) -> DataFrame:
    """(key, description) for every resource; NULL when it has none."""
    return resources.select("key").join(
        descriptions.select(F.col("resource_key").alias("key"), "description"), "key", "left")


def column_parent(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """Owning table of each column (inner: orphan columns dropped)."""
    return columns.select(F.col("key").alias("column_key"), "table_key").join(
        tables.select(F.col("key").alias("table_key")), "table_key")


def table_reports(reports: DataFrame) -> DataFrame:
    """Active reports per table, sorted by (name, url)."""
    r = reports.where(F.upper(F.col("status")) == "ACTIVE")
    return r.groupBy("table_key").agg(
        F.array_sort(F.collect_list(F.struct("name", "url"))).alias("reports"))


def user_resources(edges: DataFrame, resources: DataFrame, relation: str) -> DataFrame:
    """Resources per user for one relation (follow / own / read), with the
    resource summary. Several edges per (user, resource) collapse to one."""
    e = edges.select("user_key", F.col("resource_key").alias("key")).dropDuplicates(["user_key", "key"])
    return e.join(spread(resources), "key").withColumn("relation", F.lit(relation))


def owned_resources_union(owner_edges: DataFrame, resources: DataFrame, users: DataFrame,
                          owner_field: str = "owner") -> DataFrame:
    """Owned = resources in the user's OWNS edges union resources whose
    owner field starts with the lower-cased user id."""
    by_edge = owner_edges.select("user_key", F.col("resource_key").alias("key"))
    # Prefix match as an equi-join: a prefix can equal a user id only if some
    # id is as long, so each resource emits one row per length that occurs
    # (one short driver list), not one per character; short prefixes that
    # all owner fields share are never emitted.
    u = users.select(F.col("email").alias("user_key"), F.lower(F.col("email")).alias("_p"))
    lengths = sorted(r["n"] for r in u.select(F.length("_p").alias("n")).distinct().collect() if r["n"])
    if not lengths:
        return by_edge.distinct()
    r = resources.select("key", F.lower(F.col(owner_field)).alias("_owner"))
    pref = r.select("key", "_owner", F.explode(F.array(*map(F.lit, lengths))).alias("_n")) \
        .where(F.col("_n") <= F.length("_owner")).select("key", F.substring("_owner", F.lit(1), F.col("_n")).alias("_p"))
    by_field = pref.join(u, "_p").select("user_key", "key")
    return by_edge.unionByName(by_field).distinct()


def owners_with_fallback(owner_edges: DataFrame, users: DataFrame, resources: DataFrame,
                         fallback_col: str = "owner") -> DataFrame:
    """Active owners per resource; the resource's fallback owner is appended
    only when not already listed."""
    act = owner_edges.join(users.where(F.col("is_active")).select(F.col("email").alias("user_key")),
                           "user_key", "left_semi")
    listed = act.groupBy("resource_key").agg(F.array_sort(F.collect_set("user_key")).alias("owners"))
    fb = resources.select(F.col("key").alias("resource_key"), F.col(fallback_col).alias("fallback"))
    x = fb.join(listed, "resource_key", "left").withColumn("owners", F.coalesce("owners", F.array()))
    return x.select("resource_key", F.when(
        F.col("fallback").isNull() | F.array_contains("owners", F.col("fallback")), F.col("owners"))
        .otherwise(F.concat("owners", F.array(F.col("fallback")))).alias("owners"))


def co_reader_paths(reads: DataFrame) -> DataFrame:
    """(u, via, co, t) reader paths with pairwise-distinct edges (co != u,
    t != via). Enumerates every path -- the building block the weighted form
    in ``usage.personal_popular_tables`` avoids; use on bounded inputs."""
    a = reads.select(F.col("user_key").alias("u"), F.col("table_key").alias("via"))
    b = reads.select(F.col("user_key").alias("co"), F.col("table_key").alias("via"))
    c = reads.select(F.col("user_key").alias("co"), F.col("table_key").alias("t"),
                     F.col("read_count").alias("rc"))
    return (a.join(b, "via").where(F.col("u") != F.col("co")).join(c, "co")
            .where(F.col("t") != F.col("via")))


def co_reader_path_stats(reads: DataFrame, chunk: int = 512) -> DataFrame:
    """Per user: number of co-reader paths, distinct co-readers with a path,
    and the read_count summed over paths -- without a row per pair of users.

    Paths and reads are sums over the shared tables: the paths over table T
    are ku * (sum over its readers of k * (edges(co) - k)) less the user's own
    term, and likewise with read_count. Distinct co-readers are counted from
    the readers' numbers, of which each table sends its users lists of at most
    ``chunk``; a user's lists are merged where they arrive, so memory is that
    of one user's distinct co-readers. Several READ edges of one user and table
    each make a path."""
    edges = reads.groupBy("user_key", "table_key").agg(
        F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("read_count"), F.lit(0)).alias("rc"))
    deg = edges.where(F.col("user_key").isNotNull()).groupBy("user_key").agg(
        F.count(F.lit(1)).alias("deg"), F.sum("k").alias("n_edges"), F.sum("rc").alias("total_rc"))
    people = written(dense_ids(deg, "user_key", "u").withColumn("u", F.col("u").cast("int")), "path-users")
    e = written(edges.where(F.col("table_key").isNotNull()).join(people, "user_key").select(
        "u", "table_key", "k", (F.col("k") * (F.col("n_edges") - F.col("k"))).alias("n"),
        (F.col("k") * (F.col("total_rc") - F.col("rc"))).alias("r"), (F.col("deg") >= 2).alias("can")), "path-edges")
    via = e.groupBy("table_key").agg(F.sum("n").alias("__n"), F.sum("r").alias("__r"), F.count(F.lit(1)).alias("__readers"))
    sums = e.join(via, "table_key").groupBy("u").agg(
        F.sum(F.col("k") * (F.col("__n") - F.col("n"))).cast("long").alias("n_paths"),
        F.sum(F.col("k") * (F.col("__r") - F.col("r"))).cast("long").alias("path_reads"))

    # a table's readers in lists of about ``chunk``, whatever their number
    part = F.pmod(F.hash("u"), F.ceil(F.col("__readers") / chunk))
    lists = e.where("can").join(via.select("table_key", "__readers"), "table_key").groupBy("table_key", part.alias("__part")).agg(
        F.collect_list("u").alias("__co")).drop("__part")
    sent = e.select("u", "table_key").join(lists, "table_key").select("u", "__co")
    co = sent.repartition("u").sortWithinPartitions("u").mapInArrow(_count_others, "u int, n_co_readers long")
    return (sums.where(F.col("n_paths") > 0).join(co, "u", "left").join(people.select("u", "user_key"), "u")
            .select("user_key", "n_paths", F.coalesce("n_co_readers", F.lit(0).cast("long")).alias("n_co_readers"), "path_reads"))


def _count_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, number of distinct members of its lists other than u) of rows
    (u, list) sorted by u."""
    def counted(users: list[int], numbers: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(users, pa.int32()), pa.array(numbers, pa.int64())], ["u", "n_co_readers"])

    at, held, size = None, [], 0
    for b in batches:
        users, numbers = [], []
        u, lists = b.column(0).to_numpy(), b.column(1)
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        starts = np.flatnonzero(np.diff(u, prepend=u[:1] - 1)) if len(u) else []
        for lo, hi in zip(starts, [*starts[1:], len(u)]):
            if u[lo] != at:
                if at is not None:
                    users.append(at)
                    numbers.append(_others(at, held))
                at, held, size = int(u[lo]), [], 0
            held.append(values[offsets[lo]:offsets[hi]])
            size += len(held[-1])
            if len(held) > 1 and size > 2 * len(held[0]) + 65536:  # merged as they grow
                held = [np.unique(np.concatenate(held))]
                size = len(held[0])
        yield counted(users, numbers)
    if at is not None:
        yield counted([at], [_others(at, held)])


def _others(user: int, held: list[np.ndarray]) -> int:
    found = np.unique(np.concatenate(held))
    return len(found) - int(user in found)


def orphan_check(changes: DataFrame, resources: DataFrame, key: str = "resource_key"):
    """Split changes into (valid, rejected) by existence of the resource."""
    r = resources.select(F.col("key").alias(key)).distinct()
    return changes.join(r, key, "left_semi"), changes.join(r, key, "left_anti")


def event_registration_join(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Enrich events with the registration record (left: unregistered pets
    keep their events). Works unchanged on a streaming ``events``."""
    return events.join(registry, "pet_id", "left")


def recipients_except_sender(changes: DataFrame, owners: DataFrame, users: DataFrame) -> DataFrame:
    """Notification fan-out: owners of each changed resource except the
    actor; only active users that have a display name."""
    u = users.where(F.col("is_active") & (F.length(F.coalesce("full_name", F.lit(""))) > 0)) \
        .select(F.col("email").alias("user_key"), F.col("full_name").alias("display_name"))
    x = changes.select("seq", "resource_key", "actor").join(owners, "resource_key")
    return x.where(F.col("user_key") != F.col("actor")).join(u, "user_key").select(
        "seq", "resource_key", F.col("user_key").alias("recipient"), "display_name")
