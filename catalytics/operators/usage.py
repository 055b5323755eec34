"""Usage operators: popularity, readers, frequently used, tag/badge usage,
catalog statistics, dashboard usage, action-log usage.

Inputs are edge frames; ``reads`` is (user_key, table_key, read_count,
read_date, published_tag). Every per-key ``ORDER BY .. LIMIT`` of the
reference is computed for all keys at once with ``topk_per_key`` and every
global top-n is written *before* hydration (limit, then join)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalytics.operators.co_readers import co_reader_tops
from catalytics.plans import topk_per_key


def _hydrate_tables(top: DataFrame, tables: DataFrame, key: str = "table_key") -> DataFrame:
    """Attach hierarchy + description to a (small) ranked key list."""
    t = tables.select(F.col("key").alias(key), "database", "cluster", "schema", "name",
                      "description")
    return top.join(t, key, "inner")


def table_usage(reads: DataFrame, distinct_readers: bool = True) -> DataFrame:
    """(table_key, readers, total_reads) per table."""
    readers = (F.countDistinct("user_key") if distinct_readers else F.count("user_key"))
    return reads.groupBy("table_key").agg(readers.alias("readers"),
                                          F.sum("read_count").alias("total_reads"))


def popular_tables(reads: DataFrame, tables: DataFrame, n: int = 10, min_readers: int = 10,
                   distinct_readers: bool = True) -> DataFrame:
    """Global popular tables: readers >= min_readers, score = readers *
    ln(total_reads), top n by score (ties by key), hydrated."""
    u = table_usage(reads, distinct_readers).where(F.col("readers") >= min_readers)
    u = u.withColumn("score", F.col("readers") * F.log(F.col("total_reads")))
    top = u.orderBy(F.desc("score"), F.asc("table_key")).limit(n)
    return _hydrate_tables(top, tables)


def popular_tables_by_rows(reads: DataFrame, tables: DataFrame, n: int = 10,
                           min_readers: int = 10) -> DataFrame:
    """Relational-store variant: readers = count of READ rows (not distinct)."""
    return popular_tables(reads, tables, n, min_readers, distinct_readers=False)


def popular_tables_by_total(reads: DataFrame, tables: DataFrame, n: int = 10) -> DataFrame:
    """Gremlin variant: top n by sum(read_count) (null counts as 0), no threshold."""
    u = reads.groupBy("table_key").agg(
        F.sum(F.coalesce(F.col("read_count"), F.lit(0))).cast("long").alias("total_reads"))
    top = u.orderBy(F.desc("total_reads"), F.asc("table_key")).limit(n)
    return _hydrate_tables(top, tables)


def popular_tables_by_stored_score(tables: DataFrame, n: int = 10) -> DataFrame:
    """Atlas variant: top n active tables by their stored popularity score."""
    t = tables.where(F.upper(F.col("status")) == "ACTIVE")
    return (t.orderBy(F.desc("popularity_score"), F.asc("key")).limit(n)
            .select(F.col("key").alias("table_key"), "database", "cluster", "schema", "name",
                    "description", "popularity_score"))


def personal_popular_tables(reads: DataFrame, tables: DataFrame, n: int = 10,
                            min_readers: int = 10, users: DataFrame | None = None) -> DataFrame:
    """Per user: tables read by co-readers (peers sharing another table).

    Path semantics (u, T, co, t) with co != u and t != T; several READ edges
    of one user and table give as many paths. A co-reader counts once, and not
    at all for a table that is the only one it shares with the user; total is
    the sum of read_count over paths. Joined and summed by blocks of users
    (``co_readers.co_reader_tops``), then hydrated with the columns that
    ``tables`` has of hierarchy and description; a table without a record
    keeps its rank."""
    top = co_reader_tops(reads, n, min_readers, users)
    top = top.withColumn("score", F.col("co_readers") * F.log(F.col("total_co_reads")))
    found = [c for c in ("database", "cluster", "schema", "name", "description") if c in tables.columns]
    return top.join(tables.select(F.col("key").alias("table_key"), *found), "table_key", "left").select(
        "user_key", "table_key", "co_readers", "total_co_reads", "score", "rank", *found)


def personal_tables_own_reads(reads: DataFrame, n: int = 10, min_readers: int = 10) -> DataFrame:
    """Relational-store variant of personal popularity: only the user's own
    READ rows are grouped, so readers is 1 per table and the default
    threshold removes everything (kept as documented behaviour)."""
    g = (reads.groupBy("user_key", "table_key")
         .agg(F.count(F.lit(1)).alias("readers"), F.sum("read_count").alias("total_reads"))
         .where(F.col("readers") >= min_readers)
         .withColumn("score", F.col("readers") * F.log(F.col("total_reads"))))
    return topk_per_key(g, "user_key", [F.desc("score"), F.asc("table_key")], n, rank_col="rank")


def top_readers_per_table(reads: DataFrame, users: DataFrame, n: int = 5,
                          min_count: int | None = None, since=None, ascending: bool = False,
                          active_only: bool = False) -> DataFrame:
    """Top n readers per table by read_count (desc; asc for the relational
    variant), optional minimum count, date bound and active-user filter."""
    r = reads
    if min_count is not None:
        r = r.where(F.col("read_count") >= min_count)
    if since is not None:
        r = r.where(F.col("read_date") >= F.lit(since).cast("date"))
    if active_only:
        r = r.join(users.where(F.col("is_active")).select(F.col("email").alias("user_key")),
                   "user_key", "left_semi")
    order = F.asc("read_count") if ascending else F.desc("read_count")
    top = topk_per_key(r, "table_key", [order, F.asc("user_key")], n, rank_col="rank")
    u = users.select(F.col("email").alias("user_key"), "full_name", "team_name")
    return top.join(u, "user_key", "left").select(
        "table_key", "user_key", "full_name", "team_name", "read_count", "rank")


def reads_last_n_days(reads: DataFrame, as_of, days: int = 5) -> DataFrame:
    """Sum of read_count per table over READ edges dated >= as_of - days;
    tables with a zero sum are omitted."""
    lo = F.date_sub(F.lit(as_of).cast("date"), days)
    return (reads.where(F.col("read_date") >= lo).groupBy("table_key")
            .agg(F.sum("read_count").cast("long").alias("recent_reads"))
            .where(F.col("recent_reads") > 0))


def frequently_used_tables(reads: DataFrame, tables: DataFrame, n: int = 50) -> DataFrame:
    """Per user: READ edges with a published tag, by published_tag desc,
    read_count desc, top n, hydrated with hierarchy and description."""
    r = reads.where(F.col("published_tag").isNotNull())
    top = topk_per_key(r, "user_key", [F.desc("published_tag"), F.desc("read_count"),
                                       F.asc("table_key")], n, rank_col="rank")
    return _hydrate_tables(top.select("user_key", "table_key", "published_tag", "read_count", "rank"),
                           tables)


def frequently_used_by_count(reads: DataFrame) -> DataFrame:
    """Atlas variant: per user the tables are keyed by read count (one table
    per distinct count survives -- ours: the greatest key), listed by count
    ascending."""
    g = (reads.where(F.col("read_count").isNotNull() & (F.col("read_count") != 0))
         .groupBy("user_key", "read_count").agg(F.max("table_key").alias("table_key")))
    w = F.row_number().over(Window.partitionBy("user_key").orderBy(F.asc("read_count")))
    return g.withColumn("position", w.cast("long"))


def tag_usage(tags: DataFrame, tag_type: str = "default") -> DataFrame:
    """(tag_name, tag_count): distinct resources per tag of the given type,
    zero-count tags dropped."""
    return (tags.where(F.col("tag_type") == tag_type).groupBy(F.col("tag").alias("tag_name"))
            .agg(F.countDistinct("resource_key").alias("tag_count"))
            .where(F.col("tag_count") > 0))


def badge_list(badges: DataFrame) -> DataFrame:
    return badges.select("badge_name", "category").distinct()


def catalog_statistics(tables: DataFrame, columns: DataFrame, owner_edges: DataFrame) -> DataFrame:
    """One row of catalog counts. ``owner_edges`` = (resource_key, user_key)
    over every owned node (tables, dashboards, features). Empty inputs give
    zeros, not an empty result. The owned-and-documented count counts
    (description, owner) pairs as the path match does."""
    described = F.length("description") > 2
    documented = tables.where(described).select(F.col("key").alias("resource_key"), F.lit(True).alias("documented"))
    edges = owner_edges.select("resource_key", "user_key").join(documented, "resource_key", "left")

    # global aggregates always yield exactly one row (0 on empty input)
    parts = [
        tables.agg(F.count(F.lit(1)).alias("number_of_tables"), F.count_if(described).alias("number_of_documented_tables")),
        columns.agg(F.count_if(described).alias("number_of_documented_cols")),
        edges.agg(F.countDistinct("resource_key").alias("number_of_tables_with_owners"),
                  F.countDistinct("user_key").alias("number_of_owners"),
                  F.count_if("documented").alias("number_of_documented_and_owned_tables")),
    ]
    # three rows -> one row (no join needed)
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return long.agg(*[F.max(m).alias(m) for m in STATISTICS])


STATISTICS = ["number_of_tables", "number_of_documented_tables", "number_of_documented_cols",
              "number_of_tables_with_owners", "number_of_owners",
              "number_of_documented_and_owned_tables"]


def dashboard_view_count(dashboards: DataFrame, dashboard_reads: DataFrame) -> DataFrame:
    """recent_view_count = sum(read_count) per dashboard, 0 when unread."""
    r = dashboard_reads.groupBy("dashboard_key").agg(F.sum("read_count").alias("v"))
    return (dashboards.select(F.col("key").alias("dashboard_key"))
            .join(r, "dashboard_key", "left")
            .select("dashboard_key", F.coalesce(F.col("v"), F.lit(0)).cast("long")
                    .alias("recent_view_count")))


def latest_updated(updates: DataFrame, ts_col: str) -> DataFrame:
    """Newest update timestamp (one row)."""
    return updates.agg(F.max(ts_col).alias("latest_timestamp"))


def action_usage(action_log: DataFrame) -> DataFrame:
    """Per (command, user): action count, mean duration (ms), error count
    and error rate from the action log."""
    dur = (F.col("end_epoch_ms") - F.col("start_epoch_ms")).cast("double")
    return (action_log.groupBy("command", "user")
            .agg(F.count(F.lit(1)).alias("n_actions"), F.round(F.avg(dur), 6).alias("avg_duration_ms"),
                 F.count_if(F.col("error").isNotNull()).alias("n_errors"))
            .withColumn("error_rate", F.round(F.col("n_errors") / F.col("n_actions"), 6)))


def data_issue_rollup(issues: DataFrame) -> DataFrame:
    """Per table: open and resolved issue counts, total, and the open count
    per priority (P0..P3, from the severity name)."""
    prio = (F.when(F.col("severity") == "Critical", "P0").when(F.col("severity") == "Major", "P1")
            .when(F.col("severity") == "Minor", "P2").otherwise("P3"))
    x = issues.withColumn("priority", prio)
    is_open = F.col("status") != "resolved"
    return x.groupBy("table_key").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_open).alias("open"),
        F.count_if(~is_open).alias("resolved"),
        *[F.count_if(is_open & (F.col("priority") == p)).alias(f"open_{p.lower()}")
          for p in ("P0", "P1", "P2", "P3")])
