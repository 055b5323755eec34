"""DuckDB oracle text for the registered queries (same column names)."""

from __future__ import annotations

from catalytics.checks.views import with_views as W
from catalytics.registry import AS_OF, MIN_READERS, PERSONAL_N, POPULAR_N

ORACLES: dict[str, str] = {}


def oracle(name: str, views: list[str], body: str) -> None:
    b = body.lstrip()
    if b.upper().startswith("WITH "):
        # continue the CTE list that ``with_views`` opens
        b = ", " + b[5:]
    if not views:
        ORACLES[name] = ("WITH " + b.lstrip()[1:]) if b.lstrip().startswith(",") else b
        return
    ORACLES[name] = W(views, b)


_HYD = "t.key AS table_key, t.database, t.cluster, t.schema, t.name, t.description"

# ------------------------------------------------------------------ usage
oracle("popular_tables", ["c_reads", "c_tables"], f"""
SELECT {_HYD}, u.readers, u.total_reads, round(u.readers * ln(u.total_reads), 6) AS score
FROM (SELECT table_key, count(DISTINCT user_key) AS readers, cast(sum(read_count) AS BIGINT) AS total_reads
      FROM c_reads GROUP BY table_key HAVING count(DISTINCT user_key) >= {MIN_READERS}
      ORDER BY count(DISTINCT user_key) * ln(sum(read_count)) DESC, table_key LIMIT {POPULAR_N}) u
JOIN c_tables t ON t.key = u.table_key""")

oracle("popular_tables_by_rows", ["c_reads", "c_tables"], f"""
SELECT {_HYD}, u.readers, u.total_reads, round(u.readers * ln(u.total_reads), 6) AS score
FROM (SELECT table_key, count(user_key) AS readers, cast(sum(read_count) AS BIGINT) AS total_reads
      FROM c_reads GROUP BY table_key HAVING count(user_key) >= {MIN_READERS}
      ORDER BY count(user_key) * ln(sum(read_count)) DESC, table_key LIMIT {POPULAR_N}) u
JOIN c_tables t ON t.key = u.table_key""")

oracle("popular_tables_by_total", ["c_reads", "c_tables"], f"""
SELECT {_HYD}, u.total_reads
FROM (SELECT table_key, cast(sum(coalesce(read_count, 0)) AS BIGINT) AS total_reads
      FROM c_reads GROUP BY table_key ORDER BY total_reads DESC, table_key LIMIT {POPULAR_N}) u
JOIN c_tables t ON t.key = u.table_key""")

oracle("popular_tables_by_stored_score", ["c_tables"], f"""
SELECT {_HYD}, t.popularity_score FROM c_tables t WHERE upper(t.status) = 'ACTIVE'
ORDER BY t.popularity_score DESC, t.key LIMIT {POPULAR_N}""")

# every path by its edges: user, shared table, co-reader, table
_PATHS = f"""
p AS (SELECT a.user_key AS u, c.table_key AS t, b.user_key AS co, sum(c.read_count) AS rc
      FROM asking a JOIN e b ON b.table_key = a.table_key AND b.user_key <> a.user_key
      JOIN e c ON c.user_key = b.user_key AND c.table_key <> b.table_key GROUP BY 1, 2, 3),
g AS (SELECT u, t, count(*) AS co_readers, cast(sum(rc) AS BIGINT) AS total_co_reads
      FROM p GROUP BY u, t HAVING count(*) >= {MIN_READERS}),
k AS (SELECT u.user_key, t.table_key, co_readers, total_co_reads, co_readers * ln(total_co_reads) AS sc
      FROM g JOIN us u ON u.id = g.u JOIN ts t ON t.id = g.t),
r AS (SELECT *, row_number() OVER (PARTITION BY user_key ORDER BY sc DESC, table_key) AS rank FROM k)
SELECT user_key, table_key, co_readers, total_co_reads, round(sc, 6) AS score, rank,
       database, cluster, schema, name, description
FROM r LEFT JOIN c_tables ON key = table_key WHERE rank <= {PERSONAL_N}"""
_EDGES = """
us AS (SELECT user_key, row_number() OVER () AS id FROM (SELECT DISTINCT user_key FROM c_read_edges)),
ts AS (SELECT table_key, row_number() OVER () AS id FROM (SELECT DISTINCT table_key FROM c_read_edges)),
e AS (SELECT us.id AS user_key, ts.id AS table_key, read_count FROM c_read_edges JOIN us USING (user_key) JOIN ts USING (table_key)),"""

oracle("personal_popular_tables", ["c_read_edges", "c_tables"], f"WITH {_EDGES} asking AS (SELECT * FROM e), {_PATHS}")

oracle("personal_popular_for_active_users", ["c_read_edges", "c_tables", "c_users"], f"""WITH {_EDGES}
asking AS (SELECT e.* FROM e JOIN us ON us.id = e.user_key WHERE us.user_key IN (SELECT email FROM c_users WHERE is_active)), {_PATHS}""")

oracle("personal_tables_own_reads", ["c_reads"], f"""
WITH g AS (SELECT user_key, table_key, count(*) AS readers, cast(sum(read_count) AS BIGINT) AS total_reads
           FROM c_reads GROUP BY 1, 2 HAVING count(*) >= 1),
k AS (SELECT *, readers * ln(total_reads) AS sc,
             row_number() OVER (PARTITION BY user_key ORDER BY readers * ln(total_reads) DESC, table_key) AS rank
      FROM g)
SELECT user_key, table_key, readers, total_reads, round(sc, 6) AS score, rank FROM k WHERE rank <= {PERSONAL_N}""")

oracle("top_readers_per_table", ["c_reads", "c_users"], """
SELECT k.table_key, k.user_key, u.full_name, u.team_name, k.read_count, k.rank
FROM (SELECT table_key, user_key, read_count,
             row_number() OVER (PARTITION BY table_key ORDER BY read_count DESC, user_key) AS rank
      FROM c_reads) k LEFT JOIN c_users u ON u.email = k.user_key
WHERE k.rank <= 5""")

oracle("top_readers_active_min", ["c_reads", "c_users"], """
SELECT k.table_key, k.user_key, u.full_name, u.team_name, k.read_count, k.rank
FROM (SELECT table_key, user_key, read_count,
             row_number() OVER (PARTITION BY table_key ORDER BY read_count DESC, user_key) AS rank
      FROM c_reads WHERE read_count >= 2 AND user_key IN (SELECT email FROM c_users WHERE is_active)) k
LEFT JOIN c_users u ON u.email = k.user_key
WHERE k.rank <= 15""")

oracle("reads_last_n_days", ["c_reads"], f"""
SELECT table_key, cast(sum(read_count) AS BIGINT) AS recent_reads FROM c_reads
WHERE read_date >= DATE '{AS_OF}' - INTERVAL 5 DAY GROUP BY table_key HAVING sum(read_count) > 0""")

oracle("frequently_used_tables", ["c_reads", "c_tables"], f"""
SELECT k.user_key, {_HYD}, k.published_tag, k.read_count, k.rank
FROM (SELECT user_key, table_key, published_tag, read_count,
             row_number() OVER (PARTITION BY user_key ORDER BY published_tag DESC, read_count DESC, table_key) AS rank
      FROM c_reads WHERE published_tag IS NOT NULL) k JOIN c_tables t ON t.key = k.table_key
WHERE k.rank <= 50""")

oracle("frequently_used_by_count", ["c_reads"], """
SELECT user_key, read_count, table_key,
       row_number() OVER (PARTITION BY user_key ORDER BY read_count) AS position
FROM (SELECT user_key, read_count, max(table_key) AS table_key FROM c_reads
      WHERE read_count IS NOT NULL AND read_count <> 0 GROUP BY 1, 2)""")

oracle("tag_usage", ["c_tags"], """
SELECT tag AS tag_name, count(DISTINCT resource_key) AS tag_count FROM c_tags
WHERE tag_type = 'default' GROUP BY tag HAVING count(DISTINCT resource_key) > 0""")

oracle("badge_list", ["c_badges"], "SELECT DISTINCT badge_name, category FROM c_badges")

oracle("catalog_statistics", ["c_tables", "c_columns", "c_owners", "c_dashboard_owners",
                              "c_feature_owners"], """
, own AS (SELECT * FROM c_owners UNION ALL SELECT * FROM c_dashboard_owners UNION ALL SELECT * FROM c_feature_owners),
doc AS (SELECT key AS resource_key FROM c_tables WHERE length(description) > 2)
SELECT (SELECT count(*) FROM c_tables) AS number_of_tables,
       (SELECT count(*) FROM doc) AS number_of_documented_tables,
       (SELECT count(*) FROM c_columns WHERE length(description) > 2) AS number_of_documented_cols,
       (SELECT count(DISTINCT resource_key) FROM own) AS number_of_tables_with_owners,
       (SELECT count(DISTINCT user_key) FROM own) AS number_of_owners,
       (SELECT count(*) FROM doc JOIN own USING (resource_key)) AS number_of_documented_and_owned_tables""")

oracle("dashboard_view_count", ["c_dashboards", "c_dashboard_reads"], """
SELECT d.key AS dashboard_key, cast(coalesce(r.v, 0) AS BIGINT) AS recent_view_count
FROM c_dashboards d LEFT JOIN (SELECT dashboard_key, sum(read_count) AS v FROM c_dashboard_reads GROUP BY 1) r
ON r.dashboard_key = d.key""")

oracle("latest_updated", ["c_dashboards"], "SELECT max(created_timestamp) AS latest_timestamp FROM c_dashboards")

oracle("action_usage", ["c_action_log"], """
SELECT command, "user", count(*) AS n_actions,
       round(avg(cast(end_epoch_ms - start_epoch_ms AS DOUBLE)), 6) AS avg_duration_ms,
       count(*) FILTER (WHERE error IS NOT NULL) AS n_errors,
       round(count(*) FILTER (WHERE error IS NOT NULL) / count(*), 6) AS error_rate
FROM c_action_log GROUP BY command, "user" """)

oracle("data_issue_rollup", ["c_issues"], """
SELECT table_key, count(*) AS total, count(*) FILTER (WHERE status <> 'resolved') AS open,
       count(*) FILTER (WHERE status = 'resolved') AS resolved,
       count(*) FILTER (WHERE status <> 'resolved' AND priority = 'P0') AS open_p0,
       count(*) FILTER (WHERE status <> 'resolved' AND priority = 'P1') AS open_p1,
       count(*) FILTER (WHERE status <> 'resolved' AND priority = 'P2') AS open_p2,
       count(*) FILTER (WHERE status <> 'resolved' AND priority = 'P3') AS open_p3
FROM (SELECT *, CASE severity WHEN 'Critical' THEN 'P0' WHEN 'Major' THEN 'P1' WHEN 'Minor' THEN 'P2'
                ELSE 'P3' END AS priority FROM c_issues) GROUP BY table_key""")

# ---------------------------------------------------------------- details
_WM_FORMATS = "['%Y-%m-%d', '%Y%m%d']"


def _watermarks_sql(formats: list[str], include_deleted: bool) -> str:
    """Per table: chosen format = first format parsing the smallest active
    name that some format parses; low/high over (all|active) partitions."""
    idx = " ".join(f"WHEN try_strptime(name, '{f}') IS NOT NULL THEN {i}" for i, f in enumerate(formats))
    parse = " ".join(f"WHEN {i} THEN try_strptime(name, '{f}')" for i, f in enumerate(formats))
    src = "c_partitions" if include_deleted else "(SELECT * FROM c_partitions WHERE upper(status) = 'ACTIVE')"
    return f"""
, fmt AS (SELECT table_key, arg_min(fi, name) AS fi FROM (
            SELECT table_key, name, CASE {idx} END AS fi FROM c_partitions WHERE upper(status) = 'ACTIVE')
          WHERE fi IS NOT NULL GROUP BY table_key),
parsed AS (SELECT p.table_key, CASE f.fi {parse} END AS ts FROM {src} p JOIN fmt f USING (table_key)),
g AS (SELECT table_key, min(ts) AS lo, max(ts) AS hi FROM parsed WHERE ts IS NOT NULL GROUP BY table_key),
wm AS (SELECT table_key, 'low_watermark' AS watermark_type, 'ds region' AS partition_key,
              strftime(lo, '%Y-%m-%d %H:%M:%S') AS partition_value, cast(0 AS BIGINT) AS create_time FROM g
       UNION ALL
       SELECT table_key, 'high_watermark', 'ds region', strftime(hi, '%Y-%m-%d %H:%M:%S'), cast(0 AS BIGINT) FROM g)
"""


oracle("partition_watermarks", ["c_partitions"], _watermarks_sql(["%Y-%m-%d", "%Y%m%d"], True) +
       "SELECT * FROM wm")
oracle("partition_watermarks_active_only", ["c_partitions"], _watermarks_sql(["%Y%m%d"], False) +
       "SELECT * FROM wm")
oracle("partition_flag", ["c_partitions", "c_tables"], _watermarks_sql(["%Y-%m-%d", "%Y%m%d"], True) + """
SELECT t.key AS table_key, w.partition_key AS key, w.partition_value AS value, w.partition_value IS NOT NULL AS is_partitioned
FROM c_tables t LEFT JOIN (SELECT * FROM wm WHERE watermark_type = 'high_watermark') w ON w.table_key = t.key""")

oracle("table_hierarchy", ["c_tables"], """
SELECT key AS table_key, database AS database_name, cluster AS cluster_name, schema AS schema_name,
       name AS table_name FROM c_tables""")

_COLUMN_BADGES = """(SELECT table_key, string_agg(c.name || ':' || b.badge_name, ',' ORDER BY c.sort_order, b.badge_name) AS column_badges
  FROM c_columns c JOIN c_column_badges b ON b.resource_key = c.key GROUP BY 1)"""

oracle("table_columns", ["c_tables", "c_columns", "c_column_stats", "c_column_badges"], f"""
SELECT t.key AS table_key, t.database, t.cluster, t.schema, t.name, t.description, c.n_columns,
       c.column_names, c.column_types, c.n_stats, coalesce(cb.column_badges, '') AS column_badges
FROM c_tables t JOIN (
  SELECT c.table_key, count(*) AS n_columns, string_agg(c.name, ',' ORDER BY c.sort_order) AS column_names,
         string_agg(c.col_type, ',' ORDER BY c.sort_order) AS column_types,
         cast(sum(coalesce(s.n, 0)) AS INTEGER) AS n_stats
  FROM c_columns c LEFT JOIN (SELECT column_key, count(*) AS n FROM (SELECT DISTINCT * FROM c_column_stats)
                              GROUP BY 1) s ON s.column_key = c.key
  GROUP BY c.table_key) c ON c.table_key = t.key
LEFT JOIN {_COLUMN_BADGES} cb ON cb.table_key = t.key""")

oracle("table_detail", ["c_tables", "c_columns", "c_column_stats", "c_reads", "c_owners", "c_tags",
                        "c_badges", "c_partitions", "c_table_writers", "c_table_updates", "c_table_sources", "c_column_badges"],
       _watermarks_sql(["%Y-%m-%d", "%Y%m%d"], True) + """,
cols AS (SELECT c.table_key, string_agg(c.name, ',' ORDER BY c.sort_order) AS column_names,
                cast(sum(coalesce(s.n, 0)) AS INTEGER) AS n_stats
         FROM c_columns c LEFT JOIN (SELECT column_key, count(*) AS n FROM (SELECT DISTINCT * FROM c_column_stats)
                                     GROUP BY 1) s ON s.column_key = c.key GROUP BY c.table_key),
rd AS (SELECT table_key, string_agg(user_key || ':' || cast(read_count AS VARCHAR), ',' ORDER BY rk) AS readers
       FROM (SELECT *, row_number() OVER (PARTITION BY table_key ORDER BY read_count DESC, user_key) AS rk
             FROM c_reads) WHERE rk <= 5 GROUP BY table_key),
ow AS (SELECT resource_key, string_agg(DISTINCT user_key, '|' ORDER BY user_key) AS owners FROM c_owners GROUP BY 1),
tg AS (SELECT resource_key, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM c_tags
       WHERE tag_type = 'default' GROUP BY 1),
bd AS (SELECT resource_key, string_agg(DISTINCT badge_name || ':' || category, '|'
                                       ORDER BY badge_name || ':' || category) AS badges FROM c_badges GROUP BY 1)
SELECT t.key AS table_key, t.database, t.cluster, t.schema, t.name, t.description, cols.column_names, cols.n_stats,
       rd.readers, ow.owners, tg.tags, bd.badges,
       lo.partition_value AS low_watermark, hi.partition_value AS high_watermark, t.is_view, up.last_updated_timestamp,
       w.id AS writer_id, w.name AS writer_name, w.application_url AS writer_url, w.description AS writer_description,
       so.source_type, so.source, coalesce(cb.column_badges, '') AS column_badges,
       array_to_string(list_transform(['auditLog', 'dataContract', 'internalNote', 'quality Report', 'qualityReport'],
                                      lambda x: x || '=' || x || ': ' || t.name), '|') AS programmatic_descriptions
FROM c_tables t JOIN cols ON cols.table_key = t.key
LEFT JOIN rd ON rd.table_key = t.key LEFT JOIN ow ON ow.resource_key = t.key
LEFT JOIN tg ON tg.resource_key = t.key LEFT JOIN bd ON bd.resource_key = t.key
LEFT JOIN (SELECT * FROM wm WHERE watermark_type = 'low_watermark') lo ON lo.table_key = t.key
LEFT JOIN (SELECT * FROM wm WHERE watermark_type = 'high_watermark') hi ON hi.table_key = t.key
LEFT JOIN (SELECT table_key, max(last_updated_timestamp) AS last_updated_timestamp FROM c_table_updates GROUP BY 1) up
       ON up.table_key = t.key
LEFT JOIN c_table_writers w ON w.table_key = t.key LEFT JOIN c_table_sources so ON so.table_key = t.key
LEFT JOIN """ + _COLUMN_BADGES + " cb ON cb.table_key = t.key")

_LASTEX = """(SELECT dashboard_key, ts AS last_run_timestamp, state AS last_run_state, last_successful_run_timestamp
  FROM (SELECT dashboard_key, ts, state,
               max(CASE WHEN state = 'succeeded' THEN ts END) OVER (PARTITION BY dashboard_key) AS last_successful_run_timestamp,
               row_number() OVER (PARTITION BY dashboard_key ORDER BY ts DESC, state DESC) AS rk
        FROM c_dashboard_executions) WHERE rk = 1)"""

oracle("last_executions", ["c_dashboard_executions"], f"SELECT * FROM {_LASTEX}")

oracle("dashboard_detail", ["c_dashboards", "c_dashboard_executions", "c_dashboard_reads",
                            "c_dashboard_owners", "c_tags", "c_dashboard_queries", "c_dashboard_charts",
                            "c_dashboard_tables", "c_dashboard_badges"], f"""
SELECT d.key AS dashboard_key, d.name, d.url, d.group_name, d.cluster, d.product, d.description,
       d.created_timestamp, ex.last_run_timestamp, ex.last_run_state, ex.last_successful_run_timestamp,
       cast(coalesce(v.v, 0) AS BIGINT) AS recent_view_count, ow.owners, tg.tags, q.queries, ch.chart_names, tb.tables,
       up.updated_timestamp, bg.badges
FROM c_dashboards d
LEFT JOIN (SELECT dashboard_key, max(ts) + 86400 AS updated_timestamp FROM c_dashboard_executions GROUP BY 1) up ON up.dashboard_key = d.key
LEFT JOIN (SELECT resource_key, string_agg(DISTINCT badge_name, '|' ORDER BY badge_name) AS badges FROM c_dashboard_badges
           GROUP BY 1) bg ON bg.resource_key = d.key
LEFT JOIN {_LASTEX} ex ON ex.dashboard_key = d.key
LEFT JOIN (SELECT dashboard_key, sum(read_count) AS v FROM c_dashboard_reads GROUP BY 1) v ON v.dashboard_key = d.key
LEFT JOIN (SELECT resource_key, string_agg(DISTINCT user_key, '|' ORDER BY user_key) AS owners
           FROM c_dashboard_owners GROUP BY 1) ow ON ow.resource_key = d.key
LEFT JOIN (SELECT resource_key, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM c_tags
           WHERE tag_type = 'default' GROUP BY 1) tg ON tg.resource_key = d.key
LEFT JOIN (SELECT dashboard_key, string_agg(DISTINCT s, '|' ORDER BY s) AS queries FROM (
             SELECT dashboard_key, concat_ws(';', name, coalesce(url, ''), coalesce(query_text, '')) AS s
             FROM c_dashboard_queries WHERE name IS NOT NULL OR url IS NOT NULL OR query_text IS NOT NULL)
           GROUP BY 1) q ON q.dashboard_key = d.key
LEFT JOIN (SELECT dashboard_key, string_agg(DISTINCT chart_name, '|' ORDER BY chart_name) AS chart_names
           FROM c_dashboard_charts WHERE length(chart_name) > 0 GROUP BY 1) ch ON ch.dashboard_key = d.key
LEFT JOIN (SELECT dashboard_key, string_agg(DISTINCT table_key, '|' ORDER BY table_key) AS tables
           FROM c_dashboard_tables GROUP BY 1) tb ON tb.dashboard_key = d.key""")

oracle("dashboards_using_table", ["c_dashboards", "c_dashboard_tables", "c_dashboard_reads",
                                  "c_dashboard_executions"], f"""
SELECT x.*
FROM (SELECT dt.dashboard_key, dt.table_key, d.name, d.group_name, d.product, d.description,
             ex.last_successful_run_timestamp, cast(coalesce(v.v, 0) AS BIGINT) AS total_reads
      FROM c_dashboard_tables dt JOIN c_dashboards d ON d.key = dt.dashboard_key
      LEFT JOIN (SELECT dashboard_key, sum(read_count) AS v FROM c_dashboard_reads GROUP BY 1) v
             ON v.dashboard_key = dt.dashboard_key
      LEFT JOIN {_LASTEX} ex ON ex.dashboard_key = dt.dashboard_key) x""")

oracle("feature_detail", ["c_features", "c_feature_databases", "c_feature_owners", "c_feature_tags",
                          "c_feature_watermarks", "c_feature_badges"], """
SELECT f.key AS feature_key, f.name, f.version, f.feature_group, f.data_type, f.entity, f.status, f.description,
       a.availability, o.owners, t.tags, w.watermarks, bg.badges
FROM c_features f
LEFT JOIN (SELECT resource_key, string_agg(DISTINCT badge_name, '|' ORDER BY badge_name) AS badges FROM c_feature_badges
           GROUP BY 1) bg ON bg.resource_key = f.key
LEFT JOIN (SELECT feature_key, string_agg(DISTINCT database, '|' ORDER BY database) AS availability
           FROM c_feature_databases GROUP BY 1) a ON a.feature_key = f.key
LEFT JOIN (SELECT resource_key, string_agg(DISTINCT user_key, '|' ORDER BY user_key) AS owners
           FROM c_feature_owners GROUP BY 1) o ON o.resource_key = f.key
LEFT JOIN (SELECT resource_key, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags
           FROM c_feature_tags GROUP BY 1) t ON t.resource_key = f.key
LEFT JOIN (SELECT feature_key, string_agg(DISTINCT s, '|' ORDER BY s) AS watermarks FROM (
             SELECT feature_key, split_part(key, '/', -1) || ':' || cast(time AS VARCHAR) AS s
             FROM c_feature_watermarks) GROUP BY 1) w ON w.feature_key = f.key""")

oracle("feature_generation_code", ["c_features", "c_feature_generation_code"], """
SELECT g.* FROM c_feature_generation_code g JOIN c_features f ON f.key = g.feature_key""")

oracle("user_profile", ["c_users"], """
SELECT u.email, u.first_name, u.last_name, u.full_name, u.team_name, u.employee_type, u.github_username,
       u.slack_id, u.role_name, u.manager_email,
       coalesce(u.manager_fullname, m.full_name, '') AS manager_fullname, coalesce(u.is_active, false) AS is_active
FROM c_users u LEFT JOIN c_users m ON m.email = u.manager_email""")

oracle("active_users", ["c_users"], "SELECT email, full_name, team_name FROM c_users WHERE is_active")

oracle("resource_description", ["c_tables"], "SELECT key AS resource_key, description FROM c_tables")

oracle("column_description", ["c_columns"], "SELECT key AS resource_key, description FROM c_columns")

oracle("column_parent", ["c_columns", "c_tables"], """
SELECT c.table_key, c.key AS column_key FROM c_columns c JOIN c_tables t ON t.key = c.table_key""")

oracle("table_reports", ["c_reports"], """
SELECT table_key, count(*) AS n_reports, string_agg(name, '|' ORDER BY name, url) AS reports
FROM c_reports WHERE upper(status) = 'ACTIVE' GROUP BY table_key""")

oracle("user_resources_read", ["c_reads", "c_tables"], """
SELECT t.key, e.user_key, t.database, t.cluster, t.schema, t.name, t.description, 'read' AS relation
FROM (SELECT DISTINCT user_key, table_key FROM c_reads) e JOIN c_tables t ON t.key = e.table_key""")

oracle("user_resources_own_dashboards", ["c_dashboard_owners", "c_dashboards", "c_dashboard_executions"], f"""
SELECT d.key, e.user_key, d.name, d.group_name, d.product, d.description, ex.last_successful_run_timestamp,
       'own' AS relation
FROM (SELECT DISTINCT user_key, resource_key FROM c_dashboard_owners) e JOIN c_dashboards d ON d.key = e.resource_key
LEFT JOIN {_LASTEX} ex ON ex.dashboard_key = d.key""")

oracle("owned_resources_union", ["c_owners", "c_tables", "c_users"], """
SELECT DISTINCT user_key, key FROM (
  SELECT user_key, resource_key AS key FROM c_owners
  UNION ALL
  SELECT u.email, t.key FROM c_users u JOIN c_tables t ON starts_with(lower(t.owner), lower(u.email))
  WHERE t.status = 'ACTIVE')""")

oracle("owners_with_fallback", ["c_owners", "c_users", "c_tables"], """
SELECT t.key AS resource_key,
       CASE WHEN t.owner IS NULL OR list_contains(coalesce(o.l, []), t.owner)
            THEN array_to_string(coalesce(o.l, []), '|')
            ELSE array_to_string(list_append(coalesce(o.l, []), t.owner), '|') END AS owners
FROM c_tables t LEFT JOIN (
  SELECT resource_key, list_sort(list(DISTINCT user_key)) AS l FROM c_owners
  WHERE user_key IN (SELECT email FROM c_users WHERE is_active) GROUP BY 1) o ON o.resource_key = t.key""")

oracle("co_reader_paths", ["c_read_edges"], """
SELECT a.user_key, count(*) AS n_paths, count(DISTINCT b.user_key) AS n_co_readers,
       cast(sum(c.read_count) AS BIGINT) AS path_reads
FROM c_read_edges a JOIN c_read_edges b ON a.table_key = b.table_key AND a.user_key <> b.user_key
JOIN c_read_edges c ON c.user_key = b.user_key AND c.table_key <> a.table_key
GROUP BY a.user_key""")

oracle("orphan_check", ["c_change_feed", "c_tables"], """
SELECT seq, resource_key, resource_key IN (SELECT key FROM c_tables) AS accepted FROM c_change_feed""")

oracle("event_registration_join", ["c_sensor_events", "c_pet_registry"], """
SELECT e.pet_id, e.event_id, e.event_type, e.event_sentiment, e.event_duration, e.event_date_time,
       r.name, r.species, r.owner_email
FROM c_sensor_events e LEFT JOIN c_pet_registry r ON r.pet_id = e.pet_id""")

oracle("recipients_except_sender", ["c_change_feed", "c_owners", "c_users"], """
SELECT c.seq, c.resource_key, o.user_key AS recipient, u.full_name AS display_name
FROM c_change_feed c JOIN c_owners o ON o.resource_key = c.resource_key
JOIN c_users u ON u.email = o.user_key AND u.is_active AND length(coalesce(u.full_name, '')) > 0
WHERE o.user_key <> c.actor""")

# ----------------------------------------------------------------- search
from catalytics.operators.search import DASHBOARD_BOOSTS, TABLE_BOOSTS, USER_BOOSTS  # noqa: E402
from catalytics.registered.search import DOC_BOOSTS, SEARCH_N  # noqa: E402

_TOK = "list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda x: length(x) > 0)"


def _tok(c: str) -> str:
    return _TOK.format(c=c)


def _bm25_sql(boosts: dict, arrays: set, usage: str | None, require_all: bool, n: int) -> str:
    """Expects CTEs ``docs`` (key + fields) and ``queries`` (query_id, query)."""
    post, qt = [], []
    for f in boosts:
        base = f[:-4] if f.endswith(".raw") else f
        if f.endswith(".raw"):
            toks = base if base in arrays else f"[{base}]"
        elif base in arrays:
            toks = f"flatten(list_transform({base}, lambda x: {_tok('x')}))"
        else:
            toks = _tok(base)
        post.append(f"SELECT '{f}' AS field, key AS doc_key, toks FROM (SELECT key, {toks} AS toks FROM docs)")
        if f.endswith(".raw"):
            qt.append(f"SELECT query_id, n_terms, '{f}' AS field, q AS term FROM qq")
        else:
            qt.append(f"SELECT query_id, n_terms, '{f}' AS field, unnest(toks) AS term FROM qq")
    bmap = " ".join(f"WHEN '{f}' THEN {b}" for f, b in boosts.items())
    allf = "WHERE matched >= n_terms OR field LIKE '%.raw'" if require_all else ""
    if usage:
        scored = f"""SELECT b.query_id, b.doc_key, round(b.score * log10(2 + coalesce(cast(d.{usage} AS DOUBLE), 0)), 6) AS score
                     FROM best b JOIN docs d ON d.key = b.doc_key"""
    else:
        scored = "SELECT query_id, doc_key, round(score, 6) AS score FROM best"
    return f""",
p0 AS ({' UNION ALL '.join(post)}),
p1 AS (SELECT field, doc_key, len(toks) AS dl, unnest(toks) AS term FROM p0 WHERE toks IS NOT NULL AND len(toks) > 0),
idx AS (SELECT field, term, doc_key, dl, count(*) AS tf FROM p1 WHERE term IS NOT NULL GROUP BY ALL),
fs AS (SELECT field, count(*) AS n_docs, avg(dl) AS avgdl FROM (SELECT DISTINCT field, doc_key, dl FROM idx) GROUP BY field),
ts AS (SELECT field, term, count(*) AS df FROM idx GROUP BY ALL),
qq AS (SELECT query_id, query AS q, list_distinct({_tok('query')}) AS toks,
              len(list_distinct({_tok('query')})) AS n_terms
       FROM queries WHERE length(trim(query)) > 0),
qt AS ({' UNION ALL '.join(qt)}),
pf AS (SELECT qt.query_id, idx.doc_key, idx.field, qt.n_terms,
              sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))
                  * CASE idx.field {bmap} END) AS score, count(*) AS matched
       FROM qt JOIN idx ON idx.field = qt.field AND idx.term = qt.term
       JOIN ts ON ts.field = qt.field AND ts.term = qt.term JOIN fs ON fs.field = qt.field
       GROUP BY ALL),
best AS (SELECT query_id, doc_key, max(score) AS score FROM pf {allf} GROUP BY ALL),
scored AS ({scored}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_key) AS rank FROM scored)
SELECT * FROM ranked WHERE rank <= {n}"""


_TABLE_DOCS = """
, cols AS (SELECT table_key, list(name ORDER BY sort_order) AS column_names,
                  list(description ORDER BY sort_order) FILTER (WHERE description IS NOT NULL) AS column_descriptions
           FROM c_columns GROUP BY 1),
tg AS (SELECT resource_key, list(DISTINCT tag ORDER BY tag) AS tags FROM c_tags WHERE tag_type = 'default' GROUP BY 1),
bd AS (SELECT resource_key, list(DISTINCT badge_name ORDER BY badge_name) AS badges FROM c_badges GROUP BY 1),
us AS (SELECT table_key, cast(sum(read_count) AS BIGINT) AS total_usage FROM c_reads GROUP BY 1),
docs AS (SELECT t.key, t.name, t.schema || '.' || t.name AS display_name, t.description, t.cluster, t.database,
                t.schema, coalesce(cols.column_names, []) AS column_names,
                coalesce(cols.column_descriptions, []) AS column_descriptions,
                coalesce(tg.tags, []) AS tags, coalesce(bd.badges, []) AS badges,
                cast([] AS VARCHAR[]) AS programmatic_descriptions, coalesce(us.total_usage, 0) AS total_usage,
                t.schema || '.' || t.name || '@' || t.cluster AS qualified_name, t.popularity_score
         FROM c_tables t LEFT JOIN cols ON cols.table_key = t.key LEFT JOIN tg ON tg.resource_key = t.key
         LEFT JOIN bd ON bd.resource_key = t.key LEFT JOIN us ON us.table_key = t.key)"""
_TABLE_DOC_VIEWS = ["c_tables", "c_columns", "c_tags", "c_badges", "c_reads"]
_TABLE_ARRAYS = {"column_names", "column_descriptions", "tags", "badges", "programmatic_descriptions"}

oracle("search_tables", _TABLE_DOC_VIEWS, _TABLE_DOCS + """,
queries AS (SELECT DISTINCT p_name AS query, p_name AS query_id FROM part)""" +
       _bm25_sql(TABLE_BOOSTS, _TABLE_ARRAYS, "total_usage", False, SEARCH_N))

oracle("search_documents", [], """
, docs AS (SELECT 'doc_' || cast(doc_id AS VARCHAR) AS key, 'doc_' || cast(doc_id AS VARCHAR) AS name,
                  text AS description, lang AS schema, source AS database, n_chars AS total_usage FROM documents),
queries AS (SELECT cast(item_id AS VARCHAR) AS query_id, text AS query FROM benchmark)""" +
       _bm25_sql(DOC_BOOSTS, set(), "total_usage", False, SEARCH_N))

oracle("search_users", ["c_users"], """
, docs AS (SELECT email AS key, full_name, first_name, last_name, email FROM c_users),
queries AS (SELECT q AS query, q AS query_id FROM (
              SELECT 'last' || cast(n_nationkey AS VARCHAR) AS q FROM nation
              UNION ALL SELECT 'Customer last' || cast(n_nationkey AS VARCHAR) FROM nation))""" +
       _bm25_sql(USER_BOOSTS, set(), None, True, SEARCH_N))

oracle("search_dashboards", ["c_dashboards", "c_dashboard_queries", "c_dashboard_charts", "c_dashboard_reads"], """
, dq AS (SELECT dashboard_key, list(DISTINCT name ORDER BY name) AS query_names FROM c_dashboard_queries GROUP BY 1),
dc AS (SELECT dashboard_key, list(DISTINCT chart_name ORDER BY chart_name) AS chart_names FROM c_dashboard_charts
       WHERE length(chart_name) > 0 GROUP BY 1),
dv AS (SELECT dashboard_key, cast(sum(read_count) AS BIGINT) AS total_usage FROM c_dashboard_reads GROUP BY 1),
docs AS (SELECT d.key, d.name, d.group_name, d.description, d.product, coalesce(dq.query_names, []) AS query_names,
                coalesce(dc.chart_names, []) AS chart_names, coalesce(dv.total_usage, 0) AS total_usage
         FROM c_dashboards d LEFT JOIN dq ON dq.dashboard_key = d.key LEFT JOIN dc ON dc.dashboard_key = d.key
         LEFT JOIN dv ON dv.dashboard_key = d.key),
queries AS (SELECT DISTINCT o_orderpriority AS query, o_orderpriority AS query_id FROM orders)""" +
       _bm25_sql(DASHBOARD_BOOSTS, {"query_names", "chart_names"}, "total_usage", False, SEARCH_N))

_ASKED = {
    "search_tables": "queries AS (SELECT DISTINCT p_name AS query, p_name AS query_id FROM part)",
    "search_users": """queries AS (SELECT q AS query, q AS query_id FROM (
              SELECT 'last' || cast(n_nationkey AS VARCHAR) AS q FROM nation
              UNION ALL SELECT 'Customer last' || cast(n_nationkey AS VARCHAR) FROM nation))""",
    "search_dashboards": "queries AS (SELECT DISTINCT o_orderpriority AS query, o_orderpriority AS query_id FROM orders)",
}
_ASK_ALL = """queries AS (SELECT DISTINCT q AS query, q AS query_id FROM (
              SELECT p_name AS q FROM part UNION ALL SELECT o_orderpriority FROM orders
              UNION ALL SELECT 'last' || cast(n_nationkey AS VARCHAR) FROM nation
              UNION ALL SELECT 'Customer last' || cast(n_nationkey AS VARCHAR) FROM nation))"""
ORACLES["search_all"] = " UNION ALL ".join(
    f"SELECT query_id, doc_key AS key, score, '{t}' AS resource_type FROM ({ORACLES[n].replace(_ASKED[n], _ASK_ALL)})"
    for t, n in (("table", "search_tables"), ("user", "search_users"), ("dashboard", "search_dashboards")))
ORACLES["search_all_inline"] = f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, resource_type ORDER BY score DESC, key) AS position
  FROM ({ORACLES["search_all"]})) WHERE position <= 2"""

oracle("build_inverted_index", [], """
, docs AS (SELECT 'doc_' || cast(doc_id AS VARCHAR) AS key, 'doc_' || cast(doc_id AS VARCHAR) AS name,
                  text AS description, lang AS schema, source AS database, n_chars AS total_usage FROM documents),
queries AS (SELECT '' AS query_id, '' AS query)""" +
       _bm25_sql(DOC_BOOSTS, set(), None, False, 1).split("qq AS")[0].rstrip().rstrip(",") + """
SELECT field, term, count(*) AS df, cast(sum(tf) AS BIGINT) AS cf FROM idx GROUP BY field, term""")

_FACET = """(regexp_full_match(database, 'brand_1.*') OR database = 'brand_2')
  AND list_has_any(list_transform(tags, lambda x: lower(x)), ['red'])
  AND (coalesce(contains(lower(name), 'ring'), false) OR coalesce(contains(lower(schema), 'ring'), false)
       OR coalesce(contains(lower(description), 'ring'), false)
       OR len(list_filter(column_names, lambda x: contains(lower(x), 'ring'))) > 0
       OR len(list_filter(column_descriptions, lambda x: contains(lower(x), 'ring'))) > 0)"""

oracle("faceted_filter", _TABLE_DOC_VIEWS, _TABLE_DOCS + f"""
SELECT key, database, schema, name FROM docs WHERE {_FACET}""")

oracle("faceted_filter_sets", _TABLE_DOC_VIEWS, _TABLE_DOCS + """,
p AS (SELECT DISTINCT p_type, p_brand FROM part),
a AS (SELECT 'a:' || p_type || ':' || p_brand AS query_id, lower(p_type) AS s, right(replace(lower(p_brand), '#', '_'), 2) AS b FROM p),
l AS (SELECT *, list_transform(badges, lambda x: lower(x)) AS lb FROM docs)
SELECT DISTINCT a.query_id, l.key FROM a JOIN l ON l.schema = a.s AND ends_with(l.database, a.b)
  AND list_has_any(l.lb, ['beta', 'tiny'])
UNION
SELECT 'b:' || p_type, l.key FROM (SELECT DISTINCT p_type FROM p) p JOIN l ON l.schema = lower(p_type)
  AND (contains(lower(l.name), 'ring') OR contains(lower(l.schema), 'ring') OR contains(lower(l.description), 'ring')
       OR contains(lower(array_to_string(l.column_names, chr(1))), 'ring')
       OR contains(lower(array_to_string(l.column_descriptions, chr(1))), 'ring'))""")

oracle("faceted_filter_dashboards", ["c_dashboards", "c_tags"], """
, d AS (SELECT key, name, group_name, description, product, coalesce(t.tags, []) AS tags FROM c_dashboards LEFT JOIN (
    SELECT resource_key, list(DISTINCT tag) AS tags FROM c_tags WHERE tag_type = 'default' GROUP BY 1) t ON t.resource_key = key),
q AS (SELECT DISTINCT product, group_name FROM d)
SELECT DISTINCT 'p:' || q.product || q.group_name AS query_id, d.key FROM q JOIN d ON d.product = q.product AND d.group_name = q.group_name
UNION
SELECT DISTINCT 't:' || q.group_name, d.key FROM q JOIN d
  ON list_contains(list_transform(d.tags, lambda x: lower(x)), split_part(q.group_name, '-', 2))
  AND (contains(lower(name), q.product) OR contains(lower(d.group_name), q.product) OR contains(lower(description), q.product)
       OR contains(lower(d.product), q.product) OR contains(lower(array_to_string(d.tags, chr(1))), q.product))""")

oracle("search_with_filters", _TABLE_DOC_VIEWS, _TABLE_DOCS + """,
hits AS (SELECT key, round(log10(2 + cast(total_usage AS DOUBLE)), 6) AS score FROM docs
         WHERE (regexp_full_match(database, 'brand_1.*') OR database = 'brand_2')
           AND list_has_any(list_transform(tags, lambda x: lower(x)), ['red']))
SELECT key, score, (SELECT count(*) FROM hits) AS total_results FROM hits
ORDER BY score DESC, key LIMIT 10 OFFSET 10""")

oracle("search_filter_sets", _TABLE_DOC_VIEWS, _TABLE_DOCS + """,
asked AS (SELECT DISTINCT p_type || ':' || p_brand AS query_id, p_type AS query, right(p_brand, 2) AS b FROM part),
queries AS (SELECT query_id, query FROM asked),
allowed AS (SELECT query_id, key FROM asked JOIN docs ON ends_with(database, b)
            AND list_has_any(list_transform(badges, lambda x: lower(x)), ['beta', 'tiny']))""" +
       _bm25_sql(TABLE_BOOSTS, _TABLE_ARRAYS, "total_usage", False, SEARCH_N).split("ranked AS")[0] + f"""
allowed_hits AS (SELECT s.*, count(*) OVER (PARTITION BY s.query_id) AS total_results,
                        row_number() OVER (PARTITION BY s.query_id ORDER BY score DESC, doc_key) AS rank
                 FROM scored s JOIN allowed a ON a.query_id = s.query_id AND a.key = s.doc_key)
SELECT * FROM allowed_hits WHERE rank <= {SEARCH_N}""")

oracle("basic_filter", _TABLE_DOC_VIEWS, _TABLE_DOCS + """
SELECT key, qualified_name, popularity_score FROM docs
WHERE starts_with(qualified_name, 'economy.') AND ends_with(qualified_name, '@gold') AND contains(qualified_name, 'part_1')""")

oracle("search_result_projection", _TABLE_DOC_VIEWS, _TABLE_DOCS + """
SELECT key, name, schema, total_usage, array_to_string(tags, '|') AS tags, array_to_string(badges, '|') AS badges
FROM docs WHERE key IS NOT NULL""")

# ---------------------------------------------------------------- lineage
_TRAILS = """
, e_up AS (SELECT DISTINCT downstream_key AS src, upstream_key AS dst FROM c_lineage),
e_down AS (SELECT DISTINCT upstream_key AS src, downstream_key AS dst FROM c_lineage),
tr_up AS (
  WITH RECURSIVE r(start_key, node, parent, level, path) AS (
    SELECT key, dst, src, 1, [src || chr(1) || dst] FROM c_tables JOIN e_up ON e_up.src = key
    UNION ALL
    SELECT r.start_key, e.dst, e.src, r.level + 1, list_append(r.path, e.src || chr(1) || e.dst)
    FROM r JOIN e_up e ON e.src = r.node
    WHERE r.level < {d} AND NOT list_contains(r.path, e.src || chr(1) || e.dst))
  SELECT DISTINCT start_key, level, node AS key, parent, 'upstream' AS direction FROM r),
tr_down AS (
  WITH RECURSIVE r(start_key, node, parent, level, path) AS (
    SELECT key, dst, src, 1, [src || chr(1) || dst] FROM c_tables JOIN e_down ON e_down.src = key
    UNION ALL
    SELECT r.start_key, e.dst, e.src, r.level + 1, list_append(r.path, e.src || chr(1) || e.dst)
    FROM r JOIN e_down e ON e.src = r.node
    WHERE r.level < {d} AND NOT list_contains(r.path, e.src || chr(1) || e.dst))
  SELECT DISTINCT start_key, level, node AS key, parent, 'downstream' AS direction FROM r),
items AS (SELECT * FROM tr_up UNION ALL SELECT * FROM tr_down)"""

oracle("lineage", ["c_lineage", "c_tables", "c_reads", "c_badges"], _TRAILS.format(d=3) + """
SELECT i.start_key, i.direction, i.level, i.key, i.parent, split_part(i.key, '://', 1) AS source,
       coalesce(u.usage, 0) AS usage, coalesce(b.badges, '') AS badges
FROM items i
LEFT JOIN (SELECT table_key, cast(sum(read_count) AS BIGINT) AS usage FROM c_reads GROUP BY 1) u ON u.table_key = i.key
LEFT JOIN (SELECT resource_key, string_agg(DISTINCT badge_name, '|' ORDER BY badge_name) AS badges FROM c_badges
           GROUP BY 1) b ON b.resource_key = i.key""")

oracle("lineage_marshall", ["c_lineage", "c_tables"], _TRAILS.format(d=2) + """,
k AS (SELECT *, row_number() OVER (PARTITION BY start_key, direction ORDER BY level, key, parent) AS position FROM items)
SELECT start_key, level, key, parent, direction, position,
       regexp_extract(key, '^(.*?)://(.*)\\.(.*?)/(.*?)$', 1) AS database,
       regexp_extract(key, '^(.*?)://(.*)\\.(.*?)/(.*?)$', 2) AS cluster,
       regexp_extract(key, '^(.*?)://(.*)\\.(.*?)/(.*?)$', 3) AS schema,
       regexp_extract(key, '^(.*?)://(.*)\\.(.*?)/(.*?)$', 4) AS name
FROM k WHERE position <= 5""")

oracle("lineage_edges_levels", ["c_lineage", "c_tables"], """
, e AS (SELECT DISTINCT upstream_key AS src, downstream_key AS dst FROM c_lineage),
r AS (
  WITH RECURSIVE w(root_key, node, prev, level) AS (
    SELECT key, key, NULL::VARCHAR, 0 FROM c_tables
    UNION ALL
    SELECT w.root_key, e.dst, e.src, w.level + 1 FROM w JOIN e ON e.src = w.node WHERE w.level < 3)
  SELECT * FROM w),
m AS (SELECT root_key, node, min(level) AS level FROM r GROUP BY 1, 2)
SELECT m.root_key, m.node, min(r.prev) AS parent, m.level, 'downstream' AS direction
FROM m JOIN r ON r.root_key = m.root_key AND r.node = m.node AND r.level = m.level
WHERE m.level > 0 GROUP BY m.root_key, m.node, m.level""")

def _edge_items(direction: str) -> str:
    src, dst = ("downstream_key", "upstream_key") if direction == "upstream" else ("upstream_key", "downstream_key")
    n = direction[0]
    return f"""
{n}_e AS (SELECT DISTINCT {src} AS src, {dst} AS dst, NOT (s.is_view OR d.is_view) AS kept
          FROM c_lineage JOIN c_tables s ON s.key = {src} JOIN c_tables d ON d.key = {dst}),
{n}_r AS (WITH RECURSIVE w(root, node, hop) AS (
    SELECT key, key, 0 FROM c_tables UNION SELECT root, e.dst, hop + 1 FROM w JOIN {n}_e e ON e.src = node WHERE hop < 2)
  SELECT DISTINCT root, node FROM w),
{n}_g AS (SELECT root, src, dst FROM {n}_r JOIN {n}_e ON src = node WHERE kept),
{n}_l AS (WITH RECURSIVE w(root, node, level) AS (
    SELECT key, key, 0 FROM c_tables
    UNION SELECT w.root, g.dst, level + 1 FROM w JOIN {n}_g g ON g.root = w.root AND g.src = w.node WHERE level < 20)
  SELECT root, node, min(level) AS level FROM w GROUP BY 1, 2),
{n}_p AS (SELECT root, {'src AS key, min(dst)' if direction == 'upstream' else 'dst AS key, min(src)'} AS parent FROM {n}_g GROUP BY 1, 2),
{n}_i AS (SELECT g.root AS root_key, '{direction}' AS direction, {'dst' if direction == 'upstream' else 'src'} AS upstream_key,
    {'src' if direction == 'upstream' else 'dst'} AS downstream_key, dst AS key, coalesce(l.level, -1) AS level,
    coalesce(p.parent, '') AS parent, split_part(dst, '://', 1) AS source, cast(0 AS BIGINT) AS usage
  FROM {n}_g g LEFT JOIN {n}_l l ON l.root = g.root AND l.node = g.dst LEFT JOIN {n}_p p ON p.root = g.root AND p.key = g.dst)"""


oracle("lineage_edge_items", ["c_lineage", "c_tables"],
       "WITH " + _edge_items("upstream").lstrip() + "," + _edge_items("downstream") + "\nSELECT * FROM u_i UNION ALL SELECT * FROM d_i")

oracle("collapse_processes", ["c_process_relations", "c_process_entities"], """
, ds AS (SELECT guid, qualified_name FROM c_process_entities WHERE ends_with(type_name, 'table')),
pr AS (SELECT guid FROM c_process_entities WHERE type_name = 'Process'),
ins AS (SELECT DISTINCT r.to_guid AS proc, ds.qualified_name AS upstream_key FROM c_process_relations r
        JOIN pr ON pr.guid = r.to_guid JOIN ds ON ds.guid = r.from_guid),
outs AS (SELECT DISTINCT r.from_guid AS proc, ds.qualified_name AS downstream_key FROM c_process_relations r
         JOIN pr ON pr.guid = r.from_guid JOIN ds ON ds.guid = r.to_guid)
SELECT DISTINCT upstream_key, downstream_key FROM ins JOIN outs USING (proc)""")

oracle("relationship_edges", ["c_lineage"], """
, pairs AS (SELECT DISTINCT x, y FROM (SELECT downstream_key AS x, upstream_key AS y FROM c_lineage
                                       UNION ALL SELECT upstream_key, downstream_key FROM c_lineage)),
both_ AS (SELECT upstream_key AS x, downstream_key AS y, 'out' AS orientation FROM c_lineage
          UNION ALL SELECT downstream_key, upstream_key, 'in' FROM c_lineage)
SELECT p.x, p.y, b.orientation FROM pairs p JOIN both_ b ON b.x = p.x AND b.y = p.y""")

# ---------------------------------------------------------------- changes
_CH_OK = "(SELECT * FROM c_change_feed WHERE kind = '{k}' AND resource_key IN (SELECT key FROM c_tables))"
_CH_BAD = "(SELECT * FROM c_change_feed WHERE kind = '{k}' AND resource_key NOT IN (SELECT key FROM c_tables))"

oracle("apply_descriptions", ["c_tables", "c_change_feed"], f"""
, last AS (SELECT resource_key, arg_max(op, seq) AS op, arg_max(value, seq) AS value
           FROM {_CH_OK.format(k='description')} GROUP BY 1)
SELECT key AS resource_key, description FROM c_tables
WHERE description IS NOT NULL AND key NOT IN (SELECT resource_key FROM last)
UNION ALL SELECT resource_key, value FROM last WHERE op = 'put'""")

oracle("apply_descriptions_rejects", ["c_tables", "c_change_feed"], f"""
SELECT seq, resource_key, kind, value, 'missing resource' AS reason FROM {_CH_BAD.format(k='description')}""")

_OWN_LAST = f"""
, last AS (SELECT resource_key, value AS user_key, arg_max(op, seq) AS op
           FROM {_CH_OK.format(k='owner')} GROUP BY 1, 2)"""

oracle("apply_owners", ["c_tables", "c_change_feed", "c_owners"], _OWN_LAST + """
SELECT o.resource_key, o.user_key FROM c_owners o
WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.resource_key = o.resource_key AND l.user_key = o.user_key)
UNION ALL SELECT resource_key, user_key FROM last WHERE op = 'put'""")

oracle("apply_owners_created_users", ["c_tables", "c_change_feed", "c_users"], _OWN_LAST + """
SELECT DISTINCT user_key AS email FROM last WHERE op = 'put' AND user_key NOT IN (SELECT email FROM c_users)""")

_RESERVED = "('tiny', 'medium', 'large', 'beta', 'tag3')"
_TAG_CH = f"""
, tch AS (SELECT seq, op, resource_key, kind, value, value AS tag, coalesce(category, 'default') AS tag_type
          FROM c_change_feed WHERE kind = 'tag'),
tok AS (SELECT * FROM tch WHERE tag_type <> 'badge' AND tag NOT IN {_RESERVED}
        AND resource_key IN (SELECT key FROM c_tables)),
last AS (SELECT resource_key, tag, arg_max(op, seq) AS op, arg_max(tag_type, seq) AS tag_type FROM tok GROUP BY 1, 2)"""

oracle("apply_tags", ["c_tables", "c_change_feed", "c_tags"], _TAG_CH + """,
puts AS (SELECT resource_key, tag, arg_max(tag_type, seq) AS ptype, max(seq) AS pseq FROM tok WHERE op = 'put' GROUP BY 1, 2),
dels AS (SELECT resource_key, tag, tag_type, max(seq) AS dseq FROM tok WHERE op = 'delete' GROUP BY 1, 2, 3)
SELECT e.resource_key, e.tag, e.tag_type FROM c_tags e
WHERE NOT EXISTS (SELECT 1 FROM puts p WHERE p.resource_key = e.resource_key AND p.tag = e.tag)
  AND NOT EXISTS (SELECT 1 FROM dels d WHERE d.resource_key = e.resource_key AND d.tag = e.tag AND d.tag_type = e.tag_type)
UNION ALL
SELECT p.resource_key, p.tag, p.ptype FROM puts p
WHERE NOT EXISTS (SELECT 1 FROM dels d WHERE d.resource_key = p.resource_key AND d.tag = p.tag
                  AND d.tag_type = p.ptype AND d.dseq > p.pseq)""")

oracle("apply_tags_nodes", ["c_tables", "c_change_feed", "c_tags"], _TAG_CH + """,
nl AS (SELECT tag, arg_max(tag_type, seq) AS tag_type FROM tok WHERE op = 'put' GROUP BY 1)
SELECT DISTINCT tag, tag_type FROM c_tags WHERE tag NOT IN (SELECT tag FROM nl)
UNION ALL SELECT tag, tag_type FROM nl""")

oracle("apply_tags_rejects", ["c_tables", "c_change_feed"], _TAG_CH + f"""
SELECT seq, resource_key, kind, value, 'tag type badge' AS reason FROM tch WHERE tag_type = 'badge'
UNION ALL SELECT seq, resource_key, kind, value, 'reserved badge name' FROM tch
  WHERE tag_type <> 'badge' AND tag IN {_RESERVED}
UNION ALL SELECT seq, resource_key, kind, value, 'missing resource' FROM tch
  WHERE tag_type <> 'badge' AND tag NOT IN {_RESERVED} AND resource_key NOT IN (SELECT key FROM c_tables)""")

_WL = "(VALUES ('tiny','size'), ('medium','size'), ('large','size'), ('beta','table_status'), ('tag3','table_status')) wl(badge_name, category)"
_BADGE_CH = f"""
, bch AS (SELECT seq, op, resource_key, kind, value, value AS badge_name, category FROM c_change_feed WHERE kind = 'badge'),
wl AS (SELECT * FROM {_WL}),
good AS (SELECT b.* FROM bch b JOIN wl ON wl.badge_name = b.badge_name AND wl.category = b.category),
last AS (SELECT resource_key, badge_name, category, arg_max(op, seq) AS op FROM good
         WHERE resource_key IN (SELECT key FROM c_tables) GROUP BY 1, 2, 3)"""

oracle("apply_badges", ["c_tables", "c_change_feed", "c_badges"], _BADGE_CH + """
SELECT b.resource_key, b.badge_name, b.category FROM c_badges b
WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.resource_key = b.resource_key AND l.badge_name = b.badge_name
                  AND l.category = b.category)
UNION ALL SELECT resource_key, badge_name, category FROM last WHERE op = 'put'""")

oracle("apply_badges_rejects", ["c_tables", "c_change_feed"], _BADGE_CH + """
SELECT seq, resource_key, kind, value, 'category required' AS reason FROM bch WHERE category IS NULL
UNION ALL SELECT b.seq, b.resource_key, b.kind, b.value, 'not whitelisted' FROM bch b
  WHERE b.category IS NOT NULL AND NOT EXISTS (SELECT 1 FROM wl WHERE wl.badge_name = b.badge_name AND wl.category = b.category)
UNION ALL SELECT seq, resource_key, kind, value, 'missing resource' FROM good WHERE resource_key NOT IN (SELECT key FROM c_tables)""")

_FOLLOW = f"""
, fol AS (SELECT user_key, table_key AS resource_key FROM c_reads WHERE read_count >= 3),
last AS (SELECT value AS user_key, resource_key, arg_max(op, seq) AS op FROM {_CH_OK.format(k='follow')} GROUP BY 1, 2)"""

oracle("apply_user_relations", ["c_tables", "c_change_feed", "c_reads"], _FOLLOW + """
SELECT f.user_key, f.resource_key FROM fol f
WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.user_key = f.user_key AND l.resource_key = f.resource_key)
UNION ALL SELECT user_key, resource_key FROM last WHERE op = 'put'""")

oracle("apply_user_relations_soft", ["c_tables", "c_change_feed", "c_reads"], _FOLLOW + """
SELECT f.user_key, f.resource_key, CASE WHEN l.op = 'delete' THEN false ELSE true END AS active
FROM fol f LEFT JOIN last l ON l.user_key = f.user_key AND l.resource_key = f.resource_key
UNION ALL SELECT l.user_key, l.resource_key, true FROM last l
WHERE l.op = 'put' AND NOT EXISTS (SELECT 1 FROM fol f WHERE f.user_key = l.user_key AND f.resource_key = l.resource_key)""")

_INCOMING = """
, inc AS (SELECT 'user' || cast(c_custkey + 1000 AS VARCHAR) || '@example.com' AS email,
                 CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'First' || cast(c_custkey + 1000 AS VARCHAR) END AS first_name,
                 NULL::VARCHAR AS last_name, upper(c_name) AS full_name,
                 CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lower(c_mktsegment) END AS team_name,
                 CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal > 1000 END AS is_active
          FROM customer),
merged AS (
  SELECT coalesce(u.email, i.email) AS email,
         CASE WHEN i.first_name IS NOT NULL AND cast(i.first_name AS VARCHAR) <> '' THEN i.first_name ELSE u.first_name END AS first_name,
         CASE WHEN i.last_name IS NOT NULL AND cast(i.last_name AS VARCHAR) <> '' THEN i.last_name ELSE u.last_name END AS last_name,
         CASE WHEN i.full_name IS NOT NULL AND cast(i.full_name AS VARCHAR) <> '' THEN i.full_name ELSE u.full_name END AS full_name,
         CASE WHEN i.team_name IS NOT NULL AND cast(i.team_name AS VARCHAR) <> '' THEN i.team_name ELSE u.team_name END AS team_name,
         CASE WHEN i.is_active IS NOT NULL AND cast(i.is_active AS VARCHAR) <> '' THEN i.is_active ELSE u.is_active END AS is_active,
         u.email IS NULL AS created,
         CASE WHEN i.email IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
  FROM c_users u FULL JOIN inc i ON i.email = u.email)"""

oracle("upsert_users", ["c_users"], _INCOMING + "\nSELECT * FROM merged")

oracle("property_diff", ["c_users"], _INCOMING + """,
d AS (SELECT o.email,
        list_filter([CASE WHEN n.first_name IS NOT NULL AND o.first_name IS DISTINCT FROM n.first_name THEN 'first_name' END,
                     CASE WHEN n.last_name IS NOT NULL AND o.last_name IS DISTINCT FROM n.last_name THEN 'last_name' END,
                     CASE WHEN n.full_name IS NOT NULL AND o.full_name IS DISTINCT FROM n.full_name THEN 'full_name' END,
                     CASE WHEN n.team_name IS NOT NULL AND o.team_name IS DISTINCT FROM n.team_name THEN 'team_name' END,
                     CASE WHEN n.is_active IS NOT NULL AND o.is_active IS DISTINCT FROM n.is_active THEN 'is_active' END],
                    lambda x: x IS NOT NULL) AS changed,
        list_filter([CASE WHEN o.first_name IS NOT NULL AND n.first_name IS NULL THEN 'first_name' END,
                     CASE WHEN o.last_name IS NOT NULL AND n.last_name IS NULL THEN 'last_name' END,
                     CASE WHEN o.full_name IS NOT NULL AND n.full_name IS NULL THEN 'full_name' END,
                     CASE WHEN o.team_name IS NOT NULL AND n.team_name IS NULL THEN 'team_name' END,
                     CASE WHEN o.is_active IS NOT NULL AND n.is_active IS NULL THEN 'is_active' END],
                    lambda x: x IS NOT NULL) AS dropped
      FROM c_users o JOIN merged n ON n.email = o.email)
SELECT email, array_to_string(changed, '|') AS changed, array_to_string(dropped, '|') AS dropped FROM d
WHERE len(changed) > 0 OR len(dropped) > 0""")

_OWNER_PUTS = """
, op AS (SELECT resource_key, arg_max(value, seq) AS user_key FROM c_change_feed
         WHERE kind = 'owner' AND op = 'put' GROUP BY 1)"""

oracle("expire_other_links", ["c_change_feed", "c_owners"], _OWNER_PUTS + """
SELECT DISTINCT o.resource_key, o.user_key FROM c_owners o LEFT JOIN op ON op.resource_key = o.resource_key
WHERE op.user_key IS NULL OR o.user_key = op.user_key""")

oracle("expire_link", ["c_change_feed", "c_owners"], _OWNER_PUTS + """
SELECT o.resource_key, o.user_key FROM c_owners o
WHERE NOT EXISTS (SELECT 1 FROM op WHERE (op.resource_key = o.resource_key AND op.user_key = o.user_key)
                                      OR (op.user_key = o.resource_key AND op.resource_key = o.user_key))""")

oracle("link_if_absent", ["c_change_feed", "c_owners", "c_tables", "c_users"], """
SELECT DISTINCT c.resource_key, c.value AS user_key FROM c_change_feed c
WHERE c.kind = 'owner' AND c.op = 'put' AND c.resource_key IN (SELECT key FROM c_tables)
  AND c.value IN (SELECT email FROM c_users)
  AND NOT EXISTS (SELECT 1 FROM c_owners o WHERE o.resource_key = c.resource_key AND o.user_key = c.value)""")

oracle("upsert_documents", _TABLE_DOC_VIEWS + ["c_change_feed"], _TABLE_DOCS + """,
last AS (SELECT resource_key AS key, arg_max(op, seq) AS op, arg_max(value, seq) AS description
         FROM c_change_feed WHERE kind = 'description' GROUP BY 1)
SELECT key, name, description, total_usage FROM docs WHERE key NOT IN (SELECT key FROM last)
UNION ALL
SELECT l.key, d.name, coalesce(l.description, d.description), d.total_usage
FROM last l LEFT JOIN docs d ON d.key = l.key WHERE l.op = 'put'""")

oracle("delete_documents", _TABLE_DOC_VIEWS + ["c_change_feed"], _TABLE_DOCS + """
SELECT key, name, description, total_usage FROM docs
WHERE key NOT IN (SELECT resource_key FROM c_change_feed WHERE op = 'delete')""")

oracle("update_doc_tags", _TABLE_DOC_VIEWS + ["c_change_feed"], _TABLE_DOCS + """,
orig AS (SELECT key, unnest(tags) AS tag, unnest(generate_series(1, len(tags))) AS pos FROM docs),
last AS (SELECT resource_key AS key, value AS tag, arg_max(op, seq) AS op, max(seq) AS cseq
         FROM c_change_feed WHERE kind = 'tag' GROUP BY 1, 2),
j AS (SELECT coalesce(o.key, l.key) AS key, coalesce(o.tag, l.tag) AS tag, o.pos, l.op, l.cseq
      FROM orig o FULL JOIN last l ON l.key = o.key AND l.tag = o.tag),
p AS (SELECT key, string_agg(tag, '|' ORDER BY CASE WHEN op IS NULL THEN 0 ELSE 1 END,
                             CASE WHEN op IS NULL THEN pos ELSE cseq END) AS tags
      FROM j WHERE op IS NULL OR op = 'put' GROUP BY key)
SELECT d.key, coalesce(p.tags, '') AS tags FROM docs d LEFT JOIN p ON p.key = d.key""")

_TAG_USAGE = """
, tu AS (SELECT tag AS tag_name, count(DISTINCT resource_key) AS tag_count FROM c_tags
         WHERE tag_type = 'default' GROUP BY tag HAVING count(DISTINCT resource_key) > 0)"""

oracle("tag_partition", ["c_tags"], _TAG_USAGE + """,
top AS (SELECT tag_name FROM tu ORDER BY tag_count DESC, tag_name LIMIT 5)
SELECT tag_name, tag_count, CASE WHEN tag_name IN (SELECT tag_name FROM top) THEN 'popular' ELSE 'other' END AS "group"
FROM tu""")

oracle("tag_partition_curated", ["c_tags"], _TAG_USAGE + """
SELECT coalesce(tu.tag_name, c.tag_name) AS tag_name, coalesce(tu.tag_count, 0) AS tag_count,
       CASE WHEN coalesce(tu.tag_name, c.tag_name) IN ('red', 'blue', 'nonexistent') THEN 'curated' ELSE 'other' END AS "group"
FROM tu FULL JOIN (VALUES ('red'), ('blue'), ('nonexistent')) c(tag_name) ON c.tag_name = tu.tag_name""")

# ------------------------------------------------- keys, filters, profile
_KP = r"'^(.*?)://(.*)\.(.*?)/(.*?)$'"

oracle("parse_table_key", ["c_tables", "c_dashboards", "c_columns"], f"""
, k AS (SELECT key FROM c_tables UNION ALL SELECT key FROM c_dashboards UNION ALL SELECT key FROM c_columns),
p AS (SELECT key, CASE WHEN regexp_matches(key, {_KP}) THEN regexp_extract(key, {_KP}, 1) END AS database,
             CASE WHEN regexp_matches(key, {_KP}) THEN regexp_extract(key, {_KP}, 2) END AS cluster,
             CASE WHEN regexp_matches(key, {_KP}) THEN regexp_extract(key, {_KP}, 3) END AS schema,
             CASE WHEN regexp_matches(key, {_KP}) THEN regexp_extract(key, {_KP}, 4) END AS name FROM k)
SELECT *, (database || '://' || cluster || '.' || schema || '/' || name) = key AS rebuilt_equal FROM p""")

_BP = r"'^(.*?)\.(.*?)\.(.*?)\.(.*?)\.(.*?)@(.*?)$'"
oracle("parse_bookmark_key", ["c_reads", "c_tables"], f"""
, b AS (SELECT t.schema || '.' || t.name || '.table.' || split_part(r.user_key, '@', 1) || '.bookmark@' || t.cluster
               AS bookmark_key FROM c_reads r JOIN c_tables t ON t.key = r.table_key)
SELECT bookmark_key, """ + ", ".join(
    f"CASE WHEN regexp_matches(bookmark_key, {_BP}) THEN regexp_extract(bookmark_key, {_BP}, {i + 1}) END AS {n}"
    for i, n in enumerate(["database", "table", "entity_type", "user_id", "bookmark", "cluster"])) + " FROM b")

oracle("filter_active", ["c_dashboards"], "SELECT key FROM c_dashboards WHERE upper(status) = 'ACTIVE'")

oracle("editable_flag", ["c_tables"], """
SELECT key, schema, name,
       NOT coalesce(schema IN ('small') OR regexp_matches(schema, '^(?:econ.*)') OR regexp_matches(name, '^(?:part_1.*)')
                    OR (regexp_matches(schema, '^(?:prom.*)') AND regexp_matches(name, '^(?:part_2.*)')), false) AS is_editable
FROM c_tables""")

_PROG = """
, pd AS (SELECT t.key AS resource_key, s.source, s.source || ': ' || t.name AS text
         FROM c_tables t CROSS JOIN (VALUES ('qualityReport'), ('quality Report'), ('auditLog'), ('dataContract'),
                                            ('internalNote')) s(source))"""

oracle("restrict_description_sources", ["c_tables"], _PROG + """,
g AS (SELECT resource_key, lower(regexp_replace(source, '([a-z])([A-Z])', '\\1 \\2', 'g')) AS source,
             arg_max(text, source) AS text
      FROM pd WHERE NOT regexp_matches(source, '^(?:internal.*)') GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY resource_key ORDER BY source) AS position FROM g""")

oracle("description_layout", ["c_tables"], _PROG + """,
g AS (SELECT resource_key, lower(regexp_replace(source, '([a-z])([A-Z])', '\\1 \\2', 'g')) AS source,
             arg_max(text, source) AS text FROM pd GROUP BY 1, 2
      UNION ALL SELECT key, 'other note', 'n/a' FROM c_tables),
x AS (SELECT *, CASE WHEN source IN ('quality report', 'audit log') THEN 'left'
                     WHEN source IN ('data contract') THEN 'right' ELSE 'other' END AS side FROM g),
y AS (SELECT *, CASE side WHEN 'left' THEN (CASE source WHEN 'quality report' THEN 1 WHEN 'audit log' THEN 0 ELSE 2 END)
                          WHEN 'right' THEN 1
                          ELSE (CASE source WHEN 'other note' THEN 0 ELSE 1 END) END AS display_order FROM x)
SELECT *, row_number() OVER (PARTITION BY resource_key, side ORDER BY display_order, source) AS position FROM y""")

oracle("format_column_stats", ["c_column_stats"], """
SELECT column_key,
       CASE WHEN stat_type = 'min' THEN 'minimum' ELSE stat_type END AS stat_type,
       CASE stat_type WHEN 'min' THEN printf('%.2f', cast(stat_val AS DOUBLE))
                      WHEN 'avg' THEN printf('%.4f', cast(stat_val AS DOUBLE)) ELSE stat_val END AS stat_val,
       start_epoch, end_epoch
FROM c_column_stats WHERE stat_type <> 'max'""")

oracle("stat_order", ["c_column_stats"], """
SELECT column_key, stat_type,
       row_number() OVER (PARTITION BY column_key ORDER BY coalesce(CASE stat_type WHEN 'max' THEN 1 WHEN 'min' THEN 2
                          WHEN 'avg' THEN 3 END, 4), stat_type) AS position
FROM c_column_stats""")


def _profile_sql() -> str:
    cols = [("l_orderkey", "n"), ("l_partkey", "n"), ("l_suppkey", "n"), ("l_linenumber", "n"),
            ("l_quantity", "n"), ("l_extendedprice", "n"), ("l_discount", "n"), ("l_tax", "n"),
            ("l_returnflag", "s"), ("l_linestatus", "s"), ("l_shipdate", "t")]
    parts = []
    for c, kind in cols:
        parts.append(f"SELECT '{c}' AS column_name, 'null_count' AS stat_type, "
                     f"cast(count(*) FILTER (WHERE {c} IS NULL) AS VARCHAR) AS stat_val FROM lineitem")
        parts.append(f"SELECT '{c}', 'distinct_count', cast(count(DISTINCT {c}) AS VARCHAR) FROM lineitem")
        z = " + 0.0" if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") else ""
        parts.append(f"SELECT '{c}', 'min', cast(min({c}){z} AS VARCHAR) FROM lineitem")
        parts.append(f"SELECT '{c}', 'max', cast(max({c}){z} AS VARCHAR) FROM lineitem")
        if kind == "n":
            parts.append(f"SELECT '{c}', 'avg', cast(round(avg(cast({c} AS DOUBLE)), 6) AS VARCHAR) FROM lineitem")
    parts.append("SELECT '*', 'row_count', cast(count(*) AS VARCHAR) FROM lineitem")
    return "\nUNION ALL ".join(parts)


ORACLES["column_profile"] = _profile_sql()

oracle("unique_values_summary", ["c_column_stats"], """
, e AS (SELECT column_key, unnest(map_entries(CAST(json(replace(stat_val, '''', '"')) AS MAP(VARCHAR, BIGINT)))) AS kv
        FROM c_column_stats WHERE stat_type = 'unique_values'),
r AS (SELECT column_key, kv.key AS value, kv.value AS count,
             row_number() OVER (PARTITION BY column_key ORDER BY kv.value DESC, kv.key) AS position FROM e)
SELECT * FROM r WHERE position <= 5""")

_USAGE = """
, us AS (SELECT column_key AS key, max(cast(stat_val AS DOUBLE)) AS usage FROM c_column_stats
         WHERE stat_type = 'column_usage' GROUP BY 1)"""

oracle("column_usage", ["c_columns", "c_column_stats"], _USAGE + """
SELECT c.key, c.table_key, c.name, us.usage FROM c_columns c LEFT JOIN us ON us.key = c.key""")

oracle("column_order", ["c_columns", "c_column_stats"], _USAGE + """
SELECT c.key, c.table_key, c.name,
       row_number() OVER (PARTITION BY c.table_key ORDER BY us.usage DESC NULLS LAST, c.name) AS position
FROM c_columns c LEFT JOIN us ON us.key = c.key""")

oracle("column_type_census", ["c_columns", "c_tables"], """
, x AS (SELECT t.database, lower(trim(c.col_type)) AS ty FROM c_columns c JOIN c_tables t ON t.key = c.table_key)
SELECT database, regexp_extract(ty, '^([a-z_ ]+)', 1) AS type_name,
       (starts_with(ty, 'array') AND length(ty) > 5) OR (starts_with(ty, 'map') AND length(ty) > 3)
       OR (starts_with(ty, 'struct') AND length(ty) > 6) OR (starts_with(ty, 'uniontype') AND length(ty) > 9) AS is_nested,
       count(*) AS n_columns
FROM x GROUP BY ALL""")

oracle("page", ["c_tables"], """
SELECT key, popularity_score, (SELECT count(*) FROM c_tables) AS total_results FROM c_tables
ORDER BY popularity_score DESC, key LIMIT 10 OFFSET 30""")

oracle("scalar_functions", ["c_dashboards"], """
, x AS (SELECT *, cast(created_timestamp * 1000 AS VARCHAR) AS ms FROM c_dashboards)
SELECT key, split_part(key, '_', 1) AS product, string_split(key, '/')[-1] AS last_segment,
       CASE WHEN length(ms) >= 10 THEN cast(substr(ms, 1, 10) AS BIGINT) END AS created_s,
       array_to_string(list_transform(string_split(group_name, ' '),
                       lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS title_group,
       upper(group_name) AS upper_group,
       upper(substr(name, 1, 1)) || lower(substr(name, 2)) AS sentence_name,
       try_cast(split_part(group_name, '-', 1) AS DOUBLE) IS NOT NULL AS group_is_number,
       strftime(make_timestamp(created_timestamp * 1000000), '%Y-%m-%d') AS created_date
FROM x""")

# ------------------------------------------------------------------ events
_ENJOY = """
, ev AS (SELECT *, make_timestamp(cast(event_date_time AS BIGINT) * 1000) AS event_ts FROM c_sensor_events),
g AS (SELECT pet_id, event_type{day}, count(*) AS n, cast(sum(event_duration) AS BIGINT) AS duration,
             round(avg(event_sentiment), 6) AS mean_sentiment,
             round(sum(event_sentiment * cast(event_duration AS DOUBLE)) / nullif(sum(cast(event_duration AS DOUBLE)), 0), 6)
               AS weighted_sentiment
      FROM (SELECT *, cast(event_ts AS DATE) AS day FROM ev) GROUP BY ALL)
SELECT *, rank() OVER (PARTITION BY pet_id{day} ORDER BY weighted_sentiment DESC NULLS LAST, n DESC,
                       event_type ASC NULLS LAST) AS rank FROM g"""

oracle("event_enjoyment", ["c_sensor_events"], _ENJOY.format(day=""))
oracle("event_enjoyment_daily", ["c_sensor_events"], _ENJOY.format(day=", day"))

_SENSOR_OK = """SELECT pet_id, event_id, event_type, event_sentiment, event_duration, event_date_time,
       make_timestamp(cast(event_date_time AS BIGINT) * 1000) AS event_ts
FROM c_sensor_events"""

oracle("ingest_events_batch", ["c_sensor_events"], _SENSOR_OK)
oracle("ingest_events_stream", ["c_sensor_events"], _SENSOR_OK)
oracle("stream_dedup_events", ["c_sensor_events"], _SENSOR_OK)

_REJECTS = """
SELECT substr('{"pet_id":' || cast(pet_id AS VARCHAR) || ',"event_id":"' || event_id || '",', 1, 20) AS record,
       'malformed' AS reason
FROM c_sensor_events WHERE cast(event_id AS BIGINT) % 50 = 0"""

oracle("ingest_events_rejects", ["c_sensor_events"], _REJECTS)
oracle("ingest_events_stream_rejects", ["c_sensor_events"], _REJECTS)

_EV = f"""
, ev AS ({_SENSOR_OK})"""

oracle("stream_activity_windows", ["c_sensor_events"], _EV + """
SELECT date_trunc('day', event_ts) AS window_start, date_trunc('day', event_ts) + INTERVAL 1 DAY AS window_end,
         pet_id, event_type, count(*) AS n, round(avg(event_sentiment), 6) AS mean_sentiment
  FROM ev GROUP BY ALL""")

# rows of the first third of time are late once the second has been read, unless their window is still open then
oracle("stream_late_rows", ["c_sensor_events"], """
, m AS (SELECT cast(event_date_time AS BIGINT) AS ms FROM c_sensor_events),
b AS (SELECT min(ms) AS lo, (max(ms) - min(ms)) // 3 + 1 AS width FROM m),
s AS (SELECT ms, (ms - lo) // width AS part FROM m, b),
w AS (SELECT max(ms) - 3600000 AS late FROM s WHERE part = 1),
l AS (SELECT count(*) FILTER (part = 0 AND (ms // 86400000 + 1) * 86400000 <= late) AS rows_late, count(*) AS rows_read FROM s, w)
SELECT rows_read, rows_read - rows_late AS rows_counted, rows_late FROM l""")

oracle("stream_activity_sliding", ["c_sensor_events"], _EV + """
, b AS (SELECT date_trunc('day', event_ts) AS window_start, * FROM ev
        UNION ALL SELECT date_trunc('day', event_ts) - INTERVAL 1 DAY, * FROM ev)
SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, pet_id, event_type, count(*) AS n,
       round(avg(event_sentiment), 6) AS mean_sentiment
FROM b GROUP BY window_start, pet_id, event_type""")

oracle("stream_sessions", ["c_sensor_events"], _EV + """,
f AS (SELECT *, CASE WHEN event_ts - lag(event_ts) OVER (PARTITION BY pet_id ORDER BY event_ts) < INTERVAL 6 HOUR
                     THEN 0 ELSE 1 END AS new_s FROM ev),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY pet_id ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT pet_id, min(event_ts) AS session_start, max(event_ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n_events,
       cast(sum(event_duration) AS BIGINT) AS duration
FROM s GROUP BY pet_id, sid""")

oracle("stream_action_usage", ["c_action_log"], """
SELECT date_trunc('day', make_timestamp(start_epoch_ms * 1000)) AS day, command, "user", count(*) AS n_actions,
       count(*) FILTER (WHERE error IS NOT NULL) AS n_errors
FROM c_action_log GROUP BY ALL""")

ORACLES["stream_catalog_changes"] = ORACLES["apply_descriptions"]
ORACLES["stream_catalog_owners"] = ORACLES["apply_owners"]
ORACLES["stream_catalog_tags"] = ORACLES["apply_tags"]
ORACLES["stream_catalog_badges"] = ORACLES["apply_badges"]
ORACLES["stream_catalog_relations"] = ORACLES["apply_user_relations"]

oracle("catalog_scan", ["c_reads"], """
SELECT table_key, cast(sum(read_count) AS BIGINT) AS reads FROM c_reads GROUP BY 1""")

oracle("index_snapshot_publish", _TABLE_DOC_VIEWS, _TABLE_DOCS + "\nSELECT key, total_usage FROM docs")

oracle("catalog_scan_edges", ["c_reads", "c_owners"], """
SELECT 'read' AS label, user_key AS src, count(*) AS n_edges, cast(sum(read_count) AS BIGINT) AS reads FROM c_reads GROUP BY user_key
UNION ALL SELECT 'owner', user_key, count(*), NULL FROM c_owners GROUP BY user_key""")

oracle("table_preview", [], """
SELECT l_orderkey, l_linenumber, l_quantity, '***' AS l_extendedprice FROM lineitem WHERE l_returnflag = 'R'
ORDER BY l_orderkey, l_linenumber LIMIT 50""")

oracle("preview_flatten", [], """
SELECT o_orderkey AS id, o_custkey AS "order.custkey", o_orderstatus AS "order.info.status",
       o_orderpriority AS "order.info.priority" FROM orders""")

oracle("collect_distinct_children", ["c_tags"], """
SELECT resource_key, count(DISTINCT tag) AS n_tags, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags
FROM c_tags WHERE tag IS NOT NULL GROUP BY 1""")

oracle("topk_per_key", ["c_reads"], """
SELECT * FROM (SELECT user_key, table_key, read_count,
                      row_number() OVER (PARTITION BY user_key ORDER BY read_count DESC, table_key) AS rank
               FROM c_reads) WHERE rank <= 3""")

oracle("assemble_search_docs", _TABLE_DOC_VIEWS, _TABLE_DOCS + """
SELECT key, display_name, qualified_name, total_usage, array_to_string(column_names, ',') AS column_names,
       array_to_string(column_descriptions, '|') AS column_descriptions, array_to_string(tags, '|') AS tags,
       array_to_string(badges, '|') AS badges FROM docs""")

oracle("user_resources_follow", ["c_reads", "c_tables"], """
SELECT t.key, e.user_key, t.database, t.cluster, t.schema, t.name, t.description, 'follow' AS relation
FROM (SELECT DISTINCT user_key, table_key FROM c_reads WHERE read_count >= 2) e JOIN c_tables t ON t.key = e.table_key""")

oracle("stream_registration_join", ["c_sensor_events", "c_pet_registry"], f"""
, ev AS ({_SENSOR_OK})
SELECT e.*, r.name, r.species, r.owner_email FROM ev e LEFT JOIN c_pet_registry r ON r.pet_id = e.pet_id""")

oracle("preview_allowed", ["c_tables"], """
, t AS (SELECT key, database, CASE WHEN is_view THEN 'silver' ELSE cluster END AS cluster FROM c_tables)
SELECT key, database, cluster, cluster IN ('gold') AS previewable,
       CASE WHEN cluster IN ('gold') THEN (CASE database WHEN 'brand_1' THEN 5 WHEN 'brand_2' THEN 100 ELSE 50 END) END
         AS preview_rows
FROM t""")

oracle("last_runs_from_nodes", ["c_dashboard_executions"], f"SELECT * FROM {_LASTEX}")
oracle("watermarks_from_nodes", ["c_partitions"], _watermarks_sql(["%Y-%m-%d", "%Y%m%d"], True) +
       "SELECT table_key, watermark_type, partition_key, partition_value FROM wm")

_TOP_READERS = """
SELECT k.table_key, k.user_key, u.full_name, u.team_name, k.read_count, k.rank
FROM (SELECT table_key, user_key, read_count,
             row_number() OVER (PARTITION BY table_key ORDER BY read_count {order}, user_key) AS rank
      FROM c_reads WHERE {where}) k LEFT JOIN c_users u ON u.email = k.user_key
WHERE k.rank <= 5"""
oracle("top_readers_recent", ["c_reads", "c_users"], _TOP_READERS.format(order="DESC", where="read_date >= DATE '1997-01-01'"))
oracle("top_readers_ascending", ["c_reads", "c_users"], _TOP_READERS.format(order="ASC", where="true"))

oracle("apply_owners_rejects", ["c_tables", "c_change_feed"], f"""
SELECT seq, resource_key, kind, value, 'missing resource' AS reason FROM {_CH_BAD.format(k='owner')}""")
oracle("apply_user_relations_rejects", ["c_tables", "c_change_feed"], f"""
SELECT seq, resource_key, kind, value, 'missing resource' AS reason FROM {_CH_BAD.format(k='follow')}""")

oracle("user_resources_own", ["c_owners", "c_tables"], """
SELECT t.key, e.user_key, t.database, t.cluster, t.schema, t.name, t.description, 'own' AS relation
FROM (SELECT DISTINCT user_key, resource_key FROM c_owners) e JOIN c_tables t ON t.key = e.resource_key""")
oracle("user_resources_read_dashboards", ["c_dashboard_reads", "c_dashboards", "c_dashboard_executions"], f"""
SELECT d.key, e.user_key, d.name, d.group_name, d.product, d.description, ex.last_successful_run_timestamp,
       'read' AS relation
FROM (SELECT DISTINCT user_key, dashboard_key FROM c_dashboard_reads) e JOIN c_dashboards d ON d.key = e.dashboard_key
LEFT JOIN {_LASTEX} ex ON ex.dashboard_key = d.key""")

oracle("basic_filter_by_tag", _TABLE_DOC_VIEWS, _TABLE_DOCS + """
SELECT key, popularity_score FROM docs WHERE list_contains(tags, 'red')""")

oracle("column_order_by_sort", ["c_columns"], """
SELECT key, row_number() OVER (PARTITION BY table_key
  ORDER BY coalesce(CASE WHEN sort_order <> 2 THEN sort_order END, 9999), name) AS position FROM c_columns""")
oracle("column_order_by_name", ["c_columns"], """
SELECT key, row_number() OVER (PARTITION BY table_key ORDER BY name) AS position FROM c_columns""")

oracle("column_value_counts", [], """
WITH v AS (
  SELECT 'l_orderkey' AS column_name, cast(l_orderkey AS VARCHAR) AS value FROM lineitem
  UNION ALL SELECT 'l_linenumber', cast(l_linenumber AS VARCHAR) FROM lineitem
  UNION ALL SELECT 'l_returnflag', l_returnflag FROM lineitem UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem),
e AS (SELECT count(*) AS n, cast(epoch(min(l_shipdate)) AS BIGINT) AS start_epoch, cast(epoch(max(l_shipdate)) AS BIGINT) AS end_epoch FROM lineitem)
SELECT v.column_name, v.value, count(*) AS n, any_value(e.start_epoch) AS start_epoch, any_value(e.end_epoch) AS end_epoch
FROM v, e WHERE v.value IS NOT NULL GROUP BY v.column_name, v.value HAVING count(*) >= 0.02 * any_value(e.n)""")
