"""DuckDB text of the catalog frames (see ``catalytics.sources.catalog``).

Used only by ``__spark_entry__.oracle_sql()`` so that every oracle query is
plain SQL over the driver's pre-registered views. ``with_views(names, sql)``
prefixes the needed CTEs (dependencies resolved in order)."""

from __future__ import annotations

_TKEY = "lower(replace({b},'#','_')) || '://gold.' || lower({t}) || '/part_' || cast({k} as varchar)"


def tkey(b="p_brand", t="p_type", k="p_partkey") -> str:
    return _TKEY.format(b=b, t=t, k=k)


def email(k: str) -> str:
    return f"'user' || cast({k} as varchar) || '@example.com'"


VIEWS: dict[str, tuple[list[str], str]] = {
    "c_tables": ([], f"""
        SELECT {tkey()} AS key, lower(replace(p_brand,'#','_')) AS database, 'gold' AS cluster,
               lower(p_type) AS schema, 'part_' || cast(p_partkey as varchar) AS name,
               CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN '' ELSE p_name END AS description,
               (p_size % 10 = 0) AS is_view,
               CASE WHEN p_partkey % 17 = 0 THEN 'DELETED' ELSE 'ACTIVE' END AS status,
               p_retailprice AS popularity_score, {email('p_partkey % 150')} AS owner, p_partkey AS part_id
        FROM part"""),
    "c_users": ([], f"""
        SELECT {email('c_custkey')} AS email, 'first' || cast(c_custkey as varchar) AS first_name,
               'last' || cast(c_nationkey as varchar) AS last_name, c_name AS full_name,
               c_mktsegment AS team_name,
               CASE WHEN c_custkey >= 10 THEN {email('c_custkey // 10')} END AS manager_email,
               (c_acctbal > 0) AS is_active,
               CASE WHEN c_custkey % 2 = 0 THEN 'fte' ELSE 'contractor' END AS employee_type,
               lower(replace(c_name,'#','_')) AS github_username,
               CASE WHEN c_custkey % 2 = 1 THEN 'U' || cast(c_custkey as varchar) END AS slack_id,
               CASE WHEN c_custkey % 7 = 0 THEN 'stored manager' END AS manager_fullname,
               'role' || cast(c_custkey % 4 as varchar) AS role_name, c_custkey AS user_id
        FROM customer"""),
    "c_reads": ([], f"""
        SELECT {email('e.o_custkey')} AS user_key, {tkey()} AS table_key, e.read_count, e.read_date, e.published_tag
        FROM (SELECT o_custkey, l_partkey, count(*) AS read_count, max(cast(o_orderdate as date)) AS read_date,
                     max(CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END) AS published_tag
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey) e
        JOIN part ON e.l_partkey = p_partkey"""),
    "c_read_edges": ([], f"""
        SELECT {email('o_custkey')} AS user_key, {tkey()} AS table_key, cast(l_linenumber as bigint) AS read_count,
               cast(o_orderdate as date) AS read_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""),
    "c_owners": ([], f"""
        SELECT {tkey()} AS resource_key, {email('e.l_suppkey')} AS user_key
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) e
        JOIN part ON e.l_partkey = p_partkey"""),
    "c_dashboards": ([], """
        SELECT ['mode','superset','tableau'][(o_orderkey % 3) + 1] || '_dashboard://gold.'
                 || lower(replace(o_orderpriority,' ','_')) || '/' || cast(o_orderkey as varchar) AS key,
               'dashboard ' || cast(o_orderkey as varchar) AS name,
               'https://dash.example.com/' || cast(o_orderkey as varchar) AS url,
               lower(replace(o_orderpriority,' ','_')) AS group_name, 'gold' AS cluster,
               ['mode','superset','tableau'][(o_orderkey % 3) + 1] AS product,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'orders of customer ' || cast(o_custkey as varchar) END AS description,
               cast(epoch(o_orderdate) as bigint) AS created_timestamp,
               lower(split_part(o_orderpriority, '-', 2)) AS priority_word,
               o_orderkey AS order_id, o_custkey AS cust_id,
               CASE WHEN o_orderstatus = 'P' THEN 'DELETED' ELSE 'ACTIVE' END AS status
        FROM orders"""),
    "c_tags": (["c_dashboards"], f"""
        SELECT resource_key, tag, 'default' AS tag_type FROM (
          SELECT DISTINCT {tkey()} AS resource_key, unnest(string_split(p_name, ' ')) AS tag FROM part) x
        WHERE tag <> ''
        UNION ALL
        SELECT key AS resource_key, priority_word AS tag, 'default' AS tag_type FROM c_dashboards"""),
    "c_badges": ([], f"""
        SELECT {tkey()} AS resource_key,
               CASE WHEN p_size <= 10 THEN 'tiny' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS badge_name,
               'size' AS category FROM part
        UNION ALL
        SELECT {tkey()} AS resource_key, 'beta' AS badge_name, 'table_status' AS category FROM part
        WHERE p_partkey % 9 = 0"""),
    "c_table_writers": ([], f"""
        SELECT {tkey()} AS table_key, 'dag_' || cast(p_partkey % 50 as varchar) || '/task_' || cast(p_partkey as varchar) AS id,
               'Airflow' AS name, 'https://airflow.example.com/dag_' || cast(p_partkey % 50 as varchar) AS application_url,
               'task of dag_' || cast(p_partkey % 50 as varchar) AS description
        FROM part WHERE p_partkey % 4 <> 0"""),
    "c_table_updates": ([], f"""
        SELECT {tkey()} AS table_key, cast(epoch(l_shipdate) as bigint) AS last_updated_timestamp
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "c_table_sources": ([], f"""
        SELECT {tkey()} AS table_key, 'github' AS source_type,
               'https://git.example.com/models/' || cast(p_partkey as varchar) || '.sql' AS source
        FROM part WHERE p_partkey % 3 = 0"""),
    "c_column_badges": (["c_columns"], """
        SELECT key AS resource_key, CASE name WHEN 'partkey' THEN 'primary key' ELSE 'nested' END AS badge_name, 'column' AS category
        FROM c_columns WHERE name IN ('partkey', 'props')"""),
    "c_dashboard_badges": (["c_dashboards"], """
        SELECT key AS resource_key, 'urgent' AS badge_name, 'dashboard' AS category FROM c_dashboards
        WHERE priority_word = 'urgent'"""),
    "c_feature_badges": (["c_features"], """
        SELECT key AS resource_key, 'at risk' AS badge_name, 'feature' AS category FROM c_features WHERE status = 'deprecated'"""),
    "c_columns": (["c_tables"], """
        SELECT t.key || '/' || l.name AS key, t.key AS table_key, l.name, l.col_type, l.sort_order,
               CASE WHEN l.sort_order < 2 THEN 'column ' || l.name END AS description
        FROM c_tables t CROSS JOIN (VALUES ('partkey','bigint',0), ('name','varchar(55)',1),
             ('quantity','double',2), ('ship_dates','array<date>',3),
             ('props','map<string,struct<k:int,v:string>>',4)) l(name, col_type, sort_order)"""),
    "c_column_stats": ([], f"""
        SELECT {tkey()} || '/' || r.col AS column_key, r.stat_type, r.stat_val,
               cast(epoch(a.t0) as bigint) AS start_epoch, cast(epoch(a.t1) as bigint) AS end_epoch
        FROM (SELECT l_partkey, min(l_quantity) mn, max(l_quantity) mx, avg(l_quantity) av, count(*) usage,
                     min(l_shipdate) t0, max(l_shipdate) t1 FROM lineitem GROUP BY l_partkey) a
        JOIN (SELECT l_partkey, '{{' || string_agg('''' || l_returnflag || ''': ' || cast(n as varchar), ', '
                     ORDER BY l_returnflag, n) || '}}' AS uv
              FROM (SELECT l_partkey, l_returnflag, count(*) n FROM lineitem GROUP BY 1, 2) GROUP BY l_partkey) u
          ON a.l_partkey = u.l_partkey
        JOIN part ON a.l_partkey = p_partkey
        CROSS JOIN LATERAL (VALUES
             ('quantity', 'min', cast(round(cast(a.mn as double), 4) as varchar)),
             ('quantity', 'max', cast(round(cast(a.mx as double), 4) as varchar)),
             ('quantity', 'avg', cast(round(cast(a.av as double), 4) as varchar)),
             ('partkey', 'column_usage', cast(a.usage as varchar)),
             ('name', 'unique_values', u.uv)) r(col, stat_type, stat_val)"""),
    "c_lineage": ([], f"""
        SELECT {tkey('pu.p_brand', 'pu.p_type', 'pu.p_partkey')} AS upstream_key,
               {tkey('pd.p_brand', 'pd.p_type', 'pd.p_partkey')} AS downstream_key
        FROM (SELECT DISTINCT down, up FROM (
                SELECT p_partkey AS down, p_partkey // 2 AS up FROM part WHERE p_partkey > 0
                UNION ALL
                SELECT p_partkey AS down, p_partkey - 3 AS up FROM part WHERE p_partkey % 5 = 0 AND p_partkey > 3)) e
        JOIN part pu ON e.up = pu.p_partkey JOIN part pd ON e.down = pd.p_partkey"""),
    "c_process_relations": ([], """
        SELECT DISTINCT from_guid, to_guid FROM (
          SELECT 'ds-' || cast(l_partkey as varchar) AS from_guid, 'proc-' || cast(l_orderkey as varchar) AS to_guid
          FROM lineitem WHERE l_linenumber % 2 = 1
          UNION ALL
          SELECT 'proc-' || cast(l_orderkey as varchar), 'ds-' || cast(l_partkey as varchar)
          FROM lineitem WHERE l_linenumber % 2 = 0)"""),
    "c_process_entities": ([], f"""
        SELECT 'ds-' || cast(p_partkey as varchar) AS guid,
               CASE WHEN p_size % 4 = 0 THEN 'hive_view' ELSE 'hive_table' END AS type_name,
               {tkey()} AS qualified_name FROM part
        UNION ALL
        SELECT 'proc-' || cast(o_orderkey as varchar), 'Process', 'process://' || cast(o_orderkey as varchar)
        FROM orders"""),
    "c_partitions": (["c_tables"], f"""
        SELECT {tkey()} AS table_key, d.name, d.status
        FROM (SELECT l_partkey, strftime(l_shipdate, '%Y%m%d') AS name,
                     CASE WHEN min(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) = 0 THEN 'DELETED'
                          ELSE 'ACTIVE' END AS status
              FROM lineitem GROUP BY 1, 2) d JOIN part ON d.l_partkey = p_partkey
        UNION ALL
        SELECT key, '__HIVE_DEFAULT_PARTITION__', 'ACTIVE' FROM c_tables"""),
    "c_dashboard_executions": (["c_dashboards"], """
        SELECT d.key AS dashboard_key, cast(epoch(l_shipdate) as bigint) AS ts,
               CASE WHEN l_linestatus = 'F' THEN 'succeeded' ELSE 'failed' END AS state
        FROM lineitem JOIN c_dashboards d ON l_orderkey = d.order_id"""),
    "c_dashboard_reads": (["c_dashboards"], f"""
        SELECT {email('d.cust_id')} AS user_key, d.key AS dashboard_key, li.read_count
        FROM (SELECT l_orderkey, count(*) AS read_count FROM lineitem GROUP BY 1) li
        JOIN c_dashboards d ON li.l_orderkey = d.order_id"""),
    "c_dashboard_lines": (["c_dashboards"], """
        SELECT d.*, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag
        FROM lineitem JOIN c_dashboards d ON l_orderkey = d.order_id"""),
    "c_dashboard_owners": (["c_dashboard_lines"], f"""
        SELECT DISTINCT key AS resource_key, {email('l_suppkey')} AS user_key
        FROM c_dashboard_lines"""),
    "c_dashboard_queries": (["c_dashboard_lines"], """
        SELECT key AS dashboard_key, 'query_' || cast(l_linenumber as varchar) AS name,
               CASE WHEN l_returnflag <> 'N' THEN 'https://q.example.com/' || cast(l_orderkey as varchar) END AS url,
               CASE WHEN l_linenumber = 1 THEN 'select * from part_' || cast(l_partkey as varchar) END AS query_text
        FROM c_dashboard_lines"""),
    "c_dashboard_charts": (["c_dashboard_lines"], """
        SELECT key AS dashboard_key,
               CASE WHEN l_returnflag = 'R' THEN '' ELSE 'chart_' || cast(l_linenumber as varchar) END AS chart_name
        FROM c_dashboard_lines"""),
    "c_dashboard_tables": (["c_dashboard_lines"], f"""
        SELECT DISTINCT x.key AS dashboard_key, {tkey()} AS table_key
        FROM c_dashboard_lines x JOIN part ON x.l_partkey = p_partkey"""),
    "c_features": ([], """
        SELECT 'fg_' || cast(s_nationkey as varchar) || '/feat_' || cast(s_suppkey as varchar) || '/1.'
                 || cast(s_suppkey % 3 as varchar) || '.0' AS key,
               'feat_' || cast(s_suppkey as varchar) AS name,
               '1.' || cast(s_suppkey % 3 as varchar) || '.0' AS version,
               'fg_' || cast(s_nationkey as varchar) AS feature_group,
               CASE WHEN s_suppkey % 2 = 0 THEN 'bigint' ELSE 'double' END AS data_type,
               'supplier' AS entity,
               CASE WHEN s_acctbal < 0 THEN 'deprecated' ELSE 'active' END AS status,
               CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'balance feature of ' || s_name END AS description,
               s_suppkey AS supp_id, s_nationkey AS nation_id
        FROM supplier"""),
    "c_feature_watermarks": (["c_features"], """
        SELECT f.key AS feature_key, f.key || '/low_watermark' AS key, cast(epoch(w.lo) as bigint) AS time
        FROM (SELECT l_suppkey, min(l_shipdate) lo FROM lineitem GROUP BY 1) w JOIN c_features f ON w.l_suppkey = f.supp_id
        UNION ALL
        SELECT f.key, f.key || '/high_watermark', cast(epoch(w.hi) as bigint)
        FROM (SELECT l_suppkey, max(l_shipdate) hi FROM lineitem GROUP BY 1) w JOIN c_features f ON w.l_suppkey = f.supp_id"""),
    "c_feature_generation_code": (["c_features"], """
        SELECT key AS feature_key, 'select balance from supplier where s_suppkey = ' || cast(supp_id as varchar) AS text,
               'sql' AS source FROM c_features"""),
    "c_feature_databases": (["c_features"], """
        SELECT f.key AS feature_key, lower(n_name) AS database FROM c_features f JOIN nation ON f.nation_id = n_nationkey"""),
    "c_feature_owners": (["c_features"], f"""
        SELECT key AS resource_key, {email('supp_id')} AS user_key FROM c_features"""),
    "c_feature_tags": (["c_features"], """
        SELECT key AS resource_key, data_type AS tag,
               CASE WHEN supp_id % 2 = 0 THEN 'default' ELSE 'badge' END AS tag_type FROM c_features"""),
    "c_issues": ([], f"""
        SELECT {tkey()} AS table_key, 'issue-' || cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) AS issue_key,
               CASE l_linenumber WHEN 1 THEN 'Critical' WHEN 2 THEN 'Major' WHEN 3 THEN 'Minor' ELSE 'Trivial' END AS severity,
               CASE WHEN l_linestatus = 'F' THEN 'resolved' ELSE 'open' END AS status
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "c_reports": ([], f"""
        SELECT {tkey()} AS table_key, 'report_' || cast(l_orderkey as varchar) || '_' || cast(l_linenumber as varchar) AS name,
               'https://reports.example.com/' || cast(l_orderkey as varchar) || '_' || cast(l_linenumber as varchar) AS url,
               CASE WHEN l_linestatus = 'O' THEN 'DELETED' ELSE 'ACTIVE' END AS status
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "c_change_feed": ([], f"""
        SELECT event_id AS seq, CASE WHEN event_id % 7 = 0 THEN 'delete' ELSE 'put' END AS op,
               'table' AS resource_type,
               CASE WHEN event_id % 9 = 0 THEN 'missing://gold.none/part_' || cast(event_id as varchar)
                    WHEN p_partkey IS NOT NULL THEN {tkey()}
                    ELSE 'missing://gold.none/part_' || cast(user_id * 13 + event_id % 13 as varchar) END AS resource_key,
               kind,
               CASE kind WHEN 'description' THEN 'desc ' || cast(event_id as varchar)
                         WHEN 'tag' THEN 'tag' || cast(event_id % 5 as varchar)
                         WHEN 'owner' THEN {email('event_id % 2000')}
                         WHEN 'follow' THEN {email('user_id')}
                         ELSE ['tiny','medium','large','beta','gold'][event_id % 5 + 1] END AS value,
               CASE WHEN kind = 'badge' THEN CASE WHEN event_id % 5 < 3 THEN 'size' ELSE 'table_status' END
                    WHEN kind = 'tag' THEN CASE WHEN event_id % 11 = 0 THEN 'badge' ELSE 'default' END END AS category,
               {email('user_id')} AS actor, ts
        FROM (SELECT *, CASE event_type WHEN 'view' THEN 'description' WHEN 'click' THEN 'tag'
                        WHEN 'purchase' THEN 'owner' WHEN 'signup' THEN 'follow' ELSE 'badge' END AS kind
              FROM events) e
        LEFT JOIN part ON user_id * 13 + event_id % 13 = p_partkey"""),
    "c_pet_registry": ([], f"""
        SELECT cast(c_custkey as integer) AS pet_id, c_name AS name, c_mktsegment AS species,
               {email('c_custkey')} AS owner_email FROM customer"""),
    "c_action_log": ([], f"""
        SELECT event_id AS action_id, event_type AS command, (epoch_us(ts) // 1000) AS start_epoch_ms,
               (epoch_us(ts) // 1000) + cast(json_extract_string(props, '$.k') as bigint) * 1000 AS end_epoch_ms,
               {email('user_id')} AS "user", 'host' || cast(user_id % 4 as varchar) AS host,
               props AS extra_info, CASE WHEN event_type = 'error' THEN 'failure' END AS error
        FROM events"""),
    "c_sensor_events": ([], """
        SELECT cast(user_id as integer) AS pet_id, cast(event_id as varchar) AS event_id, event_type,
               cast(round(value) as integer) AS event_sentiment,
               cast(json_extract_string(props, '$.k') as integer) AS event_duration,
               cast((epoch_us(ts) // 1000) as varchar) AS event_date_time
        FROM events"""),
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)
    for n in names:
        visit(n)
    return out


def with_views(names: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in _order(names))
    return f"WITH {ctes}\n{body}"
