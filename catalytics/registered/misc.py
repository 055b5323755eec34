"""Registered queries: keys and scalar rules, filters, profiling, events,
sources/sinks and streaming products."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalytics.functions import keys as K
from catalytics.operators import filters as FL
from catalytics.operators import profile as P
from catalytics.operators.events import event_enjoyment
from catalytics.registry import _catalog, register
from catalytics.session import scratch_path
from catalytics.sources import events as EV
from catalytics.sources import preview as PV
from catalytics.streaming import events as ST
from catalytics.streaming.state import CatalogState, stream_into

# Fixed parameters of the registered queries.
DENY_SCHEMAS = ["small"]
EDITABLE_RULES = [("econ.*", None), (None, "part_1.*"), ("prom.*", "part_2.*")]
EXCLUDE_SOURCES = ["internal.*"]
PROG_SOURCES = ["qualityReport", "quality Report", "auditLog", "dataContract", "internalNote"]
LAYOUT = {"LEFT": {"quality report": {"display_order": 1}, "audit log": {"display_order": 0}},
          "RIGHT": {"data contract": {}},
          "other note": {"display_order": 0}}
STAT_SPEC = {"min": {"format": "%.2f", "new_name": "minimum"}, "max": {"drop": True},
             "avg": {"format": "%.4f"}}
STAT_ORDER = ["max", "min", "avg"]
VALUE_COLUMNS = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]


def prog_descriptions(c):
    t = c.tables
    return t.select(F.col("key").alias("resource_key"),
                    F.explode(F.array(*[F.lit(s) for s in PROG_SOURCES])).alias("source"),
                    "name").select(
        "resource_key", "source", F.concat("source", F.lit(": "), "name").alias("text"))


@register("parse_table_key")
def parse_table_key(spark, sf):
    c = _catalog(spark, sf)
    keys = (c.tables.select("key").unionByName(c.dashboards.select("key"))
            .unionByName(c.columns.select("key")))
    p = K.parse_table_key(keys, "key")
    return p.withColumn("rebuilt_equal", K.build_table_key(
        F.col("database"), F.col("cluster"), F.col("schema"), F.col("name")) == F.col("key"))


@register("parse_bookmark_key")
def parse_bookmark_key(spark, sf):
    c = _catalog(spark, sf)
    r = c.reads.join(c.tables.select(F.col("key").alias("table_key"), "schema", "name", "cluster"),
                     "table_key")
    b = r.select(F.concat("schema", F.lit("."), "name", F.lit(".table."),
                          F.substring_index("user_key", "@", 1), F.lit(".bookmark@"), "cluster")
                 .alias("bookmark_key"))
    return K.parse_bookmark_key(b, "bookmark_key")


@register("filter_active")
def filter_active(spark, sf):
    c = _catalog(spark, sf)
    return FL.filter_active(c.dashboards.select("key", "status")).select("key")


@register("editable_flag")
def editable_flag(spark, sf):
    c = _catalog(spark, sf)
    return FL.editable_flag(c.tables.select("key", "schema", "name"), DENY_SCHEMAS, EDITABLE_RULES)


@register("restrict_description_sources")
def restrict_description_sources(spark, sf):
    c = _catalog(spark, sf)
    return FL.restrict_description_sources(prog_descriptions(c), EXCLUDE_SOURCES)


@register("description_layout")
def description_layout(spark, sf):
    c = _catalog(spark, sf)
    d = FL.restrict_description_sources(prog_descriptions(c), []).drop("position")
    d = d.unionByName(c.tables.select(F.col("key").alias("resource_key"), F.lit("other note").alias("source"),
                                      F.lit("n/a").alias("text")))
    return P.description_layout(d, LAYOUT)


@register("format_column_stats")
def format_column_stats(spark, sf):
    return FL.format_column_stats(_catalog(spark, sf).column_stats, STAT_SPEC)


@register("stat_order")
def stat_order(spark, sf):
    return FL.stat_order(_catalog(spark, sf).column_stats, STAT_ORDER).select(
        "column_key", "stat_type", "position")


@register("column_profile")
def column_profile(spark, sf):
    c = _catalog(spark, sf)
    return P.column_profile(c.raw("lineitem"))


@register("column_value_counts")
def column_value_counts(spark, sf):
    """Values that 2 % of the order lines or more have, with their epochs."""
    return P.column_value_counts(_catalog(spark, sf).raw("lineitem"), 0.02, VALUE_COLUMNS, "l_shipdate")


@register("unique_values_summary")
def unique_values_summary(spark, sf):
    return P.unique_values_summary(_catalog(spark, sf).column_stats, 5)


@register("column_usage")
def column_usage(spark, sf):
    c = _catalog(spark, sf)
    return P.column_usage(c.columns, c.column_stats)


@register("column_order")
def column_order(spark, sf):
    c = _catalog(spark, sf)
    cols = c.columns.select("key", "table_key", "name", "sort_order")
    return P.column_order(cols, "usage", P.column_usage(c.columns, c.column_stats)).select(
        "key", "table_key", "name", "position")


@register("column_order_by_sort")
def column_order_by_sort(spark, sf):
    c = _catalog(spark, sf)
    return P.column_order(c.columns.select("key", "table_key", "name", F.when(F.col("sort_order") != 2, F.col("sort_order")).alias(
        "sort_order")), "sort_order").select("key", "position")


@register("column_order_by_name")
def column_order_by_name(spark, sf):
    return P.column_order(_catalog(spark, sf).columns.select("key", "table_key", "name"), "name").select("key", "position")


@register("column_type_census")
def column_type_census(spark, sf):
    c = _catalog(spark, sf)
    return P.column_type_census(c.columns, c.tables)


@register("page")
def page(spark, sf):
    c = _catalog(spark, sf)
    return FL.page_with_total(c.tables.select("key", "popularity_score"),
                              [F.desc("popularity_score"), F.asc("key")], 3, 10)


@register("scalar_functions")
def scalar_functions(spark, sf):
    c = _catalog(spark, sf)
    d = c.dashboards
    return d.select(
        "key", K.dashboard_product(F.col("key")).alias("product"),
        K.key_segment(F.col("key"), -1).alias("last_segment"),
        K.epoch_trim(F.col("created_timestamp") * 1000).alias("created_s"),
        K.text_case(F.col("group_name"), "title").alias("title_group"),
        K.text_case(F.col("group_name"), "upper").alias("upper_group"),
        K.text_case(F.col("name"), "sentence").alias("sentence_name"),
        K.is_number(F.element_at(F.split("group_name", "-"), 1)).alias("group_is_number"),
        # epoch seconds -> calendar date without going through the session zone
        F.date_add(F.to_date(F.lit("1970-01-01")), F.floor(F.col("created_timestamp") / 86400).cast("int"))
        .cast("string").alias("created_date"))


@register("event_enjoyment")
def event_enjoyment_q(spark, sf):
    return event_enjoyment(_catalog(spark, sf).sensor_events)


@register("event_enjoyment_daily")
def event_enjoyment_daily(spark, sf):
    return event_enjoyment(_catalog(spark, sf).sensor_events, by_day=True)


#: Parts in which the sensor events of the streaming queries arrive, and files of each.
DELIVERIES, FILES = 3, 2


def _write_sensor_json(spark, c, name):
    path = scratch_path(spark, name)
    EV.sensor_json_lines(c.sensor_events).write.text(path)
    return path


def _delivered(spark, c, name, copies_every=None, end=True, order=None):
    """A stream over events that arrive in several parts and then end."""
    events, path = c.sensor_events, scratch_path(spark, name)
    if copies_every:
        events = events.unionByName(events.where(F.col("event_id").cast("long") % copies_every == 1))
    EV.deliver(events, path, DELIVERIES, order, FILES)
    if end:
        last = events.agg(F.max(F.col("event_date_time").cast("long"))).first()[0] or 0
        EV.deliver_end(spark, path, last + 365 * 86_400_000)
    return EV.ingest_events_stream(spark, path, FILES)[0]


@register("ingest_events_batch")
def ingest_events_batch(spark, sf):
    c = _catalog(spark, sf)
    ok, _ = EV.ingest_events_batch(spark, _write_sensor_json(spark, c, "ingest"))
    return _ntz(ok)


@register("ingest_events_rejects")
def ingest_events_rejects(spark, sf):
    c = _catalog(spark, sf)
    _, bad = EV.ingest_events_batch(spark, _write_sensor_json(spark, c, "ingest"))
    return bad


def _ntz(df):
    """Render instant columns as wall-clock (session zone) timestamps, the
    type the driver tables use."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.typeName() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields])


def _stream_to_table(spark, df, name, mode="append"):
    out, chk = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-chk")
    ST.run_to_files(df, out, chk, mode)
    return _ntz(spark.read.parquet(out))


def _ingest_stream(spark, sf, sink):
    c = _catalog(spark, sf)
    path, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    EV.deliver(c.sensor_events, path, DELIVERIES, files=FILES)
    EV.ingest_stream_to(spark, path, out, scratch_path(spark, "stream-chk"), FILES)
    return spark.read.parquet(f"{out}/{sink}").drop("batch")


@register("ingest_events_stream")
def ingest_events_stream(spark, sf):
    return _ntz(_ingest_stream(spark, sf, "events"))


@register("ingest_events_stream_rejects")
def ingest_events_stream_rejects(spark, sf):
    return _ingest_stream(spark, sf, "rejects")


@register("stream_dedup_events")
def stream_dedup_events(spark, sf):
    s = _delivered(spark, _catalog(spark, sf), "dedup-in", copies_every=10, end=False)
    return _stream_to_table(spark, ST.stream_dedup_events(s), "dedup")


@register("stream_activity_windows")
def stream_activity_windows(spark, sf):
    s = _delivered(spark, _catalog(spark, sf), "win-in")
    return _stream_to_table(spark, ST.stream_activity_windows(s, "1 day", None, "1 hour"), "win")


@register("stream_activity_sliding")
def stream_activity_sliding(spark, sf):
    s = _delivered(spark, _catalog(spark, sf), "slide-in")
    return _stream_to_table(spark, ST.stream_activity_windows(s, "2 days", "1 day", "1 hour"), "slide")


@register("stream_sessions")
def stream_sessions(spark, sf):
    s = _delivered(spark, _catalog(spark, sf), "sess-in")
    return _stream_to_table(spark, ST.stream_sessions(s, "6 hours", "1 hour"), "sess")


@register("stream_late_rows")
def stream_late_rows(spark, sf):
    """Events that come in the wrong order, the first span last: rows read,
    counted in windows and left out as late, which add up."""
    c = _catalog(spark, sf)
    s = _delivered(spark, c, "late-in", order=[1, 2, 0])
    t = _stream_to_table(spark, ST.stream_activity_windows(s, "1 day", None, "1 hour"), "late")
    counted = t.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_counted"))
    read = c.sensor_events.agg(F.count(F.lit(1)).alias("rows_read"))
    return read.join(counted).select("rows_read", "rows_counted",
                                     (F.col("rows_read") - F.col("rows_counted")).alias("rows_late"))


def _parts(spark, df, by, name):
    """``df`` written in three parts by ranges of ``by``, in order; a stream
    that takes one part per micro-batch."""
    path = scratch_path(spark, name)
    span = df.agg(F.min(by).alias("lo"), F.max(by).alias("hi")).first()
    width = ((span["hi"] or 0) - (span["lo"] or 0)) // DELIVERIES + 1
    for k in range(DELIVERIES):
        part = df.where(F.floor((F.col(by) - F.lit(span["lo"] or 0)) / F.lit(width)) == k)
        part.repartition(FILES).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", FILES).parquet(path)


@register("stream_action_usage")
def stream_action_usage(spark, sf):
    c = _catalog(spark, sf)
    s = _parts(spark, c.action_log, "start_epoch_ms", "actions-in").withColumn(
        "action_ts", F.timestamp_millis("start_epoch_ms"))
    t = _stream_to_table(spark, ST.stream_action_usage(s, "1 day", "1 hour"), "actions", mode="update")
    # update mode emits a key again when it changes; that of the last batch holds
    last = t.groupBy("day", "command", "user").agg(F.max_by(F.struct("n_actions", "n_errors"), "batch").alias("m"))
    return last.select("day", "command", "user", "m.*")


def _streamed_state(spark, sf, kind):
    """The change feed in several micro-batches over bucketed state."""
    from catalytics.registered.changes import BADGE_WHITELIST, _descs, _follows, _whitelist
    c = _catalog(spark, sf)
    state = CatalogState(spark, scratch_path(spark, "catalog-state"), c.tables, _whitelist(spark),
                         [b for b, _ in BADGE_WHITELIST], kinds=[kind])
    state.start(description=_descs(c), owner=c.owners, tag=c.tags, badge=c.badges, follow=_follows(c))
    stream_into(state, _parts(spark, c.change_feed, "seq", "changes-in"), scratch_path(spark, "catalog-chk"))
    return state.read(kind)


@register("stream_catalog_changes")
def stream_catalog_changes(spark, sf):
    return _streamed_state(spark, sf, "description")


@register("stream_catalog_owners")
def stream_catalog_owners(spark, sf):
    return _streamed_state(spark, sf, "owner")


@register("stream_catalog_tags")
def stream_catalog_tags(spark, sf):
    return _streamed_state(spark, sf, "tag")


@register("stream_catalog_badges")
def stream_catalog_badges(spark, sf):
    return _streamed_state(spark, sf, "badge")


@register("stream_catalog_relations")
def stream_catalog_relations(spark, sf):
    return _streamed_state(spark, sf, "follow")


@register("catalog_scan")
def catalog_scan(spark, sf):
    c = _catalog(spark, sf)
    path = scratch_path(spark, "catalog")
    PV.write_catalog({"reads": c.reads, "owners": c.owners}, path)
    frames = PV.catalog_scan(spark, path, ["reads", "owners"])
    return frames["reads"].groupBy("table_key").agg(F.sum("read_count").cast("long").alias("reads"))


@register("catalog_scan_edges")
def catalog_scan_edges(spark, sf):
    """Edges stored by label; the scan opens the read and owner labels only."""
    c = _catalog(spark, sf)
    path = scratch_path(spark, "edges")
    PV.write_edges({
        "read": c.reads.select(F.col("user_key").alias("src"), F.col("table_key").alias("dst"), "read_count"),
        "owner": c.owners.select(F.col("user_key").alias("src"), F.col("resource_key").alias("dst")),
        "tag": c.tags.select(F.col("tag").alias("src"), F.col("resource_key").alias("dst"))}, path)
    return PV.scan_edges(spark, path, ["read", "owner"]).groupBy("label", "src").agg(
        F.count(F.lit(1)).alias("n_edges"), F.sum("read_count").cast("long").alias("reads"))


@register("index_snapshot_publish")
def index_snapshot_publish(spark, sf):
    from catalytics.operators.search import assemble_table_docs
    c = _catalog(spark, sf)
    docs = assemble_table_docs(c.tables, c.columns, c.tags, c.badges, c.reads)
    path = scratch_path(spark, "index")
    PV.index_snapshot_publish(docs.where(F.col("total_usage") > 100), path, 1)
    PV.index_snapshot_publish(docs, path, 2)
    return PV.read_current_snapshot(spark, path).select("key", "total_usage")


@register("table_preview")
def table_preview(spark, sf):
    c = _catalog(spark, sf)
    return PV.table_preview(
        c.raw("lineitem"), 50, [F.col("l_orderkey"), F.col("l_linenumber")],
        ["l_orderkey", "l_linenumber", "l_quantity", "'***' AS l_extendedprice"],
        F.col("l_returnflag") == "R")


@register("preview_flatten")
def preview_flatten(spark, sf):
    c = _catalog(spark, sf)
    o = c.raw("orders")
    nested = o.select(F.col("o_orderkey").alias("id"),
                      F.struct(F.col("o_custkey").alias("custkey"),
                               F.struct(F.col("o_orderstatus").alias("status"),
                                        F.col("o_orderpriority").alias("priority")).alias("info"))
                      .alias("order"))
    return PV.preview_flatten(nested)


@register("collect_distinct_children")
def collect_distinct_children(spark, sf):
    from catalytics.plans import collect_distinct_children as cdc
    c = _catalog(spark, sf)
    g = cdc(c.tags, "resource_key", "tag", "tags")
    return g.select("resource_key", F.size("tags").alias("n_tags"), F.array_join("tags", "|").alias("tags"))


@register("topk_per_key")
def topk_per_key(spark, sf):
    from catalytics.plans import topk_per_key as tk
    c = _catalog(spark, sf)
    return tk(c.reads.select("user_key", "table_key", "read_count"), "user_key",
              [F.desc("read_count"), F.asc("table_key")], 3, rank_col="rank")


@register("assemble_search_docs")
def assemble_search_docs(spark, sf):
    from catalytics.operators.search import assemble_table_docs
    c = _catalog(spark, sf)
    d = assemble_table_docs(c.tables, c.columns, c.tags, c.badges, c.reads)
    return d.select("key", "display_name", "qualified_name", "total_usage",
                    F.array_join("column_names", ",").alias("column_names"),
                    F.array_join("column_descriptions", "|").alias("column_descriptions"),
                    F.array_join("tags", "|").alias("tags"), F.array_join("badges", "|").alias("badges"))


@register("user_resources_follow")
def user_resources_follow(spark, sf):
    from catalytics.operators.details import user_resources
    c = _catalog(spark, sf)
    follows = c.reads.where(F.col("read_count") >= 2).select(
        "user_key", F.col("table_key").alias("resource_key"))
    res = c.tables.select("key", "database", "cluster", "schema", "name", "description")
    return user_resources(follows, res, "follow")


@register("stream_registration_join")
def stream_registration_join(spark, sf):
    """Stream-static join: streaming sensor events enriched with the
    registration table (left join; the static side is shuffled, not
    assumed small)."""
    from catalytics.operators.details import event_registration_join
    c = _catalog(spark, sf)
    s = _delivered(spark, c, "reg-in", end=False)
    return _stream_to_table(spark, event_registration_join(s, c.pet_registry), "reg")


# Fixed parameters: preview allow-list and rows per source.
PREVIEW_CLUSTERS = ["gold"]
PREVIEW_ROWS = {"brand_1": 5, "brand_2": 100}


@register("preview_allowed")
def preview_allowed(spark, sf):
    c = _catalog(spark, sf)
    t = c.tables.select("key", "database", F.when(F.col("is_view"), F.lit("silver"))
                        .otherwise(F.col("cluster")).alias("cluster"))
    return PV.preview_allowed(t, PREVIEW_CLUSTERS, PREVIEW_ROWS, 50)
