"""Catalog frames.

The catalog is a set of node and edge DataFrames keyed by string keys
(``{db}://{cluster}.{schema}/{table}`` for tables, e-mail for users). In
production they are read from wherever the catalog lives (``catalog_scan``);
for the driver's test data they are *derived* from the TPC-H-like tables so
that every operator's work grows with the data:

=================  ==========================================================
frame              derivation
=================  ==========================================================
tables             ``part``: db = brand, schema = type, name = part_<key>
databases/...      distinct hierarchy levels of ``tables``
users              ``customer``; manager = custkey div 10
reads              ``lineitem`` x ``orders``: one READ edge per
                   (customer, part), read_count = lines, date = last order
read_edges         the same edges one by one, one per order line
owners             (part, supplier) of first lines of returned items
tags               words of ``p_name`` (tables), priority word (dashboards)
badges             size band of ``p_size`` (+ a status badge)
columns            five columns per table, stats from ``lineitem``
lineage            part p has upstream p div 2 and (p % 5 = 0) p - 3
processes          orders as processes: odd lines in, even lines out
dashboards         ``orders``; executions = its lines; reads = its customer
features           ``supplier``; watermarks from its lines
partitions         one partition per (part, ship date) + noise names
action log/sensor  ``events``
=================  ==========================================================

Frames are built lazily and cached per Catalog object only as *plans*
(no ``cache()``): Catalyst prunes every unused column back to the parquet
scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.plans import dealt, spread

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events "
                 "documents embeddings pages benchmark labels conversations").split()


def table_key(db: Column, cluster: Column, schema: Column, name: Column) -> Column:
    return F.concat(db, F.lit("://"), cluster, F.lit("."), schema, F.lit("/"), name)


def part_table_key(p_brand: Column, p_type: Column, p_partkey: Column) -> Column:
    return table_key(F.lower(F.replace(p_brand, F.lit("#"), F.lit("_"))), F.lit("gold"),
                     F.lower(p_type), F.concat(F.lit("part_"), p_partkey.cast("string")))


def user_email(custkey: Column) -> Column:
    return F.concat(F.lit("user"), custkey.cast("string"), F.lit("@example.com"))


_EPOCH0 = "1970-01-01 00:00:00"


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds of a wall-clock (TIMESTAMP_NTZ) value, independent of
    the session time zone."""
    return F.unix_timestamp(ts).cast("long")


def epoch_millis(ts: Column) -> Column:
    """Epoch milliseconds (truncated) of a TIMESTAMP_NTZ value, independent
    of the session time zone."""
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH0).cast("timestamp_ntz"), ts)


class Catalog:
    """Lazily derived catalog frames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def keyed(self, name: str) -> DataFrame:
        """A table that others look up by key, for joins without broadcast."""
        return spread(self.raw(name))

    # ------------------------------------------------------------ tables
    @cached_property
    def tables(self) -> DataFrame:
        return spread(self._tables)

    @cached_property
    def _tables(self) -> DataFrame:
        p = self.raw("part")
        db = F.lower(F.replace(p.p_brand, F.lit("#"), F.lit("_")))
        schema = F.lower(p.p_type)
        name = F.concat(F.lit("part_"), p.p_partkey.cast("string"))
        return p.select(
            table_key(db, F.lit("gold"), schema, name).alias("key"),
            db.alias("database"), F.lit("gold").alias("cluster"),
            schema.alias("schema"), name.alias("name"),
            F.when(p.p_partkey % 11 == 0, F.lit(None).cast("string"))
             .when(p.p_partkey % 13 == 0, F.lit(""))
             .otherwise(p.p_name).alias("description"),
            (p.p_size % 10 == 0).alias("is_view"),
            F.when(p.p_partkey % 17 == 0, F.lit("DELETED")).otherwise(F.lit("ACTIVE")).alias("status"),
            p.p_retailprice.alias("popularity_score"),
            user_email(p.p_partkey % 150).alias("owner"),
            p.p_partkey.alias("part_id"),
        )

    @cached_property
    def schemas(self) -> DataFrame:
        t = self._tables
        return t.select(
            F.concat(t.database, F.lit("://"), t.cluster, F.lit("."), t["schema"]).alias("key"),
            t["schema"].alias("name"),
            F.concat(t.database, F.lit("://"), t.cluster).alias("cluster_key")).distinct()

    @cached_property
    def clusters(self) -> DataFrame:
        t = self._tables
        return t.select(F.concat(t.database, F.lit("://"), t.cluster).alias("key"),
                        t.cluster.alias("name"),
                        F.concat(F.lit("database://"), t.database).alias("database_key")).distinct()

    @cached_property
    def databases(self) -> DataFrame:
        t = self._tables
        return t.select(F.concat(F.lit("database://"), t.database).alias("key"),
                        t.database.alias("name")).distinct()

    @cached_property
    def table_schema_edges(self) -> DataFrame:
        t = self.tables
        return t.select(t.key.alias("table_key"),
                        F.concat(t.database, F.lit("://"), t.cluster, F.lit("."), t["schema"])
                        .alias("schema_key"))

    # ------------------------------------------------------------- users
    @cached_property
    def users(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(
            user_email(c.c_custkey).alias("email"),
            F.concat(F.lit("first"), c.c_custkey.cast("string")).alias("first_name"),
            F.concat(F.lit("last"), c.c_nationkey.cast("string")).alias("last_name"),
            c.c_name.alias("full_name"),
            c.c_mktsegment.alias("team_name"),
            F.when(c.c_custkey >= 10, user_email(F.floor(c.c_custkey / 10))).alias("manager_email"),
            (c.c_acctbal > 0).alias("is_active"),
            F.when(c.c_custkey % 2 == 0, F.lit("fte")).otherwise(F.lit("contractor")).alias("employee_type"),
            F.lower(F.replace(c.c_name, F.lit("#"), F.lit("_"))).alias("github_username"),
            F.when(c.c_custkey % 2 == 1, F.concat(F.lit("U"), c.c_custkey.cast("string"))).alias("slack_id"),
            F.when(c.c_custkey % 7 == 0, F.lit("stored manager")).alias("manager_fullname"),
            F.concat(F.lit("role"), (c.c_custkey % 4).cast("string")).alias("role_name"),
            c.c_custkey.alias("user_id"),
        )

    # ------------------------------------------------------------- reads
    @cached_property
    def reads(self) -> DataFrame:
        """READ edges (user, table): one row per (customer, part).

        Aggregated on (custkey, partkey) *before* the part lookup, so the
        join with ``part`` sees one row per edge, not one per line item."""
        li = self.raw("lineitem").select("l_orderkey", "l_partkey")
        o = self.keyed("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        per_edge = (li.join(o, li.l_orderkey == o.o_orderkey)
                    .groupBy("o_custkey", "l_partkey")
                    .agg(F.count(F.lit(1)).alias("read_count"),
                         F.max(F.to_date("o_orderdate")).alias("read_date"),
                         F.max(F.when(F.col("o_orderstatus") == "F",
                                      F.date_format("o_orderdate", "yyyy-MM-dd")))
                         .alias("published_tag")))
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        return per_edge.join(p, per_edge.l_partkey == p.p_partkey).select(
            user_email(F.col("o_custkey")).alias("user_key"),
            part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("table_key"),
            "read_count", "read_date", "published_tag")

    @cached_property
    def read_edges(self) -> DataFrame:
        """READ edges as recorded, one per order line: a user can have several
        with one table. read_count is the line number."""
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", F.col("l_linenumber").cast("long").alias("read_count"))
        o = self.keyed("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("read_date"))
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
                .select(user_email(F.col("o_custkey")).alias("user_key"),
                        part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("table_key"), "read_count", "read_date"))

    # ------------------------------------------------------------ owners
    @cached_property
    def owners(self) -> DataFrame:
        li = self.raw("lineitem")
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        e = dealt(li.select("l_partkey", "l_suppkey"), "l_partkey").distinct()
        return e.join(p, e.l_partkey == p.p_partkey).select(
            part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("resource_key"),
            user_email(e.l_suppkey).alias("user_key"))

    # -------------------------------------------------------- tags/badges
    @cached_property
    def tags(self) -> DataFrame:
        """(resource_key, tag, tag_type): words of the part name on tables,
        the priority word on dashboards."""
        p = self.raw("part")
        t = p.select(part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("resource_key"),
                     F.explode(F.split(p.p_name, " ")).alias("tag"))
        t = t.where(F.col("tag") != "").distinct().withColumn("tag_type", F.lit("default"))
        d = self.dashboards.select(F.col("key").alias("resource_key"),
                                   F.col("priority_word").alias("tag"),
                                   F.lit("default").alias("tag_type"))
        return t.unionByName(d)

    @cached_property
    def badges(self) -> DataFrame:
        """(resource_key, badge_name, category)."""
        p = self.raw("part")
        key = part_table_key(p.p_brand, p.p_type, p.p_partkey)
        size = p.select(key.alias("resource_key"),
                        F.when(p.p_size <= 10, "tiny").when(p.p_size <= 30, "medium")
                        .otherwise("large").alias("badge_name"),
                        F.lit("size").alias("category"))
        beta = p.where(p.p_partkey % 9 == 0).select(key.alias("resource_key"),
                                                   F.lit("beta").alias("badge_name"),
                                                   F.lit("table_status").alias("category"))
        return size.unionByName(beta)

    # ---------------------------------------- writers, updates, sources
    def _part_of(self, *cols):
        p = self.keyed("part")
        return p.select(part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("table_key"), "p_partkey", *cols)

    @cached_property
    def table_writers(self) -> DataFrame:
        """(table_key, id, name, application_url, description): the scheduled
        task that generates a table; every fourth table has none."""
        p = self._part_of().where(F.col("p_partkey") % 4 != 0)
        dag = F.concat(F.lit("dag_"), (F.col("p_partkey") % 50).cast("string"))
        return p.select("table_key", F.concat(dag, F.lit("/task_"), F.col("p_partkey").cast("string")).alias("id"),
                        F.lit("Airflow").alias("name"),
                        F.concat(F.lit("https://airflow.example.com/"), dag).alias("application_url"),
                        F.concat(F.lit("task of "), dag).alias("description"))

    @cached_property
    def table_updates(self) -> DataFrame:
        """(table_key, last_updated_timestamp): one per order line of the part."""
        li = self.raw("lineitem").select("l_partkey", epoch_seconds(F.col("l_shipdate")).alias("last_updated_timestamp"))
        p = self._part_of()
        return li.join(p, li.l_partkey == p.p_partkey).select("table_key", "last_updated_timestamp")

    @cached_property
    def table_sources(self) -> DataFrame:
        """(table_key, source_type, source) of every third table."""
        return self._part_of().where(F.col("p_partkey") % 3 == 0).select(
            "table_key", F.lit("github").alias("source_type"),
            F.concat(F.lit("https://git.example.com/models/"), F.col("p_partkey").cast("string"), F.lit(".sql")).alias("source"))

    @cached_property
    def column_badges(self) -> DataFrame:
        """Key columns are marked; nested ones of large parts too."""
        c = self.columns.select(F.col("key").alias("resource_key"), "name")
        key = c.where(F.col("name") == "partkey").select(
            "resource_key", F.lit("primary key").alias("badge_name"), F.lit("column").alias("category"))
        return key.unionByName(c.where(F.col("name") == "props").select(
            "resource_key", F.lit("nested").alias("badge_name"), F.lit("column").alias("category")))

    @cached_property
    def dashboard_badges(self) -> DataFrame:
        return self.dashboards.where(F.col("priority_word") == "urgent").select(
            F.col("key").alias("resource_key"), F.lit("urgent").alias("badge_name"), F.lit("dashboard").alias("category"))

    @cached_property
    def dashboard_updates(self) -> DataFrame:
        """(dashboard_key, updated_timestamp): a day after each run."""
        return self.dashboard_executions.select("dashboard_key", (F.col("ts") + 86400).alias("updated_timestamp"))

    @cached_property
    def feature_badges(self) -> DataFrame:
        return self.features.where(F.col("status") == "deprecated").select(
            F.col("key").alias("resource_key"), F.lit("at risk").alias("badge_name"), F.lit("feature").alias("category"))

    # ----------------------------------------------------------- columns
    @cached_property
    def columns(self) -> DataFrame:
        """Five columns per table (fixed layout), description on the first two."""
        spec = F.array(*[
            F.struct(F.lit(n).alias("name"), F.lit(t).alias("col_type"),
                     F.lit(i).alias("sort_order"))
            for i, (n, t) in enumerate(COLUMN_LAYOUT)])
        t = self.tables.select("key", F.explode(spec).alias("c"))
        return t.select(
            F.concat(t.key, F.lit("/"), F.col("c.name")).alias("key"),
            t.key.alias("table_key"), F.col("c.name").alias("name"),
            F.col("c.col_type").alias("col_type"), F.col("c.sort_order").alias("sort_order"),
            F.when(F.col("c.sort_order") < 2, F.concat(F.lit("column "), F.col("c.name")))
             .alias("description"))

    @cached_property
    def column_stats(self) -> DataFrame:
        """(column_key, stat_type, stat_val, start_epoch, end_epoch) computed
        from ``lineitem`` per part: quantity min/max/avg, partkey usage,
        returnflag value counts."""
        li = self.raw("lineitem")
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        per_flag = li.groupBy("l_partkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
        uniq = per_flag.groupBy("l_partkey").agg(
            F.array_sort(F.collect_list(F.struct("l_returnflag", "n"))).alias("vc"))
        uniq = uniq.select("l_partkey", F.concat(
            F.lit("{"), F.array_join(F.transform(
                "vc", lambda e: F.concat(F.lit("'"), e["l_returnflag"], F.lit("': "),
                                         e["n"].cast("string"))), ", "),
            F.lit("}")).alias("unique_values"))
        agg = li.groupBy("l_partkey").agg(
            F.min("l_quantity").alias("mn"), F.max("l_quantity").alias("mx"),
            F.avg("l_quantity").alias("av"), F.count(F.lit(1)).alias("usage"),
            F.min("l_shipdate").alias("t0"), F.max("l_shipdate").alias("t1"))
        j = agg.join(spread(uniq), "l_partkey").join(p, F.col("l_partkey") == p.p_partkey)
        tk = part_table_key(p.p_brand, p.p_type, p.p_partkey)

        def num(c):
            return F.round(c.cast("double"), 4).cast("string")
        rows = F.array(
            F.struct(F.lit("quantity").alias("col"), F.lit("min").alias("stat_type"), num(F.col("mn")).alias("stat_val")),
            F.struct(F.lit("quantity").alias("col"), F.lit("max").alias("stat_type"), num(F.col("mx")).alias("stat_val")),
            F.struct(F.lit("quantity").alias("col"), F.lit("avg").alias("stat_type"), num(F.col("av")).alias("stat_val")),
            F.struct(F.lit("partkey").alias("col"), F.lit("column_usage").alias("stat_type"),
                     F.col("usage").cast("string").alias("stat_val")),
            F.struct(F.lit("name").alias("col"), F.lit("unique_values").alias("stat_type"),
                     F.col("unique_values").alias("stat_val")))
        x = j.select(tk.alias("tk"), epoch_seconds(F.col("t0")).alias("start_epoch"),
                     epoch_seconds(F.col("t1")).alias("end_epoch"), F.explode(rows).alias("r"))
        return x.select(F.concat(x.tk, F.lit("/"), F.col("r.col")).alias("column_key"),
                        F.col("r.stat_type").alias("stat_type"), F.col("r.stat_val").alias("stat_val"),
                        "start_epoch", "end_epoch")

    # ----------------------------------------------------------- lineage
    @cached_property
    def lineage(self) -> DataFrame:
        """(upstream_key, downstream_key) table edges."""
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        half = p.where(p.p_partkey > 0).select(
            F.col("p_partkey").alias("down"), F.floor(F.col("p_partkey") / 2).alias("up"))
        three = p.where((p.p_partkey % 5 == 0) & (p.p_partkey > 3)).select(
            F.col("p_partkey").alias("down"), (F.col("p_partkey") - 3).alias("up"))
        e = half.unionByName(three).distinct()
        pu = p.select(F.col("p_partkey").alias("uk"),
                      part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("upstream_key"))
        pd_ = p.select(F.col("p_partkey").alias("dk"),
                       part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("downstream_key"))
        return (e.join(pu, e.up == pu.uk).join(pd_, e.down == pd_.dk)
                .select("upstream_key", "downstream_key"))

    @cached_property
    def process_relations(self) -> DataFrame:
        """Bipartite (from_guid, to_guid): dataset -> process -> dataset.
        Orders are processes, odd line numbers are inputs, even outputs."""
        li = dealt(self.raw("lineitem").select("l_orderkey", "l_partkey", (F.col("l_linenumber") % 2).alias("odd")), "l_orderkey").distinct()
        ds = F.concat(F.lit("ds-"), F.col("l_partkey").cast("string"))
        pr = F.concat(F.lit("proc-"), F.col("l_orderkey").cast("string"))
        ins = li.where(F.col("odd") == 1).select(ds.alias("from_guid"), pr.alias("to_guid"))
        outs = li.where(F.col("odd") == 0).select(pr.alias("from_guid"), ds.alias("to_guid"))
        return ins.unionByName(outs)

    @cached_property
    def process_entities(self) -> DataFrame:
        """(guid, type_name, qualified_name) for datasets and processes."""
        p = self.raw("part")
        ds = p.select(F.concat(F.lit("ds-"), p.p_partkey.cast("string")).alias("guid"),
                      F.when(p.p_size % 4 == 0, F.lit("hive_view")).otherwise(F.lit("hive_table"))
                      .alias("type_name"),
                      part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("qualified_name"))
        o = self.raw("orders")
        pr = o.select(F.concat(F.lit("proc-"), o.o_orderkey.cast("string")).alias("guid"),
                      F.lit("Process").alias("type_name"),
                      F.concat(F.lit("process://"), o.o_orderkey.cast("string")).alias("qualified_name"))
        return ds.unionByName(pr)

    # -------------------------------------------------------- partitions
    @cached_property
    def partitions(self) -> DataFrame:
        """(table_key, name, status): one partition per distinct ship date
        of a part, named yyyyMMdd; returned lines mark it DELETED; plus one
        noise partition per table that no date format parses."""
        li = self.raw("lineitem")
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        d = dealt(li.select("l_partkey", F.to_date("l_shipdate").alias("day"), "l_returnflag"), "l_partkey").groupBy("l_partkey", "day").agg(
            F.when(F.min(F.when(F.col("l_returnflag") == "R", 0).otherwise(1)) == 0,
                   F.lit("DELETED")).otherwise(F.lit("ACTIVE")).alias("status"))
        d = d.join(p, d.l_partkey == p.p_partkey).select(
            part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("table_key"), F.date_format("day", "yyyyMMdd").alias("name"), "status")
        noise = self.tables.select(F.col("key").alias("table_key"),
                                   F.lit("__HIVE_DEFAULT_PARTITION__").alias("name"),
                                   F.lit("ACTIVE").alias("status"))
        return d.unionByName(noise)

    @cached_property
    def partition_keys(self) -> DataFrame:
        """(table_key, position, column) partition key columns per table."""
        return self.tables.select(
            F.col("key").alias("table_key"),
            F.posexplode(F.array(F.lit("ds"), F.lit("region"))).alias("position", "column"))

    # -------------------------------------------------------- dashboards
    @cached_property
    def dashboards(self) -> DataFrame:
        o = self.keyed("orders")
        product = F.element_at(F.array(F.lit("mode"), F.lit("superset"), F.lit("tableau")),
                               (o.o_orderkey % 3 + 1).cast("int"))
        group = F.lower(F.replace(o.o_orderpriority, F.lit(" "), F.lit("_")))
        key = F.concat(product, F.lit("_dashboard://gold."), group, F.lit("/"), o.o_orderkey.cast("string"))
        return o.select(
            key.alias("key"), F.concat(F.lit("dashboard "), o.o_orderkey.cast("string")).alias("name"),
            F.concat(F.lit("https://dash.example.com/"), o.o_orderkey.cast("string")).alias("url"),
            group.alias("group_name"), F.lit("gold").alias("cluster"), product.alias("product"),
            F.when(o.o_orderkey % 4 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("orders of customer "), o.o_custkey.cast("string"))).alias("description"),
            epoch_seconds(o.o_orderdate).alias("created_timestamp"),
            F.lower(F.element_at(F.split(o.o_orderpriority, "-"), 2)).alias("priority_word"),
            o.o_orderkey.alias("order_id"), o.o_custkey.alias("cust_id"),
            F.when(o.o_orderstatus == "P", F.lit("DELETED")).otherwise(F.lit("ACTIVE")).alias("status"))

    @cached_property
    def dashboard_executions(self) -> DataFrame:
        """(dashboard_key, ts, state): one run per line item of the order."""
        li = self.raw("lineitem").select("l_orderkey", "l_shipdate", "l_linestatus")
        d = self.dashboards.select("key", "order_id")
        return li.join(d, li.l_orderkey == d.order_id).select(
            F.col("key").alias("dashboard_key"), epoch_seconds(F.col("l_shipdate")).alias("ts"),
            F.when(F.col("l_linestatus") == "F", F.lit("succeeded")).otherwise(F.lit("failed")).alias("state"))

    @cached_property
    def dashboard_reads(self) -> DataFrame:
        """READ edges (user, dashboard): the ordering customer, once per line."""
        li = self.raw("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("read_count"))
        d = self.dashboards.select("key", "order_id", "cust_id")
        return li.join(d, li.l_orderkey == d.order_id).select(
            user_email(F.col("cust_id")).alias("user_key"), F.col("key").alias("dashboard_key"),
            "read_count")

    @cached_property
    def dashboard_lines(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                         "l_returnflag")
        d = self.dashboards.select("key", "order_id")
        return li.join(d, li.l_orderkey == d.order_id)

    @cached_property
    def dashboard_owners(self) -> DataFrame:
        return self.dashboard_lines.select(F.col("key").alias("resource_key"),
                        user_email(F.col("l_suppkey")).alias("user_key")).distinct()

    @cached_property
    def dashboard_queries(self) -> DataFrame:
        return self.dashboard_lines.select(
            F.col("key").alias("dashboard_key"),
            F.concat(F.lit("query_"), F.col("l_linenumber").cast("string")).alias("name"),
            F.when(F.col("l_returnflag") != "N", F.concat(F.lit("https://q.example.com/"),
                                                         F.col("l_orderkey").cast("string"))).alias("url"),
            F.when(F.col("l_linenumber") == 1, F.concat(F.lit("select * from part_"),
                                                       F.col("l_partkey").cast("string"))).alias("query_text"))

    @cached_property
    def dashboard_charts(self) -> DataFrame:
        x = self.dashboard_lines
        return x.select(F.col("key").alias("dashboard_key"),
                        F.when(F.col("l_returnflag") == "R", F.lit(""))
                        .otherwise(F.concat(F.lit("chart_"), F.col("l_linenumber").cast("string")))
                        .alias("chart_name"))

    @cached_property
    def dashboard_tables(self) -> DataFrame:
        x = self.dashboard_lines
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        return x.join(p, x.l_partkey == p.p_partkey).select(
            F.col("key").alias("dashboard_key"),
            part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("table_key")).distinct()

    # ---------------------------------------------------------- features
    @cached_property
    def features(self) -> DataFrame:
        s = self.raw("supplier")
        group = F.concat(F.lit("fg_"), s.s_nationkey.cast("string"))
        name = F.concat(F.lit("feat_"), s.s_suppkey.cast("string"))
        version = F.concat(F.lit("1."), (s.s_suppkey % 3).cast("string"), F.lit(".0"))
        return s.select(
            F.concat(group, F.lit("/"), name, F.lit("/"), version).alias("key"), name.alias("name"),
            version.alias("version"), group.alias("feature_group"),
            F.when(s.s_suppkey % 2 == 0, F.lit("bigint")).otherwise(F.lit("double")).alias("data_type"),
            F.lit("supplier").alias("entity"),
            F.when(s.s_acctbal < 0, F.lit("deprecated")).otherwise(F.lit("active")).alias("status"),
            F.when(s.s_suppkey % 5 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("balance feature of "), s.s_name)).alias("description"),
            s.s_suppkey.alias("supp_id"), s.s_nationkey.alias("nation_id"))

    @cached_property
    def feature_watermarks(self) -> DataFrame:
        li = self.raw("lineitem").groupBy("l_suppkey").agg(
            F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
        f = self.features.select("key", "supp_id")
        j = li.join(f, li.l_suppkey == f.supp_id)
        lo = j.select(F.col("key").alias("feature_key"),
                      F.concat(F.col("key"), F.lit("/low_watermark")).alias("key"),
                      epoch_seconds(F.col("lo")).alias("time"))
        hi = j.select(F.col("key").alias("feature_key"),
                      F.concat(F.col("key"), F.lit("/high_watermark")).alias("key"),
                      epoch_seconds(F.col("hi")).alias("time"))
        return lo.unionByName(hi)

    @cached_property
    def feature_generation_code(self) -> DataFrame:
        f = self.features
        return f.select(
            f.key.alias("feature_key"),
            F.concat(F.lit("select balance from supplier where s_suppkey = "),
                     f.supp_id.cast("string")).alias("text"),
            F.lit("sql").alias("source"))

    @cached_property
    def feature_databases(self) -> DataFrame:
        f = self.features.select("key", "nation_id")
        n = self.raw("nation")
        return f.join(n, f.nation_id == n.n_nationkey).select(
            F.col("key").alias("feature_key"), F.lower(n.n_name).alias("database"))

    @cached_property
    def feature_owners(self) -> DataFrame:
        f = self.features
        return f.select(f.key.alias("resource_key"), user_email(f.supp_id).alias("user_key"))

    @cached_property
    def feature_tags(self) -> DataFrame:
        f = self.features
        return f.select(f.key.alias("resource_key"), f.data_type.alias("tag"),
                        F.when(f.supp_id % 2 == 0, F.lit("default")).otherwise(F.lit("badge")).alias("tag_type"))

    @cached_property
    def issues(self) -> DataFrame:
        """Data issues: one per line item, severity by line number,
        resolved when the line is finished."""
        li = self.raw("lineitem")
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        return li.join(p, li.l_partkey == p.p_partkey).select(
            part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("table_key"),
            F.concat(F.lit("issue-"), li.l_orderkey.cast("string"), F.lit("-"),
                     li.l_linenumber.cast("string")).alias("issue_key"),
            F.when(li.l_linenumber == 1, "Critical").when(li.l_linenumber == 2, "Major")
            .when(li.l_linenumber == 3, "Minor").otherwise("Trivial").alias("severity"),
            F.when(li.l_linestatus == "F", "resolved").otherwise("open").alias("status"))

    @cached_property
    def reports(self) -> DataFrame:
        """Reports attached to tables: one per line item."""
        li = self.raw("lineitem")
        line = F.concat(li.l_orderkey.cast("string"), F.lit("_"), li.l_linenumber.cast("string"))
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        return li.join(p, li.l_partkey == p.p_partkey).select(
            part_table_key(p.p_brand, p.p_type, p.p_partkey).alias("table_key"),
            F.concat(F.lit("report_"), line).alias("name"),
            F.concat(F.lit("https://reports.example.com/"), line).alias("url"),
            F.when(li.l_linestatus == "O", "DELETED").otherwise("ACTIVE").alias("status"))

    @cached_property
    def change_feed(self) -> DataFrame:
        """Catalog change feed derived from ``events``: seq = event_id, kind
        by event type, every 7th change a delete, every 9th names a resource
        that does not exist."""
        e = self.raw("events")
        p = self.keyed("part").select("p_partkey", "p_brand", "p_type")
        target = e.user_id * 13 + e.event_id % 13
        j = e.join(p, target == p.p_partkey, "left")
        kind = (F.when(e.event_type == "view", "description").when(e.event_type == "click", "tag")
                .when(e.event_type == "purchase", "owner").when(e.event_type == "signup", "follow")
                .otherwise("badge"))
        key = F.when(e.event_id % 9 == 0,
                     F.concat(F.lit("missing://gold.none/part_"), e.event_id.cast("string"))) \
            .when(p.p_partkey.isNotNull(), part_table_key(p.p_brand, p.p_type, p.p_partkey)) \
            .otherwise(F.concat(F.lit("missing://gold.none/part_"), target.cast("string")))
        badge = F.element_at(F.array(*[F.lit(b) for b in BADGE_NAMES]), (e.event_id % 5 + 1).cast("int"))
        value = (F.when(kind == "description", F.concat(F.lit("desc "), e.event_id.cast("string")))
                 .when(kind == "tag", F.concat(F.lit("tag"), (e.event_id % 5).cast("string")))
                 .when(kind == "owner", user_email(e.event_id % 2000))
                 .when(kind == "follow", user_email(e.user_id))
                 .otherwise(badge))
        category = (F.when(kind == "badge", F.when(e.event_id % 5 < 3, F.lit("size"))
                           .otherwise(F.lit("table_status")))
                    .when(kind == "tag", F.when(e.event_id % 11 == 0, F.lit("badge"))
                          .otherwise(F.lit("default"))))
        return j.select(
            e.event_id.alias("seq"),
            F.when(e.event_id % 7 == 0, "delete").otherwise("put").alias("op"),
            F.lit("table").alias("resource_type"), key.alias("resource_key"), kind.alias("kind"),
            value.alias("value"), category.alias("category"), user_email(e.user_id).alias("actor"),
            e.ts.alias("ts"))

    # ------------------------------------------------------- event feeds
    @cached_property
    def action_log(self) -> DataFrame:
        """Action-log records (command, start/end epoch ms, user, ...)."""
        e = self.raw("events")
        start = epoch_millis(e.ts)
        k = F.get_json_object(e.props, "$.k").cast("long")
        return e.select(
            e.event_id.alias("action_id"), e.event_type.alias("command"),
            start.alias("start_epoch_ms"), (start + k * 1000).alias("end_epoch_ms"),
            user_email(e.user_id).alias("user"), F.concat(F.lit("host"), (e.user_id % 4).cast("string")).alias("host"),
            e.props.alias("extra_info"),
            F.when(e.event_type == "error", F.lit("failure")).alias("error"))

    @cached_property
    def sensor_events(self) -> DataFrame:
        """Sensor-event records in the collar feed's shape (epoch-ms as string)."""
        e = self.raw("events")
        return e.select(
            e.user_id.cast("int").alias("pet_id"), e.event_id.cast("string").alias("event_id"),
            e.event_type.alias("event_type"), F.round(e.value).cast("int").alias("event_sentiment"),
            F.get_json_object(e.props, "$.k").cast("int").alias("event_duration"),
            epoch_millis(e.ts).cast("string").alias("event_date_time"))

    @cached_property
    def pet_registry(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(c.c_custkey.cast("int").alias("pet_id"), c.c_name.alias("name"),
                        c.c_mktsegment.alias("species"), user_email(c.c_custkey).alias("owner_email"))


# Badge names used by the derived change feed.
BADGE_NAMES = ["tiny", "medium", "large", "beta", "gold"]

# Fixed column layout given to every derived table (name, type).
COLUMN_LAYOUT = [
    ("partkey", "bigint"),
    ("name", "varchar(55)"),
    ("quantity", "double"),
    ("ship_dates", "array<date>"),
    ("props", "map<string,struct<k:int,v:string>>"),
]
