"""Column profiling and column-level display rules.

``column_profile`` produces the stat rows a catalog shows for a table's
columns with two column-pruned global aggregates (partial aggregation on
every task), turned into long form with ``stack``. Exact distinct counts are the default for
checking; ``exact=False`` switches to HyperLogLog++ sketches, which is what
a 100 TB profile should use."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalytics.functions.keys import is_nested_type, top_level_type
from catalytics.plans import spread

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_ORDERED = _NUMERIC + (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def column_profile(df: DataFrame, columns: list[str] | None = None, exact: bool = True,
                   ts_col: str | None = None) -> DataFrame:
    """Long-form stats (column_name, stat_type, stat_val STRING[, start/end
    epoch]): row_count, null_count, distinct_count, min, max (ordered
    types), avg (numeric, rounded to 6).

    Two scans with column pruning: one global aggregate for the plain stats
    and one for the distinct counts. (Mixing many distinct and plain
    aggregates in one ``agg`` makes Spark carry every plain aggregate
    through the distinct Expand, which is several times slower.)"""
    cols = columns or df.columns
    plain, dist_aggs, names, dnames = [], [], [], []
    dist = (F.countDistinct if exact else F.approx_count_distinct)
    for c in cols:
        dt = df.schema[c].dataType
        plain.append(F.count_if(F.col(c).isNull()).cast("string").alias(f"{c}__null_count"))
        names.append((c, "null_count"))
        dist_aggs.append(dist(F.col(c)).cast("string").alias(f"{c}__distinct_count"))
        dnames.append((c, "distinct_count"))
        if isinstance(dt, _ORDERED):
            plain.append(F.min(c).cast("string").alias(f"{c}__min"))
            plain.append(F.max(c).cast("string").alias(f"{c}__max"))
            names += [(c, "min"), (c, "max")]
        if isinstance(dt, _NUMERIC):
            plain.append(F.round(F.avg(F.col(c).cast("double")), 6).cast("string").alias(f"{c}__avg"))
            names.append((c, "avg"))
    plain.append(F.count(F.lit(1)).cast("string").alias("__row_count"))
    extra = []
    if ts_col:
        plain.append(F.unix_timestamp(F.min(ts_col)).alias("start_epoch"))
        plain.append(F.unix_timestamp(F.max(ts_col)).alias("end_epoch"))
        extra = ["start_epoch", "end_epoch"]
    one = df.agg(*plain)
    two = df.agg(*dist_aggs)

    def stack(frame, ns, keep):
        pairs = ", ".join(f"'{c}', '{s_}', `{c}__{s_}`" for c, s_ in ns)
        return frame.selectExpr(*keep, f"stack({len(ns)}, {pairs}) AS (column_name, stat_type, stat_val)")
    out = stack(one, names, extra).unionByName(
        one.selectExpr(*extra, "'*' AS column_name", "'row_count' AS stat_type", "__row_count AS stat_val"))
    d = stack(two, dnames, [])
    if extra:
        d = d.select("*", *[F.lit(None).cast("long").alias(x) for x in extra])
    return out.unionByName(d)


def column_value_counts(df: DataFrame, share: float = 0.02, columns: list[str] | None = None,
                        ts_col: str | None = None) -> DataFrame:
    """(column_name, value STRING, n[, start_epoch, end_epoch]): every value
    that at least ``share`` of the rows have, with its exact number of rows;
    nulls are not counted as a value.

    Two passes over the scan and no row per (row, column). The first keeps a
    frequent-items sketch of each column; with its many tracked items the
    estimate is off by far less than ``share``, so every such value is among
    the few candidates that come back. The second counts those exactly."""
    cols = columns or df.columns
    text = [F.col(c).cast("string").alias(c) for c in cols]
    tracked = max(10_000, int(200 / share))
    sketches = [F.expr(f"approx_top_k(`{c}`, {int(2 / share)}, {tracked})").alias(c) for c in cols]
    epochs = [F.unix_timestamp(F.min("__ts")).alias("lo"), F.unix_timestamp(F.max("__ts")).alias("hi")] if ts_col else []
    rows = df.select(*text, *([F.col(ts_col).alias("__ts")] if ts_col else []))
    found = rows.agg(F.count(F.lit(1)).alias("__n"), *epochs, *sketches).first()
    least = share * found["__n"]
    candidates = {c: [x["item"] for x in found[c] or [] if x["item"] is not None and x["count"] >= least / 2] for c in cols}
    pairs = [F.when(F.col(c).isin(vs), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
             for c, vs in candidates.items() if vs]
    if not pairs:
        out = rows.sparkSession.createDataFrame([], "column_name string, value string, n long")
    else:
        one = rows.select(F.explode(F.array_compact(F.array(*pairs))).alias("p"))
        out = one.groupBy("p.column_name", "p.value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    if ts_col:
        out = out.select("*", F.lit(found["lo"]).cast("long").alias("start_epoch"), F.lit(found["hi"]).cast("long").alias("end_epoch"))
    return out


def parse_unique_values(stat_val) -> F.Column:
    """Python-repr dict text "{'a': 1}" -> map<string,long>."""
    return F.from_json(F.replace(stat_val, F.lit("'"), F.lit('"')), "map<string,long>")


def unique_values_summary(stats: DataFrame, n: int = 5) -> DataFrame:
    """Top n values of every ``unique_values`` stat (count desc, value asc)."""
    u = stats.where(F.col("stat_type") == "unique_values").select(
        "column_key", F.explode(parse_unique_values(F.col("stat_val"))).alias("value", "count"))
    w = Window.partitionBy("column_key").orderBy(F.desc("count"), F.asc("value"))
    return u.withColumn("position", F.row_number().over(w).cast("long")).where(F.col("position") <= n)


def column_usage(columns: DataFrame, stats: DataFrame) -> DataFrame:
    """usage = the column_usage stat as a number, NULL when absent."""
    u = stats.where(F.col("stat_type") == "column_usage").groupBy(
        F.col("column_key").alias("key")).agg(F.max(F.col("stat_val").cast("double")).alias("usage"))
    return columns.select("key", "table_key", "name").join(u, "key", "left")


def column_order(columns: DataFrame, by: str = "sort_order", usage: DataFrame | None = None) -> DataFrame:
    """Position of each column in its table: by sort_order (missing = 9999),
    by name, or by usage descending."""
    if by == "sort_order":
        order = [F.coalesce(F.col("sort_order"), F.lit(9999)), F.col("name")]
    elif by == "name":
        order = [F.col("name")]
    elif by == "usage":
        columns = columns.join(usage.select("key", "usage"), "key", "left")
        order = [F.desc_nulls_last("usage"), F.col("name")]
    else:
        raise ValueError(by)
    w = Window.partitionBy("table_key").orderBy(*order)
    return columns.withColumn("position", F.row_number().over(w).cast("long"))


def column_type_census(columns: DataFrame, tables: DataFrame, dialect: str = "hive") -> DataFrame:
    """Columns per database x top-level type x nested flag."""
    c = columns.join(spread(tables.select(F.col("key").alias("table_key"), "database")), "table_key")
    return (c.groupBy("database", top_level_type(F.col("col_type")).alias("type_name"),
                      is_nested_type(F.col("col_type"), dialect).alias("is_nested"))
            .agg(F.count(F.lit(1)).alias("n_columns")))


def description_layout(prog_desc: DataFrame, config: dict) -> DataFrame:
    """Split programmatic descriptions into left / right / other by config
    and order each side by display_order (missing = size of that side's
    config), then by source. ``config`` = {'LEFT': {src: {'display_order':
    i}}, 'RIGHT': {...}, src: {...} (other)}."""
    left = config.get("LEFT", {})
    right = config.get("RIGHT", {})
    other = {k: v for k, v in config.items() if k not in ("LEFT", "RIGHT")}
    src = F.col("source")
    side = (F.when(src.isin(list(left)) if left else F.lit(False), "left")
            .when(src.isin(list(right)) if right else F.lit(False), "right").otherwise("other"))

    def order_of(cfg: dict):
        e = F.lit(len(cfg))
        for k, v in cfg.items():
            if "display_order" in v:
                e = F.when(src == k, F.lit(v["display_order"])).otherwise(e)
        return e
    order = (F.when(F.col("side") == "left", order_of(left))
             .when(F.col("side") == "right", order_of(right)).otherwise(order_of(other)))
    x = prog_desc.withColumn("side", side).withColumn("display_order", order)
    w = Window.partitionBy("resource_key", "side").orderBy("display_order", "source")
    return x.withColumn("position", F.row_number().over(w).cast("long"))
