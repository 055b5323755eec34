"""Partition watermarks.

Per table: pick the date format (from a configured, ordered list) that
parses the first parsable active partition name, parse every partition with
it, and report the low (min) and high (max) partition dates. One grouped
pass per table; no per-table driver work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.plans import dealt, spread

# Strptime directives -> Spark datetime pattern letters.
_DIRECTIVES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss",
               "%y": "yy", "%b": "MMM", "%j": "DDD"}
_VARIABLE_WIDTH = {"%m", "%d", "%H", "%M", "%S"}
VALUE_FORMAT = "yyyy-MM-dd HH:mm:ss"


def strptime_to_spark(fmt: str) -> str:
    """'%Y,%m' -> 'yyyy,M'. Like strptime, a month/day/hour... directive
    followed by a literal (or the end) accepts one or two digits; when it is
    directly next to another directive it takes exactly two."""
    out, i, prev_directive = [], 0, False
    while i < len(fmt):
        d = fmt[i:i + 2]
        if d in _DIRECTIVES:
            pat = _DIRECTIVES[d]
            adjacent = prev_directive or fmt[i + 2:i + 3] == "%"
            if d in _VARIABLE_WIDTH and not adjacent:
                pat = pat[0]
            out.append(pat)
            i += 2
            prev_directive = True
            continue
        ch = fmt[i]
        out.append(f"'{ch}'" if ch.isalpha() else ch)
        i += 1
        prev_directive = False
    return "".join(out)


# Strptime directives -> digit/letter shapes used as a cheap
# guard before parsing (a failed parse is costly; a regex test is not).
_SHAPES = {"%Y": r"\d{4}", "%m": r"\d{1,2}", "%d": r"\d{1,2}", "%H": r"\d{1,2}", "%M": r"\d{1,2}",
           "%S": r"\d{1,2}", "%y": r"\d{2}", "%b": r"[A-Za-z]{3}", "%j": r"\d{1,3}"}


def strptime_shape(fmt: str) -> str:
    """Anchored regex a string must match to possibly parse with ``fmt``."""
    import re
    out, i = [], 0
    while i < len(fmt):
        d = fmt[i:i + 2]
        if d in _SHAPES:
            out.append(_SHAPES[d])
            i += 2
            continue
        out.append(re.escape(fmt[i]))
        i += 1
    return "^" + "".join(out) + "$"


def _try_parse(name, fmt: str):
    """try_to_timestamp behind the shape guard."""
    return F.when(name.rlike(strptime_shape(fmt)),
                  F.try_to_timestamp(name, F.lit(strptime_to_spark(fmt))))


def partition_watermarks(partitions: DataFrame, formats: list[str],
                         partition_keys: DataFrame | None = None,
                         include_deleted: bool = True) -> DataFrame:
    """(table_key, watermark_type, partition_key, partition_value,
    create_time) -- a low and a high row per table that has active,
    parsable partitions."""
    if not formats:
        return partitions.sparkSession.createDataFrame(
            [], "table_key string, watermark_type string, partition_key string, "
                "partition_value string, create_time long")
    # One grouped pass: per row the index of the first format that parses
    # it and its value under every format; per table the chosen format is
    # that of the smallest parsable active name, and min/max are kept for
    # every format, the chosen one is picked afterwards (no join back).
    name = F.col("name")
    parsed = [_try_parse(name, f) for f in formats]
    idx = F.lit(None).cast("int")
    for i in reversed(range(len(formats))):
        idx = F.when(parsed[i].isNotNull(), F.lit(i)).otherwise(idx)
    active = F.upper(F.col("status")) == "ACTIVE"
    counted = F.lit(True) if include_deleted else active
    x = partitions.select("table_key", "name", active.alias("_act"), counted.alias("_cnt"),
                          idx.alias("_fi"), *[p.alias(f"_p{i}") for i, p in enumerate(parsed)])
    aggs = [F.min_by("_fi", F.when(F.col("_act") & F.col("_fi").isNotNull(), F.col("name"))).alias("fmt")]
    for i in range(len(formats)):
        aggs.append(F.min(F.when(F.col("_cnt"), F.col(f"_p{i}"))).alias(f"_lo{i}"))
        aggs.append(F.max(F.when(F.col("_cnt"), F.col(f"_p{i}"))).alias(f"_hi{i}"))
    g = x.groupBy("table_key").agg(*aggs).where(F.col("fmt").isNotNull())
    lo = F.lit(None).cast("timestamp")
    hi = F.lit(None).cast("timestamp")
    for i in reversed(range(len(formats))):
        lo = F.when(F.col("fmt") == i, F.col(f"_lo{i}")).otherwise(lo)
        hi = F.when(F.col("fmt") == i, F.col(f"_hi{i}")).otherwise(hi)
    g = g.select("table_key", lo.alias("lo"), hi.alias("hi")).where(F.col("lo").isNotNull())
    if partition_keys is not None:
        pk = dealt(partition_keys, "table_key").groupBy("table_key").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("position", "column"))), lambda x: x["column"]),
            " ").alias("partition_key"))
        g = g.join(spread(pk), "table_key", "left").withColumn(
            "partition_key", F.coalesce("partition_key", F.lit("")))
    else:
        g = g.withColumn("partition_key", F.lit(""))
    rows = F.array(
        F.struct(F.lit("low_watermark").alias("watermark_type"),
                 F.date_format("lo", VALUE_FORMAT).alias("partition_value")),
        F.struct(F.lit("high_watermark").alias("watermark_type"),
                 F.date_format("hi", VALUE_FORMAT).alias("partition_value")))
    return g.select("table_key", "partition_key", F.explode(rows).alias("w")).select(
        "table_key", F.col("w.watermark_type").alias("watermark_type"), "partition_key",
        F.col("w.partition_value").alias("partition_value"), F.lit(0).cast("long").alias("create_time"))


def partition_flag(watermarks: DataFrame, tables: DataFrame) -> DataFrame:
    """Per table: is_partitioned and the key/value of its high watermark."""
    hi = watermarks.where(F.col("watermark_type") == "high_watermark").select(
        "table_key", F.col("partition_key").alias("key"), F.col("partition_value").alias("value"))
    return (tables.select(F.col("key").alias("table_key")).join(hi, "table_key", "left")
            .withColumn("is_partitioned", F.col("value").isNotNull()))
