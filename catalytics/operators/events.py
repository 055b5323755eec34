"""Sensor-event product (batch): enjoyment per pet and activity.

Formula (our choice; the product is only described): per pet x activity
(x day): event count, total duration, mean sentiment and duration-weighted
sentiment sum(sentiment * duration) / sum(duration); the favourite activity
is rank 1 by weighted sentiment (then count, then name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_event_time(events: DataFrame) -> DataFrame:
    """epoch-millis string -> event_ts timestamp."""
    return events.withColumn("event_ts", F.timestamp_millis(F.col("event_date_time").cast("long")))


def event_enjoyment(events: DataFrame, by_day: bool = False) -> DataFrame:
    e = with_event_time(events) if "event_ts" not in events.columns else events
    keys = ["pet_id", "event_type"] + (["day"] if by_day else [])
    if by_day:
        e = e.withColumn("day", F.to_date("event_ts"))
    dur = F.col("event_duration").cast("double")
    g = e.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_duration").cast("long").alias("duration"),
        F.round(F.avg("event_sentiment"), 6).alias("mean_sentiment"),
        F.round(F.try_divide(F.sum(F.col("event_sentiment") * dur), F.sum(dur)), 6).alias("weighted_sentiment"))
    part = ["pet_id"] + (["day"] if by_day else [])
    w = Window.partitionBy(*part).orderBy(F.desc_nulls_last("weighted_sentiment"), F.desc("n"),
                                          F.asc_nulls_last("event_type"))
    return g.withColumn("rank", F.rank().over(w).cast("long"))
