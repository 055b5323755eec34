"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.session import scratch_path

#: ASCII white space, the separators of every contract of this subpackage.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def persisted(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts the
    lineage and lets several consumers share one computation. The files are
    reliable, so a lost executor costs at most its running tasks."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_hot(rows: DataFrame, facts: DataFrame, keys: list[str], n_rows: str, total: int, parts: int) -> DataFrame:
    """Inner join of ``rows`` with ``facts``, which has one row a key with the
    number ``n_rows`` of the key's rows, of ``total`` in all. Keys with more
    than 1 / ``parts`` of all rows are joined where their rows are: there are
    fewer than ``parts`` of them, the bound of what is broadcast. The others
    are joined by a shuffle, in which none of them fills a task."""
    is_hot = F.col(n_rows) * parts > total
    hot = F.broadcast(facts.where(is_hot))
    others = rows.join(F.broadcast(facts.where(is_hot).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(others.join(facts.where(~is_hot), keys))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (no Unicode case mapping)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
