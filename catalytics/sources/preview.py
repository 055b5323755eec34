"""Preview, catalog scan and versioned snapshot publishing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_preview(df: DataFrame, n: int, order_by: list, select_exprs: list[str] | None = None,
                  where: str | Column | None = None) -> DataFrame:
    """First n rows (by a deterministic order) with an optional select list
    (projection / masking) and filter. The limit is the feature here; Spark
    plans it as TakeOrderedAndProject (per-task top n, then merge)."""
    out = df
    if where is not None:
        out = out.where(where)
    out = out.orderBy(*order_by).limit(n)
    if select_exprs:
        out = out.selectExpr(*select_exprs)
    return out


def preview_allowed(tables: DataFrame, allowed_clusters: list[str] | None,
                    rows_by_database: dict[str, int] | None = None, default_rows: int = 50) -> DataFrame:
    """Per table: whether a preview may be shown (cluster in the allow-list;
    no list = everything) and how many rows the preview source returns
    (per database, else the default)."""
    ok = F.col("cluster").isin(allowed_clusters) if allowed_clusters else F.lit(True)
    n = F.lit(default_rows)
    for db, k in (rows_by_database or {}).items():
        n = F.when(F.col("database") == db, F.lit(k)).otherwise(n)
    return tables.select("key", "database", "cluster", ok.alias("previewable"),
                         F.when(ok, n).alias("preview_rows"))


def preview_columns(df: DataFrame) -> DataFrame:
    """(position, column_name, column_type) of a preview."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, column_type string")


def _leaves(schema: T.StructType, prefix: str = ""):
    for f in schema.fields:
        name = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, name + ".")
        else:
            yield name


def preview_flatten(df: DataFrame) -> DataFrame:
    """Nested struct columns -> dotted leaf columns (recursively)."""
    return df.select(*[F.col(".".join(f"`{p}`" for p in leaf.split("."))).alias(leaf)
                       for leaf in _leaves(df.schema)])


def catalog_scan(spark: SparkSession, path: str, frames: list[str]) -> dict[str, DataFrame]:
    """Load catalog node/edge frames stored as parquet folders (one per
    frame under ``path``)."""
    return {f: spark.read.parquet(f"{path.rstrip('/')}/{f}") for f in frames}


def write_catalog(frames: dict[str, DataFrame], path: str) -> None:
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def write_edges(frames: dict[str, DataFrame], path: str) -> None:
    """Edge frames (label -> frame with ``src``, ``dst`` and properties) as one
    table partitioned by label; properties that a label lacks are null."""
    rows = None
    for label, df in frames.items():
        part = df.withColumn("label", F.lit(label))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    rows.write.mode("overwrite").partitionBy("label").parquet(path.rstrip("/"))


def scan_edges(spark: SparkSession, path: str, labels: list[str] | None = None) -> DataFrame:
    """Edges of some labels, or of all; other labels' folders are not opened."""
    df = spark.read.parquet(path.rstrip("/"))
    return df.where(F.col("label").isin(labels)) if labels else df


def index_snapshot_publish(docs: DataFrame, path: str, version: int, partitions: int | None = None) -> str:
    """Write a new version of the search-document table and commit it by its
    marker, a one-row table written last under ``done``. Readers take the
    highest version that has a marker, so a publish that fails at any point
    leaves the old version readable; nothing is ever overwritten. A version
    that is already committed can't be published again."""
    spark = docs.sparkSession
    root = path.rstrip("/")
    if version in _committed(spark, root):
        raise ValueError(f"version {version} is already published")
    vdir = f"{root}/v={version}"
    out = docs.repartition(partitions) if partitions else docs
    out.write.mode("overwrite").parquet(vdir)
    spark.createDataFrame([(version, vdir)], _MARKER).coalesce(1).write.mode("overwrite").parquet(f"{root}/done/v={version}")
    return vdir


_MARKER = "version long, location string"


def _committed(spark: SparkSession, root: str) -> dict[int, str]:
    """Committed versions and where they are (one row a version)."""
    try:
        return {r["version"]: r["location"] for r in spark.read.schema(_MARKER).parquet(f"{root}/done/*").collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def read_current_snapshot(spark: SparkSession, path: str) -> DataFrame:
    done = _committed(spark, path.rstrip("/"))
    if not done:
        raise ValueError(f"no version is published under {path}")
    return spark.read.parquet(done[max(done)])
