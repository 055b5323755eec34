"""Catalog state kept by hash buckets, for change feeds applied per
micro-batch.

A state is a folder of versions. Version ``v=<id>`` holds, under ``data``, the
new rows of the buckets that one batch touched and, under ``touched``, the list
of those buckets; the list is a single small file written last, so it commits
the version. A bucket's current rows are those of the highest committed version
that touched it. So a batch of k keys writes k buckets at most, ids need not be
consecutive, a batch that is run again finds its version and changes nothing,
and one that failed half way is written again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from catalytics.operators import changes as C

_MANIFEST = "version long, bucket int, n_rows long"


class BucketedState:
    """Rows of one kind, dealt into ``buckets`` by the hash of ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "resource_key", buckets: int = 32):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.hash(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def manifest(self) -> DataFrame:
        """(version, bucket, n_rows) of all committed versions."""
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/*/touched")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _MANIFEST)

    def has(self, version: int) -> bool:
        return not self.manifest().where(F.col("version") == version).isEmpty()

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The current rows, of some buckets or of all. Collects one row a
        bucket and opens only the files of the versions that are current."""
        last = self.manifest().groupBy("bucket").agg(F.max(F.struct("version", "n_rows")).alias("m"))
        if buckets is not None:
            last = last.where(F.col("bucket").isin(buckets))
        paths = [f"{self.path}/v={r['m']['version']}/data/bucket={r['bucket']}" for r in last.collect() if r["m"]["n_rows"]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def commit(self, version: int, buckets: list[int], rows: DataFrame) -> None:
        """Write ``rows``, all that the named buckets now hold."""
        data = f"{self.path}/v={version}/data"
        rows.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
        named = self.spark.createDataFrame([(b,) for b in buckets], "bucket int")
        with_bucket = StructType([*self.schema.fields, StructField("bucket", IntegerType())])
        stored = self.spark.read.schema(with_bucket).parquet(data).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        named.join(stored, "bucket", "left").select(
            F.lit(version).cast("long").alias("version"), "bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n_rows")) \
            .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/v={version}/touched")

    def start(self, rows: DataFrame) -> "BucketedState":
        """Version -1: every bucket, from an existing frame."""
        if not self.has(-1):
            self.commit(-1, list(range(self.buckets)), rows)
        return self

    def apply(self, batch_id: int, batch: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace the buckets that ``batch`` names by ``step(their rows,
        batch)``; the number of buckets written, 0 if the batch is known."""
        if self.has(batch_id):
            return 0
        touched = [r["b"] for r in batch.select(self.bucket().alias("b")).distinct().collect()]
        if touched:
            self.commit(batch_id, touched, step(self.read(touched), batch))
        return len(touched)


#: Kinds of catalog state: what a change of that kind applies to.
EDGE_SCHEMAS = {
    "description": "resource_key string, description string",
    "owner": "resource_key string, user_key string",
    "tag": "resource_key string, tag string, tag_type string",
    "badge": "resource_key string, badge_name string, category string",
    "follow": "user_key string, resource_key string",
}


class CatalogState:
    """Descriptions, owners, tags, badges and follow edges, each a
    ``BucketedState`` under one folder."""

    def __init__(self, spark: SparkSession, path: str, resources: DataFrame, whitelist: DataFrame,
                 badge_names: list[str], buckets: int = 32, kinds: list[str] | None = None):
        self.resources, self.whitelist, self.badge_names = resources.select("key"), whitelist, badge_names
        self.users = spark.createDataFrame([], "email string")
        self.kinds = {k: BucketedState(spark, f"{path.rstrip('/')}/{k}", StructType.fromDDL(s), buckets=buckets)
                      for k, s in EDGE_SCHEMAS.items() if kinds is None or k in kinds}

    def start(self, **frames: DataFrame) -> "CatalogState":
        for kind, state in self.kinds.items():
            state.start(frames[kind].select(*state.schema.names))
        return self

    def _step(self, kind: str, rows: DataFrame, batch: DataFrame) -> DataFrame:
        if kind == "description":
            return C.apply_descriptions(rows, batch, self.resources)[0]
        if kind == "owner":
            return C.apply_owners(rows, self.users, batch, self.resources)[0]
        if kind == "tag":
            nodes = rows.select("tag", "tag_type").limit(0)
            return C.apply_tags(rows, nodes, batch, self.resources, self.badge_names)[0]
        if kind == "badge":
            return C.apply_badges(rows, batch, self.resources, self.whitelist)[0]
        return C.apply_user_relations(rows, self.users, batch, self.resources, kind)[0]

    def apply(self, batch_id: int, batch: DataFrame) -> dict[str, int]:
        """Apply one micro-batch; buckets written by kind."""
        return {kind: state.apply(batch_id, batch.where(F.col("kind") == kind),
                                  lambda rows, ch, kind=kind: self._step(kind, rows, ch).select(*state.schema.names))
                for kind, state in self.kinds.items()}

    def read(self, kind: str) -> DataFrame:
        return self.kinds[kind].read()


def stream_into(state: CatalogState, changes: DataFrame, checkpoint: str) -> StreamingQuery:
    """Apply a streaming change feed, whatever has arrived, micro-batch by
    micro-batch."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        state.apply(batch_id, batch)
        batch.unpersist()

    q = (changes.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(on_batch).start())
    q.awaitTermination()
    return q
