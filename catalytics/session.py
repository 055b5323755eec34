"""Session helpers: building a session for tests/bench and locating the
shared checkpoint folder."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Used only by a local master whose session names no folder (tests).
_LOCAL_FALLBACK = "/tmp/catalytics-checkpoints"


def build_session(master: str | None = None, app: str = "catalytics",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller's session is
    used as is; nothing here is required by the operators."""
    master = master or os.environ.get("CATALYTICS_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CATALYTICS_DRIVER_MEM", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The session's setting or ``setCheckpointDir`` always wins. Without either
    a local master gets a local folder (tests); a cluster raises, since a
    machine's own folder is not seen by the others."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    return fallback_dir(sc, sc.master)


def fallback_dir(sc, master: str) -> str:
    """The folder set on the context, or a local one for a local master."""
    chosen = sc.getCheckpointDir()
    if chosen is not None:
        return chosen.rsplit("/", 1)[0]  # Spark adds a folder of its own
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(_LOCAL_FALLBACK)
    return _LOCAL_FALLBACK


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir, for written
    intermediate tables, stream checkpoints and snapshot versions."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/catalytics/{name}-{uuid.uuid4().hex}"
