"""Secret scans with an incremental blob ledger (operator 5).

Every historical version of a file is a blob, addressed by the SHA-256 of its
text. The ledger (a Parquet table in shared storage) holds one row for each
(blob, rule version) pair that was ever scanned, with its findings. A run
scans only blobs without a row for the current rule version, each once
however many paths hold it, appends them, and joins the ledger's findings
back to all paths. A rule change is a new version, hence a new scan. A blob of
more than 1 / ``HOT_PARTS`` of all paths meets its findings without a shuffle.

Defined results: null texts are the empty blob; equal texts share one scan
and all get its findings; a path that occurs twice is reported twice; extra
columns are not read; null ids are paths like any other; texts of any length
are scanned whole; an empty table appends an empty batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.llm.common import join_hot, persisted

# Kinds in listed order, their patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs are maximal, so shorter ones just fail
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex"]
MIN_VALUE = 6
RULES = "1"
HOT_PARTS = 8192

LEDGER_SCHEMA = "blob string, findings array<struct<kind: int, start: int, end: int>>, rule_version string"


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of all secrets, by start, then kind. Offsets
    are code points, the end exclusive."""
    out = []
    if ":" in text or "=" in text:
        # short values still consume their text, so they are dropped afterwards
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda f: (f[1], f[0]))


def ledger(spark: SparkSession, path: str, rules: str) -> DataFrame | None:
    """The ledger's rows for one rule version; None before the first run."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path).where(F.col("rule_version") == rules)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan_unseen(docs: DataFrame, ledger_path: str, text_col: str = "text", rules: str = RULES) -> None:
    """Scan the blobs of ``docs`` that the ledger at ``ledger_path`` lacks for
    these rules, and append them to it."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    # partial aggregation keeps one row per task of a text with many copies,
    # before the blobs meet the ledger
    unseen = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    seen = ledger(spark, ledger_path, rules)
    if seen is not None:
        unseen = unseen.join(seen.select("blob"), "blob", "left_anti")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t)] for t in b["text"]]
            yield pd.DataFrame({"blob": b["blob"], "findings": found, "rule_version": rules})

    unseen.mapInPandas(scan, LEDGER_SCHEMA).write.mode("append").partitionBy("rule_version").parquet(ledger_path)


def scan_versions(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text",
                  rules: str = RULES, hot_parts: int = HOT_PARTS) -> DataFrame:
    """Scan the unseen blobs of ``docs``, append them to the ledger at
    ``ledger_path`` and return one row per path: the id, ``blob`` and
    ``findings`` (array of kind index, start, end)."""
    spark = docs.sparkSession
    scan_unseen(docs, ledger_path, text_col, rules)
    blob = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob")
    paths = persisted(docs.select(F.col(id_col), blob), "secret-paths")
    # two runs at once may both have put a pair in: equal findings, one row
    known = ledger(spark, ledger_path, rules).select("blob", "findings").dropDuplicates(["blob"])
    copies = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("__copies"))
    facts = persisted(known.join(copies, "blob"), "secret-findings")
    return join_hot(paths, facts, ["blob"], "__copies", paths.count(), hot_parts).drop("__copies")
