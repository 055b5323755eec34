"""Training-corpus pipeline: each stage works on the documents that the one
before kept, and its decisions take effect.

1. ``toxicity`` drops documents that the severity model rejects.
2. ``line_dedup`` removes repeated lines; every document stays, shorter.
3. ``near_dup`` keeps the smallest id of each near-duplicate class.
4. ``decontamination`` drops documents with a benchmark window.
5. ``bpe`` encodes what is left and returns token counts and digests.

All stages but the last return the columns of ``documents``. Null texts count
as empty; an empty table passes through every stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.llm import bpe, decontaminate, line_dedup, near_dup, toxicity
from catalytics.llm.common import persisted, table
from catalytics.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labels of documents present,
    doesn't reject."""
    model = toxicity.fit_labels(docs, table(spark, sf_dir, "labels"))
    graded = toxicity.grade_texts(docs, model, out="__severity")
    return graded.where(~F.col("__severity.rejected")).drop("__severity")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; repeated lines stay only in the largest id that holds
    them. ``n_chars`` follows the text; a null text stays null."""
    out = line_dedup.dedup_lines(docs, out="__lines")
    changed = F.col("__lines.n_dropped") > 0
    text = F.when(changed, F.col("__lines.kept")).otherwise(F.col("text"))
    n_chars = F.when(changed, F.length("__lines.kept")).otherwise(F.col("n_chars"))
    kind = docs.schema["n_chars"].dataType
    return out.withColumns({"text": text, "n_chars": n_chars.cast(kind)}).select(*docs.columns)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class. Rows
    without an id are in no class and stay."""
    classes = near_dup.near_duplicates(docs)
    others = classes.where(F.col("doc_id") != F.col("class_id")).select("doc_id")
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any benchmark window, each judged by its own text."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("__doc"))
    found = decontaminate.find_items(rows, table(spark, sf_dir, "benchmark"))
    return found.where(F.col("n_hit") == 0).select("__doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoding."""
    out = bpe.encode_texts(docs.select("doc_id", "text"), tokenizer_path(), digests=True)
    return out.select("doc_id", "bpe.*")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dup", keep_one_of_each_class),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The near-duplicate and the severity stage have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = persisted(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
