"""One registered query per operator, over its whole table. Each query gets
its rows through the operator and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.llm import (bpe, decontaminate, licenses, line_dedup, near_dup, packing, quality, resampling, secrets,
                            sharding, spelling, token_store, toxicity)
from catalytics.llm.common import table
from catalytics.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
N_SHARDS = 8


def tokenizer_path() -> str:
    """Path of the public tokenizer file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-token-shards")
    token_store.write_shards(table(spark, sf_dir, "documents"), path, tokenizer_path(), END_ID)
    return token_store.read_documents(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-secret-ledger")
    docs = table(spark, sf_dir, "documents")
    # the ledger meets history: a first batch of about half the texts, then the
    # whole table, of which only the rest is unseen
    secrets.scan_unseen(docs.where(F.crc32(F.coalesce("text", F.lit("")).cast("binary")) < 1 << 31), path)
    found = secrets.scan_versions(docs, path)
    kinds = F.array(*[F.lit(k) for k in secrets.KINDS])
    spans = F.array_join(F.transform("findings", lambda f: F.concat_ws(":", F.get(kinds, f["kind"]), f["start"], f["end"])), ",")

    def found_of(kind: int):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{secrets.KINDS[kind]}")

    n = [found_of(i) for i in range(len(secrets.KINDS))]
    return found.select("doc_id", *n, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_texts(docs, tokenizer_path(), digests=True).select("doc_id", "bpe.*")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"))
    # the key is the text, so copies are neighbours in a shard
    out = sharding.shard_by_bytes(docs, N_SHARDS, key=F.col("text_key"), size=F.col("size"), tie=F.col("doc_id"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_labels(docs, table(spark, sf_dir, "labels"))
    return toxicity.grade_texts(docs, model).select(
        "doc_id", F.col("severity.expected").alias("expected_severity"), "severity.p_toxic",
        "severity.grade", F.col("severity.rejected").alias("toxic"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "llm-pieces")
    packing.write_pieces(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_TOKENIZER),
                         public_tokenizers.PATTERN)
    # the digest is taken where the ids are read, so placing moves no ids
    pieces = packing.read_pieces(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(pieces).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
                                        "ids_crc32", "sequence_id", "offset")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_license_scan, op3_quality_rules, op4_token_store, op5_secret_scan,
                            op6_near_dup, op7_bpe, op8_sharding, op9_toxicity, op10_decontamination,
                            op11_importance_resampling, op12_best_fit_packing, op13_spelling_variants)}
