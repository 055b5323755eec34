"""Target-distribution importance resampling (operator 11).

Word n-grams are hashed to buckets; a bucket's gain is the log ratio of its
smoothed share in the target texts to its share in the corpus. A document
weighs the mean gain of its features, and adding Gumbel noise that is a pure
function of the id turns "take the highest scores" into sampling without
replacement in proportion to the weights.

Inside a task a batch's texts are joined with a sentinel byte and one regex
pass finds the words and sentinels of all of them. The sentinels' places are
the document offsets: ``searchsorted`` over them gives each word its document,
which masks the n-grams that would cross from one document to the next, and
``bincount`` sums buckets or gains. The bucket of an n-gram continues the crc32
of its first n-1 words, so no n-gram is ever built as a string.

Two passes read the corpus. The first ships at most ``buckets`` counts from
each task; the gains (one number a bucket, whatever the corpus) go out with
the second. Ranks need no global sort: scores are whole thousandths, so the
documents before each score are a running sum over the distinct scores (some
10^5 at most: a gain is within 1000 ln of the count range, the noise within
-3,130 and 22,900), and rows are numbered only within one score.

Defined results: null and empty texts have no features and weight 0; a text of
any length is read whole, in pieces; rows that repeat an id are scored each
by its own text and ranked one after the other; a null id is hashed as the
empty string and comes last among ties; an empty corpus gives no rows, an empty
target gives every bucket the target count 0; other columns of the input are
not read."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalytics.llm.common import persisted
from catalytics.llm.text_batches import ASCII_LOWER, cut, grouped

#: Ends a document in a joined batch; the byte itself becomes a space in texts.
END = b"\x00"
_FOLD = bytes([0x20]) + ASCII_LOWER[1:]
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_WORD_OR_END = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")
_GAP = re.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]")


def _pieces(texts: list[bytes | None], max_n: int) -> Iterator[tuple[bytes, int, int]]:
    """(folded bytes, row, words led in) of bounded size. A later piece of a
    long text starts with the ``max_n - 1`` words before it, whose own
    features count in the piece before."""
    for row, text in enumerate(texts):
        lead: list[bytes] = []
        for piece in cut((text or b"").translate(_FOLD), _GAP):
            yield b" ".join([*lead, piece]), row, len(lead)
            if max_n > 1:
                lead = (lead + _WORD.findall(piece))[1 - max_n:]


def features(texts: list[bytes | None], n_buckets: int, max_n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each joined batch: the row of every feature, its bucket, and the
    row of every word (features of one word, led-in ones left out)."""
    for batch in grouped(_pieces(texts, max_n)):
        tokens = _WORD_OR_END.findall(END.join([p for p, _, _ in batch]) + END)
        ends = np.empty(len(batch), np.int64)
        at = -1
        for i in range(len(batch)):
            at = tokens.index(END, at + 1)
            ends[i] = at
        place = np.arange(len(tokens))
        piece = np.searchsorted(ends, place)
        row = np.array([r for _, r, _ in batch], np.int64)[piece]
        word = np.ones(len(tokens), bool)
        word[ends] = False
        starts = np.concatenate([[0], ends[:-1] + 1])
        new = word & (place - starts[piece] >= np.array([k for _, _, k in batch], np.int64)[piece])
        rows, buckets = [row[new]], []
        hashes = list(map(crc32, tokens))
        buckets.append(np.array(hashes, np.int64)[new] % n_buckets)
        for n in range(2, max_n + 1):  # position i: the n words from i on
            hashes = list(map(crc32, tokens[n - 1:], map(crc32, repeat(b" "), hashes)))
            if not hashes:
                break
            whole = new[n - 1:] & (piece[n - 1:] == piece[:1 - n])
            rows.append(row[n - 1:][whole])
            buckets.append(np.array(hashes, np.int64)[whole] % n_buckets)
        yield np.concatenate(rows), np.concatenate(buckets), rows[0]


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").to_pylist()


def bucket_counts(docs: DataFrame, text_col: str = "text", n_buckets: int = 10_000, max_n: int = 2) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for b in batches:
            for _, buckets, _ in features(_texts(b), n_buckets, max_n):
                total += np.bincount(buckets, minlength=n_buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["bucket", "n"])

    parts = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, n_buckets: int = 10_000) -> np.ndarray:
    """floor(1000 ln(share in target / share in corpus)) of each bucket, with
    one added to every count. Collects at most ``n_buckets`` counts of each."""
    s, t = np.zeros(n_buckets, np.int64), np.zeros(n_buckets, np.int64)
    for counts, out in ((corpus, s), (target, t)):
        for r in counts.collect():
            out[r["bucket"]] = r["n"]
    over, under = float(s.sum() + n_buckets), float(t.sum() + n_buckets)
    return np.array([math.floor(1000 * math.log(float(b + 1) * over / (float(a + 1) * under)))
                     for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = 2) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            words, found, sums = (np.zeros(n, np.int64) for _ in range(3))
            for row, bucket, word_row in features(_texts(b), len(gains), max_n):
                words += np.bincount(word_row, minlength=n)
                found += np.bincount(row, minlength=n)
                # whole numbers below 2^53: exact in doubles
                sums += np.bincount(row, weights=gains[bucket], minlength=n).astype(np.int64)
            weight = np.where(found > 0, sums // np.maximum(found, 1), 0)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (words, found, weight))],
                                             ["id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(rows, f"id {kind}, n_words long, n_features long, weight long") \
        .withColumnRenamed("id", id_col)


def with_scores(weighed: DataFrame, id_col: str = "doc_id", seed: int = 7) -> DataFrame:
    """Adds ``score``: weight plus Gumbel noise, in thousandths, from the
    first 32 bits of the sha256 of ``<seed>:<id>``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weighed.withColumn("score", (F.col("weight") + noise).cast("long"))


def draw(scored: DataFrame, percent: int, min_words: int, id_col: str = "doc_id") -> DataFrame:
    """Adds ``rank``: 1, 2, ... for the ``floor(percent / 100 * N)`` highest
    scores of the N rows with at least ``min_words`` words, ties to the
    smaller id; null for all others."""
    able = F.col("n_words") >= min_words
    # one row a distinct score: bounded by the range of scores
    steps = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("__n"))
    high_first = Window.orderBy(F.desc("score"))
    steps = steps.select("score", F.sum("__n").over(high_first.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
                         F.sum("__n").over(Window.orderBy(F.lit(0)).rowsBetween(
                             Window.unboundedPreceding, Window.unboundedFollowing)).alias("__total"))
    steps = steps.select("score", F.coalesce("__before", F.lit(0)).alias("__before"),
                         F.floor(F.col("__total") * percent / 100).alias("__drawn"))
    inside = F.row_number().over(Window.partitionBy("score").orderBy(F.asc_nulls_last(id_col)))
    rank = F.col("__before") + inside
    ranked = scored.where(able).join(steps, "score").withColumn("rank", rank) \
        .withColumn("rank", F.when(F.col("rank") <= F.col("__drawn"), F.col("rank")).cast("long"))
    columns = [*scored.columns, "rank"]
    return ranked.select(columns).unionByName(
        scored.where(~able).withColumn("rank", F.lit(None).cast("long")).select(columns))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, n_buckets: int = 10_000,
             max_n: int = 2, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features, weight, score and
    rank (null when not drawn). The scores are written to the shared folder
    once, as the ranks need them twice."""
    gains = bucket_gains(bucket_counts(docs, text_col, n_buckets, max_n), bucket_counts(target, target_col, n_buckets, max_n),
                         n_buckets)
    scored = with_scores(weigh(docs, gains, id_col, text_col, max_n), id_col, seed)
    return draw(persisted(scored, "resample-scores"), percent, min_words, id_col)
