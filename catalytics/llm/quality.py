"""Quality rules with cross-document line frequency (operator 3).

Base rules judge each text alone. The method then looks across documents:
normalised lines are hashed, the distinct documents (by content, so exact
copies count once) that hold a line are counted per host, lines of more than
``MIN_HOLDERS`` documents are boilerplate and removed, and documents of which
too little remains are rejected. The limit is the same for hosts of every
size, and every line with a word counts.

Defined results: null and empty texts have no words and fail the base rules;
a null host is a host of its own; repeated rows are judged alike; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import persisted

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_HOLDERS = 10
#: No part of a host's documents is added to the limit, and no line is too
#: short to count; the oracle's text reads both.
HOST_SHARE = 0
MIN_LINE_CHARS = 1
#: A document is depleted when less than this share of its words remains.
MIN_REMAINING = 0.3

_SYMBOLS = b"#*$%&|<>"
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    v = len(codes)
    _, pair = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)
    _, back, count = np.unique(pair[:-1] * v + ids[2:], return_inverse=True, return_counts=True)
    again = count[back] > 1
    hit = np.zeros(n, bool)
    hit[:-2] |= again
    hit[1:-1] |= again
    hit[2:] |= again
    return int(hit.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    raw = text.encode()
    words = raw.split()  # bytes.split() parts at ASCII white space alone
    spaces = len(raw) - sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), len(text) - spaces, len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


def line_hashes(text: str) -> list[tuple[int, int]]:
    """(hash, words) of each line with a word."""
    import xxhash

    out = []
    for line in text.encode().split(b"\n"):
        words = line.lower().split()
        key = b" ".join(words)
        if key:
            h = xxhash.xxh3_64_intdigest(key)
            out.append((h - (1 << 64) if h >> 63 else h, len(words)))
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: the id, the base counts, ``base_failed``,
    ``n_removed_lines``, ``remaining_words`` and ``kept``."""
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(host_col).cast("string"), F.lit("\0")).alias("host"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for b in batches:
            base = pd.DataFrame([base_counts(t) for t in b["text"]],
                                columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
            lines = [line_hashes(t) for t in b["text"]]
            base["id"], base["host"] = b["id"].to_numpy(), b["host"].to_numpy()
            base["content"] = [np.int64(np.uint64(xxhash.xxh3_64_intdigest(t.encode())).view(np.int64)) for t in b["text"]]
            base["lines"] = [[{"h": h, "w": w} for h, w in x] for x in lines]
            yield base

    kind = slim.schema["id"].dataType.simpleString()
    table = persisted(slim.mapInPandas(count, f"{BASE}, id {kind}, host string, content long, "
                                              "lines array<struct<h: long, w: int>>"), "quality")
    # distinct (host, line, content), combined per task first; then holders per line
    held = table.select("host", "content", F.explode(F.array_distinct(F.col("lines.h"))).alias("h")).distinct()
    common = held.groupBy("host", "h").agg(F.count(F.lit(1)).alias("holders")) \
        .where(F.col("holders") > MIN_HOLDERS).select("host", "h")
    # documents by content: copies on one host share their verdict
    lost = table.select("host", "content", "lines").dropDuplicates(["host", "content"]) \
        .select("host", "content", F.explode("lines").alias("l")).select("host", "content", "l.h", "l.w") \
        .join(common, ["host", "h"]).groupBy("host", "content") \
        .agg(F.count(F.lit(1)).alias("n_removed_lines"), F.sum("w").alias("lost"))
    remaining = F.col("n_words") - F.coalesce(F.col("lost"), F.lit(0))
    base_failed = (F.col("n_words") < MIN_WORDS) | \
        (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    return table.drop("lines").join(lost, ["host", "content"], "left").select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & (remaining >= MIN_REMAINING * F.col("n_words"))).alias("kept"),
        F.coalesce(F.col("n_removed_lines"), F.lit(0)).alias("n_removed_lines"), remaining.alias("remaining_words"))
