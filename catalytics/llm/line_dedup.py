"""Line dedup with two Bloom filters (operator 1).

A line repeats when its key (white space stripped, A-Z lower-cased) is long
enough and occurs in enough documents; all its copies go except those in the
largest document id. Steps:

1. Each task hashes its lines to 128-bit keys, written once per document.
2. Each task fills two Bloom filters, *once* and *twice*, for keys seen in
   one and in two or more of its documents. Filters merge per chunk of bits
   with ``twice = t1 | t2 | (o1 & o2)``, ``once = o1 | o2``; a key of two
   documents is always in ``twice``.
3. Only keys in ``twice`` are shuffled and counted exactly, by (key, id)
   first, so a line of a third of all documents fills no task. Keys that lose
   lines are joined back to the documents; those with more than 1 /
   ``HOT_PARTS`` of all suspects without a shuffle.

The filters' size follows the number of lines up to ``MAX_BLOOM_BITS``, the
bound of what is broadcast; beyond it more lines are counted exactly, with
the same result.

Defined results: null and empty texts are one empty line, kept; a document is
an id, so rows that repeat it count once for a line, and rows that share the
largest id of a line all keep it; rows with a null id don't count and keep all
their lines; texts of any length are read whole; an empty table has an empty
result; other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import join_hot, persisted

MIN_CHARS = 20
MIN_DOCS = 3
MAX_BLOOM_BITS = 1 << 28
BITS_PER_LINE = 16
CHUNK_BITS = 1 << 18
HASHES = 3
HOT_PARTS = 65_536


def line_keys(text: str, min_chars: int) -> tuple[list[bytes], list[int]]:
    """128-bit keys of the lines with long enough keys, and their positions."""
    import xxhash

    keys, at = [], []
    for i, line in enumerate(text.encode().split(b"\n")):
        # bytes.strip/lower work on ASCII white space and A-Z alone
        k = line.strip().lower()
        if len(k) >= min_chars and (k.isascii() or len(k.decode()) >= min_chars):
            keys.append(xxhash.xxh3_128_digest(k))
            at.append(i)
    return keys, at


def _positions(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bit positions of each key (rows of two 64-bit halves) per hash."""
    for h in range(HASHES):
        yield ((keys[:, 0] + np.uint64(h) * (keys[:, 1] | np.uint64(1))) & np.uint64(bits - 1)).astype(np.int64)


def _holds(bloom: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    ok = np.ones(len(keys), bool)
    for p in _positions(keys, bits):
        ok &= (bloom[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
    return ok


def _add(bloom: np.ndarray, keys: np.ndarray, bits: int) -> None:
    for p in _positions(keys, bits):
        np.bitwise_or.at(bloom, p >> 3, np.left_shift(1, p & 7).astype(np.uint8))


def _as_keys(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


def twice_filter(keyed: DataFrame, bits: int) -> bytes:
    """The merged filter of keys seen in two or more documents; ``bits`` / 8
    bytes, whatever the input."""

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for b in batches:
            if not (raw := b"".join(b["keys"])):
                continue
            keys, n = np.unique(_as_keys(raw), axis=0, return_counts=True)
            again = (n > 1) | _holds(once, keys, bits)
            _add(twice, keys[again], bits)
            _add(once, keys, bits)
        step = CHUNK_BITS // 8
        for c in range(bits // CHUNK_BITS):
            o, t = once[c * step:(c + 1) * step], twice[c * step:(c + 1) * step]
            if o.any():
                yield pd.DataFrame({"chunk": [c], "once": [zlib.compress(o.tobytes(), 1)],
                                    "twice": [zlib.compress(t.tobytes(), 1)]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for c, o, t in b.itertuples(index=False):
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
                if c in state:
                    po, pt = state[c]
                    o, t = po | o, pt | t | (po & o)
                state[c] = (o, t)
        for c, (_, t) in state.items():
            yield pd.DataFrame({"chunk": [c], "twice": [t.tobytes()]})

    chunks = keyed.select("keys").mapInPandas(fill, "chunk int, once binary, twice binary")
    merged = chunks.repartition("chunk").mapInPandas(merge, "chunk int, twice binary")
    out = bytearray(bits // 8)
    step = CHUNK_BITS // 8
    for r in merged.toLocalIterator():  # bits / CHUNK_BITS rows at most
        out[r["chunk"] * step:(r["chunk"] + 1) * step] = r["twice"]
    return bytes(out)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "lines",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                max_bits: int = MAX_BLOOM_BITS, hot_parts: int = HOT_PARTS) -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_lines`` (before dropping),
    ``n_dropped`` and ``kept`` (the text that remains)."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = [b"".join(dict.fromkeys(line_keys(t, min_chars)[0])) for t in b["text"]]
            yield pd.DataFrame({"id": b["id"].astype("Int64"), "keys": keys})

    keyed = persisted(slim.mapInPandas(hashed, "id long, keys binary").where(F.length("keys") > 0), "line-keys")
    n = keyed.agg(F.sum(F.length("keys"))).first()[0] or 0
    wanted = max(CHUNK_BITS, n // 16 * BITS_PER_LINE)
    bits = min(max_bits, 1 << (wanted - 1).bit_length())
    twice = spark.sparkContext.broadcast(twice_filter(keyed, bits))

    def suspected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bloom = np.frombuffer(twice.value, np.uint8)
        for b in batches:
            keys = _as_keys(b"".join(b["keys"]))
            ids = b["id"].astype("Int64").repeat(b["keys"].map(len).to_numpy() // 16)
            hit = _holds(bloom, keys, bits)
            if hit.any():
                some = keys[hit].view(np.int64)
                yield pd.DataFrame({"id": ids[hit].reset_index(drop=True), "hi": some[:, 0], "lo": some[:, 1]})

    # rows without an id are no documents
    found = keyed.where(F.col("id").isNotNull()).mapInPandas(suspected, "id long, hi long, lo long")
    suspects = persisted(found, "line-suspects")
    each = suspects.groupBy("hi", "lo", "id").agg(F.count(F.lit(1)).alias("rows"))
    repeated = persisted(each.groupBy("hi", "lo").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs), "line-repeated")
    drops = join_hot(suspects, repeated, ["hi", "lo"], "rows", suspects.count(), hot_parts) \
        .where(F.col("id") < F.col("keeper")) \
        .groupBy(F.col("id").alias("__drop_id")).agg(F.collect_set(F.struct("hi", "lo")).alias("__drops"))

    @F.pandas_udf("n_lines long, n_dropped long, kept string")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drop_lists in batches:
            rows = []
            for t, drop in zip(texts, drop_lists):
                t = t or ""
                if drop is None or not len(drop):
                    rows.append((t.count("\n") + 1, 0, t))
                    continue
                gone = {np.array([d["hi"], d["lo"]], "<i8").tobytes() for d in drop}
                lines = t.split("\n")
                keys, at = line_keys(t, min_chars)
                out_of = {i for k, i in zip(keys, at) if k in gone}
                rows.append((len(lines), len(out_of), "\n".join([x for i, x in enumerate(lines) if i not in out_of])))
            yield pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept"])

    joined = docs.join(drops, F.col(id_col) == F.col("__drop_id"), "left")
    return joined.withColumn(out, apply(F.col(text_col), F.col("__drops"))).drop("__drop_id", "__drops")
