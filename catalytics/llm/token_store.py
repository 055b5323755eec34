"""Token-ID output in wavelet-matrix shard files (operator 4).

Documents are range-partitioned by ``doc_id``; each task encodes its sorted
documents and cuts them into shards of a bounded number of tokens. A shard is
one compressed file holding one row: the document table (ids, cumulative
token counts) and a wavelet matrix of all token ids, that is one packed bit
plane per id bit with a rank directory. Access, counting and occurrence
lookup run on the planes without expanding them.

Defined results: null and empty texts are a single end id; a null doc_id sorts
first; rows that repeat a doc_id are all kept, next to each other in the
order of their texts; an empty table writes no shard and reads back as no
rows. A document longer than the shard bound is a shard of its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalytics.llm.bpe import byte_symbols

#: Tokens at which a task closes a shard.
SHARD_TOKENS = 2_000_000
#: Bits between two entries of a plane's rank directory.
RANK_BLOCK = 512
#: Values that are put back in their places at a time, a multiple of 8.
VALUE_BLOCK = 1 << 16
#: Distinct pieces, and their characters, at which an encoder's memo starts a
#: new generation; it keeps two.
MEMO_PIECES = 600_000
MEMO_CHARS = 32_000_000
#: Documents that are encoded at once.
BATCH_DOCS = 2_000

SHARD_SCHEMA = ("shard string, part int, seq int, n_docs long, n_tokens long, bits int, "
                "doc_ids binary, doc_null binary, ends binary, "
                "planes array<binary>, ranks array<binary>, zeros array<long>")
_ARROW_SCHEMA = pa.schema([
    ("shard", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
    ("n_tokens", pa.int64()), ("bits", pa.int32()), ("doc_ids", pa.binary()), ("doc_null", pa.binary()),
    ("ends", pa.binary()), ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
    ("zeros", pa.list_(pa.int64()))])


class WaveletMatrix:
    """Succinct sequence of small integers. Plane j holds, for the sequence
    as ordered by the higher bits, bit ``bits-1-j`` of each value; the
    sequence is then parted stably into zeros before ones."""

    def __init__(self, n: int, planes: list[bytes], ranks: list[bytes], zeros: list[int]):
        self.n, self.zeros = n, [int(z) for z in zeros]
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, "<u4") for r in ranks]

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> "WaveletMatrix":
        kind = np.uint16 if bits <= 16 else np.uint32
        seq = values.astype(kind, copy=False)
        planes, ranks, zeros = [], [], []
        for j in range(bits - 1, -1, -1):
            ones = (seq & kind(1 << j)) != 0
            packed = np.packbits(ones)
            pad = -len(packed) % (RANK_BLOCK // 8)
            words = np.pad(packed, (0, pad)).view(np.uint64)
            per = np.bitwise_count(words).reshape(-1, RANK_BLOCK // 64).sum(1, dtype=np.uint32)
            planes.append(packed.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(per)]).astype("<u4").tobytes())
            low = np.compress(~ones, seq)
            zeros.append(len(low))
            seq = np.concatenate([low, np.compress(ones, seq)])
        return cls(len(values), planes, ranks, zeros)

    def rank1(self, j: int, i: int) -> int:
        """Ones in the first ``i`` bits of plane ``j``."""
        block = i // RANK_BLOCK
        lo, hi = block * (RANK_BLOCK // 8), i // 8
        total = int(self.ranks[j][block]) + int(np.bitwise_count(self.planes[j][lo:hi]).sum())
        if i % 8:
            total += (int(self.planes[j][hi]) >> (8 - i % 8)).bit_count()
        return total

    def _bit(self, j: int, i: int) -> int:
        return int(self.planes[j][i >> 3]) >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        """The value at position ``i``."""
        v = 0
        for j in range(len(self.planes)):
            b = self._bit(j, i)
            v = v << 1 | b
            r = self.rank1(j, i)
            i = self.zeros[j] + r if b else i - r
        return v

    def count(self, v: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``v`` in positions ``lo`` to ``hi`` (exclusive)."""
        first, last = self._narrow(v, lo, self.n if hi is None else hi)
        return last - first

    def _narrow(self, v: int, lo: int, hi: int) -> tuple[int, int]:
        bits = len(self.planes)
        if v < 0 or v >> bits:
            return 0, 0
        for j in range(bits):
            a, b = self.rank1(j, lo), self.rank1(j, hi)
            if v >> (bits - 1 - j) & 1:
                lo, hi = self.zeros[j] + a, self.zeros[j] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def select1(self, j: int, k: int) -> int:
        """Position of the ``k``-th (from 0) one of plane ``j``."""
        block = int(np.searchsorted(self.ranks[j], k, side="right")) - 1
        start = block * RANK_BLOCK
        ones = np.flatnonzero(np.unpackbits(self.planes[j][start // 8:(start + RANK_BLOCK) // 8]))
        return start + int(ones[k - int(self.ranks[j][block])])

    def select0(self, j: int, k: int) -> int:
        """Position of the ``k``-th (from 0) zero of plane ``j``."""
        lo, hi = 0, len(self.ranks[j]) - 1
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if mid * RANK_BLOCK - int(self.ranks[j][mid]) <= k:
                lo = mid
            else:
                hi = mid - 1
        start = lo * RANK_BLOCK
        zeros = np.flatnonzero(np.unpackbits(self.planes[j][start // 8:(start + RANK_BLOCK) // 8]) == 0)
        return start + int(zeros[k - (start - int(self.ranks[j][lo]))])

    def select(self, v: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``v``, or -1."""
        first, last = self._narrow(v, 0, self.n)
        if not 0 <= k < last - first:
            return -1
        i = first + k
        bits = len(self.planes)
        for j in range(bits - 1, -1, -1):
            one = v >> (bits - 1 - j) & 1
            i = self.select1(j, i - self.zeros[j]) if one else self.select0(j, i)
        return i

    def values(self) -> np.ndarray:
        """The whole sequence: planes are undone from the last to the first."""
        bits = len(self.planes)
        kind = np.uint16 if bits <= 16 else np.uint32
        seq = np.zeros(self.n, kind)
        for j in range(bits - 1, -1, -1):
            plane, up = self.planes[j], np.empty(self.n, kind)
            low, high = 0, self.zeros[j]
            seq[high:] |= kind(1 << (bits - 1 - j))
            for at in range(0, self.n, VALUE_BLOCK):  # small enough for the processor's cache
                some = up[at:at + VALUE_BLOCK]
                ones = np.unpackbits(plane[at // 8:(at + VALUE_BLOCK) // 8], count=len(some)).view(bool)
                where = np.flatnonzero(ones)
                some[where] = seq[high:high + len(where)]
                high += len(where)
                where = np.flatnonzero(~ones)
                some[where] = seq[low:low + len(where)]
                low += len(where)
            seq = up
        return seq.astype(np.uint32)


class PieceMemo:
    """Ids of distinct pieces: a row for each, all ids in one array. Row 0 is
    the empty piece."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.chars = 0
        self.flat, self.ends = np.empty(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)
        self.add([""], np.empty(0, np.uint32), [0])

    @property
    def full(self) -> bool:
        return len(self.rows) > MEMO_PIECES or self.chars > MEMO_CHARS

    def add(self, pieces: list[str], ids: np.ndarray, lengths: list[int]) -> None:
        """New pieces with their ids, one after the other."""
        n, end = len(self.rows), int(self.ends[len(self.rows)])
        while len(self.ends) < n + len(pieces) + 1:
            self.ends = np.concatenate([self.ends, np.empty_like(self.ends)])
        while len(self.flat) < end + len(ids):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[end:end + len(ids)] = ids
        self.ends[n + 1:n + 1 + len(pieces)] = end + np.cumsum(lengths)
        self.rows.update(zip(pieces, range(n, n + len(pieces))))
        self.chars += sum(map(len, pieces))

    def rows_of(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.rows.__getitem__, pieces), np.int64, len(pieces))

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these rows, one after the other, and where each ends."""
        first = self.ends[rows]
        lengths = self.ends[rows + 1] - first
        ends = np.cumsum(lengths)
        at = np.repeat(first - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.flat[at], ends


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library. White space separates
    words for this kind of tokenizer file, and so does the step from a letter
    to closing punctuation. So the chunks of a batch are made distinct and
    parted into *pieces*: a word of Latin-1 letters in lower case and the ASCII
    punctuation after it, or else the whole chunk. Distinct pieces are encoded at
    first sight and remembered (bounded); texts are put together from their
    pieces' ids. A word of Latin-1 letters is one word to the file's splitter
    whatever stands around it, so it goes to the library's BPE model by itself,
    with a byte-level symbol for each byte. All other pieces go through the
    library's whole encoder, many in one call, with a marker between them that
    is a single token."""

    MARK = "\x01"
    #: Letters whose lower case is one of these letters and which NFC leaves alone, then ASCII punctuation.
    PLAIN = r"^(?P<word>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+)(?P<tail>[!-/:-@\[-`{-~]*)$"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.symbols = dict(enumerate(byte_symbols()))
        alone = self._whole(self.MARK)
        self.mark = alone[0] if len(alone) == 1 else None
        self.young, self.old = PieceMemo(), PieceMemo()

    @property
    def top(self) -> int:
        return self.tok.get_vocab_size(with_added_tokens=True)

    def _whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _learn_words(self, words: list[str]) -> None:
        tokenize, symbols = self.model.tokenize, self.symbols
        ids, ends = [], [0]
        for w in words:
            ids += [t.id for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(symbols))]
            ends.append(len(ids))
        self.young.add(words, np.array(ids, np.uint32), np.diff(ends))

    def _learn_others(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), 500):
            some = pieces[at:at + 500]
            if self.mark is not None and not any(self.MARK in c for c in some):
                ids = np.array(self._whole(f" {self.MARK} ".join(some)), np.uint32)
                marks = np.append(np.flatnonzero(ids == self.mark), len(ids))
                if len(marks) == len(some):
                    self.young.add(some, ids[ids != self.mark], np.diff(marks, prepend=-1) - 1)
                    continue
            each = [self._whole(c) for c in some]
            self.young.add(some, np.array([i for ids in each for i in ids], np.uint32), [len(ids) for ids in each])

    def _rows(self, pieces: list[str], learn: Callable[[list[str]], None]) -> np.ndarray:
        """Rows of distinct pieces; those not seen lately are learnt."""
        fresh = [c for c in pieces if c not in self.young.rows]
        if back := [c for c in fresh if c in self.old.rows]:
            ids, ends = self.old.take(self.old.rows_of(back))
            self.young.add(back, ids, np.diff(ends, prepend=0))
            fresh = [c for c in fresh if c not in self.old.rows]
        if fresh:
            learn(fresh)
        return self.young.rows_of(pieces)

    def encode_all(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if self.young.full:  # pieces in use move on, the others go
            self.young, self.old = PieceMemo(), self.young
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        chunks, at = coded.dictionary, _numpy(coded.indices)
        parts = pc.extract_regex(chunks, self.PLAIN)
        plain = parts.is_valid()
        first, second = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        is_plain = _numpy(plain)
        parts = parts.filter(plain)
        words = pc.utf8_lower(parts.field("word")).dictionary_encode()
        tails = parts.field("tail").dictionary_encode()
        first[is_plain] = self._rows(words.dictionary.to_pylist(), self._learn_words)[_numpy(words.indices)]
        second[is_plain] = self._rows(tails.dictionary.to_pylist(), self._learn_others)[_numpy(tails.indices)]
        first[~is_plain] = self._rows(chunks.filter(pc.invert(plain)).to_pylist(), self._learn_others)
        ids, ends = self.young.take(np.stack([first[at], second[at]], axis=1).ravel())
        n_chunks = np.cumsum(_numpy(split.value_lengths()))
        return np.split(ids, np.concatenate([[0], ends[1::2]])[n_chunks][:-1])


def _numpy(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


_LOADED: dict[str, LibraryEncoder] = {}


def _encoder(path: str) -> LibraryEncoder:
    if path not in _LOADED:
        _LOADED[path] = LibraryEncoder(path)
    return _LOADED[path]


def _shard_row(part: int, seq: int, doc_ids: list, ids: list[np.ndarray], bits: int) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    w = WaveletMatrix.build(flat, bits)
    null = np.array([d is None for d in doc_ids], bool)
    keys = np.array([d or 0 for d in doc_ids], "<i8")
    row = {"shard": f"{part:07d}-{seq:05d}", "part": part, "seq": seq, "n_docs": len(ids), "n_tokens": len(flat),
           "bits": bits, "doc_ids": keys.tobytes(), "doc_null": np.packbits(null).tobytes(),
           "ends": np.cumsum([len(x) for x in ids]).astype("<i8").tobytes(),
           "planes": [p.tobytes() for p in w.planes], "ranks": [r.tobytes() for r in w.ranks], "zeros": w.zeros}
    return pa.RecordBatch.from_pylist([row], _ARROW_SCHEMA)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` and write one wavelet-matrix file per shard under
    ``path`` (folders ``shard=...``), in ascending ``id_col`` order: shard
    names sort as their documents do. One shuffle of (id, text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, seq = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        bits = max(1, int(max(enc.top - 1, end_id)).bit_length())
        end = np.array([end_id], np.uint32)
        keys: list = []
        held: list[np.ndarray] = []
        total = 0
        for b in batches:
            for at in range(0, len(b), BATCH_DOCS):
                some = b.slice(at, BATCH_DOCS)
                for d, ids in zip(some["doc_id"].to_pylist(), enc.encode_all(some["text"])):
                    if held and total + len(ids) + 1 > shard_tokens:
                        yield _shard_row(part, seq, keys, held, bits)
                        keys, held, total, seq = [], [], 0, seq + 1
                    keys.append(d)
                    held.append(np.concatenate([ids, end]))
                    total += len(ids) + 1
        if held:
            yield _shard_row(part, seq, keys, held, bits)

    shards = rows.mapInArrow(encode, SHARD_SCHEMA)
    shards.write.option("compression", "zstd").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard file."""
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Decode shard files: one row per document with ``doc_id``, ``start``
    (ids of all documents before it), ``n_tokens``, ``ids_crc32`` and
    ``shard``. Only per-shard totals meet in the running sum, per task part
    first, so no task sees more than one row per part."""
    shards = read_shards(spark, path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                ids = WaveletMatrix(r.n_tokens, r.planes, r.ranks, r.zeros).values().astype("<u4")
                ends = np.frombuffer(r.ends, "<i8")
                starts = np.concatenate([[0], ends[:-1]])
                null = np.unpackbits(np.frombuffer(r.doc_null, np.uint8), count=r.n_docs).astype(bool)
                keys = pd.Series(np.frombuffer(r.doc_ids, "<i8")).astype("Int64").mask(null)
                yield pd.DataFrame({"shard": r.shard, "doc_id": keys, "within": starts, "n_tokens": ends - starts,
                                    "ids_crc32": [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends)]})

    docs = shards.mapInPandas(decode, "shard string, doc_id long, within long, n_tokens long, ids_crc32 long")
    totals = shards.select("shard", "part", "seq", "n_tokens")
    parts = totals.groupBy("part").agg(F.sum("n_tokens").alias("n_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n_part").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("off", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))) \
        .join(parts, "part").select("shard", (F.col("base") + F.col("off")).alias("base"))
    return docs.join(starts, "shard").select(
        "doc_id", (F.col("base") + F.col("within")).cast("long").alias("start"), "n_tokens", "ids_crc32", "shard")
