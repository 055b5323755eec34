"""Best-fit packing of documents into sequences (operator 12).

Documents are encoded and cut into pieces of at most ``capacity`` tokens; only
the first piece of a document can be shorter. Full pieces are sequences of
their own. All others are packed by minimum bin slack: a bin takes the longest
piece left and then, found by subset-sum dynamic programming with one bit a
reachable sum, the combination of lengths still available that fills it best.

Which pieces have the same length does not matter to a bin, so the program
works on the number of pieces of each length (``capacity - 1`` numbers at most)
and takes a combination as often as the numbers allow. Each combination leaves
some length with fewer pieces than it uses, so there are at most some
capacity * ln(capacity) different ones however many documents there are; that
table is all the driver holds. Pieces never pass through it: each is numbered
among the pieces of its length (a count within its task plus the counts of
the tasks before) and finds its bin and offset by that number.

Defined results: a null text is an empty document, which is the end id alone;
a text of any length is encoded whole; rows that repeat an id are separate
documents; a null id is kept; an empty table gives no rows; strings of special
tokens in a text give their ids, as the tokenizers library does."""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalytics.llm.bpe import byte_symbols
from catalytics.llm.text_batches import BATCH_BYTES

#: Sequence ids of full pieces start here: task number + 1, then a count.
_TASK = 1 << 40


class ByteEncoder:
    """Ids of whole texts for a byte-level BPE file of the tokenizers library
    (``path``) whose words follow ``pattern``. The vocabulary and the pattern
    run in tiktoken, several times faster; a text with the string of a special
    token goes to the library itself."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        of = {c: b for b, c in enumerate(byte_symbols())}
        ranks = {bytes(of[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in self.specials}
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.specials):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


_LOADED: dict[tuple[str, str], ByteEncoder] = {}


def _encoder(path: str, pattern: str) -> ByteEncoder:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteEncoder(path, pattern)
    return _LOADED[path, pattern]


def write_pieces(docs: DataFrame, path: str, tokenizer: str, pattern: str, capacity: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every document, append ``end_id`` and write its pieces: id,
    ``piece``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``part`` (the task) and ``nth`` (number among the task's pieces of that
    length). The written file fixes the numbers: a task that is run again
    replaces its own."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, piece int, start long, length int, ids binary, part int, nth long"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = _encoder(tokenizer, pattern), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        seen = [0] * (capacity + 1)
        names = [id_col, "piece", "start", "length", "ids", "part", "nth"]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]

        def flush(b: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
            at, *cols = zip(*rows)
            return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())),
                                               *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

        for b in batches:
            rows, size = [], 0
            for i, text in enumerate(b.column("text")):
                ids = np.concatenate([enc.ids(text.as_py() or ""), end])
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((i, k, lo, hi - lo, ids[lo:hi].tobytes(), part, seen[hi - lo]))
                    seen[hi - lo] += 1
                size += ids.nbytes
                if size >= BATCH_BYTES:
                    yield flush(b, rows)
                    rows, size = [], 0
            if rows:
                yield flush(b, rows)

    texts = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    texts.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(path)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of the available ``lengths`` (ascending) with the
    largest sum up to ``room``, as length -> pieces. Bit s of ``reach`` says
    that s is the sum of some combination; long pieces come first, and the
    search ends when the room can be filled."""
    full, reach = (1 << (room + 1)) - 1, 1
    steps = []
    for at in range(bisect_left(lengths, room + 1) - 1, -1, -1):
        length = lengths[at]
        left, take = min(counts[length], room // length), 1
        while left > 0:  # 1, 2, 4, ... pieces at once
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & full
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Minimum bin slack over the pieces of each length. Returns rows
    (length, first, uses, first bin, offset): the pieces of that length from
    number ``first`` on go to bins from ``first bin`` on, ``uses`` to each, the
    first of them at ``offset``; and the number of bins."""
    left = {n: c for n, c in counts.items() if c > 0}
    given = dict.fromkeys(left, 0)
    lengths = sorted(left)
    plan, bins = [], 0
    while lengths:
        longest = lengths[-1]
        left[longest] -= 1
        uses = fullest(lengths, left, capacity - longest)
        left[longest] += 1
        uses[longest] = uses.get(longest, 0) + 1
        times = min(left[n] // k for n, k in uses.items())
        offset = 0
        for n in sorted(uses, reverse=True):
            plan.append((n, given[n], uses[n], bins, offset))
            offset += n * uses[n]
            given[n] += times * uses[n]
            left[n] -= times * uses[n]
            if not left[n]:
                lengths.pop(bisect_left(lengths, n))
        bins += times
    return plan, bins


def place(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of written pieces."""
    short = pieces.where(F.col("length") < capacity)
    in_part = short.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in in_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = plan_bins(counts, capacity)
    plan.sort()
    table = np.array(plan, np.int64).reshape(-1, 5)
    starts = [(n, first) for n, first, *_ in plan]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.int64(1) << 44
        keys = np.array([n * wide + first for n, first in starts], np.int64)
        for b in batches:
            length, number = (np.asarray(b.column(c), np.int64) for c in ("length", "number"))
            row = table[np.searchsorted(keys, length * wide + number, side="right") - 1]
            nth = number - row[:, 1]
            bins, offset = row[:, 3] + nth // row[:, 2], row[:, 4] + nth % row[:, 2] * length
            keep = [b.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(bins), pa.array(offset)], [*columns, "sequence_id", "offset"])

    columns = [c for c in pieces.columns if c not in ("part", "nth")]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = in_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = short.join(base, ["length", "part"]).select(*columns, (F.col("base") + F.col("nth")).alias("number"))
    kinds = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in columns)
    packed = numbered.mapInArrow(find, f"{kinds}, sequence_id long, offset long")
    alone = pieces.where(F.col("length") == capacity).select(
        *columns, ((F.col("part").cast("long") + 1) * F.lit(_TASK) + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the token ids of every sequence, which has
    at most ``capacity`` of them."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def pack(docs: DataFrame, path: str, tokenizer: str, pattern: str, capacity: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the pieces of ``docs`` under ``path`` and return them placed:
    id, piece, start, length, ids, sequence_id, offset."""
    write_pieces(docs, path, tokenizer, pattern, capacity, end_id, id_col, text_col)
    return place(read_pieces(docs.sparkSession, path), capacity)
