"""Sharding by sampled splitters (operator 8), DataFrame operations only.

1. Draw a sample of sort keys in which a record's chance grows with its size.
2. Take splitters at the sample's quantiles: many more ranges than shards.
3. Assign every record to its range by two-level search among the splitters
   and sum rows and bytes per range, exactly.
4. A range above its limit is overfull: it gets splitters of its own from a
   new sample inside the range, again and again until no range is overfull
   (or a range cannot be parted, being one single sort key). A key that the
   sample holds several times gets a range of its own.
5. Ranges in key order are dealt to shards by their cumulated bytes, so the
   shards' sizes differ by no more than about one range.

The sort key is a pair: the key's hash, so equal keys are neighbours, and a
hash of the id, so that a hot key's records can be parted. Slots number a
shard's records from 0: the rows of the ranges before, plus the row number
inside the range. No task holds more than a range.

The number of ranges follows the bytes (``RANGE_BYTES`` each) between
``ranges_per_shard`` a shard and ``max_ranges`` in all. The splitters are
collected: about ``max_ranges`` pairs of longs, and as many again for overfull
ranges, since a round gives a range one splitter for each mean range that it
holds. That bounds what the driver and the plan hold.

Defined results: null texts have size 1 and the digest of the empty text;
repeated rows go next to each other and each has a slot; texts of any length
are one record; an empty table has an empty result; shards without records
are possible on tiny inputs; other
columns pass through.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalytics.llm.common import persisted

#: Least ranges per shard that the first splitters aim at, and the size of one.
RANGES_PER_SHARD = 64
RANGE_BYTES = 64 << 20
#: Sampled keys per range.
SAMPLES_PER_RANGE = 24
#: A range is overfull beyond so many times the mean range.
OVERFULL = 3.0
MAX_RANGES = 65_536


def _literal(values: list[tuple[int, int]]) -> Column:
    """A constant array of key pairs; parsed from text, so that the plan
    holds one literal."""
    text = ",".join(f'{{"k":{k},"t":{t}}}' for k, t in values)
    return F.from_json(F.lit(f"[{text}]"), "array<struct<k: bigint, t: bigint>>")


def _range_of(key: Column, splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below ``key``: a coarse search over every
    s-th splitter, then a search inside that stretch."""
    if not splitters:
        return F.lit(0)
    step = max(1, int(len(splitters) ** 0.5))
    every = splitters[::step]
    stretch = F.size(F.filter(_literal(every), lambda s: s <= key))
    fine = F.slice(_literal(splitters), F.greatest(stretch - 1, F.lit(0)) * step + 1, step)
    return F.when(stretch == 0, F.lit(0)).otherwise(
        (stretch - 1) * step + F.size(F.filter(fine, lambda s: s <= key))).cast("int")


def _draw(rows: DataFrame, wanted: Column, salt: int) -> DataFrame:
    """Records drawn with a chance of ``wanted`` (expected number) each; the
    draw is a hash of the sort key, so a retried task draws the same."""
    chance = (F.xxhash64("__key", F.lit(salt)).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
    return rows.where(chance < wanted)


def _quantiles(sample: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    sample.sort()
    return [sample[i * len(sample) // n] for i in range(1, n)] if len(sample) >= n else sample


def _part(sample: list[tuple[int, int]], n: int, lo: tuple[int, int], hi: tuple[int, int]) -> set[tuple[int, int]]:
    """Splitters that part the range of keys ``lo`` to ``hi``: never none. A
    key drawn more than once also ends where it begins."""
    cuts = _quantiles(sample, n)
    twice = {s for s, after in zip(cuts, cuts[1:]) if s == after}
    inside = {s for s in {*cuts, *((k, t + 1) for k, t in twice if t < (1 << 63) - 1)} if lo < s <= hi}
    return inside or {hi}


def shard_by_bytes(docs: DataFrame, n_shards: int, key: Column, size: Column, tie: Column,
                   max_ranges: int = MAX_RANGES, ranges_per_shard: int = RANGES_PER_SHARD,
                   range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` with ``shard``, ``slot`` (gapless from 0 inside a shard) and
    ``range`` (the splitter range), replacing columns of these names. ``size`` is a record's weight in bytes;
    records with equal ``key`` are neighbours; ``tie`` parts them."""
    keyed = docs.withColumn("__key", F.struct(F.xxhash64(key).alias("k"), F.xxhash64(tie).alias("t"))) \
        .withColumn("__size", size.cast("long")).drop("shard", "slot", "range")
    # the narrow columns are read several times: write them once
    slim = persisted(keyed.select("__key", "__size"), "shard-keys")
    total = slim.agg(F.sum("__size")).first()[0] or 0
    goal = max(n_shards * ranges_per_shard, min(max_ranges, total // range_bytes))
    rate = goal * SAMPLES_PER_RANGE / max(total, 1)
    first = _draw(slim, F.col("__size") * rate, 0).select("__key.k", "__key.t")
    splitters = sorted(set(_quantiles([(r["k"], r["t"]) for r in first.toLocalIterator()], goal)))
    limit = OVERFULL * total / goal
    for salt in count(1):  # every round parts each overfull range
        ranged = slim.withColumn("__range", _range_of(F.col("__key"), splitters))
        full = ranged.groupBy("__range").agg(
            F.sum("__size").alias("bytes"), F.min("__key").alias("lo"), F.max("__key").alias("hi"))
        over = [r for r in full.where((F.col("bytes") > limit) & (F.col("lo") < F.col("hi"))).toLocalIterator()]
        if not over:
            break
        new: set[tuple[int, int]] = set()
        inside = ranged.where(F.col("__range").isin([r["__range"] for r in over]))
        drawn: dict[int, list[tuple[int, int]]] = {r["__range"]: [] for r in over}
        for r in _draw(inside, F.col("__size") * rate * 4, salt).select("__range", "__key.k", "__key.t").toLocalIterator():
            drawn[r["__range"]].append((r["k"], r["t"]))
        for r in over:
            parts = int(r["bytes"] // (limit / OVERFULL)) + 1
            new |= _part(drawn[r["__range"]], parts, tuple(r["lo"]), tuple(r["hi"]))
        splitters = sorted({*splitters, *new})
    ranged = keyed.withColumn("range", _range_of(F.col("__key"), splitters))
    sums = slim.groupBy(_range_of(F.col("__key"), splitters).alias("range")) \
        .agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # one row a range, bounded as the splitters are: the running sums are one small task
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("bytes").over(upto), F.lit(0)) + F.col("bytes") / 2
    dealt = sums.withColumn("shard", F.least(F.floor(middle * n_shards / F.lit(max(total, 1))), F.lit(n_shards - 1)).cast("int"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.select("range", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("range").orderBy("__key")
    numbered = ranged.withColumn("__row", F.row_number().over(inside))
    return numbered.join(F.broadcast(dealt), "range") \
        .withColumn("slot", (F.col("__base") + F.col("__row") - 1).cast("long")) \
        .drop("__key", "__size", "__row", "__base")
