"""Near-duplicate classes by DartMinHash (operator 6).

Documents are weighted sets of shingles of five words: a shingle's weight is
its number in the text, so weighted Jaccard similarity of 0.8 or more links two of
them (without ``counted`` every weight is one).

Signature: each element's plane of weight x rank is cut into weight regions
[0,1), [1,2), [2,4), ...; hashed darts arrive in a region as a Poisson
process along the rank axis. Darts below the element's weight are the
document's; each falls on a hashed coordinate, which keeps its earliest dart.
Ranks are explored only as far as needed to fill the coordinates, about
t ln t + 2t darts a document, whatever its size. Two documents agree on a
coordinate with probability equal to their weighted Jaccard similarity.

Classes:
1. Documents of equal word sequences are one row, kept by the smallest id;
   sequences and classes of many documents are joined back to them where they
   are, so a third of all rows fills no task.
2. Bands of the signature are bucket keys. In a bucket every member meets its
   bucket's head, the member that shares buckets with most others and so the
   most central of its copies; a document keeps the most central one it
   meets, and this one pair is verified exactly on the shingle sets. Verified
   pairs give first classes.
3. Pairs of *different* classes that still share a bucket are compared too:
   a bucket's members outside its largest class meet all others. Documents of
   such buckets get a second, longer signature of ``CHECKS`` one-bit coordinates.
   Pairs whose signatures, first the short and then the long ones, agree on
   clearly too few coordinates (``MARGIN`` standard deviations below the
   similarity) end inside the join, the rest come out at their first common
   band and are verified exactly. So each pair sharing a bucket is in one
   class or has been compared, while a group of thousands of copies costs
   about one verification a member.
4. Connected components of the links, with written tables between rounds.

Defined results: texts of fewer than five words are one shingle of all their
words; texts without words (null, empty) are classes of their own; rows that
repeat an id count as one document, with one row's text: of the rows with
words the one whose words have the smallest digest; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import join_hot, persisted

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 30
ROWS = 5
#: Standard deviations of a signature's agreement that count as certain.
MARGIN = 4.5
#: Coordinates, of one bit each, of the long signature of documents in
#: contested buckets.
CHECKS = 1024
#: Word sequences and classes with more than this part of all documents are
#: joined without a shuffle.
HOT_PARTS = 65_536

_TABLE = bytes(32 if b < 48 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 else
               b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def nth(i: int) -> np.uint64:
    """``i`` steps of the additive sequence, modulo 2^64."""
    return np.uint64(i * int(_STEP) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64 hashed bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64."""

    def __init__(self) -> None:
        self.base = 0xD6E8FEB86659FD93
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])
        return self.up, self.down


POWERS = Powers()


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, bytes]:
    """Hashes of all shingles of a text, in text order, and its words joined
    by single spaces. A shingle's hash is that of its bytes."""
    joined = b" ".join(text.encode().translate(_TABLE).split(b" ")) if text else b""
    joined = b" ".join(joined.split())
    if not joined:
        return np.empty(0, np.uint64), b""
    b = np.frombuffer(joined, np.uint8)
    up, down = POWERS.upto(len(b) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)])])
    gaps = np.flatnonzero(b == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(b)]])
    k = min(size, len(starts))
    s, e = starts[:len(starts) - k + 1], ends[k - 1:]
    return mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _STEP), joined


def dart_minhash(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, t: int) -> np.ndarray:
    """Signatures (n x t) of ``n`` weighted sets given as parallel arrays
    (element hash, positive weight, index of its set); sets are not empty."""
    sig = np.zeros((n, t), np.uint64)
    total = np.bincount(owner, weights, n)
    reach = (t * np.log(t) + 2 * t) / total
    todo = np.arange(n)
    while len(todo):
        local = np.full(n, -1)
        local[todo] = np.arange(len(todo))
        mine = local[owner] >= 0
        e, w, o = elements[mine], weights[mine], local[owner[mine]]
        best = np.full(len(todo) * t, np.inf)
        ids = np.zeros(len(todo) * t, np.uint64)
        limit = reach[todo]
        low, region = 0.0, 0
        while len(e):  # weight regions [0,1), [1,2), [2,4), ...
            width = max(low, 1.0)
            whole = (w >= low + width).all()  # no dart of this region can miss
            seed, at, weight, end, row = mix(e + nth(region)), np.zeros(len(e)), w, limit[o], o * t
            arrival = 0
            while len(seed):
                arrival += 1
                h = mix(seed + nth(arrival))
                at = at - np.log(unit(h)) / width
                live = np.flatnonzero(at < end)
                seed, at, weight, end, row, h = seed[live], at[live], weight[live], end[live], row[live], h[live]
                rank, base, dart = at, row, h
                if not whole:
                    inside = low + width * unit(mix(h + np.uint64(1))) <= weight
                    rank, base, dart = at[inside], row[inside], h[inside]
                slot = base + (mix(dart + np.uint64(2)) % np.uint64(t)).astype(np.int64)
                np.minimum.at(best, slot, rank)
                first = rank == best[slot]
                ids[slot[first]] = dart[first]
            low, region = low + width, region + 1
            on = w > low
            e, w, o = e[on], w[on], o[on]
        best = best.reshape(len(todo), t)
        full = np.isfinite(best).all(1)
        sig[todo[full]] = ids.reshape(len(todo), t)[full]
        todo = todo[~full]
        reach[todo] *= 2  # darts of smaller rank stay the same
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(sig), bands), np.int64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, np.uint64)
        for r in range(rows):
            h = mix(h * _STEP + sig[:, b * rows + r])
        out[:, b] = h.view(np.int64)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, counted: bool) -> DataFrame:
    """(id, key, fp, size, bands, sig) of each row with words: key is a hash
    of the text, fp a digest of the words, size the number of shingles
    (distinct, or all if ``counted``), sig the signature with 16 bits a
    coordinate."""
    slim = _keyed(docs, id_col, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 200):
                some = b.iloc[at:at + 200]
                elements, weights, owner, keep, keys, fps, sizes = [], [], [], [], [], [], []
                for d, k, t in zip(some["id"], some["key"], some["text"]):
                    hashes, words = shingles(t)
                    if not len(hashes):
                        continue
                    e, c = np.unique(hashes, return_counts=True)
                    elements.append(e)
                    weights.append(c.astype(np.float64) if counted else np.ones(len(e)))
                    owner.append(np.full(len(e), len(keep)))
                    keep.append(d)
                    keys.append(k)
                    fps.append(hashlib.md5(words).digest())
                    sizes.append(int(c.sum()) if counted else len(e))
                if keep:
                    sig = dart_minhash(np.concatenate(elements), np.concatenate(weights), np.concatenate(owner),
                                       len(keep), bands * rows)
                    yield pd.DataFrame({"id": keep, "key": keys, "fp": fps, "size": sizes,
                                        "bands": list(band_keys(sig, bands, rows)),
                                        "sig": list(sig.astype(np.uint16).view(np.int16))})

    return slim.where(F.col("id").isNotNull()).mapInPandas(run, "id long, key long, fp binary, size long, bands array<long>, sig array<smallint>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float, counted: bool) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            ok = []
            for x, y in zip(p["sa"], p["sb"]):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                if counted:
                    (ex, cx), (ey, cy) = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
                    _, ix, iy = np.intersect1d(ex, ey, assume_unique=True, return_indices=True)
                    both, either = np.minimum(cx[ix], cy[iy]).sum(), len(x) + len(y)
                else:
                    both, either = len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)
                ok.append(both >= similarity * (either - both) - 1e-9)
            yield p.loc[ok, ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").mapInPandas(compare, "a long, b long")


def long_signatures(sets: DataFrame, t: int) -> DataFrame:
    """(rep, check): one bit of each of ``t`` coordinates, 64 to a long, by
    shingle sets instead of texts; ``t`` is a multiple of 64. Empty sets
    have none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 100):
                some = b.iloc[at:at + 100]
                some = some[some["shingles"].map(len) > 0]
                if some.empty:
                    continue
                found = [np.unique(np.frombuffer(x, "<u8"), return_counts=True) for x in some["shingles"]]
                sig = dart_minhash(np.concatenate([e for e, _ in found]), np.concatenate([c for _, c in found]).astype(np.float64),
                                   np.repeat(np.arange(len(found)), [len(e) for e, _ in found]), len(found), t)
                bits = np.packbits((sig & np.uint64(1)).astype(bool), axis=1)
                yield pd.DataFrame({"rep": some["id"], "check": list(bits.view("<i8"))})

    return sets.mapInPandas(run, "rep long, check array<long>")


def enough(agreement: float, t: int) -> float:
    """Fewest of ``t`` coordinates on which pairs agree that do so with
    probability ``agreement`` each."""
    return t * (agreement - MARGIN * (agreement * (1 - agreement) / t) ** 0.5)


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id of the connected component, for every id
    on an edge. Each round links every vertex's neighbours to the smallest
    one it knows, first larger neighbours, then smaller ones; the edges
    become stars. Minima and joins only: no neighbour list is gathered."""
    last = None
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = persisted(edges, "components")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == last:
            break
        last = now
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("comp"))
    return stars.union(edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS, counted: bool = True, hot_parts: int = HOT_PARTS) -> DataFrame:
    """One row per document id: the id, ``class_id`` (smallest id of its
    class) and ``class_size`` (documents of the class)."""
    sigs = persisted(signatures(docs, id_col, text_col, bands, rows, counted), "dart-signatures")
    # one row of each id, then equal word sequences: one representative, and the membership
    chosen = persisted(sigs.groupBy("id").agg(F.min(F.struct("fp", "key")).alias("of")).select("id", "of.fp", "of.key"), "dart-chosen")
    firsts = chosen.groupBy("fp").agg(F.min(F.struct("id", "key")).alias("of"), F.count(F.lit(1)).alias("copies")) \
        .select("fp", F.col("of.id").alias("rep"), F.col("of.key").alias("key"), "copies")
    traits = sigs.groupBy("fp").agg(F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    reps = persisted(traits.join(firsts, "fp"), "dart-distinct")
    buckets = reps.select("rep", F.explode("bands").alias("bucket"))
    crowded = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = persisted(buckets.join(crowded, "bucket"), "dart-buckets")
    # the member that meets most others is the most central of its copies
    central = shared.groupBy("rep").agg(F.struct(F.sum("n").alias("met"), (-F.col("rep")).alias("first")).alias("rank"))
    ranked = shared.select("bucket", "rep").join(central, "rep")
    heads = ranked.groupBy("bucket").agg(F.max("rank").alias("head"))
    first = ranked.join(heads, "bucket").groupBy("rep").agg(F.max("head").alias("head")) \
        .select((-F.col("head.first")).alias("a"), F.col("rep").alias("b")).where("a <> b")
    texts = reps.select("rep", "key").join(shared.select("rep").distinct(), "rep", "left_semi").withColumnRenamed("rep", "id")
    sets = persisted(_shingle_sets(docs, texts, id_col, text_col, counted), "dart-sets")
    links = persisted(verified(first, sets, similarity, counted), "dart-links")
    comp = components(links)
    # pairs of different classes that share a bucket
    named = shared.select("bucket", "rep").join(comp.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("bucket", "rep", F.coalesce("comp", "rep").alias("comp"))
    counts = named.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    open_ = counts.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("classes")) \
        .where("classes > 1").select("bucket", F.col("top.comp").alias("major"))
    named = persisted(named.join(open_, "bucket"), "dart-open")
    contested = sets.join(named.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    traits = persisted(reps.select("rep", "size", "bands", "sig").join(long_signatures(contested, CHECKS), "rep"), "dart-traits")
    named = named.join(traits, "rep")
    x = named.where("comp <> major").select("bucket", *[F.col(c).alias(f"x_{c}") for c in ("rep", "comp", "size", "bands", "sig", "check")])
    y = named.withColumn("is_major", F.col("comp") == F.col("major"))
    agree = F.size(F.filter(F.zip_with("x_sig", "sig", lambda a, b: a == b), lambda e: e))
    # coordinates that differ still have equal bits half the time
    unequal = F.aggregate(F.zip_with("x_check", "check", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, m: n + m)
    first_common = F.get(F.filter(F.zip_with("x_bands", "bands", lambda a, b: F.when(a == b, a)), lambda e: e.isNotNull()), F.lit(0))
    cross = x.join(y, "bucket").where(
        (F.col("x_comp") != F.col("comp")) & (F.col("is_major") | (F.col("x_rep") < F.col("rep")))
        & (F.col("x_size") >= similarity * F.col("size")) & (F.col("size") >= similarity * F.col("x_size"))
        & (CHECKS - unequal >= enough((1 + similarity) / 2, CHECKS))
        & (agree >= enough(similarity, bands * rows)) & (first_common == F.col("bucket"))) \
        .select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b")).distinct()
    late = verified(cross, sets, similarity, counted)
    comp = components(links.union(persisted(late, "dart-late")))
    named = reps.select("rep", "copies", "fp").join(comp.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("fp", "copies", F.coalesce("comp", "rep").alias("class_id"))
    classed = join_hot(chosen.select("id", "fp"), persisted(named, "dart-named"), ["fp"], "copies", chosen.count(), hot_parts) \
        .select("id", "class_id")
    all_ids = docs.select(F.col(id_col).cast("long").alias("id")).distinct()
    out = persisted(all_ids.join(classed, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id")), "dart-classes")
    sizes = out.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    return join_hot(out, persisted(sizes, "dart-sizes"), ["class_id"], "class_size", out.count(), hot_parts) \
        .select(F.col("id").alias(id_col), "class_id", "class_size")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def _shingle_sets(docs: DataFrame, texts: DataFrame, id_col: str, text_col: str, counted: bool) -> DataFrame:
    """(id, shingles) of the texts named by (id, key)."""
    slim = _keyed(docs, id_col, text_col).join(texts, ["id", "key"], "left_semi").dropDuplicates(["id", "key"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [np.sort(h) if counted else np.unique(h) for h in (shingles(t)[0] for t in b["text"])]
            yield pd.DataFrame({"id": b["id"], "shingles": [s.astype("<u8").tobytes() for s in sets]})

    return slim.mapInPandas(run, "id long, shingles binary")
