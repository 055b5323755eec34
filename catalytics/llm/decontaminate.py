"""Benchmark decontamination by a prefix-filtered set join (operator 10),
DataFrame operations only.

A window is ``window`` consecutive words of a benchmark item (an item of
fewer words is one window). A document word is hit when it lies in an
occurrence of a window.

1. Shingles (``shingle`` words, or the whole window if shorter) of all
   windows go into a bitmap whose size follows their number. One pass over the documents keeps
   only *stretches*: runs of words covered by shingles that the bitmap holds,
   long enough for a window. Equal stretches are joined as one row, so a
   passage copied into a third of all documents is verified once.
2. Shingles are counted over the stretches of all documents and a window's
   shingles are ordered by rarity. Containment is full, so the necessary
   prefix is the one rarest shingle: only its occurrences are joined.
3. Its offset in the window fixes the start of the only possible match
   (positional bound); windows that would leave the stretch are dropped
   (length bound); the rest are compared word by word.

Defined results: null and empty texts have no words and no hits; items
without words never occur; equal items (or items sharing a window) are all
reported; rows that repeat a document id are judged each; extra columns pass
through or are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import ascii_lower, persisted

WINDOW = 10
SHINGLE = 3
#: Bits of the bitmap for each benchmark shingle (as many false stretches at
#: every size of the benchmark), and the fewest and most bits: the bound of what the plan
#: holds. Beyond it more false stretches are verified, with the same result.
BITS_PER_SHINGLE = 32
LEAST_BITS = 1 << 18
MOST_BITS = 1 << 26
# fixed value: the word pattern of the contract
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _shingle_hash(words: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(k)])


def _shingles(words: Column, k: int) -> Column:
    """Hashes of all k-word shingles; the index is the first word's."""
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(0), F.size(words) - k), lambda i: _shingle_hash(words, i, k))
    ).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """Distinct (item, window): ``item``, ``words``, ``n`` (words), ``k``
    (shingle words), ``wid`` (hash of the words)."""
    w = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("all")).where(F.size("all") > 0)
    w = w.select("item", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0))),
        lambda i: F.slice(F.col("all"), i + 1, window))).alias("words"))
    return w.distinct().withColumn("n", F.size("words")) \
        .withColumn("k", F.least(F.col("n"), F.lit(shingle))) \
        .withColumn("wid", F.xxhash64(F.array_join("words", " ")))


def _by_k(words: Column, k: Column, classes: list[int]) -> Column:
    """Shingle hashes with the shingle length of the window."""
    out = F.array().cast("array<bigint>")
    for c in classes:
        out = F.when(k == c, _shingles(words, c)).otherwise(out)
    return out


def _hashes(windows: DataFrame, classes: list[int]) -> DataFrame:
    return windows.select(F.explode(_by_k(F.col("words"), F.col("k"), classes)).alias("h")).distinct()


def bitmap_bits(windows: DataFrame, classes: list[int]) -> int:
    """A power of two that follows the number of distinct shingles."""
    n = _hashes(windows, classes).count()
    return min(MOST_BITS, max(LEAST_BITS, 1 << (n * BITS_PER_SHINGLE - 1).bit_length()))


def _bitmap(windows: DataFrame, classes: list[int], bits: int) -> Column:
    """Constant array of ``bits`` / 64 longs holding all shingles."""
    slots = _hashes(windows, classes) \
        .select(F.pmod(F.col("h"), F.lit(bits)).alias("b")) \
        .groupBy(F.shiftright("b", 6).alias("slot")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("set"))
    full = [0] * (bits // 64)
    for r in slots.toLocalIterator():  # bits / 64 rows at most
        full[r["slot"]] = r["set"]
    return F.from_json(F.lit("[" + ",".join(map(str, full)) + "]"), "array<bigint>")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def stretches(words: Column, classes: list[int], bitmap: Column, bits: int) -> Column:
    """Array of (s, e): maximal runs of words covered by shingles that
    the bitmap holds. Shingles closer than their length share words and
    belong to one run, so runs are disjoint. Linear in the number of words."""
    def held(h: Column) -> Column:
        b = F.pmod(h, F.lit(bits))
        return F.get(bitmap, F.shiftright(b, 6).cast("int")).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), b.bitwiseAND(F.lit(63)).cast("int"))) != 0

    def first_words(k: int) -> Column:
        return F.filter(F.transform(_shingles(words, k), lambda h, i: F.when(held(h), i)), lambda i: i.isNotNull())

    def runs_of(at: Column, k: int, gap: int) -> Column:
        """Runs of sorted positions, each of ``k`` words; neighbours that are
        ``gap`` or more apart are in different runs."""
        starts = F.filter(F.transform(at, lambda p, i: F.when((i == 0) | (p - F.get(at, i - 1) >= gap), p)),
                          lambda p: p.isNotNull())
        ends = F.filter(F.transform(at, lambda p, i: F.when((i == F.size(at) - 1) | (F.get(at, i + 1) - p >= gap), p + k)),
                        lambda p: p.isNotNull())
        return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))

    if len(classes) == 1:
        return _bound(first_words(classes[0]), lambda at: runs_of(at, classes[0], gap=classes[0]))
    # shingles of several lengths: the covered words themselves
    covered = [F.flatten(F.transform(first_words(k), lambda p: F.sequence(p, p + (k - 1)))) for k in classes]
    return _bound(F.array_sort(F.array_distinct(F.concat(*covered))), lambda at: runs_of(at, 1, gap=2))


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
               shingle: int = SHINGLE, bits: int | None = None) -> DataFrame:
    """``docs``'s other columns than the text (same-named ones are replaced), with ``n_words``, ``n_hit``
    and ``items`` (array of the ids of items with occurring windows)."""
    windows = persisted(item_windows(items, item_id, item_text, window, shingle), "bench-windows")
    # (shingle words, window words) pairs in use: at most `window` rows
    sizes = [(r["k"], r["n"]) for r in windows.select("k", "n").distinct().toLocalIterator()]
    classes = sorted({k for k, _ in sizes})
    others = [c for c in docs.columns if c not in (id_col, text_col, "n_words", "n_hit", "items")]
    ids = docs.select(F.col(id_col), *others, words_of(F.col(text_col)).alias("__words"))
    if not sizes:
        return ids.withColumn("n_words", F.size("__words").cast("long")).withColumn("n_hit", F.lit(0).cast("long")) \
            .withColumn("items", F.array().cast("array<string>")).drop("__words")
    least = min(n for _, n in sizes)
    bits = bits or bitmap_bits(windows, classes)
    bitmap = _bitmap(windows, classes, bits)
    runs = F.filter(stretches(F.col("__words"), classes, bitmap, bits), lambda r: r["e"] - r["s"] >= least)
    marked = persisted(ids.withColumn("n_words", F.size("__words").cast("long")).withColumn(
        "__runs", F.transform(runs, lambda r: F.array_join(F.slice(F.col("__words"), r["s"] + 1, r["e"] - r["s"]), " ")))
        .drop("__words").withColumn("__row", F.monotonically_increasing_id()), "bench-marked")
    placed = marked.select("__row", F.explode("__runs").alias("run"))
    # equal stretches are one row with the number of their occurrences
    run_id = F.unhex(F.sha2("run", 256))
    distinct = placed.groupBy("run").agg(F.count(F.lit(1)).alias("times")).withColumn("rid", run_id) \
        .withColumn("w", F.split("run", " ")).drop("run")
    distinct = persisted(distinct, "bench-stretches")
    occur = None
    for k in classes:
        part = distinct.select("rid", "times", F.posexplode(_shingles(F.col("w"), k)).alias("pos", "h")) \
            .withColumn("k", F.lit(k))
        occur = part if occur is None else occur.unionByName(part)
    counts = occur.groupBy("k", "h").agg(F.sum("times").alias("seen"))
    each = windows.select("wid", "words", "n", "k").dropDuplicates(["wid", "words"])
    ranked = each.select("wid", "words", "n", "k", F.posexplode(_by_k(F.col("words"), F.col("k"), classes)).alias("offset", "h")) \
        .join(counts, ["k", "h"], "left")
    # the rarest shingle; one that never occurs rules the window out
    prefix = ranked.groupBy("wid", "words", "n", "k").agg(F.min(F.struct(
        F.coalesce("seen", F.lit(0)).alias("seen"), "h", "offset")).alias("p")).where(F.col("p.seen") > 0) \
        .select("wid", "words", "n", "k", F.col("p.h").alias("h"), F.col("p.offset").alias("offset"))
    starts = occur.select("rid", "k", "h", "pos").join(prefix, ["k", "h"]) \
        .select("rid", "wid", "words", "n", (F.col("pos") - F.col("offset")).alias("s")).where(F.col("s") >= 0)
    found = starts.join(distinct.select("rid", "w"), "rid").where(
        (F.col("s") + F.col("n") <= F.size("w")) & (F.slice(F.col("w"), F.col("s") + 1, F.col("n")) == F.col("words"))) \
        .select("rid", "wid", "words", "s", "n")
    found = persisted(found, "bench-found")
    # hit words of a stretch: the distinct positions, at most its length
    hits = found.select("rid", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("n") - 1)).alias("p")).distinct() \
        .groupBy("rid").agg(F.count(F.lit(1)).alias("hits"))
    named = found.select("rid", "wid", "words").distinct() \
        .join(windows.select("wid", "words", "item"), ["wid", "words"]).select("rid", "item").distinct()
    occurs = placed.select("__row", run_id.alias("rid"))
    n_hit = occurs.join(hits, "rid").groupBy("__row").agg(F.sum("hits").alias("n_hit"))
    item_sets = occurs.distinct().join(named, "rid").groupBy("__row") \
        .agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    return marked.drop("__runs").join(n_hit, "__row", "left").join(item_sets, "__row", "left").drop("__row") \
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0))) \
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
