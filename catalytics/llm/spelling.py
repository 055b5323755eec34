"""Spelling variant grouping (operator 13).

Words of a corpus that differ by one inserted, deleted or replaced letter are
near; a word's form is its near word that is used most, if at least twice as
often.

Candidates come from PartEnum signatures. A word's letters are a multiset,
that is a binary vector with a dimension for the k-th use of a letter. One
replaced letter is a Hamming distance of two between vectors of equal size,
one inserted letter a distance of one between sizes that differ by one. The
letters are dealt into parts of equal use; vectors within distance d agree on
all parts but d. So a signature is a vector without d of the parts, for every
choice of d, together with the size; vectors within distance d have a
signature in common, always. Signatures are made for distinct vectors only
(permuted letters share one) and equi-joined; pairs whose sorted letters are
near enough become pairs of words, and those whose edit distance is one stay.

Counting is one pass over the texts with counts merged in the task, then a
grouped sum. Everything after it works on distinct words, in shuffled joins:
a few MB of files hold a million words or vectors, and a vector has up to 15
signatures, so no side is broadcast by the size of its files.

Defined results: a null or empty text has no words; a text of any length is
read whole, in pieces; a null id is written as the empty string; rows that
repeat an id count each time; of equally common near words the smallest is
taken; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import persisted
from catalytics.llm.text_batches import ASCII_LOWER, cut
from catalytics.plans import spread

#: Parts of the letters for pairs of equal and of different length.
EQUAL_PARTS, LONGER_PARTS = 6, 4
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 300_000
_GAP = re.compile(rb"[\x00-\x60\x7b-\x7f]")


def _runs(least: int) -> re.Pattern[bytes]:
    """Maximal runs of a-z and U+00C0 to U+00FF, in UTF-8, of ``least``
    letters or more."""
    return re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % least)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5,
                min_count: int = 3, slip_every: int = 97) -> DataFrame:
    """(word, n): lower-cased runs of letters with at least ``min_chars`` and
    ``min_count`` uses. A use whose crc32 of ``<id>:<run>`` is divisible by
    ``slip_every`` loses one letter first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _runs(min_chars)
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = [w.decode() for w in held]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for b in batches:
            for name, text in zip(b.column("name").to_pylist(), b.column("text")):
                seed = crc32(name + b":")
                for piece in cut((text.as_py() or b"").translate(ASCII_LOWER), _GAP):
                    words = pattern.findall(piece)
                    hashes = np.fromiter(map(crc32, words, repeat(seed)), np.int64, len(words))
                    for i in np.flatnonzero(hashes % slip_every == 0).tolist():
                        letters = words[i].decode()
                        drop = int(hashes[i]) % len(letters)
                        words[i] = (letters[:drop] + letters[drop + 1:]).encode()
                    held.update(words)
                    if len(held) >= HELD_WORDS:
                        yield flush()
        yield flush()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary").alias("name"),
                       F.col(text_col).cast("binary").alias("text"))
    parts = rows.mapInArrow(count, "word string, n long").where(F.length("word") >= min_chars)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def deal_letters(vectors: DataFrame, n_parts: int) -> list[str]:
    """The letters in ``n_parts`` parts of about equal use. Collects one row a
    letter: 90 at most in the alphabet of ``count_words``."""
    used = vectors.select(F.explode(F.split("vec", "")).alias("c")) \
        .where(F.col("c") != "").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()
    parts, load = [""] * n_parts, [0] * n_parts
    for r in sorted(used, key=lambda r: (-r["n"], r["c"])):
        i = load.index(min(load))
        parts[i] += r["c"]
        load[i] += r["n"]
    return parts


def _signatures(size: Column, parts: list[str], distance: int) -> Column:
    """One 64-bit digest for each choice of ``distance`` parts: the choice, the
    size and the sorted letters of the other parts."""
    chosen = list(combinations(range(len(parts)), distance))
    return F.explode(F.array(*[F.xxhash64(F.lit(k), size, F.translate("vec", "".join(parts[i] for i in c), ""))
                               for k, c in enumerate(chosen)])).alias("sig")


def near_vectors(vectors: DataFrame, equal_parts: list[str], longer_parts: list[str]) -> DataFrame:
    """(a, b): pairs of letter multisets, as sorted strings, that one replaced
    letter (a < b) or one letter added to ``a`` can part. Words with the same
    letters in another order are never one letter apart."""
    size = F.length("vec")
    equal = vectors.select(_signatures(size, equal_parts, 2), "vec")
    a, b = equal.withColumnRenamed("vec", "a"), equal.withColumnRenamed("vec", "b")
    # sorted strings of two multisets at distance two are two edits apart
    same = a.join(spread(b), "sig").where((F.col("a") < F.col("b")) & (F.length("a") == F.length("b"))
                                  & (F.levenshtein("a", "b", 2) >= 0))
    short = vectors.select(_signatures(size, longer_parts, 1), F.col("vec").alias("a"))
    long = vectors.select(_signatures(size - 1, longer_parts, 1), F.col("vec").alias("b"))
    longer = short.join(spread(long), "sig").where((F.length("a") + 1 == F.length("b")) & (F.levenshtein("a", "b", 1) == 1))
    return same.select("a", "b").unionByName(longer.select("a", "b")).distinct()


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): both directions of every near pair."""
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    members = vocabulary.select(letters.alias("vec"), "word", "n")
    vectors = persisted(members.select("vec").distinct(), "spelling-vectors")
    pairs = near_vectors(vectors, deal_letters(vectors, EQUAL_PARTS), deal_letters(vectors, LONGER_PARTS))
    left = members.select(F.col("vec").alias("a"), F.col("word").alias("w"), F.col("n").alias("wn"))
    right = members.select(F.col("vec").alias("b"), F.col("word").alias("v"), F.col("n").alias("vn"))
    found = pairs.join(spread(left), "a").join(spread(right), "b").where(F.levenshtein("w", "v", 1) == 1)
    both = F.array(F.struct(F.col("w").alias("word"), F.col("wn").alias("n"), F.col("v").alias("near"), F.col("vn").alias("near_n")),
                   F.struct(F.col("v").alias("word"), F.col("vn").alias("n"), F.col("w").alias("near"), F.col("wn").alias("near_n")))
    return found.select(F.inline(both))


def choose_forms(vocabulary: DataFrame, near: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest n, the
    smallest of several, if its n is at least twice the word's."""
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near").alias("near"))).alias("best"))
    out = vocabulary.join(spread(best), "word", "left")
    form_n = -F.col("best.k")
    good = form_n >= 2 * F.col("n")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.when(good, F.col("best.near")).alias("form"), F.when(good, form_n).alias("form_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root``. Each round replaces a word's furthest known form by the
    furthest known form of that one, so the reach doubles; n at least doubles
    along a chain, so six rounds reach the end of any chain of 64-bit counts.
    The loop ends with the first round that moves nothing."""
    links = persisted(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        step = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = persisted(links.join(spread(step), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-links")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return forms.join(spread(links), "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_spellings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5,
                    min_count: int = 3, slip_every: int = 97) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row a word."""
    vocabulary = persisted(count_words(docs, id_col, text_col, min_chars, min_count, slip_every), "spelling-words")
    forms = persisted(choose_forms(vocabulary, near_words(vocabulary)), "spelling-forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
