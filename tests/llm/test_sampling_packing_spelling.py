"""Importance resampling, best-fit packing and spelling groups against brute
force, with the edge cases that their docstrings define."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catalytics.llm import packing, resampling, spelling
from catalytics.llm.queries import BYTE_TOKENIZER, QUERIES
from catalytics.llm.text_batches import ASCII_LOWER, cut, grouped
from catalytics.session import scratch_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, id int, n int, word string, part int, bucket int, length int, score int"
LONG = "Ab cd é " * 20_000
EDGE = [(1, None), (2, ""), (3, " \n\t\n"), (4, "İ Σ é́ <|endoftext|> don't\x00stop 12²"), (5, "same text here"),
        (6, "same text here"), (7, "x" * 30_000), (8, LONG), (8, LONG), (None, "a text without an id " * 9),
        (9, "Straße ÀÉÎ éèê ÷× word's")]


def low(s):
    return "".join(c.lower() if c < "\x80" else c for c in s or "")


def make(spark, rows):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, 1, 2, "w", 3, 4, 5, 6) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def real(spark, sf_small):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]


# 11 ----------------------------------------------------------------------

def brute_features(text, max_n=2):
    w = WORD.findall(low(text))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000 for n in range(1, max_n + 1)
                    for i in range(len(w) - n + 1)]


def brute_resample(rows, target, percent=25):
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(brute_features(x)[1])
    for x in target:
        t.update(brute_features(x)[1])
    S, T = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000))))

    out = []
    for i, x in rows:
        n, f = brute_features(x)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:25 * len(able) // 100 if percent == 25 else percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(tuple(map(str, r[:5])) for r in out)


def resampled(df):
    return sorted(tuple(map(str, r)) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_resampling_matches_brute_force(spark, sf_small, real):
    target = [r["text"] for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    got = QUERIES["op11_importance_resampling"](spark, sf_small)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert resampled(got) == brute_resample(real, target)


def test_resampling_edge_cases(spark):
    target = spark.createDataFrame([(1, "same text here"), (2, None)], "item_id long, text string")
    rows = EDGE + [(i, "one two three four five " * 5 + str(i % 3)) for i in range(20, 60)]
    got = resampling.resample(make(spark, rows), target, percent=100)
    want = brute_resample(rows, ["same text here", None], 100)
    # rows of one id have equal scores and texts here, so their ranks are the same set
    assert resampled(got) == want
    ranks = sorted(r["rank"] for r in got.collect() if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1))


def test_resampling_empty_tables(spark):
    target = spark.createDataFrame([], "item_id long, text string")
    assert resampled(resampling.resample(make(spark, EDGE).limit(0), target)) == []
    assert resampled(resampling.resample(make(spark, EDGE), target)) == brute_resample(EDGE, [])


def test_features_of_a_text_in_pieces():
    rng = random.Random(3)
    text = " ".join(rng.choice(["Alpha", "b", "çà", "9"]) for _ in range(1_200_000))
    n, buckets = brute_features(text, 3)
    got = list(resampling.features([b"lead in", text.encode(), None], 10_000, 3))
    assert len(got) > 1  # really in pieces
    rows, found, words = (np.concatenate(x) for x in zip(*got))
    assert Counter(found[rows == 1].tolist()) == Counter(buckets) and (words == 1).sum() == n
    assert (rows == 0).sum() == 3 and not (rows == 2).any()


def test_cut_and_grouped():
    data = b"ab cd\xc3\xa9f gh  ijklmnop qr"
    for limit in range(1, 30):
        pieces = list(cut(data, re.compile(rb" "), limit))
        assert b"".join(pieces) == data and all(p.endswith(b" ") for p in pieces[:-1])
    assert [len(g) for g in grouped([(b"aaa", 1), (b"bb", 2), (b"cccccc", 3), (b"", 4)], 5)] == [2, 1, 1]
    assert bytes(range(256)).translate(ASCII_LOWER) == bytes(range(256)).lower()


# 12 ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(BYTE_TOKENIZER))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def check_packing(rows, want, capacity, ids_of):
    """``want``: (id, ids) of every document; rows of placed pieces."""
    docs = defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
    expected, got = Counter(), Counter()
    for i, ids in want:
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        expected.update((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    got.update((r["doc_id"], r["piece"], r["start"], r["length"], ids_of(r)) for r in rows)
    assert got == expected
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_packing_query(spark, sf_small, real, library):
    got = QUERIES["op12_best_fit_packing"](spark, sf_small)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    want = [(i, library(t)) for i, t in real]
    n = check_packing(rows, want, 2048, lambda r: r["ids_crc32"])
    lengths = [r["length"] for r in rows]
    assert math.ceil(sum(lengths) / 2048) <= n <= best_fit_decreasing(lengths, 2048)


def test_packing_edge_cases_and_sequences(spark, library):
    capacity = 64
    placed = packing.pack(make(spark, EDGE), scratch_path(spark, "t-pieces"), public_tokenizers.path(BYTE_TOKENIZER),
                          public_tokenizers.PATTERN, capacity)
    rows = placed.collect()
    check_packing(rows, [(i, library(t)) for i, t in EDGE], capacity, lambda r: zlib.crc32(r["ids"]))
    whole = {r["sequence_id"]: r for r in packing.sequences(placed).collect()}
    for r in rows:
        s = whole[r["sequence_id"]]
        assert len(s["ids"]) == 4 * s["length"] <= 4 * capacity
        assert s["ids"][4 * r["offset"]:4 * (r["offset"] + r["length"])] == r["ids"]


def test_packing_empty_table(spark):
    out = packing.pack(make(spark, EDGE).limit(0), scratch_path(spark, "t-pieces"), public_tokenizers.path(BYTE_TOKENIZER),
                       public_tokenizers.PATTERN)
    assert out.collect() == []


def test_fullest_matches_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        counts = {rng.randrange(1, 25): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(0, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        chosen = packing.fullest(sorted(counts), counts, room)
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= room)
        assert all(0 < k <= counts[n] for n, k in chosen.items())


def test_plan_is_bounded_and_near_the_lower_bound():
    rng = random.Random(2)
    for scale in (1, 1000):
        counts = Counter(min(511, int(rng.lognormvariate(4.5, 1)) + 1) for _ in range(5000))
        counts = {n: c * scale for n, c in counts.items()}
        plan, bins = packing.plan_bins(counts, 512)
        bound = math.ceil(sum(n * c for n, c in counts.items()) / 512)
        assert bound <= bins <= bound * 1.002 + 1
        assert len(plan) < 512 * 30  # does not grow with the number of pieces


def test_encoder_equals_the_library(spark, library):
    enc = packing.ByteEncoder(public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.PATTERN)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(4)
    texts = ["a%s1 %s!%s  %sb\n%s \t%s" % ((chr(c),) * 6) for c in [*range(0x600), *rng.sample(points, 3000)]]
    texts += ["<|endoftext|>", "a<|endoftext|> b", "x" * 5000, " " * 3000, "\n" * 500 + "q", "'s 'T they'll"]
    for t in texts:
        assert enc.ids(t).tolist() == library(t)[:-1]


# 13 ----------------------------------------------------------------------

def brute_words(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_spelling(n):
    holes = defaultdict(set)  # words that share a word with one letter left out, or are it
    for w in n:
        holes[w].add(w)
        for i in range(len(w)):
            holes[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(map(str, out))


def grouped_words(df):
    return sorted(str(tuple(r)) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_spelling_query(spark, sf_small, real):
    want = brute_spelling(brute_words(real))
    assert sum("None" not in x for x in want) > 100
    assert grouped_words(QUERIES["op13_spelling_variants"](spark, sf_small)) == want


def test_spelling_edge_cases(spark):
    rng = random.Random(6)
    chain = ["colour", "color", "colo", "coloor", "colours", "colouers", "rouloc"]
    rows = EDGE + [(i, " ".join(w for k, w in enumerate(chain) for _ in range(rng.randrange(1, 3 ** (k % 4) + 1)))) for i in range(100, 160)]
    rows += [(i, "éèàùç éèàùx ÉÈàùç anagram gramana margana aaaaa aaaab") for i in range(200, 206)]
    assert grouped_words(spelling.group_spellings(make(spark, rows))) == brute_spelling(brute_words(rows))


def test_spelling_of_dense_random_words(spark):
    """Few letters, so that vectors, parts and forms collide all the time."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(5, 9))) for _ in range(700)]
    rows = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=300))) for i in range(60)]
    n = brute_words(rows)
    got = spelling.group_spellings(make(spark, rows))
    assert len(n) > 300 and grouped_words(got) == brute_spelling(n)


def test_spelling_empty_table(spark):
    assert spelling.group_spellings(make(spark, EDGE).limit(0)).collect() == []
    assert spelling.group_spellings(make(spark, EDGE[:3])).collect() == []


def test_signature_letters_are_dealt_once(spark):
    vectors = spark.createDataFrame([("aabc",), ("bcdé",), ("aabd",), ("aabcz",), ("zzzz",)], "vec string")
    three, two = spelling.deal_letters(vectors, 3), spelling.deal_letters(vectors, 2)
    assert sorted("".join(three)) == sorted("".join(two)) == sorted("abcdéz") and len(three) == 3
    pairs = spelling.near_vectors(vectors, three, two)
    assert {(r["a"], r["b"]) for r in pairs.collect()} >= {("aabc", "aabd"), ("aabc", "aabcz")}


def test_growing_words_are_not_broadcast(spark, monkeypatch):
    """A few MB of files hold a million words, and each vector has many
    signatures: every join, also those whose results are written, is shuffled."""
    plans = []
    kept = spelling.persisted

    def seen(df, name):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(spelling, "persisted", seen)
    words = ["colour", "color", "colours", "anagram", "anagrams", "anagra"]
    rows = [(i, " ".join(w for k, w in enumerate(words) for _ in range(3 ** (k % 3)))) for i in range(20)]
    out = spelling.group_spellings(make(spark, rows))
    assert out.where("form IS NOT NULL").count() > 0
    plans.append(out._jdf.queryExecution().sparkPlan().toString())
    assert not any("Broadcast" in p for p in plans) and sum(p.count("SortMergeJoin") for p in plans) >= 7


# 4: the encoder's short cut for plain words -------------------------------

def test_token_store_encoder_equals_the_library():
    from catalytics.llm.queries import tokenizer_path
    from catalytics.llm.token_store import LibraryEncoder

    path = tokenizer_path()
    whole = Tokenizer.from_file(path)
    rng = random.Random(11)
    points = [*range(0x600), *rng.sample([c for c in range(0x600, 0x110000) if not 0xD800 <= c < 0xE000], 3000)]
    texts = ["%s a%s %sb c%sd. %s!" % ((chr(c),) * 5) for c in points]
    texts += ["<|endoftext|> x", "x<|endoftext|>. y", "a \x01 b", "K Å ẞ ẞa İi ŸŸ ÀÉ.,; é́ ñ̃ x'", "don't DON'T it's. 'S we're,", "É" * 300]
    enc = LibraryEncoder(path)
    for _ in range(2):  # the second time from memory
        for got, e in zip(enc.encode_all(texts), whole.encode_batch(texts, add_special_tokens=False)):
            assert got.tolist() == e.ids


@pytest.mark.parametrize("name, bound", [("MEMO_PIECES", 3), ("MEMO_CHARS", 50), ("MEMO_PIECES", 600_000)])
def test_token_store_encoder_that_forgets(monkeypatch, name, bound):
    """Pieces go and come back; batches of one text and of many agree."""
    from catalytics.llm import token_store
    from catalytics.llm.queries import tokenizer_path

    monkeypatch.setattr(token_store, name, bound)
    whole = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(12)
    pool = ["the", "The", "THE.", "cat,", "Ünder", "don't", "3.5", "...", "x" * 3000, "İ", "\u212a", "\u1e9e", "end)."] + \
        ["w%s" % "abcdefgh"[i % 8] * (1 + i % 5) for i in range(30)]
    texts = [rng.choice([" ", "\n", "  ", "\x0b"]).join(rng.choices(pool, k=rng.randint(0, 12))) for _ in range(200)]
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    enc = token_store.LibraryEncoder(tokenizer_path())
    for size in (1, 7, 200):
        got = [ids.tolist() for at in range(0, len(texts), size) for ids in enc.encode_all(texts[at:at + size])]
        assert got == want


def test_token_store_with_null_and_repeated_ids(spark):
    from catalytics.llm import token_store
    from catalytics.llm.queries import tokenizer_path

    whole = Tokenizer.from_file(tokenizer_path())
    path = scratch_path(spark, "t-shards")
    token_store.write_shards(make(spark, EDGE), path, tokenizer_path(), 2, shard_tokens=500)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_store.read_documents(spark, path).collect()),
                 key=lambda r: r[1])
    at, want = 0, []
    for i, t in sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


# 5: a ledger that two writers filled --------------------------------------

def test_ledger_pairs_written_twice(spark):
    from catalytics.llm import secrets

    rows = [(1, "password=abcdef12"), (2, "nothing"), (3, "password=abcdef12"), (3, "password=abcdef12"), (None, None)]
    path = scratch_path(spark, "t-ledger")
    first = sorted(map(str, secrets.scan_versions(make(spark, rows), path).collect()))
    again = spark.read.parquet(path)
    again.write.mode("append").partitionBy("rule_version").parquet(path)  # the other writer's rows
    more = make(spark, [*rows, (4, "token: zzzzzzzz")])
    got = sorted(map(str, secrets.scan_versions(more, path).collect()))
    assert len(first) == 5 and len(got) == 6 and set(first) < set(got)
