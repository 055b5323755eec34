"""Operators against brute force on small data, with the edge cases that the
docstrings define: nulls, empty and long texts, ties, repeated rows, empty
tables and extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalytics.llm import (bpe, decontaminate, licenses, line_dedup, near_dup, quality, secrets, sharding,
                            token_store, toxicity)
from catalytics.llm.oracle import ORACLES
from catalytics.llm.queries import QUERIES, tokenizer_path
from catalytics.session import scratch_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, source string, n_tokens int, id int, run string, shard string"


def low(s):
    return "".join(c.lower() if c < "\x80" else c for c in s or "")


def make(spark, texts, schema=SCHEMA):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, f"h{(i or 0) % 2}", 7, 8, "x", "y") for i, t in texts], schema).repartition(3)


@pytest.fixture(scope="module")
def rng():
    return random.Random(5)


def prose(rng, n, vocabulary=300):
    return " ".join("w%d" % rng.randrange(vocabulary) for _ in range(n))


EDGE = [(1, None), (2, ""), (3, " \n\t\n"), (4, "é́ ΑΣ İ <|endoftext|> don't 12²"), (5, "same text"), (6, "same text"),
        (7, "x" * 30_000), (8, "a " * 20_000), (8, "a " * 20_000)]


@pytest.fixture(scope="module")
def real(spark, sf_small):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]


# 1 -----------------------------------------------------------------------

def brute_lines(rows):
    key = lambda x: low(x).strip(" \t\n\x0b\x0c\r")
    holders = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20 and i is not None:
                holders.setdefault(k, set()).add(i)
    gone = {k: max(h) for k, h in holders.items() if len(h) >= 3}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) in gone and i is not None and i < gone[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [1 << 18, 1 << 28])
def test_line_dedup(spark, rng, bits):
    pool = ["  Line %d of the Common Pool é\t" % i for i in range(12)] + ["LINE 3 of the common pool é", "short", ""]
    rows = EDGE + [(20 + i, "\n".join(rng.choices(pool, k=rng.randint(1, 9)))) for i in range(60)] + [(None, pool[0])]
    got = line_dedup.dedup_lines(make(spark, rows), max_bits=bits)
    assert {"n_tokens", "run", "shard"} < set(got.columns)
    assert sorted([(r["doc_id"], *r["lines"]) for r in got.collect()], key=str) == brute_lines(rows)


REPEATS = [(1, "a line that two ids hold\nx"), (1, "a line that two ids hold"), (2, "a line that two ids hold"),
           (3, "a line that three ids hold"), (4, "A line that three ids hold "), (5, "y\na line that three ids hold"),
           (5, "a line that three ids hold"), (None, "a line that two ids hold"), (None, "a line that three ids hold")]


@pytest.mark.parametrize("parts", [1, 4, 65_536])
def test_line_dedup_repeated_ids_and_hot_lines(spark, rng, parts):
    rows = REPEATS + [(10 + i, f"a line that a third of all rows hold\nline of its own number {i % 50:08d}") for i in range(200)]
    got = line_dedup.dedup_lines(make(spark, rows), hot_parts=parts)
    assert sorted([(r["doc_id"], *r["lines"]) for r in got.collect()], key=str) == brute_lines(rows)


def test_line_dedup_is_its_sql(spark, tmp_path):
    import duckdb

    make(spark, EDGE + REPEATS).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op1_line_dedup"](spark, str(tmp_path)).collect()
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = con.execute(ORACLES["op1_line_dedup"]).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_line_dedup_saturated_filter(spark, rng):
    """A filter far too small only sends more lines to the exact count."""
    line_dedup.CHUNK_BITS, old = 64, line_dedup.CHUNK_BITS
    try:
        rows = [(i, "\n".join("line number %030d" % rng.randrange(200) for _ in range(20))) for i in range(50)]
        got = line_dedup.dedup_lines(make(spark, rows), max_bits=64)
        assert sorted([(r["doc_id"], *r["lines"]) for r in got.collect()], key=str) == brute_lines(rows)
    finally:
        line_dedup.CHUNK_BITS = old


# 2 -----------------------------------------------------------------------

def test_license_canonical_forms(spark):
    mit = licenses.KNOWN["MIT"]
    changed = mit.replace("Copyright (c) <year> <copyright holders>", "// Copyright 2019-2021 A. Person\n# (c) 2020 B") \
        .replace("sublicense", "SUBLICENCE").replace('"', "“").replace("\n\n", "\r\n * \r\n")
    rows = [(1, mit), (2, changed), (3, mit + " and more"), (4, "a story\nReleased under the MIT licence!\nthe end"),
            (5, None), (6, ""), (7, "intro\n\n" + mit.split("\n\n", 2)[2] + "\n\nend"),
            (8, licenses.KNOWN["Apache-2.0-header"].replace("http:", "https:")), (4, "Licensed under CC BY-NC 4.0.\nx\nLicensed under CC BY-NC 4.0")]
    got = licenses.scan_licenses(make(spark, rows), licenses.known_digests(spark)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["license"], r["n_notices"], r["notices"]))
    assert by[1][0][0] == by[2][0][0] == "MIT" and by[3][0][0] is None
    assert sorted(by[4]) == [(None, 1, "MIT-notice"), (None, 2, "CC-BY-NC-4.0-notice")] or \
        sorted(by[4], key=str) == [(None, 1, "MIT-notice"), (None, 2, "CC-BY-NC-4.0-notice")]
    assert by[5] == by[6] == [(None, 0, "")] and by[8][0][0] == "Apache-2.0-header"


def test_license_inside_a_document(spark):
    mit, zlib_, apache = (licenses.KNOWN[k] for k in ("MIT", "Zlib", "Apache-2.0-header"))
    body = mit.split("\n\n", 2)[2]
    rows = [(7, "intro\n\n" + body + "\n\nend"), (1, "# Project\n\n" + mit + "\n\nusage\nmore"), (2, body),
            (3, "The MIT License (MIT)\n\nCopyright (c) 2020 A\n\n" + body), (4, body + "\n\n---\n\n" + zlib_ + "\n\n" + mit),
            (5, "/*\n * Copyright 2020 A\n *\n * " + apache.replace("\n", "\n * ") + "\n */\npackage a;\n\nclass B {}"),
            (6, "intro\n\n" + "\n\n".join(body.split("\n\n")[:2]) + "\n\nend"),
            (8, "intro\n\nReleased under the\nMIT License.\n\nReleased under the MIT License.\n\nend"),
            (9, "Title\n\n" + licenses.KNOWN["BSD-3-Clause"].split("\n\n", 2)[2]), (10, "intro\n\nMIT License\n" + body.replace(". ", ".\n"))]
    got = {r["doc_id"]: (r["license"], r["n_notices"], r["notices"]) for r in
           licenses.scan_licenses(make(spark, rows), licenses.known_digests(spark)).collect()}
    assert got == {7: (None, 1, "MIT"), 1: (None, 1, "MIT"), 2: ("MIT", 0, ""), 3: ("MIT", 0, ""),
                   4: (None, 3, "MIT,Zlib"), 5: (None, 1, "Apache-2.0-header"), 6: (None, 0, ""),
                   8: (None, 2, "MIT-notice"), 9: (None, 1, "BSD-3-Clause"), 10: (None, 1, "MIT")}


# 3 -----------------------------------------------------------------------

def test_quality_base(spark, real):
    rows = EDGE + [(100 + i, t) for i, t in real]
    for r in quality.judge(make(spark, rows)).collect():
        t = dict(rows)[r["doc_id"]] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        twice = {w for w in set(windows) if len(windows) < 5000 and windows.count(w) > 1 or len(windows) >= 5000}
        hit = {p for i, w in enumerate(windows) if w in twice for p in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(hit) > 50 * len(words))


def test_quality_line_frequency(spark, rng):
    boiler = "accept all cookies now " + " ".join("b%d" % i for i in range(60))
    rows = [(i, boiler + "\n" + prose(rng, 10, 9999)) for i in range(0, 60, 2)] + [(i, prose(rng, 80, 9999)) for i in range(61, 121, 2)]
    rows += [(200 + 2 * i, "a copied text " + prose(random.Random(1), 70, 9999)) for i in range(30)]  # exact copies count once
    got = {r["doc_id"]: r for r in quality.judge(make(spark, rows)).collect()}
    assert not any(got[i]["kept"] for i in range(0, 60, 2)) and got[0]["n_removed_lines"] == 1
    assert all(got[i]["kept"] for i in got if i > 60)


def test_quality_limit_of_a_large_host_and_short_lines(spark):
    """A line of 12 documents goes from a host of 3,000 too, whatever its length."""
    rows = [(2 * i, ("the boilerplate line of twelve documents\nHome\n" if i < 12 else "é\n" if i < 22 else "") + f"text number {i} of this host")
            for i in range(3000)]
    got = {r["doc_id"] // 2: r["n_removed_lines"] for r in quality.judge(make(spark, rows)).collect()}
    assert got == {i: 2 if i < 12 else 0 for i in range(3000)}


# 4 -----------------------------------------------------------------------

def test_wavelet_matrix(rng):
    x = np.array([rng.choice([0, 1, 2, 500, 65535, rng.randrange(65536)]) for _ in range(3000)], np.uint32)
    w = token_store.WaveletMatrix.build(x, 16)
    w = token_store.WaveletMatrix(len(x), [p.tobytes() for p in w.planes], [r.tobytes() for r in w.ranks], w.zeros)
    assert (w.values() == x).all()
    for i in range(0, 3000, 37):
        v = int(x[i])
        where = np.flatnonzero(x == v)
        assert w.access(i) == v and w.count(v) == len(where) and w.count(v, i // 2, i) == (x[i // 2:i] == v).sum()
        k = rng.randrange(len(where))
        assert w.select(v, k) == where[k] and w.select(v, len(where)) == -1
    assert w.count(1 << 16) == 0 and w.count(7) == (x == 7).sum()


@pytest.mark.parametrize("bound", [50, 2_000_000])
def test_token_store(spark, real, bound):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    rows = [(i - 4, t) for i, t in EDGE[:7]] + [(100 + i, t) for i, t in real]
    path = scratch_path(spark, "t")
    token_store.write_shards(make(spark, rows), path, tokenizer_path(), 2, shard_tokens=bound)
    got = token_store.read_documents(spark, path).orderBy("start").collect()
    want, at = [], 0
    for i, t in sorted(rows):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert [tuple(r)[:4] for r in got] == want
    names = [r["shard"] for r in got]
    assert names == sorted(names)


# 5 -----------------------------------------------------------------------

def brute_secrets(t):
    t = t or ""
    out = [("assign", m) for m in re.finditer(
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t)
        if len(m[2]) >= 6]
    out += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", m) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    out.sort(key=lambda x: (x[1].start(), ["assign", "access", "hex"].index(x[0])))
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


def test_secrets_query(spark, tmp_path, real):
    odd = ["é password='abcdef' TOKEN : xyz token=abc secret==abcdefg", "api_key=token:token:abcdefgh", "ſecret=abcdefgh",
           "AKIAAKIA" + "A" * 12 + " AKIA1234", "f" * 24 + "g" + "0" * 23, "secret=" + "0" * 30]
    rows = EDGE[:7] + [(50 + i, t) for i, t in enumerate(odd)] + [(100 + i, t) for i, t in real]
    make(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op5_secret_scan"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        spans = brute_secrets(t)
        assert got[i]["spans"] == spans and got[i]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert got[i]["n_hex"] == spans.count("hex:") and got[i]["n_assign"] == spans.count("assign:")


@pytest.mark.parametrize("parts", [1, 3, 8192])
def test_secrets_of_hot_blobs(spark, parts):
    rows = [(i, "secret=abcdefg" if i % 2 else f"token=abcdef{i % 9}") for i in range(60)] + [(None, "plain"), (1, "plain")]
    got = secrets.scan_versions(make(spark, rows), scratch_path(spark, "ledger"), hot_parts=parts).collect()
    assert sorted([(r["doc_id"], len(r["findings"])) for r in got], key=str) == \
        sorted([(i, int(t != "plain")) for i, t in rows], key=str)


def test_secret_ledger_is_incremental(spark):
    path = scratch_path(spark, "ledger")
    first = make(spark, [(1, "secret=abcdefg"), (2, "secret=abcdefg"), (3, "plain")])
    assert secrets.scan_versions(first, path).count() == 3
    assert secrets.ledger(spark, path, "1").count() == 2
    both = make(spark, [(1, "secret=abcdefg"), (4, "token=abcdefg"), (5, "plain")])
    got = {r["doc_id"]: len(r["findings"]) for r in secrets.scan_versions(both, path).collect()}
    assert got == {1: 1, 4: 1, 5: 0}
    assert secrets.ledger(spark, path, "1").count() == 3  # one blob was new
    secrets.scan_versions(both, path, rules="2")
    assert secrets.ledger(spark, path, "2").count() == 3 and secrets.ledger(spark, path, "1").count() == 3


# 6 -----------------------------------------------------------------------

def shingle_set(t, counted=True):
    w = WORD.findall(low(t))
    k = min(5, len(w))
    found = Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()
    return found if counted else Counter(set(found))


def brute_classes(rows, counted=True):
    sets = {i: shingle_set(t, counted) for i, t in rows}
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 1.8 * (x & y).total() >= 0.8 * (x.total() + y.total()) - 1e-9:
                p, q = find(a), find(b)
                comp[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def near_rows(rng):
    rows, n = [], 0
    for size in (2, 3, 40):
        base = prose(rng, 200).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = "edit%d" % rng.randrange(50)
            rows.append((n, " ".join(w) + rng.choice(["", ".", "!\n"])))
            n += 1
    chain = prose(rng, 300).split()
    for step in range(8):  # neighbours alike, ends not
        rows.append((n, " ".join(chain[step * 12:step * 12 + 150])))
        n += 1
    return rows + [(100 + i, prose(rng, rng.randint(1, 200), 5000)) for i in range(60)] + \
        [(200, None), (201, ""), (202, "one two"), (203, "One, two"), (204, "two one"), (205, "..."), (206, "w " * 9000), (207, "w " * 9000)]


@pytest.mark.parametrize("counted, parts", [(True, 65_536), (False, 65_536), (True, 4)])
def test_near_duplicates(spark, rng, counted, parts):
    rows = near_rows(rng)
    # a refrain: equal sets of shingles, but not equal numbers
    verse, more = prose(rng, 40, 5000), prose(rng, 30, 5000)
    rows += [(300, verse + " " + more), (301, " ".join([verse] * 3 + [more])), (302, " ".join([verse] * 3 + [more]) + " end"),
             (303, " ".join([verse] * 4 + [more]))]
    got = near_dup.near_duplicates(make(spark, rows), counted=counted, hot_parts=parts).collect()
    want = brute_classes(rows, counted)
    assert want[302] == want[301] and (want[301] == want[300]) != counted
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert all(r["class_size"] == sum(c == r["class_id"] for c in want.values()) for r in got) and len(got) == len(rows)


def test_near_duplicates_one_row_an_id(spark, rng):
    """Rows that share an id but differ: one of those with words counts."""
    rows = []
    for i in range(12):
        a, b = prose(rng, 120, 5000), prose(rng, 120, 5000)
        rows += [(i, None), (i, a), (i, "..."), (100 + i, a + " tail"), (200 + i, b + " tail"), (300 + i, a), (300 + i, b), (300 + i, "")]
    rows += [(400, None), (400, "")]
    texts = {}
    for i, t in rows:
        words = near_dup.shingles(t or "")[1]
        texts[i] = min(texts.get(i, (b"\xff" * 17, t)), (hashlib.md5(words).digest() if words else b"\xff" * 16, t or ""))
    want = brute_classes([(i, t) for i, (_, t) in texts.items()])
    assert all(want[100 + i] == i for i in range(12))
    for order in (rows, rows[::-1]):
        got = near_dup.near_duplicates(make(spark, order)).collect()
        assert {r["doc_id"]: r["class_id"] for r in got} == want and len(got) == len(want)


def test_long_signatures_skip_empty_sets(spark):
    full = near_dup.shingles("some words of one text")[0].astype("<u8").tobytes()
    sets = spark.createDataFrame([(1, bytearray()), (2, bytearray(full))], "id long, shingles binary").coalesce(1)
    assert [r["rep"] for r in near_dup.long_signatures(sets, 64).collect()] == [2]
    assert near_dup.long_signatures(sets.where("id = 1"), 64).count() == 0


def test_near_duplicates_real(spark, real):
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(make(spark, real)).collect()}
    assert got == brute_classes(real)


def test_dart_agreement_is_weighted_jaccard():
    """Share of equal coordinates against weighted Jaccard similarity."""
    r = np.random.default_rng(3)
    e = np.arange(400, dtype=np.uint64) * np.uint64(7919)
    a, b = r.integers(1, 9, 400).astype(float), r.integers(1, 9, 400).astype(float)
    t = 3000
    sig = near_dup.dart_minhash(np.concatenate([near_dup.mix(e)] * 2), np.concatenate([a, b]),
                                np.repeat([0, 1], 400), 2, t)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_components_of_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (300, 300), (150, 200)], "a long, b long")
    got = {r["id"]: r["comp"] for r in near_dup.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 150: 100, 200: 100}


# 7 -----------------------------------------------------------------------

def odd_texts(n=1500):
    r = random.Random(1)
    out = ["", "  ", "İstanbul ΑΣ ΟΔΟΣ", "a\x1cb c\x85d\xa0e", "<|endoftext|>foo<|startoftext|> <|endof text|>x<|endoftext|><|",
           "don't we'll I'M", "½ ² 12345 १२३", "a" * 50, "!" * 40 + "?" * 9, "日本語 ｶﾞ ﬀ Ǆ ß ẞ 👨‍👩", "\x00\x01\x7f", "a</w>b </w> <w>"]
    for _ in range(n):
        out.append("".join(r.choice("abcde'st  re\n\tÀéßñ1٣²<|>/w-–́ͅΣς\x1c\x85ŉǰ한글") for _ in range(r.randint(1, 60))))
        out.append("".join(chr(r.choice([r.randint(1, 0x24f), r.randint(1, 0xd7ff), r.randint(0xe000, 0x1ffff)])) for _ in range(20)))
    return out


def test_prefix_bpe_is_the_library(spark, real):
    from tokenizers import Tokenizer

    tok, own, lib = Tokenizer.from_file(tokenizer_path()), bpe.loaded(tokenizer_path()), token_store._encoder(tokenizer_path())
    for t in [t for _, t in real] + odd_texts():
        ids, decoded = own.encode(t)
        want = tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == tok.decode(want, skip_special_tokens=False)
        assert lib.encode_all([t])[0].tolist() == want
    every = odd_texts() + ["Word, word. WORD;! 12. a\x01b, \x01 , end."]
    fresh = token_store.LibraryEncoder(tokenizer_path())
    assert [x.tolist() for x in fresh.encode_all(every)] == [tok.encode(t, add_special_tokens=False).ids for t in every]


def test_bpe_frames(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    docs = make(spark, EDGE)
    for r in bpe.encode_texts(docs, tokenizer_path()).collect():
        want = tok.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["bpe"]["ids"], "<u4").tolist() == want and r["n_tokens"] == 7
        assert r["bpe"]["decoded"] == tok.decode(want, skip_special_tokens=False)
    d = bpe.encode_texts(docs.where("doc_id = 5"), tokenizer_path(), digests=True).first()["bpe"]
    want = tok.encode("same text", add_special_tokens=False).ids
    assert d["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest() and d["n_tokens"] == len(want)


# 8 -----------------------------------------------------------------------

@pytest.mark.parametrize("n, hot", [(3, 0), (4000, 0), (4000, 1500)])
def test_shards_are_near_equal(spark, rng, n, hot):
    rows = [(i, "hot " * 50 if i < hot else prose(rng, rng.choice([1, 5, 40, 400]))) for i in range(n)] + EDGE[:2]
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    docs = make(spark, rows)
    got = sharding.shard_by_bytes(docs, 8, F.col("text"), size, F.col("doc_id")).collect()
    assert len(got) == len(rows) and {r["run"] for r in got} == {"x"}
    loads = dict.fromkeys(range(8), 0)
    slots = {k: [] for k in loads}
    for r in got:
        loads[r["shard"]] += len((r["text"] or "").encode()) + 1
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if n > 100:
        assert max(loads.values()) < 1.05 * sum(loads.values()) / 8 and min(loads.values()) > 0.95 * sum(loads.values()) / 8


def test_overfull_ranges_are_parted(spark, rng):
    """Few first splitters: later rounds must part the ranges."""
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', cast(id as string)) as text")
    got = sharding.shard_by_bytes(docs, 4, F.col("text"), F.lit(10), F.col("doc_id"), ranges_per_shard=8)
    per = got.groupBy("range").count().agg(F.max("count")).first()[0]
    assert per <= sharding.OVERFULL * 3000 / 32 + 1


def test_ranges_follow_the_bytes_and_repeated_rows_end(spark):
    """A single sort key can't be parted; all around it is."""
    docs = spark.range(2000).selectExpr("if(id < 900, 7, id) as doc_id", "if(id < 900, 'one', cast(id % 50 as string)) as text")
    got = sharding.shard_by_bytes(docs, 4, F.col("text"), F.lit(10), F.col("doc_id"), ranges_per_shard=2, range_bytes=200)
    per = {r["range"]: r["count"] for r in got.groupBy("range").count().collect()}
    assert len(per) > 40 and sorted(per.values())[-1] == 900 and sorted(per.values())[-2] <= sharding.OVERFULL * 20 + 1
    slots = got.groupBy("shard").agg(F.count_distinct("slot"), F.max("slot") + 1, F.count("*")).collect()
    assert all(r[1] == r[2] == r[3] for r in slots) and sum(r[1] for r in slots) == 2000


def test_sharding_query(spark, tmp_path, real):
    rows = EDGE + [(100 + i, t) for i, t in real] + [(None, "no id")]
    make(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op8_sharding"](spark, str(tmp_path)).collect()
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    assert sorted([(r["doc_id"], r["size"], r["text_crc32"]) for r in got], key=str) == sorted(want, key=str)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)} and {r["shard"] for r in got} <= set(range(8))
    for k in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == k)
        assert slots == list(range(len(slots)))


# 9 -----------------------------------------------------------------------

def test_toxicity_sample_is_one_row_an_id(spark):
    docs = make(spark, [(1, f"text {i % 7}") for i in range(500)] + [(2, "clean"), (2, None), (3, None)])
    lab = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (4, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.training_sample(docs, lab) == (["", "clean", "text 0"], [0, 0, 1])


def test_toxicity_scores_are_the_model(spark, rng):
    model = toxicity.OrdinalModel([0.5, 1.0, 2.5], {"vile": 1.5, "^scum": 0.75}, cut=0.6)
    rows = EDGE + [(20, "Vile scummy"), (20, "Vile scummy"), (21, "scum"), (22, "vile " * 30_000), (None, "SCUMMY")]
    got = toxicity.grade_texts(make(spark, rows), model)
    assert {"n_tokens", "run", "shard"} < set(got.columns)

    def brute(t):
        w = set(re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low(t)))
        s = 1.5 * ("vile" in w) + 0.75 * sum(x.startswith("scum") and len(x) > 4 for x in w)
        p = [1 / (1 + math.exp(k - s)) for k in model.thresholds]
        each = [a - b for a, b in zip([1.0, *p], [*p, 0.0])]
        return round(sum(p), 6), round(p[0], 6), each.index(max(each)), s >= 0.6

    assert sorted([(r["doc_id"], *r["severity"]) for r in got.collect()], key=str) == \
        sorted([(i, *brute(t)) for i, t in rows], key=str)


def test_toxicity_grades_come_from_the_other_half(rng):
    texts = [prose(rng, 30, 500) + " vile" * (i % 2) + " scum grobian" * (i % 4 == 3) for i in range(800)]
    toxic = [i % 2 for i in range(800)]
    grade = toxicity.cross_grades(texts, toxic)
    assert set(grade[::2]) == {0} and set(grade[1::2]) <= {1, 2, 3}
    assert grade[3::4].mean() > grade[1::4].mean() + 0.5
    model = toxicity.fit(texts, toxic)
    assert model.thresholds == sorted(model.thresholds)


def test_toxicity_held_out(spark, rng):
    docs, labels = [], []
    for i in range(900):
        w = prose(rng, rng.randint(20, 200), 2000).split()
        bad = i % 4 == 0
        for _ in range(rng.randint(1, 8) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "Scum", "grobian" + rng.choice("abcdefghij") + "en"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad) if i < 600 else None))
    frame, lab = make(spark, docs + [(2000, None), (2001, "")]), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit_labels(frame, lab)
    got = {r["doc_id"]: r["severity"] for r in toxicity.grade_texts(frame, model).collect()}
    held = range(600, 900)
    right = sum(got[i]["rejected"] == (i % 4 == 0) for i in held) / len(held)
    assert right >= 0.98 and not got[2000]["rejected"] and not got[2001]["rejected"]
    assert model.thresholds == sorted(model.thresholds)
    one, many = "vile " + prose(rng, 50, 2000), "vile scum grobianaen " + prose(rng, 50, 2000)
    assert sum(model.exceed(many)) > sum(model.exceed(one))


def test_toxicity_without_classes(spark):
    docs = make(spark, EDGE[:3])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.grade_texts(docs, toxicity.fit_labels(docs, none)).collect()
    assert not any(r["severity"]["rejected"] for r in got) and {r["severity"]["expected"] for r in got} == {0.0}


# 10 ----------------------------------------------------------------------

def brute_items(rows, items):
    out = {}
    for i, t in rows:
        w = WORD.findall(low(t))
        hit, names = set(), set()
        for item, s in items:
            b = WORD.findall(low(s))
            n = min(10, len(b))
            wins = {tuple(b[j:j + n]) for j in range(max(1, len(b) - 9))} if b else set()
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in wins:
                    hit.update(range(p, p + n))
                    names.add(str(item))
        out[i] = (len(w), len(hit), sorted(names))
    return out


def test_stretches_are_linear_runs(spark, rng):
    """Runs of covered words, of one shingle length and of several; and long
    texts full of runs end soon."""
    def got(words, classes, held):
        bits = 1 << 16
        shingles = spark.createDataFrame([(list(h), len(h), len(h)) for h in held], "words array<string>, n int, k int")
        bitmap = decontaminate._bitmap(shingles, classes, bits)
        d = spark.createDataFrame([(words,)], "w array<string>")
        return [tuple(r) for r in d.select(decontaminate.stretches(F.col("w"), classes, bitmap, bits)).first()[0]]

    for classes in ([3], [1, 3], [1, 2, 3]):
        for _ in range(4):
            w = [rng.choice("abcd") for _ in range(60)]
            held = {tuple(rng.choice("abcd") for _ in range(k)) for k in classes for _ in range(1 if k < 3 else 12)}
            covered = {p + j for k in classes for p in range(len(w) - k + 1) if tuple(w[p:p + k]) in held for j in range(k)}
            runs = got(w, classes, held)
            assert {p for s, e in runs for p in range(s, e)} == covered
            assert all(a[1] <= b[0] for a, b in zip(runs, runs[1:]))
    many = got(["x", "a", "b", "c"] * 50_000, [3], {("a", "b", "c")})
    assert many == [(4 * i + 1, 4 * i + 4) for i in range(50_000)]


def test_bitmap_follows_the_shingles(spark):
    few = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    many = spark.createDataFrame([(1, " ".join("w%d" % i for i in range(30_000)))], "item_id long, text string")
    bits = [decontaminate.bitmap_bits(decontaminate.item_windows(b, "item_id", "text", 10, 3), [3]) for b in (few, many)]
    assert bits == [decontaminate.LEAST_BITS, 1 << 20]


@pytest.mark.parametrize("bits", [None, 1 << 20, 64])
def test_decontamination(spark, rng, bits):
    items = [(1, prose(rng, 30, 40)), (2, prose(rng, 10, 40)), (3, "Alpha beta!"), (4, "gamma"), (5, None), (6, ""),
             (7, "a a a a a a a a a a a a"), (11, prose(rng, 25, 40)), (12, "one two three four")]
    items.append((8, items[0][1]))
    rows = list(EDGE[:8])
    for i in range(60):
        w = prose(rng, rng.randint(0, 60), 40).split()
        for _ in range(rng.randint(0, 3)):
            b = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, max(0, len(b) - 9))
            at = rng.randint(0, len(w))
            w[at:at] = b[cut:cut + rng.randint(5, 30)]
        rows.append((100 + i, rng.choice([", ", " ", "\n"]).join(w)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_items(make(spark, rows), bench, bits=bits).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in got} == brute_items(rows, items)


# all ---------------------------------------------------------------------

def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    import corpus_pipeline

    for name, q in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
        assert q(spark, str(tmp_path)).count() == 0, name
