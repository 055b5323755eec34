"""BPE encoding and decoding by per-prefix dynamic programming (operator 7).

For a word of n symbols the encoder keeps, for every prefix, the one token
that ends the BPE encoding of that prefix. A token that matches a suffix of
the prefix (found by an automaton over the vocabulary) is that last token
exactly if it is *compatible* with the last token of the remaining, shorter
prefix: no merge crosses the joint between the two before both are complete.
Following the stored tokens back from the whole word gives the ids.

``encode_texts`` runs this inside Spark tasks on Arrow batches. White-space
delimited chunks never influence each other, so a task keeps a bounded memo
of chunk -> ids and runs the program only on chunks that it has not seen.

Defined results: null and empty texts give no ids and the empty decoding;
strings of special tokens in a text give their special id, as the tokenizers
library does; repeated rows are encoded like any other; extra columns of the
input are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

#: Chunks that one Python worker remembers; when full the memo starts anew.
MEMO_CHUNKS = 500_000
#: Offset that turns a byte symbol into the "last symbol of its word" form.
_LAST = 0x1000
_NEVER = math.inf


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 stands for itself, the rest follow from
    U+0100 in byte order."""
    out, extra = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


class PrefixBpe:
    """Encoder/decoder for a tokenizers file of the word-BPE kind: NFC, white
    space folding, lower case; words, digits and symbol runs; byte symbols
    with an end-of-word suffix."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = specials
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in specials.items()}
        self.chars = byte_symbols()
        # merges: rank of a pair, and birth rank and parts of each token
        self.rank: dict[int, int] = {}
        self.born: dict[int, int] = {i: -1 for i in vocab.values()}
        self.parts: dict[int, tuple[int, int]] = {}
        for r, (a, b) in enumerate(model["merges"]):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.rank[left << 20 | right] = r
            if whole not in self.parts:
                self.born[whole], self.parts[whole] = r, (left, right)
        self.matcher = ahocorasick.Automaton()
        for s, i in vocab.items():
            if s in specials or not s:
                continue
            if i in self.parts or len(s.removesuffix(self.suffix)) == 1:
                sym = self._symbols(s)
                self.matcher.add_word(sym, (i, len(sym)))
        self.matcher.make_automaton()
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, sorted(specials))) + ")") if specials else None
        # fixed value: the word pattern of the tokenizer file
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word_re = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"), regex.V1)
        library = Tokenizer.from_file(path)
        self.normal, self.words = library.normalizer, library.pre_tokenizer
        self.joints: dict[int, bool] = {}
        self.words_memo: dict[str, list[int]] = {}
        self.memo: dict[bytes, tuple[bytes, str]] = {}

    def _symbols(self, s: str) -> str:
        if s.endswith(self.suffix) and len(s) > len(self.suffix):
            s = s[: -len(self.suffix)]
            return s[:-1] + chr(ord(s[-1]) + _LAST)
        return s

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay apart when their joined
        symbols are encoded. Walks back in time along the two pieces that
        touch the joint; a merge of the two pieces, earlier than the merge
        that takes either of them away, would have crossed the joint."""
        key = left << 20 | right
        rank, born, parts = self.rank, self.born, self.parts
        left_ends = right_ends = _NEVER
        ok = True
        while True:
            k = rank.get(left << 20 | right)
            # of equal pairs the leftmost merges first
            if k is not None and k < left_ends and k <= right_ends:
                ok = False
                break
            if born[left] > born[right]:
                left_ends = born[left]
                left = parts[left][1]
            elif born[right] >= 0:
                right_ends = born[right]
                right = parts[right][0]
            else:
                break
        if len(self.joints) >= 1_000_000:
            self.joints.clear()
        self.joints[key] = ok
        return ok

    def word_ids(self, sym: str) -> list[int]:
        """Ids of one word given as symbols (its last one in "last" form)."""
        n = len(sym)
        last = [-1] * (n + 1)
        size = [0] * (n + 1)
        joints, fits = self.joints, self.fits
        done = -1
        for end, (token, length) in self.matcher.iter(sym):
            if done == end:
                continue
            start = end + 1 - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                ok = joints.get(before << 20 | token)
                if not (fits(before, token) if ok is None else ok):
                    continue
            done = end
            last[end + 1], size[end + 1] = token, length
        ids = []
        while n > 0:
            ids.append(last[n])
            n -= size[n]
        ids.reverse()
        return ids

    def plain_ids(self, s: str) -> list[int]:
        if s.isascii():
            pieces = self.word_re.findall(s.lower())
            if not s.isprintable():  # control characters have other symbols
                pieces = [self._bytes_to_symbols(x) for x in pieces]
        else:  # the Unicode tables of the tokenizer file's own library decide
            pieces = [x for x, _ in self.words.pre_tokenize_str(self.normal.normalize_str(s))]
        out: list[int] = []
        words = self.words_memo
        for sym in pieces:
            ids = words.get(sym)
            if ids is None:
                ids = words[sym] = self.word_ids(sym[:-1] + chr(ord(sym[-1]) + _LAST))
            out += ids
        return out

    def _bytes_to_symbols(self, s: str) -> str:
        return "".join([self.chars[b] for b in s.encode()])

    def chunk_ids(self, s: str) -> list[int]:
        if self.special_re is None or "<|" not in s:
            return self.plain_ids(s)
        out: list[int] = []
        for piece in self.special_re.split(s):
            if piece in self.specials:
                out.append(self.specials[piece])
            elif piece:
                out += self.plain_ids(piece)
        return out

    def _learn(self, chunk: bytes) -> tuple[bytes, str]:
        ids = self.chunk_ids(chunk.decode())
        got = (b"".join([i.to_bytes(4, "little") for i in ids]), " ".join([self.strings[i] for i in ids]))
        self.memo[chunk] = got
        return got

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and their decoding."""
        memo, learn = self.memo, self._learn
        if len(memo) >= MEMO_CHUNKS:
            memo.clear()
            self.words_memo.clear()
        got = [memo.get(c) or learn(c) for c in text.encode().split()]
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[1]])


_LOADED: dict[str, PrefixBpe] = {}


def loaded(path: str) -> PrefixBpe:
    """One encoder per Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = PrefixBpe(path)
    return _LOADED[path]


ENCODED = StructType([StructField("n_tokens", LongType()), StructField("ids", BinaryType()),
                      StructField("decoded", StringType())])
DIGESTS = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
                      StructField("decoded_sha256", StringType())])


def encode_texts(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "bpe",
                 digests: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_tokens``, ``ids`` (binary,
    little-endian unsigned 32-bit) and ``decoded`` (the decoding of the ids),
    or with ``digests`` only the two SHA-256 digests, so that ids and decoded
    text need not leave the Python worker. ``tokenizer`` is the path of the
    tokenizer file, present on every executor. No shuffle; rows keep their
    partition."""
    kind = DIGESTS if digests else ENCODED

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = loaded(tokenizer)
        for texts in batches:
            rows = []
            for t in texts:
                ids, decoded = bpe.encode(t or "")
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(decoded.encode()).hexdigest())
                            if digests else (len(ids) // 4, ids, decoded))
            yield pd.DataFrame(rows, columns=kind.fieldNames())

    return docs.withColumn(out, run(F.col(text_col)))
