"""Toxicity by cumulative-link ordinal regression (operator 9).

Severity grades 0 (clean) to 3 come from the labels: documents labelled
clean have grade 0. The sample is cut in two halves by text; a labelled toxic
document's grade is the third, within its half, of the score that a two-class
model fitted on the other half alone gives it, so no document grades itself.
One weight vector over sparse text features (words and word beginnings) is
shared by the ordered thresholds: P(grade > k) = sigmoid(score - threshold_k).
The output is the expected severity, sum over k of P(grade > k). Rejected are
documents whose expected severity reaches that of the score that errs least
on the sample (the middle of the best stretch of scores).

The model is fitted in the driver on a bounded sample: at most ``MAX_TOXIC``
toxic and ``MAX_CLEAN`` clean labelled documents, those with the smallest
hash of their id, one text an id. Feature counts for the choice of features
come from the same sample. Scoring covers every document, inside Spark tasks.

Defined results: null and empty texts score the model's bias alone and are
not rejected; rows of ``labels`` without a document, or with a null label,
are left out; of rows that share an id the sample takes the smallest text;
without toxic or without clean labels nothing is rejected and every severity
is 0; repeated rows score alike; texts of any length are read whole; an empty
table has an empty result; other columns pass through.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOXIC = 3000
MAX_CLEAN = 9000
#: A feature is tied to the label when so many features, untied, would hold
#: about one of its log-likelihood ratio by chance.
CHANCE = 1.0
PREFIXES = (4, 5, 6)
GRADES = 3

_TABLE = bytes(32 if b < 48 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 else
               b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str) -> list[str]:
    return text.encode().translate(_TABLE).decode().split(" ") if text else []


def features_of_word(word: str) -> list[str]:
    return [word, *["^" + word[:n] for n in PREFIXES if len(word) > n]]


@dataclass
class OrdinalModel:
    thresholds: list[float]
    weights: dict[str, float] = field(default_factory=dict)
    cut: float = 50.0
    words: dict[str, float] = field(default_factory=dict, repr=False, compare=False)

    def score(self, text: str) -> float:
        known, total = self.words, 0.0
        for w in set(words_of(text)):
            s = known.get(w)
            if s is None:
                s = sum([self.weights.get(f, 0.0) for f in features_of_word(w)]) if w else 0.0
                if len(known) < 400_000:
                    known[w] = s
            total += s
        return total

    def rejects(self, text: str) -> bool:
        return sum(self.exceed(text)) >= self.limit

    @property
    def limit(self) -> float:
        """The expected severity from which documents are rejected."""
        return sum(self.above(self.cut))

    def exceed(self, text: str) -> list[float]:
        """P(grade > k) for each k."""
        return self.above(self.score(text))

    def above(self, s: float) -> list[float]:
        return [float(1 / (1 + np.exp(np.clip(t - s, -50, 50)))) for t in self.thresholds]


def _tie(pos: int, neg: int, n_pos: int, n_neg: int) -> float:
    """Log-likelihood ratio (G) of a feature, 0 unless it leans to toxic."""
    n = n_pos + n_neg
    if pos * n_neg <= neg * n_pos:
        return 0.0
    g = 0.0
    for seen, group in ((pos, n_pos), (neg, n_neg)):
        for a, share in ((seen, (pos + neg) / n), (group - seen, 1 - (pos + neg) / n)):
            if a > 0:
                g += 2 * a * np.log(a / (group * share))
    return g


def fit(texts: list[str], toxic: list[int]) -> OrdinalModel:
    """Fit on a sample that the caller has bounded."""
    return fit_grades(texts, cross_grades(texts, toxic))


def cross_grades(texts: list[str], toxic: list[int]) -> np.ndarray:
    """Grade 0 for clean documents, 1 to ``GRADES`` for toxic ones, by a
    two-class model of the half of the texts that the document isn't in."""
    y01, half = np.array(toxic), np.array([zlib.crc32(t.encode()) & 1 for t in texts])
    grade = y01.copy()
    for h in (0, 1):
        mine, other = np.flatnonzero((half == h) & (y01 == 1)), np.flatnonzero(half != h)
        if not len(mine):
            continue
        model = fit_grades([texts[i] for i in other], y01[other], grades=1)
        score = np.array([model.score(texts[i]) for i in mine])
        cuts = np.quantile(score, [i / GRADES for i in range(1, GRADES)])
        grade[mine] = 1 + (score[:, None] > cuts).sum(1)
    return grade


def fit_grades(texts: list[str], grade: np.ndarray, grades: int = GRADES, rounds: int = 300,
               l2: float = 1e-4) -> OrdinalModel:
    """The cumulative-link model of texts with grades 0 to ``grades``."""
    y01 = (grade > 0).astype(int)
    toxic = y01.tolist()
    n_pos, n_neg = int(y01.sum()), int((1 - y01).sum())
    never = OrdinalModel([50.0] * grades)
    if not n_pos or not n_neg:
        return never
    # holders of each feature; clean texts only count those of toxic texts
    pos: Counter = Counter()
    for t, y in zip(texts, toxic):
        if y:
            pos.update({f for w in set(words_of(t)) if w for f in features_of_word(w)})
    least = 2 * np.log(len(pos) / CHANCE)
    pos = Counter({f: p for f, p in pos.items() if p >= 3})
    neg: Counter = Counter()
    for t, y in zip(texts, toxic):
        if not y:
            neg.update({f for w in set(words_of(t)) if w for f in features_of_word(w) if f in pos})
    ties = {f: g for f, p in pos.items() if (g := _tie(p, neg[f], n_pos, n_neg)) >= least}
    chosen = sorted(ties, key=lambda f: (-ties[f], f))
    if not chosen:
        return never
    index = {f: i for i, f in enumerate(chosen)}
    bags = [Counter(f for w in set(words_of(t)) if w for f in features_of_word(w) if f in index) for t in texts]
    rows, cols, vals = [], [], []
    for i, b in enumerate(bags):
        for f in sorted(b):
            rows.append(i)
            cols.append(index[f])
            vals.append(float(b[f]))
    r, c, v = np.array(rows, np.int64), np.array(cols, np.int64), np.array(vals)
    above = (grade[:, None] > np.arange(grades)).astype(float)  # y > k
    w, theta = np.zeros(len(chosen)), np.arange(grades) + 1.0
    m, s = np.zeros(len(w) + grades), np.zeros(len(w) + grades)
    for step in range(1, rounds + 1):  # Adam on the mean log loss of the thresholds
        score = np.bincount(r, v * w[c], len(bags))
        err = 1 / (1 + np.exp(np.clip(theta - score[:, None], -50, 50))) - above
        grad = np.concatenate([np.bincount(c, v * err.sum(1)[r], len(w)) / len(bags) + l2 * w,
                               -err.mean(0)])
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad ** 2
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
        w = np.maximum(w - move[:-grades], 0.0)  # chosen features speak for the label only
        theta = np.maximum.accumulate(theta - move[-grades:])  # thresholds stay ordered
    return OrdinalModel([float(t) for t in theta], {f: float(x) for f, x in zip(chosen, w) if x},
                        best_cut(np.bincount(r, v * w[c], len(bags)), y01))


def best_cut(score: np.ndarray, toxic: np.ndarray) -> float:
    """The score between two neighbours that parts the classes with the
    fewest errors; of equal cuts the one in the widest gap."""
    values = np.unique(np.append(score, 0.0))
    cuts = np.append((values[1:] + values[:-1]) / 2, values[-1] + 1)
    gaps = np.append(values[1:] - values[:-1], 0.0)
    pos, neg = np.sort(score[toxic == 1]), np.sort(score[toxic == 0])
    errors = np.searchsorted(pos, cuts) + len(neg) - np.searchsorted(neg, cuts)
    best = np.flatnonzero(errors == errors.min())
    return float(cuts[best[np.argmax(gaps[best])]])


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> tuple[list[str], list[int]]:
    """Texts and labels of the bounded sample."""
    ids = None
    for value, most in ((1, max_toxic), (0, max_clean)):
        part = labels.where(F.col("toxic") == value).select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic")) \
            .where(F.col("__id").isNotNull()).distinct().orderBy(F.xxhash64("__id"), "__id").limit(most)
        ids = part if ids is None else ids.unionByName(part)
    # at most max_toxic + max_clean ids: a proven bound
    picked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(ids), "__id")
    texts, toxic = [], []
    # one row an id, however many rows share it
    for r in picked.groupBy("__id", "__toxic").agg(F.min("__text").alias("__text")).toLocalIterator():
        texts.append(r["__text"] or "")
        toxic.append(int(r["__toxic"]))
    order = sorted(range(len(texts)), key=lambda i: (texts[i], toxic[i]))
    return [texts[i] for i in order], [toxic[i] for i in order]


def grade_texts(docs: DataFrame, model: OrdinalModel, text_col: str = "text", out: str = "severity") -> DataFrame:
    """``docs`` with a struct column ``out``: ``expected`` (severity),
    ``p_toxic``, ``grade`` (most likely) and ``rejected``. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # weights of features of the bounded sample

    @F.pandas_udf("expected double, p_toxic double, grade int, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            rows, limit = [], m.limit
            for t in texts:
                p = m.exceed(t or "")
                each = [a - b for a, b in zip([1.0, *p], [*p, 0.0])]
                rows.append((round(sum(p), 6), round(p[0], 6), int(np.argmax(each)), sum(p) >= limit))
            yield pd.DataFrame(rows, columns=["expected", "p_toxic", "grade", "rejected"])

    return docs.withColumn(out, run(F.col(text_col)))


def fit_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    return fit(*training_sample(docs, labels, id_col, text_col))
