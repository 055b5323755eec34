"""The pipeline against a brute-force version, and its stages' contract."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from catalytics.llm import bpe, toxicity
from catalytics.llm.queries import tokenizer_path
from tests.llm.test_operators import brute_classes, brute_items, brute_lines

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def brute(spark, sf_small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    known = sorted((docs[i] or "", y) for i, y in labels.items() if i in docs)
    model = toxicity.fit([t for t, _ in known], [y for _, y in known])
    sizes = [len(docs)]
    docs = {i: t for i, t in docs.items() if not model.rejects(t or "")}
    sizes.append(len(docs))
    docs = {i: t for i, _, _, t in brute_lines(list(docs.items()))}
    classes = brute_classes(list(docs.items()))
    docs = {i: t for i, t in docs.items() if classes[i] == i}
    sizes.append(len(docs))
    hits = brute_items(list(docs.items()), items)
    docs = {i: t for i, t in docs.items() if not hits[i][1]}
    sizes.append(len(docs))
    return docs, sizes


def test_pipeline_equals_brute_force(spark, sf_small, brute):
    docs, sizes = brute
    assert sizes == sorted(set(sizes), reverse=True)  # every filter removes something
    own = bpe.loaded(tokenizer_path())
    want = {i: (len(e[0]) // 4, hashlib.sha256(e[0]).hexdigest(), hashlib.sha256(e[1].encode()).hexdigest())
            for i, e in ((i, own.encode(t or "")) for i, t in docs.items())}
    got = {r["doc_id"]: tuple(r)[1:] for r in corpus_pipeline.run(spark, sf_small).collect()}
    assert got == want


def test_stages_keep_the_columns_and_odd_rows(spark, sf_small):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id here", "en", "s", 10),
                                  (3, "x" * 50_000, "en", "s", 50_000), (4, "some clean text", "en", "s", 15)], COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns, name
        assert out.dtypes == docs.dtypes and out.count() == 5, name
    assert np.array([r["n_tokens"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).collect()]).min() == 0


def test_contaminated_rows_go_by_their_own_text(spark, sf_small):
    item = spark.read.parquet(f"{sf_small}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(None, item), (None, "no id, clean"), (7, item), (7, "shares its id, clean"), (8, None), (9, "clean")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)
    out = corpus_pipeline.drop_contaminated(spark, docs, sf_small)
    assert out.dtypes == docs.dtypes
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"]) == [
        (7, "shares its id, clean"), (8, None), (9, "clean")]
    assert [r["text"] for r in out.collect() if r["doc_id"] is None] == ["no id, clean"]
