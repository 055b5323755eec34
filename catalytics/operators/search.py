"""Ranked search as Spark jobs: many queries against a whole corpus.

* ``build_inverted_index`` tokenises every search field of every document
  into (field, term, doc_key, tf) plus per-(field, doc) lengths -- one
  explode + one grouped count, partitioned by term.
* ``top_hits`` shuffles the postings by document, with each partition a copy
  of the (small) term rows of the queries, and scores batches of documents
  there: partial scores are summed per (query, doc, field), the best field
  wins (multi-field "best fields" semantics), the usage factor
  log10(2 + usage) multiplies, and only a partition's top n per query leave
  it. No row per (query, document) is shuffled.
* ``bm25_field_scores`` gives those rows where they are wanted, for given
  pairs of query and document.
* Per-field statistics (document count, average length) are one row per
  field: a size bounded by the number of fields, so they are broadcast.

BM25 (k1 = 1.2, b = 0.75, no (k1 + 1) factor) with
idf = ln(1 + (N - df + 0.5) / (df + 0.5)). Analyzer: lower-case, split on
anything outside [a-z0-9]. ``.raw`` fields match the whole, unaltered value.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalytics.operators.co_readers import dense_ids
from catalytics.plans import dealt, spread, topk_per_key, written

K1, B = 1.2, 0.75
TOKEN_SPLIT = "[^a-z0-9]+"

# Field boosts of the table, dashboard and user searches.
TABLE_BOOSTS = {"display_name": 1000.0, "name.raw": 75.0, "name": 5.0, "schema": 3.0,
                "description": 3.0, "column_names": 2.0, "column_descriptions": 1.0,
                "tags": 1.0, "badges": 1.0, "programmatic_descriptions": 1.0}
DASHBOARD_BOOSTS = {"name.raw": 75.0, "name": 7.0, "group_name.raw": 15.0, "group_name": 7.0,
                    "description": 3.0, "query_names": 3.0, "chart_names": 2.0}
USER_BOOSTS = {"full_name.raw": 30.0, "full_name": 5.0, "first_name.raw": 5.0,
               "last_name.raw": 5.0, "first_name": 3.0, "last_name": 3.0, "email": 3.0}


def tokens(text: Column) -> Column:
    """Analyzer: the maximal runs of [a-z0-9] in the lower-cased text
    (identical to splitting on TOKEN_SPLIT and dropping empties)."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), 0)


def _field_text(df: DataFrame, field: str) -> Column:
    base = field[:-4] if field.endswith(".raw") else field
    dtype = df.schema[base].dataType.typeName()
    c = F.col(base)
    if field.endswith(".raw"):
        # keyword field: each value is one untokenised term
        return c if dtype == "array" else F.array(c)
    if dtype == "array":
        return F.flatten(F.transform(c, lambda x: tokens(x)))
    return tokens(c)


def build_inverted_index(docs: DataFrame, fields: list[str], key: str = "key", terms: DataFrame | None = None) -> DataFrame:
    """(field, term, doc_key, dl, tf) postings for every field of every doc.
    The documents go by key to the tasks of a shuffle, where one projection +
    explode and one grouped count follow. ``dl`` (terms in that field of that doc) rides along each
    posting so the scorer needs no second join. With ``terms`` (field, term)
    other terms are left out before the count; a search needs those of its
    queries, and ``document_lengths`` for the lengths of all documents."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), _field_text(docs, f).alias("toks"))
                        for f in fields])
    x = (_by_key(docs, fields, key).select("doc_key", F.explode(entries).alias("e"))
         .select("doc_key", F.col("e.field").alias("field"), F.col("e.toks").alias("toks")))
    x = x.where(F.col("toks").isNotNull() & (F.size("toks") > 0)).withColumn("dl", F.size("toks"))
    x = x.select("doc_key", "field", "dl", F.explode("toks").alias("term")).where(F.col("term").isNotNull())
    if terms is not None:
        x = x.join(terms.select("field", "term").distinct(), ["field", "term"], "left_semi")
    return (x.groupBy("field", "term", "doc_key", "dl").agg(F.count(F.lit(1)).alias("tf")))


def field_stats(index: DataFrame) -> DataFrame:
    """Per field: N (docs having the field) and average length."""
    per_doc = index.select("field", "doc_key", "dl").distinct()
    return per_doc.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"),
                                        F.avg("dl").alias("avgdl"))


def _by_key(docs: DataFrame, fields: list[str], key: str) -> DataFrame:
    bases = dict.fromkeys(f.removesuffix(".raw") for f in fields)
    return dealt(docs.select(F.col(key).alias("doc_key"), *bases), "doc_key")


def document_lengths(docs: DataFrame, fields: list[str], key: str = "key") -> DataFrame:
    """``field_stats`` of the whole index from the documents themselves, by one
    row a document."""
    def length(f: str) -> Column:
        toks = _field_text(docs, f)
        return F.when(F.exists(toks, lambda x: x.isNotNull()), F.struct(F.lit(f).alias("field"), F.size(toks).alias("dl")))

    lengths = _by_key(docs, fields, key).select("doc_key", F.array_compact(F.array(*map(length, fields))).alias("ls"))
    per_doc = lengths.groupBy("doc_key").agg(F.array_distinct(F.flatten(F.collect_list("ls"))).alias("ls"))
    return per_doc.select(F.inline("ls")).groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl"))


def query_terms(queries: DataFrame, fields: list[str], text_col: str = "query") -> DataFrame:
    """(query_id, n_terms, field, term) rows: analysed terms for text fields,
    the whole query string for ``.raw`` fields."""
    q = queries.select("query_id", F.col(text_col).alias("q")).where(
        F.length(F.trim(F.col("q"))) > 0)
    q = q.withColumn("toks", F.array_distinct(tokens(F.col("q"))))
    q = q.withColumn("n_terms", F.size("toks"))
    entries = F.array(*[F.struct(F.lit(f).alias("field"),
                                 (F.array(F.col("q")) if f.endswith(".raw") else F.col("toks")).alias("t"))
                        for f in fields])
    x = q.select("query_id", "n_terms", F.explode(entries).alias("e"))
    return x.select("query_id", "n_terms", F.col("e.field").alias("field"),
                    F.explode("e.t").alias("term"))


def bm25_field_scores(index: DataFrame, queries: DataFrame, boosts: dict[str, float], text_col: str = "query",
                      stats: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_key, field, score, matched, n_terms) per field, of the
    distinct ``pairs`` (query_id, doc_key) if given.

    Document frequencies are computed only for terms that occur in some
    query (semi join first), and the small (query, term, df) side is joined
    to the postings once."""
    fields = list(boosts)
    qt = query_terms(queries, fields, text_col)
    fs = F.broadcast(field_stats(index) if stats is None else stats)  # one row per field: bounded by the field list
    rel = index.join(qt.select("field", "term").distinct(), ["field", "term"], "left_semi")
    ts = rel.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    qtt = qt.join(ts, ["field", "term"])
    boost = _boost(boosts)
    if pairs is None:
        hits = rel.join(qtt, ["field", "term"]).join(fs, "field")
    else:
        hits = rel.join(pairs, "doc_key").join(qtt, ["query_id", "field", "term"]).join(fs, "field")
    idf = _idf()
    norm = K1 * (1 - B + B * F.col("dl") / F.col("avgdl"))
    part = idf * F.col("tf") / (F.col("tf") + norm)
    return (hits.withColumn("s", part * boost[F.col("field")])
            .groupBy("query_id", "doc_key", "field", "n_terms")
            .agg(F.sum("s").alias("score"), F.count(F.lit(1)).alias("matched")))


def _boost(boosts: dict[str, float]) -> Column:
    return F.create_map(*[x for f, b in boosts.items() for x in (F.lit(f), F.lit(b))])


def _idf() -> Column:
    return F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))


def usage_factor(usage: Column) -> Column:
    return F.log10(F.lit(2.0) + F.coalesce(usage.cast("double"), F.lit(0.0)))


def rank_hits(per_field: DataFrame, docs: DataFrame, n: int, usage_col: str | None,
              require_all_terms: bool = False, key: str = "key") -> DataFrame:
    x = per_field
    if require_all_terms:
        x = x.where((F.col("matched") >= F.col("n_terms")) | F.col("field").endswith(".raw"))
    best = x.groupBy("query_id", "doc_key").agg(F.max("score").alias("score"))
    if usage_col:
        u = docs.select(F.col(key).alias("doc_key"), F.col(usage_col).alias("_u"))
        best = best.join(u, "doc_key").withColumn("score", F.col("score") * usage_factor(F.col("_u"))) \
            .drop("_u")
    best = best.withColumn("score", F.round("score", 6))
    return topk_per_key(best, "query_id", [F.desc("score"), F.asc("doc_key")], n, rank_col="rank")


def top_hits(index: DataFrame, docs: DataFrame, queries: DataFrame, boosts: dict[str, float], n: int, usage_col: str | None,
             require_all_terms: bool = False, stats: DataFrame | None = None, key: str = "key", block: int = 256) -> DataFrame:
    """The ``rank_hits`` of ``bm25_field_scores``, scored where the documents
    are. Postings of asked terms and usage go by hash of their document to a
    partition, which also gets the term rows of its block of at most about
    ``block`` queries; it sends on its own top n of each query. What is shuffled
    is the postings for each block that asks their term, and n rows per query
    and partition."""
    spark = index.sparkSession
    qt = query_terms(queries, list(boosts))
    vocab = dense_ids(qt.select(F.struct("field", "term").alias("at")).distinct(), "at", "tid")
    vocab = written(vocab.select("at.field", "at.term", F.col("tid").cast("int").alias("tid")), "asked-terms")
    posts = written(index.join(vocab, ["field", "term"]).select("doc_key", "tid", "dl", "tf"), "asked-postings")
    df = posts.groupBy("tid").agg(F.count(F.lit(1)).alias("df"))
    fs = F.broadcast(field_stats(index) if stats is None else stats)  # one row per field: bounded by the field list
    weights = vocab.join(df, "tid").join(fs, "field").select(
        "field", "term", "tid", (_idf() * _boost(boosts)[F.col("field")]).alias("w"), "avgdl")
    requests = qt.groupBy("query_id", "n_terms", "field", "term").agg(F.count(F.lit(1)).alias("times"))
    n_blocks = max(1, -(-requests.select("query_id", "n_terms").distinct().count() // block))
    asked = written(requests.join(weights, ["field", "term"])
                    .groupBy(F.pmod(F.hash("query_id", "n_terms"), F.lit(n_blocks)).alias("block"), "tid", "field", "w", "avgdl")
                    .agg(F.collect_list(F.struct("query_id", "n_terms", "times")).alias("requests")), "asked-weights")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = (F.col("block") * parts + F.pmod(F.hash("doc_key"), F.lit(parts))).alias("pid")
    if n_blocks == 1:
        dealt = posts.withColumn("block", F.lit(0))
    else:
        dealt = posts.join(asked.select("tid", "block"), "tid")
    rows = dealt.select(at, F.lit(2).alias("kind"), "doc_key", "tid", F.col("tf").cast("int").alias("tf"), "dl").unionByName(
        asked.select(F.explode(F.sequence(F.col("block") * parts, F.col("block") * parts + parts - 1)).alias("pid"),
                     F.lit(0).alias("kind"), "tid", "field", "w", "avgdl", "requests"), allowMissingColumns=True)
    if usage_col:  # a document counts once for each of its rows, as in a join
        rows = rows.where((F.col("kind") == 0) | F.col("doc_key").isNotNull()).unionByName(
            docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_key"), usage_factor(F.col(usage_col)).alias("usage"),
                                                      F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
            .select(at, F.lit(1).alias("kind"), "doc_key", "usage"), allowMissingColumns=True)
    else:
        rows = rows.withColumn("usage", F.lit(None).cast("double"))
    kinds = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("doc_key", index.schema["doc_key"].dataType),
                          T.StructField("copy", T.IntegerType()), T.StructField("score", T.DoubleType())])
    ordered = rows.repartitionById(parts * n_blocks, "pid").sortWithinPartitions("pid", F.col("kind") > 0, "doc_key", "kind")
    found = ordered.mapInArrow(partial(_score_documents, n=n, with_usage=bool(usage_col), all_terms=require_all_terms), kinds)
    # one query asked with several texts has its best of them
    best = found.groupBy("query_id", "doc_key", "copy").agg(F.max("score").alias("score")).drop("copy")
    return topk_per_key(best.withColumn("score", F.round("score", 6)), "query_id", [F.desc("score"), F.asc("doc_key")], n, rank_col="rank")


class _Requests:
    """The term rows of one block of queries, and each query's best n so far."""

    def __init__(self, rows: pa.Table, n: int, all_terms: bool):
        self.n, self.all_terms = n, all_terms
        found = [[(r["query_id"], r["n_terms"], r["times"]) for r in rs] for rs in rows["requests"].to_pylist()]
        self.ids = list(dict.fromkeys((q, k) for rs in found for q, k, _ in rs))
        number = {x: i for i, x in enumerate(self.ids)}
        tid = rows["tid"].to_numpy()
        order = np.argsort(tid)
        self.tid, self.w, self.avgdl = tid[order], rows["w"].to_numpy()[order], rows["avgdl"].to_numpy()[order]
        names = rows["field"].to_pylist()
        self.raw = [f.endswith(".raw") for f in sorted(set(names))]
        self.field = np.searchsorted(sorted(set(names)), [names[i] for i in order])
        self.times = np.zeros((len(tid), len(self.ids)))
        for at, i in enumerate(order):
            for q, k, times in found[i]:
                self.times[at, number[q, k]] = times
        self.n_terms = np.array([k for _, k in self.ids])
        self.floor, self.seen = np.full(len(self.ids), -np.inf), np.zeros(len(self.ids), bool)
        self.request, self.key = np.empty(0, np.int64), np.empty(0)
        self.kept: list[tuple] = []  # (document key, copy, score) beside request and key

    def best(self, doc: np.ndarray, n_docs: int, tid: np.ndarray, tf: np.ndarray, dl: np.ndarray) -> np.ndarray:
        """Score of the best field by (document, request); 0 where none matches."""
        out = np.zeros((n_docs, len(self.ids)))
        at = np.searchsorted(self.tid, tid)
        part = self.w[at] * tf / (tf + K1 * (1 - B + B * dl / self.avgdl[at]))
        of = self.field[at]
        for f in np.unique(of):
            mine = of == f
            docs, d = np.unique(doc[mine], return_inverse=True)
            terms, t = np.unique(at[mine], return_inverse=True)
            cell, size = d * len(terms) + t, (len(docs), len(terms))
            score = np.bincount(cell, part[mine], size[0] * size[1]).reshape(size) @ self.times[terms]
            if self.all_terms and not self.raw[f]:
                matched = np.bincount(cell, minlength=size[0] * size[1]).reshape(size) @ self.times[terms]
                score[matched < self.n_terms] = 0
            out[docs] = np.maximum(out[docs], score)
        return out

    def keep(self, scores: np.ndarray, matched: np.ndarray, keys: pa.Array, copies: np.ndarray) -> None:
        """Rows come in the order of their document's key, so an equal score
        doesn't displace an earlier one. A null score is the last of all."""
        key = np.where(np.isnan(scores), -np.inf, scores)
        d, r = np.nonzero(matched & (~self.seen | (key > self.floor - 1e-6)))
        rounded = np.round(key[d, r], 6)
        some = ~self.seen[r] | (rounded > self.floor[r])
        d, r, rounded = d[some], r[some], rounded[some]
        if not len(d):
            return
        request, key = np.concatenate([self.request, r]), np.concatenate([self.key, rounded])
        order = np.lexsort((np.arange(len(key)), -key, request))
        start = np.searchsorted(request[order], request[order])  # where its request begins
        order = order[np.arange(len(order)) - start < self.n]
        old = len(self.request)
        names = keys.take(pa.array(d[order[order >= old] - old])).to_pylist()
        new = iter(names)
        self.kept = [self.kept[i] if i < old else (next(new), int(copies[d[i - old]]), float(scores[d[i - old], r[i - old]])) for i in order]
        self.request, self.key = request[order], key[order]
        have = np.bincount(self.request, minlength=len(self.ids))
        self.seen = have >= self.n
        last = np.searchsorted(self.request, np.arange(len(self.ids)), "right") - 1
        self.floor[self.seen] = self.key[last[self.seen]]

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([self.ids[r][0] for r in self.request], schema.field("requests").type.value_type.field("query_id").type),
            pa.array([k for k, _, _ in self.kept], schema.field("doc_key").type), pa.array([c for _, c, _ in self.kept], pa.int32()),
            pa.array([None if np.isnan(x) else x for _, _, x in self.kept], pa.float64())], ["query_id", "doc_key", "copy", "score"])


def _score_documents(batches: Iterator[pa.RecordBatch], n: int, with_usage: bool, all_terms: bool) -> Iterator[pa.RecordBatch]:
    """(query_id, doc_key, copy, score): the best n of each query among the
    documents of a partition. Rows are in the order of pid, then the term rows,
    then by document its usage rows and postings."""
    pid, terms, asked, left = None, [], None, None

    def numbers(t: pa.Table, column: str) -> np.ndarray:
        return t[column].to_numpy()

    def score(t: pa.Table) -> None:
        keys = t["doc_key"].combine_chunks()
        keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
        new = _changes(keys)
        doc = np.cumsum(new) - 1
        post = numbers(t, "kind") == 2
        p = t.filter(pa.array(post))
        best = asked.best(doc[post], int(doc[-1]) + 1, numbers(p, "tid"), numbers(p, "tf").astype(float), numbers(p, "dl").astype(float))
        first = np.flatnonzero(new)
        if not with_usage:
            asked.keep(best, best > 0, keys.take(pa.array(first)), np.zeros(len(first), int))
            return
        rows = np.flatnonzero(~post)
        usage = np.asarray(t["usage"].to_numpy(), float)[rows]  # a null is nan
        mine = best[doc[rows]]
        asked.keep(mine * usage[:, None], mine > 0, keys.take(pa.array(rows)), rows - first[doc[rows]])

    for b in batches:
        schema = b.schema
        t = pa.Table.from_batches([b])
        ids = numbers(t, "pid")
        cuts = np.flatnonzero(np.diff(ids)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(ids)]):
            part = t.slice(lo, hi - lo)
            if not len(part):
                continue
            if ids[lo] != pid:
                if asked is not None and left is not None:
                    score(left)
                if asked is not None:
                    yield asked.rows(schema)
                pid, terms, asked, left = ids[lo], [], None, None
            head = int(np.count_nonzero(numbers(part, "kind") == 0))
            if head:
                terms.append(part.slice(0, head))
                part = part.slice(head)
            if not len(part):
                continue
            if asked is None:
                if not terms:  # no query asks this block
                    continue
                asked = _Requests(pa.concat_tables(terms), n, all_terms)
            part = part if left is None else pa.concat_tables([left, part])
            last = int(np.flatnonzero(_changes(part["doc_key"].combine_chunks()))[-1])  # the last document may go on
            if last:
                score(part.slice(0, last))
            left = part.slice(last)
    if asked is not None:
        if left is not None:
            score(left)
        yield asked.rows(schema)


def _changes(keys) -> np.ndarray:
    """Where a run of equal values (or of nulls) begins."""
    k = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
    codes = k.dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.diff(codes, prepend=-1) != 0


def search_tables(index: DataFrame, docs: DataFrame, queries: DataFrame, n: int = 10,
                  boosts: dict | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Table search: OR of terms, best field wins, x log10(2 + total_usage)."""
    return top_hits(index, docs, queries, boosts or TABLE_BOOSTS, n, "total_usage", stats=stats)


def search_dashboards(index: DataFrame, docs: DataFrame, queries: DataFrame, n: int = 10, stats: DataFrame | None = None) -> DataFrame:
    return top_hits(index, docs, queries, DASHBOARD_BOOSTS, n, "total_usage", stats=stats)


def search_users(index: DataFrame, docs: DataFrame, queries: DataFrame, n: int = 10, stats: DataFrame | None = None) -> DataFrame:
    """User search: every query term must match within one field
    (operator AND); no usage factor."""
    return top_hits(index, docs, queries, USER_BOOSTS, n, None, require_all_terms=True, stats=stats)


def search_with_filters(docs: DataFrame, filters: dict | None, term: str | None,
                        resource: str = "table", page_index: int = 0,
                        page_size: int = 10) -> DataFrame:
    """Faceted filter, scored by the usage factor, paged, with the total."""
    from catalytics.operators.filters import faceted_filter, page_with_total
    hits = faceted_filter(docs, filters, term, resource).withColumn(
        "score", F.round(usage_factor(F.col("total_usage")), 6))
    return page_with_total(hits, [F.desc("score"), F.asc("key")], page_index, page_size)


def search_filter_sets(index: DataFrame, docs: DataFrame, queries: DataFrame, filters: DataFrame, n: int = 10,
                       resource: str = "table", boosts: dict | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Many filtered searches at once. ``queries`` has rows (query_id, query),
    ``filters`` rows (query_id, category, value). A hit matches its query's
    text and every filter category of it; its score is the match score (best
    field) x log10(2 + total_usage). The first ``n`` per query come back with
    the query's ``total_results``. A request without usable filters has no
    hits, as in ``faceted_filter``. Only pairs that pass the filters are
    scored."""
    from catalytics.operators.filters import faceted_filter_sets
    boosts = boosts or (TABLE_BOOSTS if resource == "table" else DASHBOARD_BOOSTS)
    allowed = faceted_filter_sets(docs, filters, resource).withColumnRenamed("key", "doc_key")
    matched = written(bm25_field_scores(index, queries, boosts, stats=stats, pairs=allowed), "filtered-scores")
    total = matched.groupBy("query_id").agg(F.countDistinct("doc_key").alias("total_results"))
    return rank_hits(matched, docs, n, "total_usage").join(total, "query_id")


def search_result_projection(hits: DataFrame, fields: list[str]) -> DataFrame:
    """Keep declared fields only; tags/badges become array<struct<tag_name>>;
    hits without a document payload (null key) are skipped."""
    keep = [f for f in fields if f in hits.columns]
    out = hits.where(F.col("key").isNotNull()).select(*keep)
    for f in ("tags", "badges"):
        if f in keep:
            out = out.withColumn(f, F.transform(f, lambda t: F.struct(t.alias("tag_name"))))
    return out


def inline_topk(hits: DataFrame, k: int = 2) -> DataFrame:
    """First k hits of each resource type, for every query."""
    return topk_per_key(hits, ["query_id", "resource_type"], [F.desc("score"), F.asc("key")], k,
                        rank_col="position")


def search_all(**hits: DataFrame) -> DataFrame:
    """Union of per-type hit frames (same columns) labelled by type."""
    frames = [df.withColumn("resource_type", F.lit(t)) for t, df in hits.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def assemble_table_docs(tables: DataFrame, columns: DataFrame, tags: DataFrame,
                        badges: DataFrame, reads: DataFrame) -> DataFrame:
    """Flatten the catalog into table search documents: column names and
    descriptions, default tags, badge names, total usage = sum of reads.
    Each child is aggregated per table before the join (no fan-out)."""
    cols = columns.groupBy("table_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("sort_order", "name"))),
                    lambda x: x["name"]).alias("column_names"),
        F.transform(F.array_sort(F.collect_list(F.struct("sort_order", "description"))),
                    lambda x: x["description"]).alias("_cd"))
    cols = cols.withColumn("column_descriptions", F.filter("_cd", lambda x: x.isNotNull())).drop("_cd")
    tg = tags.where(F.col("tag_type") == "default").groupBy(F.col("resource_key").alias("table_key")) \
        .agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    bd = badges.groupBy(F.col("resource_key").alias("table_key")).agg(
        F.array_sort(F.collect_set("badge_name")).alias("badges"))
    us = reads.groupBy("table_key").agg(F.sum("read_count").cast("long").alias("total_usage"))
    t = tables.select(F.col("key").alias("table_key"), "name", "description", "cluster", "database",
                      "schema", "popularity_score")
    empty = F.array().cast("array<string>")
    return (t.join(spread(cols), "table_key", "left").join(spread(tg), "table_key", "left")
            .join(spread(bd), "table_key", "left").join(spread(us), "table_key", "left")
            .select(F.col("table_key").alias("key"), "name",
                    F.concat("schema", F.lit("."), "name").alias("display_name"),
                    "description", "cluster", "database", "schema",
                    F.coalesce("column_names", empty).alias("column_names"),
                    F.coalesce("column_descriptions", empty).alias("column_descriptions"),
                    F.coalesce("tags", empty).alias("tags"),
                    F.coalesce("badges", empty).alias("badges"),
                    empty.alias("programmatic_descriptions"),
                    F.coalesce("total_usage", F.lit(0).cast("long")).alias("total_usage"),
                    F.concat("schema", F.lit("."), "name", F.lit("@"), "cluster").alias("qualified_name"),
                    "popularity_score"))
