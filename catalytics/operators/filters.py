"""Filters and predicate operators.

Filters are small request-side configuration; they are compiled into one
Column predicate on the driver (no join, no Python per row) so the scan
keeps its pushdown and whole-stage codegen."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalytics.functions.keys import camel_to_words
from catalytics.plans import dealt, written

#: Pieces in which the distinct values of a field meet wildcards and terms.
PIECES = 64

# Filter category -> (document field, exact keyword field?)
TABLE_FILTER_FIELDS = {
    "badges": ("badges", False),
    "tag": ("tags", False),
    "schema": ("schema", True),
    "table": ("name", True),
    "column": ("column_names", True),
    "database": ("database", True),
    "cluster": ("cluster", True),
}
DASHBOARD_FILTER_FIELDS = {
    "group_name": ("group_name", True),
    "name": ("name", True),
    "product": ("product", False),
    "tag": ("tags", False),
}
# Fields searched by a free-text term.
TABLE_TERM_FIELDS = ["name", "schema", "description", "column_names", "column_descriptions"]
DASHBOARD_TERM_FIELDS = ["name", "group_name", "query_names", "description", "tags", "badges",
                         "product"]


def _or(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds)


def _and(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)


def _wildcard_regex(value: str) -> str:
    v = re.sub(r"\*+", "*", value)
    return "^" + ".*".join(re.escape(p) for p in v.split("*")) + "$"


def _value_match(x: Column, value: str, exact: bool) -> Column:
    if not exact:
        x, value = F.lower(x), value.lower()
    if "*" in value:
        return x.rlike(_wildcard_regex(value))
    return x == F.lit(value)


def _field_match(df: DataFrame, field: str, value: str, exact: bool) -> Column:
    dtype = df.schema[field].dataType.typeName()
    if dtype == "array":
        return F.exists(F.col(field), lambda x: _value_match(x, value, exact))
    return _value_match(F.col(field), value, exact)


def _term_match(df: DataFrame, field: str, term: str) -> Column:
    t = term.lower()
    dtype = df.schema[field].dataType.typeName()
    if dtype == "array":
        return F.exists(F.col(field), lambda x: F.lower(x).contains(t))
    return F.coalesce(F.lower(F.col(field)).contains(t), F.lit(False))


def faceted_predicate(df: DataFrame, filters: dict | None, term: str | None,
                      resource: str = "table") -> Column:
    """Column predicate for a filter request (values OR-ed inside a
    category, categories AND-ed, free-text term AND-ed). Requests the
    reference rejects (a value containing '/' or ':', or nothing usable)
    give a constant-false predicate, i.e. an empty result."""
    mapping = TABLE_FILTER_FIELDS if resource == "table" else DASHBOARD_FILTER_FIELDS
    term_fields = TABLE_TERM_FIELDS if resource == "table" else DASHBOARD_TERM_FIELDS
    preds = []
    for category, values in (filters or {}).items():
        values = values if isinstance(values, list) else [values]
        if any("/" in str(v) or ":" in str(v) for v in values):
            return F.lit(False)
    for category, values in (filters or {}).items():
        values = values if isinstance(values, list) else [values]
        if category not in mapping or values in ([""], []) or values == "":
            continue
        field, exact = mapping[category]
        preds.append(_or([_field_match(df, field, str(v), exact) for v in values]))
    if term:
        preds.append(_or([_term_match(df, f, term) for f in term_fields if f in df.columns]))
    if not preds:
        return F.lit(False)
    return _and(preds)


def faceted_filter(docs: DataFrame, filters: dict | None, term: str | None = None,
                   resource: str = "table") -> DataFrame:
    return docs.where(faceted_predicate(docs, filters, term, resource))


def faceted_filter_sets(docs: DataFrame, filters: DataFrame, resource: str = "table") -> DataFrame:
    """Many filter requests at once, by relational division. ``filters`` has
    rows (query_id, category, value); the category ``term`` is a free-text term
    that any of the term fields may contain. A document is a hit of a query if
    it satisfies each of its usable categories, by one value or more. Returns
    (query_id, key) of all hits, under the rules of ``faceted_filter``.

    The documents are read once, as (key, field, value) rows in the form that a
    request compares with. Plain values meet the asked ones by an equi-join on
    field and value; values with a wildcard, and terms, are compared with the
    distinct values of their field, in ``PIECES`` pieces. What a document has of
    the asked values is one set; queries are decided once for each distinct set,
    by counting its categories against the query's."""
    mapping = TABLE_FILTER_FIELDS if resource == "table" else DASHBOARD_FILTER_FIELDS
    terms = [f for f in (TABLE_TERM_FIELDS if resource == "table" else DASHBOARD_TERM_FIELDS) if f in docs.columns]
    usable = filters.where(F.col("category").isin([*mapping, "term"]) & (F.coalesce("value", F.lit("")) != ""))
    # a value with '/' or ':' in any category empties the whole request
    bad = filters.where((F.col("category") != "term") & F.col("value").rlike("[/:]")).select("query_id").distinct()
    usable = usable.join(bad, "query_id", "left_anti").distinct()
    needed = usable.groupBy("query_id").agg(F.countDistinct("category").alias("__needed"))

    def values(field: str) -> Column:
        kind = docs.schema[field].dataType.typeName()
        return F.col(field) if kind == "array" else F.array(F.col(field))

    stored = [F.struct(F.lit(c).alias("category"), (values(f) if exact else F.transform(values(f), F.lower)).alias("vs"))
              for c, (f, exact) in mapping.items() if f in docs.columns]
    words = F.struct(F.lit("term").alias("category"),
                     F.transform(F.flatten(F.array(*[F.coalesce(values(f), F.array().cast("array<string>")) for f in terms])),
                                                             F.lower).alias("vs"))
    exact = [c for c, (_, e) in mapping.items() if e]
    asked = usable.where(F.col("query_id").isNotNull()) \
        .withColumn("value", F.when(F.col("category").isin(exact), F.col("value")).otherwise(F.lower("value")))
    asked = written(asked.select("query_id", "category", "value").distinct(), "asked-values")
    rows = docs.select("key", F.explode(F.array(*stored, words)).alias("s")) \
        .select("key", F.col("s.category").alias("category"), F.explode("s.vs").alias("stored")).where(F.col("stored").isNotNull())
    wild = (F.col("category") != "term") & F.col("value").contains("*")
    values_asked = asked.select("category", "value").distinct()
    plain = values_asked.where(~wild & (F.col("category") != "term")).withColumn("stored", F.col("value"))
    # '*' stands for any run of characters; all else is literal
    pattern = F.concat(F.lit("^"), F.array_join(F.transform(F.split("value", "[*]+"), lambda x: F.concat(
        F.lit("\\Q"), x, F.lit("\\E"))), ".*"), F.lit("$"))
    open_ = values_asked.where(wild | (F.col("category") == "term")).withColumn("__re", F.when(wild, pattern)) \
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    matches = F.when(F.col("__re").isNotNull(), F.rlike("stored", F.col("__re"))).otherwise(F.col("stored").contains(F.col("value")))
    distinct = rows.join(open_.select("category").distinct(), "category", "left_semi").select("category", "stored").distinct() \
        .withColumn("piece", F.pmod(F.hash("stored"), F.lit(PIECES)))
    by_match = distinct.join(open_, ["category", "piece"]).where(matches).select("category", "value", "stored")
    met = written(plain.select("category", "value", "stored").unionByName(by_match), "met-values")
    has = rows.join(met, ["category", "stored"]).groupBy("key").agg(F.array_sort(F.collect_set(F.struct("category", "value"))).alias("has"))
    has = written(has, "document-values")
    atoms = has.select("has").distinct().select("has", F.inline("has"))
    hits = atoms.join(asked, ["category", "value"]).groupBy("query_id", "has").agg(F.countDistinct("category").alias("__n"))
    hits = hits.join(needed, "query_id").where(F.col("__n") == F.col("__needed")).select("query_id", "has")
    return has.join(hits, "has").select("query_id", "key")


def basic_filter(docs: DataFrame, filters: dict | None, page_index: int = 0,
                 page_size: int = 10) -> DataFrame:
    """Atlas form over ``qualified_name`` (schema.table@cluster): database ->
    starts with 'db.', cluster -> ends with '@cluster', table -> contains;
    only the first value of each is used; AND-ed. Without any of those a
    single tag equality is used. Sorted by popularity score, paged."""
    f = filters or {}
    qn = F.col("qualified_name")
    preds = []
    if f.get("database"):
        preds.append(qn.startswith(f"{f['database'][0]}."))
    if f.get("cluster"):
        preds.append(qn.endswith(f"@{f['cluster'][0]}"))
    if f.get("table"):
        preds.append(qn.contains(f["table"][0]))
    if not preds and f.get("tag"):
        preds.append(F.exists("tags", lambda x: x == F.lit(f["tag"][0])))
    if not preds:
        return docs.limit(0)
    out = docs.where(_and(preds))
    return page(out, [F.desc("popularity_score"), F.asc("key")], page_index, page_size)


def page(df: DataFrame, order: list[Column], page_index: int = 0, page_size: int = 10) -> DataFrame:
    """offset = page_index * page_size; page_index -1 = everything."""
    out = df.orderBy(*order)
    if page_index < 0:
        return out
    return out.offset(page_index * page_size).limit(page_size)


def page_with_total(df: DataFrame, order: list[Column], page_index: int = 0,
                    page_size: int = 10) -> DataFrame:
    """The page plus the total hit count as a column (one extra global
    count, planned as a scalar subquery)."""
    total = df.agg(F.count(F.lit(1))).scalar()  # uncorrelated scalar subquery
    return page(df, order, page_index, page_size).withColumn("total_results", total)


def filter_active(df: DataFrame, *status_cols: str) -> DataFrame:
    """Keep rows whose entity (and relationship) status is ACTIVE."""
    cols = status_cols or ("status",)
    return df.where(_and([F.upper(F.col(c)) == "ACTIVE" for c in cols]))


def editable_predicate(schema: Column, table: Column, deny_schemas: list[str],
                       rules: list[tuple[str | None, str | None]]) -> Column:
    """True when the table description is editable: schema not denied and
    no rule matches (a rule matches when every regex it gives matches from
    the start of the string)."""
    not_editable = [schema.isin(deny_schemas)] if deny_schemas else []
    for schema_re, table_re in rules:
        parts = []
        if schema_re:
            parts.append(schema.rlike(f"^(?:{schema_re})"))
        if table_re:
            parts.append(table.rlike(f"^(?:{table_re})"))
        if parts:
            not_editable.append(_and(parts))
    if not not_editable:
        return F.lit(True)
    return ~F.coalesce(_or(not_editable), F.lit(False))


def editable_flag(tables: DataFrame, deny_schemas: list[str],
                  rules: list[tuple[str | None, str | None]]) -> DataFrame:
    return tables.withColumn("is_editable",
                             editable_predicate(F.col("schema"), F.col("name"), deny_schemas, rules))


def restrict_description_sources(prog_desc: DataFrame, exclude_patterns: list[str]) -> DataFrame:
    """Drop programmatic descriptions whose source matches (from the start)
    any exclude regex, rename camelCase sources to spaced lower case,
    de-duplicate by renamed source (the last by original source wins) and
    sort by source."""
    d = prog_desc.where(F.col("source").isNotNull())
    for p in exclude_patterns:
        d = d.where(~F.col("source").rlike(f"^(?:{p})"))
    d = dealt(d.withColumn("display_source", camel_to_words(F.col("source"))), "resource_key")
    g = d.groupBy("resource_key", "display_source").agg(
        F.max_by("text", "source").alias("text"))
    w = Window.partitionBy("resource_key").orderBy("display_source")
    return g.withColumn("position", F.row_number().over(w).cast("long")).withColumnRenamed(
        "display_source", "source")


def format_column_stats(stats: DataFrame, spec: dict[str, dict]) -> DataFrame:
    """Apply a stat-format spec: ``drop`` removes the stat, ``new_name``
    renames it, ``format`` (a printf pattern such as '%.2f') formats the
    numeric value; other stats are passed through as strings. The spec is a
    handful of config entries, compiled into CASE expressions."""
    st = F.col("stat_type")
    dropped = [k for k, v in spec.items() if v.get("drop")]
    out = stats.where(~st.isin(dropped)) if dropped else stats
    val = F.col("stat_val").cast("string")
    for k, v in spec.items():
        if v.get("format") and not v.get("drop"):
            val = F.when(st == k, F.format_string(v["format"], F.col("stat_val").cast("double"))) \
                .otherwise(val)
    name = st
    for k, v in spec.items():
        if v.get("new_name") and not v.get("drop"):
            name = F.when(st == k, F.lit(v["new_name"])).otherwise(name)
    return out.withColumn("stat_val", val).withColumn("stat_type", name)


def stat_order(stats: DataFrame, order: list[str]) -> DataFrame:
    """Position of each stat per column: configured index, unknown last
    (then by type name)."""
    idx = F.coalesce(F.array_position(F.array(*[F.lit(o) for o in order]), F.col("stat_type"))
                     .cast("int"), F.lit(len(order) + 1))
    idx = F.when(idx == 0, F.lit(len(order) + 1)).otherwise(idx)
    w = Window.partitionBy("column_key").orderBy(idx, F.col("stat_type"))
    return stats.withColumn("position", F.row_number().over(w).cast("long"))
