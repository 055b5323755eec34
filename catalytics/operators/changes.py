"""Change-feed application.

The reference mutates one edge per request inside a transaction. Here a
change table ``(seq, op, resource_type, resource_key, kind, value,
category, actor, ts)`` is applied in bulk to the current node/edge tables:

* the latest change per identity wins (``max_by(struct, seq)`` -- one
  partial aggregate, combine-before-shuffle, so a hot resource does not
  overload one task);
* the new state is (current anti-joined with touched identities) union
  (latest puts) -- no full outer join needed;
* rejected changes are returned as a separate frame with a reason.

Everything is a pure function of (current, changes); feeding the same
batch twice gives the same result, which the streaming variant relies on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PUT, DELETE = "put", "delete"


def latest_per_identity(changes: DataFrame, identity: list[str]) -> DataFrame:
    """One row per identity: the change with the highest seq."""
    payload = [c for c in changes.columns if c not in identity]
    g = changes.groupBy(*identity).agg(F.max_by(F.struct(*payload), "seq").alias("_c"))
    return g.select(*identity, *[F.col(f"_c.{c}").alias(c) for c in payload])


def _reject(df: DataFrame, reason: str) -> DataFrame:
    return df.select("seq", "resource_key", "kind", "value", F.lit(reason).alias("reason"))


def apply_descriptions(current: DataFrame, changes: DataFrame, resources: DataFrame):
    """current (resource_key, description). Puts upsert, deletes clear.
    Changes naming a missing resource are rejected.
    Returns (new_current, rejects)."""
    ch = changes.where(F.col("kind") == "description")
    keys = resources.select(F.col("key").alias("resource_key")).distinct()
    ok = ch.join(keys, "resource_key", "left_semi")
    rejects = _reject(ch.join(keys, "resource_key", "left_anti"), "missing resource")
    last = latest_per_identity(ok.select("resource_key", "seq", "op", "value"), ["resource_key"])
    kept = current.join(last.select("resource_key"), "resource_key", "left_anti")
    puts = last.where(F.col("op") == PUT).select("resource_key", F.col("value").alias("description"))
    return kept.unionByName(puts), rejects


def apply_owners(edges: DataFrame, users: DataFrame, changes: DataFrame, resources: DataFrame):
    """edges (resource_key, user_key). Put adds (idempotent) and creates
    the user when missing; delete removes the edge (both directions are
    one row here). Returns (new_edges, new_users, rejects)."""
    ch = changes.where(F.col("kind") == "owner").select(
        "seq", "op", "resource_key", F.col("value").alias("user_key"), "kind", "value")
    keys = resources.select(F.col("key").alias("resource_key")).distinct()
    ok = ch.join(keys, "resource_key", "left_semi")
    rejects = _reject(ch.join(keys, "resource_key", "left_anti"), "missing resource")
    last = latest_per_identity(ok.select("resource_key", "user_key", "seq", "op"),
                               ["resource_key", "user_key"])
    kept = edges.join(last.select("resource_key", "user_key"), ["resource_key", "user_key"], "left_anti")
    puts = last.where(F.col("op") == PUT).select("resource_key", "user_key")
    new_edges = kept.unionByName(puts)
    created = (puts.select(F.col("user_key").alias("email")).distinct()
               .join(users.select("email"), "email", "left_anti"))
    return new_edges, created, rejects


def apply_tags(edges: DataFrame, tag_nodes: DataFrame, changes: DataFrame, resources: DataFrame,
               badge_names: list[str]):
    """edges (resource_key, tag, tag_type); tag_nodes (tag, tag_type).
    Rejects: missing resource, tag_type 'badge', names reserved for badges.
    Put upserts the tag node (last tag_type wins) and the edge; delete
    removes the edge only when the type matches (applied in seq order);
    orphan tag nodes stay.
    Returns (new_edges, new_tag_nodes, rejects)."""
    ch = changes.where(F.col("kind") == "tag").select(
        "seq", "op", "resource_key", "kind", "value", F.col("value").alias("tag"),
        F.coalesce(F.col("category"), F.lit("default")).alias("tag_type"))
    keys = resources.select(F.col("key").alias("resource_key")).distinct()
    bad_type = ch.where(F.col("tag_type") == "badge")
    reserved = ch.where((F.col("tag_type") != "badge") & F.col("tag").isin(badge_names))
    valid = ch.where((F.col("tag_type") != "badge") & ~F.col("tag").isin(badge_names))
    missing = valid.join(keys, "resource_key", "left_anti")
    ok = valid.join(keys, "resource_key", "left_semi")
    rejects = (_reject(bad_type, "tag type badge").unionByName(_reject(reserved, "reserved badge name"))
               .unionByName(_reject(missing, "missing resource")))
    # Sequential semantics without replaying the sequence: the last put
    # (seq p, type x) wins unless a delete of the same type comes after it;
    # without a put, an existing edge of type y goes when any delete of type
    # y is in the batch. Two grouped aggregates, no window.
    ident = ["resource_key", "tag"]
    puts = (ok.where(F.col("op") == PUT).groupBy(*ident)
            .agg(F.max_by("tag_type", "seq").alias("ptype"), F.max("seq").alias("pseq")))
    dels = (ok.where(F.col("op") == DELETE).groupBy(*ident, "tag_type")
            .agg(F.max("seq").alias("dseq")))
    put_state = (puts.join(dels.withColumnRenamed("tag_type", "ptype"), ident + ["ptype"], "left")
                 .where(F.col("dseq").isNull() | (F.col("dseq") < F.col("pseq")))
                 .select(*ident, F.col("ptype").alias("tag_type")))
    untouched = (edges.join(puts.select(*ident), ident, "left_anti")
                 .join(dels, ident + ["tag_type"], "left_anti"))
    new_edges = untouched.select(*ident, "tag_type").unionByName(put_state)
    node_last = latest_per_identity(ok.where(F.col("op") == PUT).select("tag", "seq", "tag_type"), ["tag"])
    new_nodes = (tag_nodes.join(node_last.select("tag"), "tag", "left_anti")
                 .unionByName(node_last.select("tag", "tag_type")))
    return new_edges, new_nodes, rejects


def apply_badges(edges: DataFrame, changes: DataFrame, resources: DataFrame, whitelist: DataFrame):
    """edges (resource_key, badge_name, category). Category required and
    (name, category) must be whitelisted; delete of an absent badge is
    silent. Returns (new_edges, rejects)."""
    ch = changes.where(F.col("kind") == "badge").select(
        "seq", "op", "resource_key", "kind", "value", F.col("value").alias("badge_name"), "category")
    keys = resources.select(F.col("key").alias("resource_key")).distinct()
    no_cat = ch.where(F.col("category").isNull())
    has_cat = ch.where(F.col("category").isNotNull())
    wl = whitelist.select("badge_name", "category").distinct()
    not_wl = has_cat.join(wl, ["badge_name", "category"], "left_anti")
    good = has_cat.join(wl, ["badge_name", "category"], "left_semi")
    missing = good.join(keys, "resource_key", "left_anti")
    ok = good.join(keys, "resource_key", "left_semi")
    rejects = (_reject(no_cat, "category required").unionByName(_reject(not_wl, "not whitelisted"))
               .unionByName(_reject(missing, "missing resource")))
    ident = ["resource_key", "badge_name", "category"]
    last = latest_per_identity(ok.select(*ident, "seq", "op"), ident)
    kept = edges.join(last.select(*ident), ident, "left_anti")
    return kept.unionByName(last.where(F.col("op") == PUT).select(*ident)), rejects


def apply_user_relations(edges: DataFrame, users: DataFrame, changes: DataFrame,
                         resources: DataFrame, kind: str = "follow", soft_delete: bool = False):
    """edges (user_key, resource_key) for follow / own / read. Put upserts
    (creating the user), delete removes -- or, with ``soft_delete``, keeps
    the edge flagged inactive (Atlas style). Returns (edges, new_users, rejects)."""
    ch = changes.where(F.col("kind") == kind).select(
        "seq", "op", "resource_key", F.col("value").alias("user_key"), "kind", "value")
    keys = resources.select(F.col("key").alias("resource_key")).distinct()
    ok = ch.join(keys, "resource_key", "left_semi")
    rejects = _reject(ch.join(keys, "resource_key", "left_anti"), "missing resource")
    ident = ["user_key", "resource_key"]
    last = latest_per_identity(ok.select(*ident, "seq", "op"), ident)
    if soft_delete:
        cur = edges.withColumn("active", F.lit(True)).join(last.select(*ident, "op"), ident, "left")
        cur = cur.select(*ident, F.when(F.col("op") == DELETE, False).otherwise(F.col("active"))
                         .alias("active"))
        add = last.where(F.col("op") == PUT).join(edges, ident, "left_anti").select(
            *ident, F.lit(True).alias("active"))
        new_edges = cur.unionByName(add)
    else:
        kept = edges.join(last.select(*ident), ident, "left_anti")
        new_edges = kept.unionByName(last.where(F.col("op") == PUT).select(*ident))
    created = (last.where(F.col("op") == PUT).select(F.col("user_key").alias("email")).distinct()
               .join(users.select("email"), "email", "left_anti"))
    return new_edges, created, rejects


def upsert_users(users: DataFrame, incoming: DataFrame, props: list[str], audit_ts=None) -> DataFrame:
    """Insert or merge users by email. Only truthy incoming values (not
    NULL, not '') overwrite; ``created`` flags new users; ``updated_at``
    is the audit timestamp of the merge (rows not touched keep NULL)."""
    inc = incoming.select("email", *[F.col(p).alias(f"_n_{p}") for p in props]).withColumn("_in", F.lit(True))
    cur = users.select("email", *props).withColumn("_old", F.lit(True))
    j = cur.join(inc, "email", "full")

    def merged(p):
        new = F.col(f"_n_{p}")
        truthy = new.isNotNull() & (new.cast("string") != "")
        return F.when(truthy, new).otherwise(F.col(p)).alias(p)
    ts = F.lit(audit_ts).cast("timestamp") if audit_ts is not None else F.current_timestamp()
    return j.select("email", *[merged(p) for p in props],
                    F.col("_old").isNull().alias("created"),
                    F.when(F.col("_in").isNotNull(), ts).alias("updated_at"))


def property_diff(old: DataFrame, new: DataFrame, key: str, props: list[str]) -> DataFrame:
    """Per key present on both sides: properties whose value changed (null
    safe, new value present) and properties dropped (old present, new
    NULL). Array properties compare as sets."""
    kinds = dict(new.dtypes)

    def value(p):
        c = F.col(p)
        return F.array_sort(F.array_distinct(c)) if kinds[p].startswith("array") else c

    o = old.select(key, *[value(p).alias(f"_o_{p}") for p in props])
    n = new.select(key, *[value(p).alias(f"_n_{p}") for p in props])
    j = o.join(n, key)
    changed = [F.when(F.col(f"_n_{p}").isNotNull() & ~F.col(f"_o_{p}").eqNullSafe(F.col(f"_n_{p}")),
                      F.lit(p)) for p in props]
    dropped = [F.when(F.col(f"_o_{p}").isNotNull() & F.col(f"_n_{p}").isNull(), F.lit(p)) for p in props]
    return j.select(key, F.array_compact(F.array(*changed)).alias("changed"),
                    F.array_compact(F.array(*dropped)).alias("dropped")) \
        .where((F.size("changed") > 0) | (F.size("dropped") > 0))


def expire_other_links(edges: DataFrame, keep: DataFrame, src: str, dst: str) -> DataFrame:
    """For every source in ``keep`` (src, dst), drop its edges to any other
    target; sources not in ``keep`` are untouched."""
    k = keep.select(src, F.col(dst).alias("_keep")).distinct()
    j = edges.join(k, src, "left")
    return j.where(F.col("_keep").isNull() | (F.col(dst) == F.col("_keep"))).drop("_keep").distinct()


def expire_link(edges: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Drop edges between each pair, in both directions."""
    fwd = pairs.select(F.col(a), F.col(b))
    rev = pairs.select(F.col(b).alias(a), F.col(a).alias(b))
    return edges.join(fwd.unionByName(rev).distinct(), [a, b], "left_anti")


def link_if_absent(edges: DataFrame, new: DataFrame, src_nodes: DataFrame, dst_nodes: DataFrame,
                   src: str, dst: str) -> DataFrame:
    """Add new edges unless an equal edge (all columns) exists; both
    endpoints must exist (node frames have one column, the key). NULL
    properties are equal to each other.
    Returns the added edges."""
    ok = (new.join(src_nodes.toDF(src).distinct(), src, "left_semi")
          .join(dst_nodes.toDF(dst).distinct(), dst, "left_semi"))
    same = edges.select(*[F.col(c).alias(f"_e_{c}") for c in new.columns])
    equal = [F.col(c).eqNullSafe(F.col(f"_e_{c}")) for c in new.columns]
    return ok.join(same, equal, "left_anti").distinct()


def upsert_documents(docs: DataFrame, batch: DataFrame, key: str = "key") -> DataFrame:
    """Index documents by id: new ids inserted, existing ids partially
    updated (NULL fields in the batch keep the stored value); batch rows
    with op 'delete' remove the id. Latest seq per id wins."""
    fields = [c for c in docs.columns if c != key]
    last = latest_per_identity(batch, [key])
    kept = docs.join(last.select(key), key, "left_anti")
    upd = (last.where(F.col("op") == PUT).alias("b")
           .join(docs.alias("d"), key, "left")
           .select(key, *[F.coalesce(F.col(f"b.{f}"), F.col(f"d.{f}")).alias(f) for f in fields]))
    return kept.unionByName(upd)


def delete_documents(docs: DataFrame, ids: DataFrame, key: str = "key") -> DataFrame:
    return docs.join(ids.select(key), key, "left_anti")


def update_doc_tags(docs: DataFrame, changes: DataFrame, key: str = "key") -> DataFrame:
    """Apply tag changes to the ``tags`` array of search documents, in seq
    order: put = remove the same name then append; delete = remove.
    Equivalent set form: the last change per (doc, tag) decides presence;
    untouched tags keep their place, re-added tags go to the end in seq
    order."""
    orig = docs.select(key, F.posexplode("tags").alias("pos", "tag")).withColumn(
        "seq", F.lit(None).cast("long"))
    last = latest_per_identity(changes.select(key, "tag", "seq", "op"), [key, "tag"])
    j = orig.join(last.select(key, "tag", F.col("seq").alias("cseq"), "op"), [key, "tag"], "full")
    present = j.where(F.col("op").isNull() | (F.col("op") == PUT))
    order = F.when(F.col("op").isNull(), F.struct(F.lit(0).alias("g"), F.col("pos").cast("long").alias("o"))) \
        .otherwise(F.struct(F.lit(1).alias("g"), F.col("cseq").alias("o")))
    tags = present.groupBy(key).agg(F.transform(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("tag")))), lambda x: x["tag"])
        .alias("new_tags"))
    return docs.join(tags, key, "left").select(
        *[c for c in docs.columns if c != "tags"],
        F.coalesce("new_tags", F.array().cast("array<string>")).alias("tags"))


def tag_partition(tag_usage: DataFrame, curated: list[str] | None = None, n: int = 20) -> DataFrame:
    """Split tags for display: without a curated list, the top n by count
    are 'popular' and the rest 'other' (zero counts dropped); with one,
    curated tags (even with count 0) vs 'other'. Sorted by group, name
    (a distributed range sort; no single-partition window)."""
    t = tag_usage
    if curated:
        cur = t.sparkSession.createDataFrame([(c,) for c in curated], "tag_name string")
        t = t.join(F.broadcast(cur), "tag_name", "full").withColumn(
            "tag_count", F.coalesce("tag_count", F.lit(0).cast("long")))
        t = t.withColumn("group", F.when(F.col("tag_name").isin(curated), "curated").otherwise("other"))
    else:
        t = t.where(F.col("tag_count") > 0)
        top = t.orderBy(F.desc("tag_count"), F.asc("tag_name")).limit(n).select(
            "tag_name", F.lit("popular").alias("_g"))
        # the top-n side holds at most n rows
        t = t.join(F.broadcast(top), "tag_name", "left").withColumn(
            "group", F.coalesce("_g", F.lit("other"))).drop("_g")
    return t.orderBy("group", "tag_name")
