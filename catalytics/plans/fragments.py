"""Plan fragments.

* ``topk_per_key``: per-key ``ORDER BY .. LIMIT k`` for every key at once.
  Spark plans ``row_number() <= k`` over a window as a shuffle on the key
  plus a per-partition sort; with a rank filter Spark 3.5+ inserts a
  WindowGroupLimit below the shuffle so each map task only ships its local
  top k per key (a hot key does not ship its whole group).
* ``collect_distinct_children``: pre-aggregate a child edge table to one
  row per parent *before* joining, so parent x child x child never fans out.
* ``gather_children``: several such roll-ups of one parent in one grouping.
* ``cut_lineage``: checkpoint to the shared folder named by the session.
* ``written``: a table in the shared folder, computed once for several readers.
* ``spread``: a side of a join that is never sent whole to every task.
* ``dealt``: rows by hash of some columns, before a grouping by them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalytics.session import ensure_checkpoint_dir, scratch_path


def _cols(cols) -> list:
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def topk_per_key(df: DataFrame, key, order: Sequence[Column], k: int,
                 rank_col: str | None = None) -> DataFrame:
    """Top ``k`` rows per ``key`` by ``order`` (which must end in a unique
    tie-break for deterministic output)."""
    w = Window.partitionBy(*_cols(key)).orderBy(*order)
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    if rank_col is None:
        return out.drop(name)
    return out.withColumn(name, F.col(name).cast("long"))


def collect_distinct_children(edges: DataFrame, parent: str, child, out: str,
                              sort: bool = True) -> DataFrame:
    """``collect(distinct child)`` per parent, nulls dropped, sorted for
    determinism. ``child`` may be a column name or a struct Column.

    Spark plans collect_set as a partial (map-side) aggregate, so a hot
    parent is combined before the shuffle. For children that are bounded per
    parent; return (parent, child) rows otherwise."""
    c = F.col(child) if isinstance(child, str) else child
    e = edges.where(c.isNotNull()).select(F.col(parent), c.alias("_child"))
    agg = F.collect_set("_child")
    if sort:
        agg = F.array_sort(agg)
    return e.groupBy(parent).agg(agg.alias(out))


def gather_children(parent: str, sets: dict | None = None, latest: dict | None = None,
                    totals: dict | None = None) -> DataFrame:
    """All child collections of a kind of parent by one shuffle and one
    grouping. Each entry is name -> (frame, its parent column, child column);
    the frames become one tagged union in which only the child's own column is
    set. ``sets`` give the sorted distinct children, nulls dropped (null for a
    parent with none), ``latest`` the greatest and ``totals`` the sum.

    Sets are for children that are bounded per parent, as in
    ``collect_distinct_children``; partial aggregates combine before the
    shuffle, so a hot parent is combined where its rows are."""
    entries = [(n, e, k) for k, d in (("set", sets), ("max", latest), ("sum", totals)) for n, e in (d or {}).items()]
    rows = None
    for name, (df, key, child), _ in entries:
        c = F.col(child) if isinstance(child, str) else child
        part = df.select(F.col(key).alias(parent), c.alias(name)).where(F.col(name).isNotNull())
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    # one set of sparse structs: a group holds one buffer, not one for each kind
    names = [n for n, _, kind in entries if kind == "set"]
    child = F.struct(*names) if names else F.lit(None)
    some = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names], F.lit(False))
    held = F.collect_set(F.when(some, child)).alias("__all")
    how = {"max": F.max, "sum": F.sum}
    out = rows.groupBy(parent).agg(*([held] if names else []), *[how[kind](n).alias(n) for n, _, kind in entries if kind != "set"])

    def of(name: str) -> Column:
        found = F.transform(F.filter("__all", lambda x: x[name].isNotNull()), lambda x: x[name])
        return F.when(F.size(found) > 0, F.array_sort(found)).alias(name)

    return out.select(parent, *[of(n) if kind == "set" else F.col(n) for n, _, kind in entries])


def spread(df: DataFrame) -> DataFrame:
    """``df`` as a side of the next join that is shuffled and sorted. Without
    this Spark broadcasts a table whose files are below the threshold, and a
    file of a few MB can hold millions of rows. The hint passes through
    selections, filters and groupings up to the join."""
    return df.hint("merge")


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` by hash of ``columns`` in as many parts as a shuffle has. A
    grouping by these and more columns then needs no partial groups in the
    scan, whose few large tasks would hold nearly every row as a group."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut a long logical plan (iterative operators) with a reliable
    checkpoint in the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
