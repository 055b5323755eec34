"""Forms that keep the work in proportion to the input, against plain ones."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalytics.operators import co_readers as CO
from catalytics.operators import details as D

READS = "user_key string, table_key string, read_count long"


def _reads():
    rows = [(f"u{u}", f"t{t}", 1 + (u * 7 + t) % 5) for u in range(14) for t in range(9) if (u + 2 * t) % 3 != 0]
    rows += [(f"u{u}", "hot", 2) for u in range(20)] + [(f"u{u}", f"t{u % 9}", 3) for u in range(14)]
    return rows + [("solo", "t1", 1), ("lone", "own", 4), ("u1", None, 1), (None, "t1", 5), ("u3", "t2", None)]


def test_path_stats_by_short_lists_match_paths(spark):
    reads = spark.createDataFrame(_reads(), READS)
    got = {tuple(r) for r in D.co_reader_path_stats(reads, chunk=2).select(
        "user_key", "n_paths", "n_co_readers", "path_reads").collect()}
    edges = defaultdict(list)
    for u, t, rc in _reads():
        edges[u].append((t, rc or 0))
    want = set()
    for u in edges.keys() - {None}:
        paths = [(co, rc) for via, _ in edges[u] for co in edges.keys() - {None, u} for shared, _ in edges[co]
                 if via is not None and shared == via for t, rc in edges[co] if t != via]
        if paths:
            want.add((u, len(paths), len({co for co, _ in paths}), sum(rc for _, rc in paths)))
    assert got == want


def test_path_stats_make_no_row_per_pair_of_users(spark):
    """300 readers of one table are 90,000 pairs, but 300 rows with lists."""
    rows = [(f"u{u}", t, 1) for u in range(300) for t in ("hot", f"own{u}")]
    df = D.co_reader_path_stats(spark.createDataFrame(rows, READS))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "__co" in plan
    assert {tuple(r) for r in df.select("n_paths", "n_co_readers", "path_reads").collect()} == {(299, 299, 299)}
    assert df.agg(F.count(F.lit(1))).first()[0] == 300


def test_held_blocks_match_streamed_blocks(spark, monkeypatch):
    """Blocks that hold their co-readers' edges, in rows of a few edges, give
    what blocks that hold their sums do."""
    reads = spark.createDataFrame(_reads(), READS)
    streamed = {tuple(r) for r in CO.co_reader_tops(reads, 4, 3, held_edges=0).collect()}
    assert {tuple(r) for r in CO.co_reader_tops(reads, 4, 3).collect()} == streamed and streamed
    monkeypatch.setattr(CO, "HELD_BLOCKS", 5)
    monkeypatch.setattr(CO._held_tops, "__defaults__", (2,))
    assert {tuple(r) for r in CO.co_reader_tops(reads, 4, 3).collect()} == streamed


def test_a_reader_is_sent_once_to_each_of_a_bounded_number_of_blocks(spark, monkeypatch):
    sent = []
    kept = CO._held_tops

    def held(e, asking, n_tables, n_asking, *more):
        sent.append(-(-n_asking // max(1, min(CO.HELD_USERS, -(-n_asking // CO.HELD_BLOCKS)))))
        return kept(e, asking, n_tables, n_asking, *more)

    monkeypatch.setattr(CO, "_held_tops", held)
    rows = [(f"u{u}", f"t{t}", 1) for u in range(200) for t in (u % 3, 3 + u)]
    CO.co_reader_tops(spark.createDataFrame(rows, READS), 3, 2, block_sums=10).count()
    assert sent and sent[0] <= CO.HELD_BLOCKS


def test_blocks_read_the_edges_and_are_not_sent_them(spark, monkeypatch):
    """Nothing above the packed lists is shuffled, a task reads for one block,
    and the lists hold each edge once however many blocks there are."""
    tables = []
    kept, held = CO.written, CO._held_tops

    def seen(df, name):
        tables.append((name, kept(df, name)))
        return tables[-1][1]

    def tops(*args):
        df = held(*args)
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert not any(x in plan for x in ("Exchange", "Repartition", "Generate")) and "Union" in plan
        assert df.rdd.getNumPartitions() > -(-args[3] // -(-args[3] // blocks))
        return df

    monkeypatch.setattr(CO, "written", seen)
    monkeypatch.setattr(CO, "_held_tops", tops)
    reads = spark.createDataFrame(_reads(), READS)
    found = []
    for blocks in (1, 20):
        monkeypatch.setattr(CO, "HELD_BLOCKS", blocks)
        found.append({tuple(r) for r in CO.co_reader_tops(reads, 4, 3).collect()})
    lists = [df.where("kind = 0").select(F.sum(F.length("a") / 4)).first()[0] for name, df in tables if name == "co-lists"]
    assert found[0] == found[1] and found[0]
    assert lists == [len({(u, t) for u, t, _ in _reads() if u and t})] * 2


def test_no_more_blocks_than_scans_in_a_plan(spark, monkeypatch):
    reads = spark.createDataFrame(_reads(), READS)
    want = {tuple(r) for r in CO.co_reader_tops(reads, 4, 3).collect()}
    monkeypatch.setattr(CO, "HELD_USERS", 1)
    monkeypatch.setattr(CO, "MOST_BLOCKS", 4)
    assert {tuple(r) for r in CO.co_reader_tops(reads, 4, 3).collect()} == want


@pytest.mark.parametrize("list_edges", [1, 7, 1000])
def test_packed_lists_hold_every_row(spark, list_edges):
    rows = [(1, i, 300) for i in range(50)] + [(2, 5, -1), (4, 6, 70_000), (4, 7, 0)] + [(9, i, i) for i in range(20)]
    df = CO.packed(spark.createDataFrame(rows, "u long, x long, rc long").repartition(5), 0, "u", {"x": np.dtype(np.int32), "rc": np.dtype(np.int32)}, list_edges)
    types = [np.dtype(np.int32)] * 4
    pieces = [[CO._unpacked(b.column(i + 1), t) for i, t in enumerate(types)] for b in df.toArrow().to_batches() if b.num_rows]
    lo, n, (x, rc) = CO._lists(pieces)
    got = sorted((u, int(x[i]), int(rc[i])) for u in range(len(lo)) for i in range(lo[u], lo[u] + n[u]))
    assert got == sorted(rows) and n.sum() == len(rows)
