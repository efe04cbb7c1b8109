"""Decaying top-k: overlap with exact counts, merge bound, decay by simulation."""

import functools
import math
import random

import duckdb
from pyspark.sql import functions as F

from postlake.operators import decay_topk as dk
from postlake.plans.sql import EVENT_TOPICS, with_
from postlake.sources.tables import event_topics


def _exact(sf, k=15):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    return [r[0] for r in c.execute(with_(EVENT_TOPICS) + f"SELECT topic FROM event_topics GROUP BY 1 ORDER BY count(*) DESC, topic LIMIT {k}").fetchall()]


def test_overlap_with_exact_top(spark):
    sf = "/root/testdata/sf0.1"
    t = event_topics(spark, sf).withColumn("part", F.col("event_id") % 4)
    one = dk.merge(dk.count_table(t, ["part"], "topic"), [])
    for width in (dk.WIDTH, 300):
        table = one if width == dk.WIDTH else dk.count_table(t, [], "topic", width=width)
        got = [r["item"] for r in dk.top_items(table, []).orderBy("rank").collect()]
        want = _exact(sf)
        assert len(set(got) & set(want)) >= 0.9 * len(want)


def _items(spark, rows):
    return spark.createDataFrame(rows, "part int, item string")


def test_merge_order_within_the_bound(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(4), f"i{int(rnd.paretovariate(0.7)) % 90}") for _ in range(4000)]
    true: dict[str, int] = {}
    for _, i in rows:
        true[i] = true.get(i, 0) + 1
    parts = [dk.count_table(_items(spark, [r for r in rows if r[0] == p]), [], "item", width=7, depth=3).cache() for p in range(4)]
    totals = set()
    for order in ((0, 1, 2, 3), (3, 1, 0, 2)):
        table = functools.reduce(lambda a, b: dk.merge(a.unionByName(b), []), [parts[p] for p in order]).collect()
        totals.add(frozenset((r.row, r.bucket, r.n + r.others) for r in table))
        assert all(true[r["item"]] - r.others <= r.n <= true[r["item"]] for r in table)
    assert len(totals) == 1 and sum(n for *_, n in next(iter(totals))) == 3 * len(rows)


def test_decay_is_the_expectation_of_single_losses(spark):
    rnd = random.Random(9)
    cases = [(3, 0), (20, 40), (30, 15), (10, 200), (60, 500), (5000, 900)]
    got = {(r.n, r.m): r.c for r in spark.createDataFrame(cases, "n long, m long").withColumn("c", dk.decayed(F.col("n"), F.col("m"))).collect()}
    for n, m in cases:
        runs = []
        for _ in range(300):
            c = n
            for _ in range(m):
                if c and rnd.random() < dk.DECAY ** c:
                    c -= 1
            runs.append(c)
        assert abs(sum(runs) / len(runs) - got[n, m]) < 1.5
    assert got[3, 0] == 3 and got[10, 200] == 0 and math.isclose(got[5000, 900], 5000)


def test_evictions_and_awkward_rows(spark):
    rows = [(0, "a")] * 3 + [(0, "b")] * 2 + [(1, "c")] * 5 + [(2, "b")] * 9 + [(2, None)]
    tables = dk.count_table(_items(spark, rows).selectExpr("0 AS g", "part AS batch", "item", "'x' AS row", "1 AS n"), ["g", "batch"], "item")
    got = {(r.batch, r["item"]): (r["rank"], r.item_count, r.evicted) for r in dk.top_by_batch(tables, ["g"], "batch", k=2).collect()}
    assert got == {(0, "a"): (1, 3, False), (0, "b"): (2, 2, True), (1, "c"): (1, 5, False), (1, "a"): (2, 3, True),
                   (2, "b"): (1, 11, False), (2, "c"): (2, 5, False)}
    assert dk.top_items(dk.count_table(_items(spark, []), [], "item"), []).count() == 0
