"""The bucketed keyed table and the search cursor."""

import os
import random

from pyspark.sql import functions as F

from postlake.operators import keyed, tables
from postlake.session import scratch_path

SCHEMA = "id string, v long, t long"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_upserts_equal_a_dictionary(spark):
    rng = random.Random(2)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first = frame([])
    table = keyed.KeyedTable(spark, scratch_path(spark, "kt"), first.schema, "id", "t", 8)
    assert table.read().count() == 0 and table.upsert(first) == []
    want = {}
    for _ in range(4):
        rows = [(rng.choice([None, *[f"k{i}" for i in range(30)]]), rng.randrange(100), rng.choice([None, *range(9)])) for _ in range(40)]
        table.upsert(frame(rows))
        for k, v, t in rows:
            new = (t is not None, -1 if t is None else t, v)
            if k not in want or new > want[k]:
                want[k] = new
        assert _rows(table.read()) == sorted(((k, v, t if has else None) for k, (has, t, v) in want.items()), key=str)
    before = _rows(table.read())
    table.upsert(frame(rows))                       # a replayed update changes nothing
    assert _rows(table.read()) == before
    table.update_field(spark.createDataFrame([("k1", 777), ("nobody", 1), ("k2", None)], "id string, v long"), "v")
    assert _rows(table.read()) == sorted(((k, 777 if k == "k1" else v, t) for k, v, t in before), key=str)


def test_only_touched_buckets_are_rewritten(spark):
    df = spark.range(20_000).selectExpr("concat('key', id) AS id", "id AS v", "id AS t")
    table = keyed.KeyedTable(spark, scratch_path(spark, "kt"), df.schema, "id", "t", 32)
    assert len(table.upsert(df)) == 32
    before = _files(table.path)
    size = sum(map(os.path.getsize, before))
    touched = table.upsert(df.where("id IN ('key5', 'key77')").withColumn("t", F.lit(10 ** 9)))
    kept, new = before & _files(table.path), _files(table.path) - before
    assert len(touched) <= 2 and len(new) == len(touched) and len(kept) == 32 - len(touched)
    assert sum(map(os.path.getsize, new)) < 0.1 * size and table.read().count() == 20_000


def test_cursors_give_the_ranked_pages(spark):
    rows = [(f"at://{i % 37}/{i}", 1_000_000 * (i // 3), "has term" if i % 4 else "none") for i in range(300)] + [("x", None, "term"), ("y", 5, None)]
    posts = spark.createDataFrame(rows, "uri string, time_us long, text string")
    path = scratch_path(spark, "posts")
    posts.write.parquet(path)
    as_of = F.lit(99_000_000)
    ranked = tables.search_posts(posts, "term", as_of, page_size=20).orderBy("position").collect()
    got, cursor, pages = [], None, 0
    while True:
        stored = spark.read.parquet(path)           # every page reads anew: nothing but the cursor is kept
        page, cursor = keyed.search_page(stored, "term", as_of, cursor, page_size=20)
        got += [(r.uri, pages) for r in page.collect()]
        pages += 1
        if cursor is None:
            break
    assert got == [(r.uri, r.page_no) for r in ranked] and len({u for u, _ in got}) == len(got)
    empty, none = keyed.search_page(posts, "nowhere", as_of)
    assert empty.count() == 0 and none is None


def test_an_upsert_moves_its_rows_once(spark):
    """One exchange deals the rows for the merge and the write."""
    df = spark.range(500).selectExpr("concat('key', id % 100) AS id", "id AS v", "cast(null AS long) AS t")
    table = keyed.KeyedTable(spark, scratch_path(spark, "kt"), df.schema, "id", "t", 4)
    merged = table._merge(table._bucketed(df))
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange ") == 1, plan
    table.upsert(df)
    assert _rows(table.read()) == sorted(((f"key{i}", 400 + i, None) for i in range(100)), key=str)
    assert len(_files(table.path)) == 4
