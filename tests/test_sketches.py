"""Property tests for the sketches and the per-batch Bloom semantics."""

import hashlib
import math

from pyspark.sql import functions as F

from postlake.operators import sketches as sk
from postlake.operators.topk import hour_of
from postlake.sources.tables import event_topics
from tests.conftest import SF001


def _positions(item, k, m):
    h = hashlib.md5(item.encode()).hexdigest()
    h1, h2 = int(h[0:8], 16), int(h[8:16], 16)
    return [(h1 + i * h2) % m for i in range(k)]


def test_bloom_size():
    m, k = sk.bloom_size(1_000_000, 0.01)
    assert 9_500_000 < m < 9_700_000 and k == 7


def test_bloom_dedup_equals_sequential_filter(spark):
    # tiny filter so that false positives really happen
    rows = [(f"u{i % 37}", i // 20, i) for i in range(300)]
    df = spark.createDataFrame(rows, "item string, batch int, ord int")
    cap, err = 20, 0.2
    got = {(r.item, r.batch): r.accepted for r in sk.bloom_dedup(df, "item", "batch", "ord", cap, err).collect()}
    grown = df.select(F.approx_count_distinct("item", 0.02)).first()[0]
    m, k = sk.bloom_size(max(cap, math.ceil(1.1 * grown)), err)
    bits, want = set(), {}
    for b in sorted({r[1] for r in rows}):
        batch_items = sorted({r[0] for r in rows if r[1] == b})
        for it in batch_items:
            want[(it, b)] = not all(p in bits for p in _positions(it, k, m))
        for it in batch_items:
            bits.update(_positions(it, k, m))
    assert got == want
    # never re-accepts an item accepted in an earlier batch (no false negatives)
    acc = {}
    for (it, b), a in sorted(got.items(), key=lambda x: x[0][1]):
        if a:
            assert it not in acc
            acc[it] = b


def test_bloom_grows_with_the_data(spark):
    """Ten times the first capacity: new items are still accepted."""
    rows = spark.range(20_000).selectExpr("cast(id AS string) AS item", "cast(id div 2000 AS int) AS batch", "id AS ord")
    out = sk.bloom_dedup(rows, "item", "batch", "ord", capacity=2_000, error=0.01)
    assert out.where("not accepted").count() <= 0.02 * 20_000


def test_count_min_never_underestimates(spark):
    t = event_topics(spark, SF001).select(hour_of(F.col("ts")).alias("hour"), "topic")
    exact = {(r.hour, r.topic): r.c for r in t.groupBy("hour", "topic").agg(F.count("*").alias("c")).collect()}
    sketch = sk.count_min_sketch(t, ["hour"], "topic", width=8, depth=3)
    est = {(r.hour, r.topic): r.estimate for r in sk.count_min_estimate(
        sketch, t.distinct(), ["hour"], "topic", width=8, depth=3).collect()}
    assert est.keys() == exact.keys()
    assert all(est[k] >= exact[k] for k in exact)
    assert any(est[k] > exact[k] for k in exact)     # width 8 forces collisions


def test_approx_topk_exact_when_small(spark):
    t = event_topics(spark, SF001).select(hour_of(F.col("ts")).alias("hour"), "topic")
    parts = t.withColumn("part", F.pmod(F.hash("topic"), F.lit(3)))
    approx = sk.approx_topk(sk.approx_topk_state(parts, ["hour", "part"], "topic"), ["hour"], "topic", k=5)
    got = sorted((r.hour, r["rank"], r.topic, r.item_count) for r in approx.collect())
    from postlake.operators.topk import hourly_topk
    ex = hourly_topk(event_topics(spark, SF001), k=5)
    want = sorted((r.hour, r["rank"], r.topic, r.topic_count) for r in ex.collect())
    assert got == want
