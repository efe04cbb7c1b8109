"""Sketch queries over ``events`` topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.operators import decay_topk as dk
from postlake.operators import sketches as sk
from postlake.operators.bloom_store import BloomStore
from postlake.operators.topk import hour_of
from postlake.plans.registry import register
from postlake.plans.sql import EVENT_TOPICS, POSTS, with_
from postlake.session import scratch_path
from postlake.sources.tables import event_topics, posts, read_table

_M, _K = sk.bloom_size()
_MD5 = "CAST(('0x' || substr(md5({x}), {s}, 8)) AS BIGINT)"


@register("approx_topk", sql=with_(EVENT_TOPICS) + """
SELECT hour, topic, rank, item_count FROM (
  SELECT hour, topic, topic_count AS item_count,
         row_number() OVER (PARTITION BY hour ORDER BY topic_count DESC, topic) AS rank
  FROM (SELECT date_trunc('hour', ts) AS hour, topic, count(*) AS topic_count FROM event_topics GROUP BY 1, 2))
WHERE rank <= 15""")
def q_approx_topk(spark, sf_dir):
    """Sketches of four parts of the stream are merged to one per hour."""
    t = event_topics(spark, sf_dir).select(hour_of(F.col("ts")).alias("hour"), (F.col("event_id") % 4).alias("part"), "topic")
    states = sk.approx_topk_state(t, ["hour", "part"], "topic")
    return sk.approx_topk(states, ["hour"], "topic", k=15).select("hour", "topic", "rank", "item_count")


_LN = 0.10536051565782628  # ln(1 / 0.9)
_HELD = """{name} AS (SELECT hour, batch, row, bucket, topic, n, sum(n + others) OVER cell - n AS others FROM {source}
  WINDOW cell AS (PARTITION BY hour, batch, row, bucket)
  QUALIFY row_number() OVER (PARTITION BY hour, batch, row, bucket ORDER BY n DESC, topic) = 1)"""


@register("decaying_topk", sql=with_(EVENT_TOPICS) + f""",
c AS (SELECT date_trunc('hour', ts) AS hour, CAST(floor(extract(minute FROM ts) / 20) AS INTEGER) AS batch, topic, count(*) AS n
      FROM event_topics WHERE topic IS NOT NULL GROUP BY ALL),
cells AS (SELECT hour, batch, r AS row, {_MD5.format(x="CAST(r AS VARCHAR) || ':' || topic", s=1)} % {dk.WIDTH} AS bucket, topic, n, 0 AS others
          FROM c, range({dk.DEPTH}) AS rr(r)),
{_HELD.format(name="state", source="cells")},
keys AS (SELECT DISTINCT hour, batch FROM state),
grown AS (SELECT s.hour, k.batch, s.row, s.bucket, s.topic, CAST(sum(s.n) AS BIGINT) AS n, CAST(sum(s.others) AS BIGINT) AS others
          FROM state s JOIN keys k ON k.hour = s.hour AND s.batch <= k.batch GROUP BY ALL),
{_HELD.format(name="merged", source="grown")},
cut AS (SELECT *, 1 - others * {_LN} * pow(0.9::DOUBLE, n) AS rest FROM merged),
items AS (SELECT hour, batch, topic, max(round(greatest(0, CASE WHEN rest > 0 THEN n + ln(rest) / {_LN} ELSE 0 END), 6)) AS item_count
          FROM cut GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY hour, batch ORDER BY item_count DESC, topic) AS rank FROM items WHERE item_count > 0
        QUALIFY rank <= {dk.TOPK_K}),
after AS (SELECT hour, batch, lead(batch) OVER (PARTITION BY hour ORDER BY batch) AS next FROM keys)
SELECT t.hour, t.batch, t.topic, t.rank, CAST(t.item_count AS DOUBLE) AS item_count, a.next IS NOT NULL AND s.topic IS NULL AS evicted
FROM top t JOIN after a ON a.hour = t.hour AND a.batch = t.batch
LEFT JOIN top s ON s.hour = t.hour AND s.batch = a.next AND s.topic = t.topic""")
def q_decaying_topk(spark, sf_dir):
    """Top topics of every hour so far, after each of its three parts, and those
    that the next part evicts."""
    t = event_topics(spark, sf_dir).select(hour_of(F.col("ts")).alias("hour"), F.floor(F.minute("ts") / 20).cast("int").alias("batch"), "topic")
    path = scratch_path(spark, "topic-tables")
    dk.count_table(t, ["hour", "batch"], "topic").write.parquet(path)
    return dk.top_by_batch(spark.read.parquet(path), ["hour"], "batch").select("hour", "batch", F.col("item").alias("topic"), "rank", "item_count", "evicted")


@register("count_min", sql=with_(EVENT_TOPICS) + f""",
t AS (SELECT date_trunc('hour', ts) AS hour, topic FROM event_topics),
b AS (SELECT hour, topic, r AS row,
             {_MD5.format(x="CAST(r AS VARCHAR) || ':' || topic", s=1)} % {sk.CMS_WIDTH} AS bucket
      FROM t, range({sk.CMS_DEPTH}) AS rr(r)),
sketch AS (SELECT hour, row, bucket, count(*) AS counter FROM b GROUP BY 1, 2, 3),
probes AS (SELECT DISTINCT hour, topic, row, bucket FROM b)
SELECT p.hour, p.topic, min(s.counter) AS estimate
FROM probes p JOIN sketch s USING (hour, row, bucket) GROUP BY 1, 2""")
def q_count_min(spark, sf_dir):
    t = event_topics(spark, sf_dir).select(hour_of(F.col("ts")).alias("hour"), "topic")
    sketch = sk.count_min_sketch(t, ["hour"], "topic")
    return sk.count_min_estimate(sketch, t.distinct(), ["hour"], "topic")


@register("dedup_bloom", sql=f"""
WITH f AS (SELECT CAST(user_id AS VARCHAR) || ':' || event_type AS item, CAST(ts AS DATE) AS batch,
                  min(event_id) AS event_id FROM events GROUP BY 1, 2),
pos AS (SELECT item, batch, event_id,
               ({_MD5.format(x="item", s=1)} + i * {_MD5.format(x="item", s=9)}) % {_M} AS p
        FROM f, range({_K}) AS r(i)),
fs AS (SELECT p, min(batch) AS first_batch FROM pos GROUP BY 1)
SELECT item, batch, event_id, max(first_batch) >= batch AS accepted
FROM pos JOIN fs USING (p) GROUP BY 1, 2, 3""")
def q_dedup_bloom(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_type")).alias("item"),
        F.col("ts").cast("date").alias("batch"), "event_id")
    return sk.bloom_dedup(e, "item", "batch", "event_id")


# No false rejection at this size: the stored filter is far from full.
@register("bloom_store", sql=with_(POSTS) + """
SELECT 0 AS run, uri AS item, true AS accepted FROM posts WHERE doc_id % 2 = 0
UNION ALL SELECT 1, uri, doc_id % 2 <> 0 FROM posts""")
def q_bloom_store(spark, sf_dir):
    """D2 kept between runs: a first run takes in half of the posts; a second
    one, which has only the stored bits, rejects these and takes the others."""
    p = posts(spark, sf_dir).select("doc_id", F.col("uri").alias("item"))
    path = scratch_path(spark, "bloom-store")
    first = BloomStore(spark, path).add(p.where("doc_id % 2 = 0"), 0)
    second = BloomStore(spark, path).add(p, 1)
    return (first.select(F.lit(0).alias("run"), "item", "accepted")
            .unionByName(second.select(F.lit(1).alias("run"), "item", "accepted")))
