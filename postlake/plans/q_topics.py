"""Trending-topic queries over ``events``."""

from __future__ import annotations

from postlake.operators import topk
from postlake.plans.registry import register
from postlake.plans.sql import EVENT_TOPICS, with_
from postlake.sources import event_topics


@register("hourly_topk", sql=with_(EVENT_TOPICS) + """
SELECT hour, topic, topic_count, rank FROM (
  SELECT hour, topic, topic_count,
         row_number() OVER (PARTITION BY hour ORDER BY topic_count DESC, topic) AS rank
  FROM (SELECT date_trunc('hour', ts) AS hour, topic, count(*) AS topic_count
        FROM event_topics GROUP BY 1, 2))
WHERE rank <= 15""")
def q_hourly_topk(spark, sf_dir):
    return topk.hourly_topk(event_topics(spark, sf_dir), k=topk.TOPK_K)
