"""Filter, keyed-table, dedup and search queries (P1, P3, P4, S5, S13, S14,
D1, A8, A9, S16) plus topic aggregates (A1, A4, A5, A6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.functions import text as tx
from postlake.operators import filters, keyed, tables, topk
from postlake.plans.registry import register
from postlake.plans.sql import EVENT_TOPICS, NOT_BLANK_SQL, POSTS, with_
from postlake.session import scratch_path
from postlake.sources.tables import POST_EPOCH_US, event_topics, posts, read_table, stored_time_range

_JTRIM = "regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"

# Fixture parameters of the registered queries.
LANG = "fr"
RANGE_START_US = POST_EPOCH_US + 2 * 3600 * 1_000_000
RANGE_END_US = POST_EPOCH_US + 8 * 3600 * 1_000_000
CAP_LEN = 5000                 # stream cap for the fixture (the reference cap is 1,000,000)
SEARCH_TERM = "that"
CURSOR_PAGES = 3               # pages read through cursors


@register("content_filter", sql=with_(POSTS) + """
SELECT doc_id, uri FROM posts
WHERE text IS NOT NULL AND regexp_matches(text, '""" + NOT_BLANK_SQL + """') AND operation IS DISTINCT FROM 'delete'""")
def q_content_filter(spark, sf_dir):
    return filters.content_filter(posts(spark, sf_dir)).select("doc_id", "uri")


@register("lang_filter", sql=with_(POSTS) + f"""
SELECT doc_id FROM posts WHERE list_bool_or(list_transform(langs, lambda x: lower(x) = '{LANG}'))""")
def q_lang_filter(spark, sf_dir):
    return filters.lang_filter(posts(spark, sf_dir), LANG).select("doc_id")


@register("time_range", sql=with_(POSTS) + f"""
SELECT doc_id, time_us FROM posts WHERE time_us >= {RANGE_START_US} AND time_us < {RANGE_END_US}""")
def q_time_range(spark, sf_dir):
    stored = posts(spark, sf_dir).filter(stored_time_range(RANGE_START_US, RANGE_END_US))
    return filters.time_range(stored, RANGE_START_US, RANGE_END_US).select("doc_id", "time_us")


@register("dedup_exact", sql="""
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events)
WHERE rn = 1""")
def q_dedup_exact(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return tables.dedup_exact(e, ["user_id", "event_type"], "event_id")


@register("upsert_posts", sql="""
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def q_upsert_posts(spark, sf_dir):
    """Saves of every event into a table keyed by (user, type): the first
    half of the log is the stored table, the rest arrives as a batch."""
    e = read_table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    old = e.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    new = e.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return tables.upsert(old, new, ["user_id", "event_type"], "event_id")


@register("update_topics", sql="""
SELECT e.event_id,
       coalesce(u.topics, [e.event_type]) AS topics
FROM events e LEFT JOIN (
  SELECT event_id, ['k' || json_extract_string(props, '$.k')] AS topics FROM events WHERE event_type = 'click') u
ON e.event_id = u.event_id""")
def q_update_topics(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    table = e.select("event_id", F.array("event_type").alias("topics"))
    updates = (e.filter(F.col("event_type") == "click")
                .select("event_id", F.array(F.concat(F.lit("k"), F.get_json_object("props", "$.k"))).alias("topics")))
    return tables.update_field(table, updates, "event_id", "topics")


@register("capped_stream", sql=f"""
SELECT event_id, ts, event_type FROM events ORDER BY event_id DESC LIMIT {CAP_LEN}""")
def q_capped_stream(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return tables.capped_stream(e, "event_id", CAP_LEN)


@register("batch_metrics", sql=with_(POSTS) + """
SELECT CAST(time_us // 3600000000 AS BIGINT) AS batch, count(*) AS processed,
       count(*) FILTER (WHERE text IS NOT NULL AND regexp_matches(text, '""" + NOT_BLANK_SQL + """')
                        AND operation IS DISTINCT FROM 'delete') AS stored
FROM posts GROUP BY 1""")
def q_batch_metrics(spark, sf_dir):
    p = posts(spark, sf_dir)
    return tables.batch_metrics(p, F.floor(F.col("time_us") / 3600000000).cast("bigint"),
                                filters.is_content(F.col("text"), F.col("operation")))


_SEARCH_SQL = with_(POSTS) + f""",
hits AS (SELECT uri, time_us FROM posts
         WHERE contains(text, '{SEARCH_TERM}')
           AND time_us >= (SELECT max(time_us) FROM posts) - {tables.SEARCH_LOOKBACK_HOURS} * 3600000000
           AND time_us <= (SELECT max(time_us) FROM posts)),
ranked AS (SELECT uri, time_us, row_number() OVER (ORDER BY time_us DESC, uri) AS position FROM hits)
"""


def _search(spark, sf_dir):
    p = posts(spark, sf_dir).select("uri", "time_us", "text")
    as_of = p.agg(F.max("time_us")).first()[0]
    return tables.search_posts(p, SEARCH_TERM, F.lit(as_of)).select("uri", "time_us", "position", "page_no")


@register("search_mentions", sql=_SEARCH_SQL + """
SELECT uri, time_us, position, CAST((position - 1) // 100 AS BIGINT) AS page_no FROM ranked""")
def q_search_mentions(spark, sf_dir):
    return _search(spark, sf_dir)


@register("page_totals", sql=_SEARCH_SQL + """
SELECT page_no, fetched, sum(fetched) OVER (ORDER BY page_no) AS running_total FROM (
  SELECT CAST((position - 1) // 100 AS BIGINT) AS page_no, count(*) AS fetched FROM ranked GROUP BY 1)""")
def q_page_totals(spark, sf_dir):
    return tables.page_totals(_search(spark, sf_dir))


@register("topic_counts", sql="""
SELECT conv_id, turn, topic, count(*) AS topic_count FROM (
  SELECT conv_id, turn, unnest(list_filter(list_transform(string_split(replace(text, '"', ''), ','),
         lambda x: """ + _JTRIM.format(x="x") + """), lambda x: x <> '')) AS topic
  FROM conversations) GROUP BY 1, 2, 3""")
def q_topic_counts(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    t = c.select("conv_id", "turn", tx.parse_topics(F.col("text")).alias("topics"))
    t = t.select(F.struct("conv_id", "turn").alias("id"), "topics")
    out = topk.topic_counts(t, "id", "topics")
    return out.select("id.conv_id", "id.turn", "topic", "topic_count")


@register("trending_now", sql=with_(EVENT_TOPICS) + """
SELECT hour, topic, topic_count, rank FROM (
  SELECT hour, topic, topic_count,
         row_number() OVER (PARTITION BY hour ORDER BY topic_count DESC, topic) AS rank
  FROM (SELECT date_trunc('hour', ts) AS hour, topic, count(*) AS topic_count
        FROM event_topics WHERE date_trunc('hour', ts) = (SELECT date_trunc('hour', max(ts)) FROM events)
        GROUP BY 1, 2))
WHERE rank <= 15""")
def q_trending_now(spark, sf_dir):
    """A5 as of the newest event: only that hour's rows are aggregated (the
    hour filter is applied before the aggregate and pushed to the scan)."""
    e = read_table(spark, sf_dir, "events")
    as_of = e.agg(F.max("ts")).first()[0]
    hour = topk.hour_of(F.lit(as_of).cast("timestamp_ntz"))
    rows = event_topics(spark, sf_dir).filter(
        (F.col("ts") >= hour) & (F.col("ts") < hour + F.expr("INTERVAL 1 HOUR")))
    return topk.trending_now(topk.hourly_topk(rows), F.lit(as_of).cast("timestamp_ntz"))


@register("topic_vocabulary", sql=with_(EVENT_TOPICS) + "SELECT DISTINCT topic FROM event_topics")
def q_topic_vocabulary(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(
        F.array("event_type", F.concat(F.lit("k"), F.get_json_object("props", "$.k"))).alias("topics"))
    return topk.topic_vocabulary(ev)


@register("topk_evictions", sql=with_(EVENT_TOPICS) + """,
pb AS (SELECT date_trunc('hour', ts) AS hour, topic, CAST(floor(minute(ts) / 10) AS INTEGER) AS b, count(*) AS c
       FROM event_topics GROUP BY 1, 2, 3),
run AS (SELECT hour, batch, topic, sum(c) AS running_count
        FROM (SELECT hour, topic, c, unnest(range(b, 6)) AS batch FROM pb) GROUP BY 1, 2, 3),
top AS (SELECT hour, batch, topic FROM (
          SELECT *, row_number() OVER (PARTITION BY hour, batch ORDER BY running_count DESC, topic) AS rk FROM run)
        WHERE rk <= 15)
SELECT p.hour, CAST(p.batch + 1 AS INTEGER) AS batch, p.topic FROM top p
WHERE p.batch + 1 <= 5 AND NOT EXISTS (
  SELECT 1 FROM top c WHERE c.hour = p.hour AND c.batch = p.batch + 1 AND c.topic = p.topic)""")
def q_topk_evictions(spark, sf_dir):
    return topk.topk_evictions(event_topics(spark, sf_dir))


@register("keyed_table", sql=with_(POSTS) + """
SELECT uri, doc_id, CASE WHEN doc_id % 50 = 0 THEN time_us + 1 ELSE time_us END AS time_us,
       CASE WHEN doc_id % 50 = 0 THEN 'edited ' || CAST(doc_id AS VARCHAR) ELSE text END AS text,
       CASE WHEN doc_id % 100 = 7 THEN 'hide' ELSE operation END AS operation
FROM posts""")
def q_keyed_table(spark, sf_dir):
    """S13/S14 on disk: the post table in hash buckets, saved once, then some
    posts saved again (the same update twice, and once with an older version)
    and one field of others replaced."""
    return keyed_posts(spark, posts(spark, sf_dir).select("uri", "doc_id", "time_us", "text", "operation")).read()


def keyed_posts(spark, p):
    table = keyed.KeyedTable(spark, scratch_path(spark, "keyed"), p.schema, "uri", "time_us", keyed.buckets_for(p.count()))
    table.upsert(p)
    edits = p.where("doc_id % 50 = 0").withColumn("time_us", F.col("time_us") + 1).withColumn("text", F.concat(F.lit("edited "), F.col("doc_id").cast("string")))
    stale = p.where("doc_id % 50 = 0").withColumn("time_us", F.col("time_us") - 1).withColumn("text", F.lit("stale"))
    table.upsert(edits.unionByName(stale))
    table.upsert(edits)
    table.update_field(p.where("doc_id % 100 = 7").select("uri", F.lit("hide").alias("operation")), "operation")
    return table


@register("search_cursor", sql=_SEARCH_SQL + f"""
SELECT CAST((position - 1) // 100 AS BIGINT) AS page_no, uri, time_us FROM ranked WHERE position <= 100 * {CURSOR_PAGES}""")
def q_search_cursor(spark, sf_dir):
    """S16 by cursor: the first pages, each asked for with the cursor that the
    page before returned."""
    p, cursor, pages = posts(spark, sf_dir).select("uri", "time_us", "text"), None, None
    as_of = F.lit(p.agg(F.max("time_us")).first()[0])
    for number in range(CURSOR_PAGES):
        page, cursor = keyed.search_page(p, SEARCH_TERM, as_of, cursor)
        page = page.select(F.lit(number).cast("long").alias("page_no"), "uri", "time_us")
        pages = page if pages is None else pages.unionByName(page)
        if cursor is None:
            break
    return pages
