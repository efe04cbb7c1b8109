"""Text transform queries (T1-T5, T8, T9) over conversations, documents, events."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.functions import text as tx
from postlake.operators.topk import hour_key
from postlake.plans.registry import register
from postlake.plans.sql import JTRIM, REQUESTS, chunk_cte, with_
from postlake.sources.tables import read_table, user_requests

_JTRIM = JTRIM
BOT_HANDLE = "@assistant.example"  # fixture value
_CLAUSES = ("list_filter(list_transform(regexp_split_to_array(text, '[!?,.:;()\"\\[\\]{{}}]+'), "
            "lambda x: " + _JTRIM.format(x="x") + "), lambda x: x <> '')")


@register("split_clauses", sql=with_(REQUESTS) + f"""
SELECT request_id, i - 1 AS clause_no, cl[i] AS clause FROM (
  SELECT request_id, cl, generate_subscripts(cl, 1) AS i
  FROM (SELECT request_id, {_CLAUSES} AS cl FROM requests))""")
def q_split_clauses(spark, sf_dir):
    r = user_requests(spark, sf_dir)
    return r.select("request_id", F.posexplode(tx.split_clauses(F.col("text"))).alias("clause_no", "clause"))


@register("chunk_text", sql=f"""WITH {chunk_cte("documents", "doc_id")}
SELECT doc_id, chunk_no, chunk FROM chunk_rows""")
def q_chunk_text(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(tx.chunk_text(F.col("text"), tx.REPLY_MAX_CHARS))
                    .alias("chunk_no", "chunk"))


@register("parse_topics", sql="""
SELECT conv_id, turn, i - 1 AS topic_no, t[i] AS topic FROM (
  SELECT conv_id, turn, t, generate_subscripts(t, 1) AS i FROM (
    SELECT conv_id, turn,
           list_filter(list_transform(string_split(replace(text, '"', ''), ','), lambda x: """
    + _JTRIM.format(x="x") + """), lambda x: x <> '') AS t
    FROM conversations))""")
def q_parse_topics(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.posexplode(tx.parse_topics(F.col("text"))).alias("topic_no", "topic"))


@register("strip_mention", sql=with_(REQUESTS) + f"""
SELECT request_id, {_JTRIM.format(x="replace('@assistant.example ' || text, '@assistant.example', '')")} AS cleaned
FROM requests""")
def q_strip_mention(spark, sf_dir):
    r = user_requests(spark, sf_dir)
    mention = F.concat(F.lit(BOT_HANDLE + " "), F.col("text"))
    return r.select("request_id", tx.strip_mention(mention, BOT_HANDLE).alias("cleaned"))


@register("format_reply", sql=with_(REQUESTS) + """
SELECT request_id, '@' || ('user' || CAST(conv_id AS VARCHAR) || '.bsky.social') || ' ' || text AS reply
FROM requests""")
def q_format_reply(spark, sf_dir):
    r = user_requests(spark, sf_dir)
    handle = F.concat(F.lit("user"), F.col("conv_id").cast("string"), F.lit(".bsky.social"))
    return r.select("request_id", tx.format_reply(handle, F.col("text")).alias("reply"))


@register("build_prompt", sql=with_(REQUESTS) + f"""
SELECT request_id, i - 1 AS msg_no, m[i].role AS role, m[i].content AS content FROM (
  SELECT request_id, m, generate_subscripts(m, 1) AS i FROM (
    SELECT request_id, [
      {{'role': 'system', 'content': '{tx.ANSWER_SYSTEM_PROMPT.replace("'", "''")}'}},
      {{'role': 'system', 'content': 'Enriching data: [' || array_to_string({_CLAUSES}, ', ') || ']'}},
      {{'role': 'user', 'content': 'User query: ' || text}}] AS m
    FROM requests))""")
def q_build_prompt(spark, sf_dir):
    r = user_requests(spark, sf_dir)
    p = tx.build_prompt(tx.ANSWER_SYSTEM_PROMPT, tx.split_clauses(F.col("text")), F.col("text"))
    return (r.select("request_id", F.posexplode(p).alias("msg_no", "m"))
             .select("request_id", "msg_no", F.col("m.role").alias("role"), F.col("m.content").alias("content")))


@register("hour_key", sql="""
SELECT 'topics-topk:' || strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') AS hour_key, count(*) AS n_events
FROM events GROUP BY 1""")
def q_hour_key(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.groupBy(hour_key(F.col("ts")).alias("hour_key")).agg(F.count(F.lit(1)).alias("n_events"))
