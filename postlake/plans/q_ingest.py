"""Ingest queries: raw JSON events -> typed -> flat entry -> typed post
(S1, S2, S3, S9, S10, T6, T7).  The JSON wire form is derived by Spark from
the ``documents``-based post view, so the work grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.functions.text import java_list_string, parse_langs
from postlake.plans.registry import register
from postlake.plans.sql import POSTS, with_
from postlake.sources import events as ev
from postlake.sources.tables import build_uri, posts


def _parsed(spark, sf_dir):
    return ev.parse_events(ev.raw_event_json(posts(spark, sf_dir)))


def _flat(spark, sf_dir):
    return ev.flatten_event(ev.collection_scan(_parsed(spark, sf_dir)))


# DuckDB form of the wire fixture (same rules as raw_event_json).
_WIRE = """wire AS (
  SELECT doc_id AS seq, did, time_us, 'commit' AS kind, operation, rkey, text, langs,
         CASE WHEN doc_id % 5 = 4 THEN 'app.bsky.feed.like' ELSE 'app.bsky.feed.post' END AS collection,
         operation <> 'delete' AS has_record,
         strftime(make_timestamp(time_us), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS created_at,
         CASE WHEN doc_id % 3 = 1 THEN 'at://' || did || '/app.bsky.feed.post/' || CAST(doc_id - 1 AS VARCHAR) END AS parent_uri,
         CASE WHEN doc_id % 3 = 1 THEN 'at://' || did || '/app.bsky.feed.post/' || CAST(CAST(floor(doc_id / 10) AS BIGINT) * 10 AS VARCHAR) END AS root_uri
  FROM posts)"""

_FLAT = """flat AS (
  SELECT seq, did,
         CASE WHEN has_record THEN coalesce(created_at, 'null') ELSE '' END AS "createdAt",
         CAST(time_us AS VARCHAR) AS "timeUs",
         CASE WHEN has_record THEN coalesce(text, 'null') ELSE '' END AS text,
         CASE WHEN has_record THEN '[' || array_to_string(list_transform(langs, lambda x: coalesce(x, 'null')), ', ') || ']' ELSE '' END AS langs,
         coalesce(operation, 'null') AS operation,
         coalesce(rkey, 'null') AS rkey,
         CASE WHEN has_record AND parent_uri IS NOT NULL THEN parent_uri ELSE '' END AS "parentUri",
         CASE WHEN has_record AND root_uri IS NOT NULL THEN root_uri ELSE '' END AS "rootUri",
         'at://' || coalesce(did, 'null') || '/app.bsky.feed.post/' || coalesce(rkey, 'null') AS uri
  FROM wire WHERE collection = 'app.bsky.feed.post')"""

_DECODED = """decoded AS (
  SELECT seq, uri AS id, did, rkey, text, TRY_CAST("timeUs" AS BIGINT) AS time_us, operation, uri,
         "parentUri" AS parent_uri, "rootUri" AS root_uri,
         string_split(regexp_replace(langs, '[\\[\\]]', '', 'g'), ', ') AS langs
  FROM flat)"""


@register("parse_events", sql=with_(POSTS, _WIRE) + """
SELECT seq, did, time_us, kind, operation, collection, rkey,
       CASE WHEN has_record THEN text END AS text,
       CASE WHEN has_record THEN langs END AS langs,
       CASE WHEN has_record THEN created_at END AS created_at,
       CASE WHEN has_record THEN parent_uri END AS parent_uri,
       CASE WHEN has_record THEN root_uri END AS root_uri
FROM wire""")
def q_parse_events(spark, sf_dir):
    e = F.col("event")
    r = e["commit"]["record"]
    return _parsed(spark, sf_dir).select(
        "seq", e["did"].alias("did"), e["time_us"].alias("time_us"), e["kind"].alias("kind"),
        e["commit"]["operation"].alias("operation"), e["commit"]["collection"].alias("collection"),
        e["commit"]["rkey"].alias("rkey"), r["text"].alias("text"), r["langs"].alias("langs"),
        r["createdAt"].alias("created_at"), r["reply"]["parent"]["uri"].alias("parent_uri"),
        r["reply"]["root"]["uri"].alias("root_uri"))


@register("collection_scan", sql=with_(POSTS, _WIRE) + """
SELECT seq, did, rkey, operation FROM wire WHERE collection = 'app.bsky.feed.post'""")
def q_collection_scan(spark, sf_dir):
    e = F.col("event")
    return ev.collection_scan(_parsed(spark, sf_dir)).select(
        "seq", e["did"].alias("did"), e["commit"]["rkey"].alias("rkey"),
        e["commit"]["operation"].alias("operation"))


@register("flatten_event", sql=with_(POSTS, _WIRE, _FLAT) + "SELECT * FROM flat")
def q_flatten_event(spark, sf_dir):
    return _flat(spark, sf_dir)


@register("decode_entry", sql=with_(POSTS, _WIRE, _FLAT, _DECODED) + "SELECT * FROM decoded")
def q_decode_entry(spark, sf_dir):
    return ev.decode_entry(ev.to_entry_map(_flat(spark, sf_dir)))


@register("encode_entry", sql=with_(POSTS, _WIRE, _FLAT, _DECODED) + """
SELECT seq, k AS key, v AS value FROM (
  SELECT seq, unnest(['did', 'timeUs', 'text', 'langs', 'operation', 'rkey', 'uri', 'parentUri', 'rootUri']) AS k,
         unnest([did, CAST(time_us AS VARCHAR), text, '[' || array_to_string(langs, ', ') || ']',
                 operation, rkey, uri, parent_uri, root_uri]) AS v
  FROM decoded)""")
def q_encode_entry(spark, sf_dir):
    enc = ev.encode_entry(ev.decode_entry(ev.to_entry_map(_flat(spark, sf_dir))))
    return enc.select("seq", F.explode("entry").alias("key", "value"))


@register("parse_langs", sql=with_(POSTS) + """
SELECT doc_id, '[' || array_to_string(langs, ', ') || ']' AS langs_text, langs FROM posts""")
def q_parse_langs(spark, sf_dir):
    p = posts(spark, sf_dir).select("doc_id", java_list_string(F.col("langs")).alias("langs_text"))
    return p.select("doc_id", "langs_text", parse_langs(F.col("langs_text")).alias("langs"))


@register("build_uri", sql=with_(POSTS) + """
SELECT doc_id, 'at://' || did || '/app.bsky.feed.post/' || rkey AS uri FROM posts""")
def q_build_uri(spark, sf_dir):
    p = posts(spark, sf_dir)
    return p.select("doc_id", build_uri(F.col("did"), F.col("rkey")).alias("uri"))
