"""Raw post events: schema, parsing, flattening and the stream-entry codec
(S1, S2, S3, S9, S10, T6, T7).

Raw events arrive as JSON text (one event per line of a file).
They are parsed with an explicit nested schema; unknown fields are ignored
and malformed lines land in ``_corrupt_record`` for quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.text import java_list_string, parse_langs
from postlake.sources.tables import POST_COLLECTION, build_uri

_REF = T.StructType([T.StructField("cid", T.StringType()), T.StructField("uri", T.StringType())])

RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("did", T.StringType()),
    T.StructField("time_us", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("commit", T.StructType([
        T.StructField("rev", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("rkey", T.StringType()),
        T.StructField("cid", T.StringType()),
        T.StructField("record", T.StructType([
            T.StructField("$type", T.StringType()),
            T.StructField("createdAt", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("langs", T.ArrayType(T.StringType())),
            T.StructField("facets", T.ArrayType(T.StructType([
                T.StructField("$type", T.StringType()),
                T.StructField("features", T.ArrayType(T.StructType([
                    T.StructField("$type", T.StringType()), T.StructField("did", T.StringType())]))),
                T.StructField("index", T.StructType([
                    T.StructField("byteStart", T.IntegerType()), T.StructField("byteEnd", T.IntegerType())])),
            ]))),
            T.StructField("reply", T.StructType([T.StructField("parent", _REF), T.StructField("root", _REF)])),
            T.StructField("embed", T.StructType([
                T.StructField("$type", T.StringType()),
                T.StructField("images", T.ArrayType(T.StructType([
                    T.StructField("alt", T.StringType()),
                    T.StructField("aspectRatio", T.StructType([
                        T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType())])),
                    T.StructField("image", T.StructType([
                        T.StructField("$type", T.StringType()),
                        T.StructField("ref", T.StructType([T.StructField("$link", T.StringType())])),
                        T.StructField("mimeType", T.StringType()),
                        T.StructField("size", T.IntegerType())])),
                ]))),
            ])),
        ])),
    ])),
])

# Keys of the flat stream entry (all values are strings).
FLAT_KEYS = ("did", "createdAt", "timeUs", "text", "langs", "operation", "rkey",
             "parentUri", "rootUri", "uri")
# Keys written back by the second hop (createdAt is dropped there).
ENCODED_KEYS = ("did", "timeUs", "text", "langs", "operation", "rkey", "uri", "parentUri", "rootUri")


def raw_event_json(posts: DataFrame) -> DataFrame:
    """Wire form of the post view: one JSON event per post (``seq``, ``value``).

    Deletes carry no record; every third post is a reply; every fifth event
    is a like (other collection); an unknown field is added to the embed to
    exercise schema tolerance.
    """
    did, rkey, n = F.col("did"), F.col("rkey"), F.col("doc_id")
    is_delete = F.col("operation") == "delete"
    is_reply = n % 3 == 1
    collection = F.when(n % 5 == 4, F.lit("app.bsky.feed.like")).otherwise(F.lit(POST_COLLECTION))
    reply = F.when(is_reply, F.struct(
        F.struct(F.concat(F.lit("cid"), (n - 1).cast("string")).alias("cid"),
                 build_uri(did, (n - 1).cast("string")).alias("uri")).alias("parent"),
        F.struct(F.concat(F.lit("cid"), ((n / 10).cast("long") * 10).cast("string")).alias("cid"),
                 build_uri(did, ((n / 10).cast("long") * 10).cast("string")).alias("uri")).alias("root")))
    created = F.date_format(F.timestamp_micros(F.col("time_us")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    record = F.when(~is_delete, F.struct(
        F.lit(POST_COLLECTION).alias("$type"),
        created.alias("createdAt"),
        F.col("text").alias("text"),
        F.col("langs").alias("langs"),
        reply.alias("reply"),
        F.struct(F.lit("app.bsky.embed.record").alias("$type"),
                 F.struct(F.lit("unknown").alias("uri")).alias("record")).alias("embed")))
    event = F.struct(
        did.alias("did"), F.col("time_us").alias("time_us"), F.lit("commit").alias("kind"),
        F.struct(F.concat(F.lit("rev"), rkey).alias("rev"), F.col("operation").alias("operation"),
                 collection.alias("collection"), rkey.alias("rkey"), record.alias("record"),
                 F.concat(F.lit("cid"), rkey).alias("cid")).alias("commit"))
    return posts.select(n.alias("seq"), F.to_json(event).alias("value"))


# A new object: StructType.add would change the shared schema in place.
_PARSED_SCHEMA = T.StructType([*RAW_EVENT_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])


def is_malformed() -> Column:
    """Rows of ``parse_events`` that are no event."""
    return F.col("event").isNull() | F.col("event._corrupt_record").isNotNull()


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good events, quarantined raw rows) of ``parse_events``."""
    bad = is_malformed()
    return parsed.where(~bad), parsed.where(bad)


def parse_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> typed nested event.  Unknown fields are ignored;
    malformed text keeps ``event`` null and the text in ``_corrupt_record``."""
    parsed = F.from_json(F.col(value_col), _PARSED_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return raw.withColumn("event", parsed)


def collection_scan(events: DataFrame, collection: str = POST_COLLECTION) -> DataFrame:
    """Keep events of one collection (the subscription filter)."""
    return events.filter(F.col("event.commit.collection") == F.lit(collection))


def _sv(c: Column) -> Column:
    """``String.valueOf(x)`` for a possibly-null object: null -> ``"null"``."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def flatten_event(events: DataFrame, legacy_null_text: bool = True) -> DataFrame:
    """S3: nested event -> the 10 flat string fields of a stream entry.

    ``legacy_null_text=True`` reproduces ``String.valueOf``: a null field of an
    existing parent becomes the text ``null``; a missing parent gives ``""``.
    """
    e = F.col("event")
    commit, record = e["commit"], e["commit"]["record"]
    has_commit, has_record = commit.isNotNull(), record.isNotNull()
    sv = _sv if legacy_null_text else (lambda c: c.cast("string"))
    reply = record["reply"]
    parent_uri = F.when(has_record & reply.isNotNull() & reply["parent"].isNotNull(),
                        reply["parent"]["uri"]).otherwise(F.lit(""))
    root_uri = F.when(has_record & reply.isNotNull() & reply["root"].isNotNull(),
                      reply["root"]["uri"]).otherwise(F.lit(""))
    langs_txt = F.when(record["langs"].isNull(), F.lit("null")).otherwise(java_list_string(record["langs"])) \
        if legacy_null_text else java_list_string(record["langs"])
    return events.select(
        "seq",
        e["did"].alias("did"),
        F.when(has_commit & has_record, sv(record["createdAt"])).otherwise(F.lit("")).alias("createdAt"),
        F.coalesce(e["time_us"], F.lit(0)).cast("string").alias("timeUs"),
        F.when(has_commit & has_record, sv(record["text"])).otherwise(F.lit("")).alias("text"),
        F.when(has_commit & has_record, langs_txt).otherwise(F.lit("")).alias("langs"),
        F.when(has_commit, sv(commit["operation"])).otherwise(F.lit("")).alias("operation"),
        F.when(has_commit, sv(commit["rkey"])).otherwise(F.lit("")).alias("rkey"),
        parent_uri.alias("parentUri"),
        root_uri.alias("rootUri"),
        F.when(has_commit, build_uri(_sv(e["did"]), _sv(commit["rkey"]))).otherwise(F.lit("")).alias("uri"),
    )


def to_entry_map(flat: DataFrame, keys=FLAT_KEYS) -> DataFrame:
    """Flat columns -> ``entry map<string,string>`` (the stream's wire form)."""
    kv = []
    for k in keys:
        kv += [F.lit(k), F.col(k)]
    return flat.select("seq", F.create_map(*kv).alias("entry"))


def decode_entry(entries: DataFrame, legacy_langs: bool = True) -> DataFrame:
    """String map -> typed post row; missing keys default to ``""`` and
    ``timeUs`` to 0; a non-numeric ``timeUs`` gives null (quarantine) instead
    of an exception; ``id`` is the uri."""
    m = F.col("entry")
    get = lambda k: F.coalesce(m[k], F.lit(""))
    return entries.select(
        "seq",
        get("uri").alias("id"),
        get("did").alias("did"),
        get("rkey").alias("rkey"),
        get("text").alias("text"),
        F.coalesce(m["timeUs"], F.lit("0")).try_cast("bigint").alias("time_us"),
        get("operation").alias("operation"),
        get("uri").alias("uri"),
        get("parentUri").alias("parent_uri"),
        get("rootUri").alias("root_uri"),
        parse_langs(m["langs"], legacy=legacy_langs).alias("langs"),
    )


def encode_entry(rows: DataFrame) -> DataFrame:
    """Typed post row -> string map (drops id, createdAt and topics)."""
    return rows.select(
        "seq",
        F.create_map(
            F.lit("did"), F.col("did"),
            F.lit("timeUs"), F.col("time_us").cast("string"),
            F.lit("text"), F.col("text"),
            F.lit("langs"), java_list_string(F.col("langs")),
            F.lit("operation"), F.col("operation"),
            F.lit("rkey"), F.col("rkey"),
            F.lit("uri"), F.col("uri"),
            F.lit("parentUri"), F.col("parent_uri"),
            F.lit("rootUri"), F.col("root_uri"),
        ).alias("entry"))
