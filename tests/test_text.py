"""Golden cases for the text transforms (FIXTURES.md A6) and Java string quirks."""

from pyspark.sql import functions as F

from postlake.functions import text as tx


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_split_clauses(spark):
    assert one(spark, tx.split_clauses(F.col("s")), 'Hi! a, b (c) [d] {e}. "f"') == ["Hi", "a", "b", "c", "d", "e", "f"]


def test_chunk_text_golden(spark):
    assert one(spark, tx.chunk_text(F.col("s"), 10), "aaa bbb ccc ddddddddddddddd e") == ["aaa bbb", "ccc", "ddddddddddddddd", "e"]
    assert one(spark, tx.chunk_text(F.col("s"), 10), "123456789 x") == ["123456789", "x"]
    assert one(spark, tx.chunk_text(F.col("s"), 10), "1234567890 x") == ["", "1234567890", "x"]


def _chunk_py(text, max_len):
    import re
    words = re.split(r"\s+", text)
    while words and words[-1] == "":
        words.pop()
    if not words and text:
        return []
    if not words:
        words = [""]
    chunks, cur = [], ""
    for w in words:
        if len(cur) + len(w) + 1 > max_len:
            chunks.append(cur.strip())
            cur = ""
        cur += w + " "
    if cur:
        chunks.append(cur.strip())
    return chunks


def test_chunk_text_matches_loop(spark):
    texts = ["a " * 40, "word " * 3 + "x" * 25 + " tail", "  lead and trail  ", "one", "x" * 31 + " y"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["r"] for r in df.select(tx.chunk_text(F.col("s"), 30).alias("r")).collect()]
    assert got == [_chunk_py(t, 30) for t in texts]


def test_chunk_text_counts_utf16_units(spark):
    assert one(spark, tx.chunk_text(F.col("s"), 13), "😀😀😀😀😀😀 ab") == ["😀" * 6, "ab"]
    assert one(spark, tx.chunk_text(F.col("s"), 13), None) is None
    assert one(spark, tx.chunk_text(F.col("s"), 13), "") == [""] and one(spark, tx.chunk_text(F.col("s"), 13), " \n") == []


def test_chunk_text_is_linear():
    import time
    began = time.time()
    assert len(tx.pack_words("word " * 80_000, 300)) == 1334
    assert time.time() - began < 1


def test_parse_topics(spark):
    assert one(spark, tx.parse_topics(F.col("s")), '"LangChain, OpenAI, Prompt Engineering, AI Tooling"') == [
        "LangChain", "OpenAI", "Prompt Engineering", "AI Tooling"]
    assert one(spark, tx.parse_topics(F.col("s")), '""') == []


def test_parse_langs_legacy(spark):
    assert one(spark, tx.parse_langs(F.col("s")), None) == [""]
    assert one(spark, tx.parse_langs(F.col("s")), "[en, pt]") == ["en", "pt"]
    assert one(spark, tx.parse_langs(F.col("s")), "null") == ["null"]
    assert one(spark, tx.parse_langs(F.col("s"), legacy=False), None) == []


def test_strip_and_format(spark):
    assert one(spark, tx.strip_mention(F.col("s"), "@assistant.example"), "@assistant.example  what is hot? ") == "what is hot?"
    assert one(spark, tx.format_reply(F.lit("bob.bsky.social"), F.col("s")), "hi") == "@bob.bsky.social hi"


def test_java_trim_control_chars(spark):
    assert one(spark, tx.java_trim(F.col("s")), "\x01\t ab \x1f") == "ab"


def test_content_filter_cases(spark):
    from postlake.operators.filters import content_filter
    rows = [(0, "\u3000\u2003", "create"), (6, "\u00a0", "create"), (1, " ", "create"), (2, "text", "delete"), (3, "text", None), (4, None, "create"), (5, "ok", "create")]
    df = spark.createDataFrame(rows, "id int, text string, operation string")
    assert sorted(r.id for r in content_filter(df).collect()) == [3, 5, 6]
