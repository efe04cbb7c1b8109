"""Registered queries of this subpackage (driver contract: see ``__spark_entry__``)."""

from __future__ import annotations

import hashlib
import os
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from postlake.llm import bpe, conversation_repair, decontaminate, licenses, line_dedup, neardup, oracles, packing, pii, quality_rules, secrets, spelling, urls, warc
from postlake.llm.common import ASCII_LOWER, ASCII_UPPER, map_rows, table
from postlake.session import shared_dir

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


def spans_text(spans: str, kinds: tuple[str, ...] | None = None) -> F.Column:
    """kind:start:end of a span column (of ``kinds``, else all), comma-joined."""
    col = F.col(spans) if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digest(found, base: tuple[str, ...]):
    """Counts of the base kinds, the digest of their spans, and all spans."""
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, base),
                        F.sha2(spans_text("spans", base), 256).alias("base_sha256"), spans_text("spans").alias("spans"))


@query("op2_neardup", """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS sh FROM w),
c AS (SELECT doc_id, len(sh) AS n, md5(array_to_string(list_sort(sh), chr(10))) AS k FROM s),
r AS (SELECT k, n, min(doc_id) AS rep FROM c WHERE n > 0 GROUP BY k, n),
x AS (SELECT r.rep, r.n, unnest(s.sh) AS sh FROM r JOIN s ON s.doc_id = r.rep),
p AS (SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.sh = b.sh AND a.rep < b.rep
      GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
z AS (WITH RECURSIVE reach(node, label) AS (SELECT rep, rep FROM r UNION SELECT e.b, reach.label FROM reach JOIN e ON e.a = reach.node)
      SELECT node, min(label) AS comp FROM reach GROUP BY node)
SELECT c.doc_id, c.n AS n_shingles, coalesce(z.comp, c.doc_id) AS component_id, coalesce(z.comp, c.doc_id) = c.doc_id AS kept
FROM c LEFT JOIN r ON r.k = c.k AND r.n = c.n LEFT JOIN z ON z.node = r.rep""")
def op2(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op1_secrets")
def op1(spark, sf_dir):
    return span_digest(secrets.find_secrets(table(spark, sf_dir, "documents")), secrets.KINDS[:3])


@query("op4_pii")
def op4(spark, sf_dir):
    return span_digest(pii.find_pii(table(spark, sf_dir, "documents")), pii.BASE)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer file; ``POSTLAKE_TOKENIZERS`` overrides the folder."""
    if folder := os.environ.get("POSTLAKE_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op3_bpe")
def op3(spark, sf_dir):
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


@query("op5_licenses", rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
ph(phrase, label) AS (VALUES {_values(licenses.PHRASES)}),
hit AS (SELECT doc_id, i - 1 AS pos, label FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d), ph
        WHERE array_to_string(ws[i:i + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM hit GROUP BY 1),
t(label, phrase, text, t) AS (VALUES {_values((*x, i) for i, x in enumerate(licenses.TEMPLATES))}),
tw AS (SELECT t, i - 1 AS pos, l[i] AS word FROM (SELECT t, l, generate_subscripts(l, 1) AS i FROM (SELECT t, string_split(text, ' ') AS l FROM t))),
df AS (SELECT word, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(ws) AS word FROM d) WHERE word IN (SELECT word FROM tw) GROUP BY 1),
idf AS (SELECT DISTINCT tw.word, ln(((SELECT count(*) FROM d) + 1) / (coalesce(df.n, 0) + 0.5)) AS idf FROM tw LEFT JOIN df USING (word)),
idx AS (SELECT t, pos, word, idf FROM (SELECT t, pos, word, idf, row_number() OVER (PARTITION BY t ORDER BY idf DESC, pos) AS rk,
        max(idf) OVER (PARTITION BY t) AS top FROM tw JOIN idf USING (word)) WHERE rk <= {licenses.INDEX_WORDS} AND idf >= {licenses.RARE} * top),
place AS (SELECT doc_id, i AS place, ws[i] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d) WHERE ws[i] IN (SELECT word FROM idx)),
line AS (SELECT doc_id, t, sum(idf) AS got FROM (SELECT DISTINCT p.doc_id, x.t, p.place - x.pos AS start, x.pos, x.idf
         FROM place p JOIN idx x ON x.word = p.word) GROUP BY doc_id, t, start),
best AS (SELECT doc_id, line.t, max(got / total) AS score FROM line JOIN (SELECT t, sum(idf) AS total FROM idx GROUP BY 1) s ON s.t = line.t GROUP BY 1, 2),
ok AS (SELECT best.doc_id, list(DISTINCT t.label) AS labels, max(score) AS score FROM best JOIN t USING (t) JOIN d USING (doc_id)
       WHERE score >= {licenses.MIN_SCORE} AND contains(' ' || array_to_string(ws, ' ') || ' ', ' ' || phrase || ' ') GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(ok.labels, [])))), ','), '') AS labels,
       greatest(CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END, least(1.0, coalesce(ok.score, 0))) AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN ok USING (doc_id)""")
def op5(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("matches")


@query("op6_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM m""")
def op6(spark, sf_dir):
    path = f"{shared_dir(spark)}/llm-warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    c = warc.assemble(warc.read_records(spark, path, with_payload=False))
    fields = F.col("metadata.fields")
    return c.select(fields["page-id"].cast("long").alias("page_id"),
                    F.when(F.col("response.type") == "response", F.col("response.payload_bytes"))
                    .otherwise(fields["payload-bytes"].cast("long")).alias("payload_bytes"),
                    F.when(F.col("response.type") == "response", F.col("response.payload_sha1"))
                    .otherwise(F.substring_index("response.payload_digest", ":", -1)).alias("payload_digest"),
                    F.col("response.type").alias("record_type"), fields["refers-to-page-id"].cast("long").alias("refers_to"))


_BLANK = r"[\x20\x09-\x0D]+"


@query("op7_quality_rules", rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANK}'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY 1),
li AS (SELECT doc_id, i, l[i] AS line FROM (SELECT doc_id, l, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM d))),
lw AS (SELECT doc_id, line, list_filter(regexp_split_to_array(line, '{_BLANK}'), lambda x: x <> '') AS ws,
              row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS before FROM li WHERE regexp_matches(line, '[^ 	-
]')),
arrows AS (SELECT *, string_split(regexp_replace(line, '</?[A-Za-z][^<>]*>', ' ', 'g'), '>') AS parts FROM lw),
m AS (SELECT doc_id, before, len(ws) AS n, strlen(array_to_string(ws, '')) AS size, length(line) - length(replace(line, '|', '')) +
             len(list_filter(range(1, len(parts)), lambda i: (regexp_matches(parts[i], '[^<=\x20\x09-\x0D-][\x20\x09-\x0D]*$') OR
               (i = 1 AND regexp_matches(parts[i], '^[\x20\x09-\x0D]*$'))) AND regexp_matches(parts[i + 1], '^[\x20\x09-\x0D]*[^<=\x20\x09-\x0D]'))) AS bars,
             len(regexp_extract_all(line, '[#*$%&<>]+|!!+')) AS marks,
             len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS same FROM arrows),
f AS (SELECT *, (bars + 1 >= {quality_rules.MIN_ENTRIES} AND bars >= {quality_rules.MAX_BARS} * (n - bars))
             OR (marks >= {quality_rules.MAX_MARKS} * n AND n >= 3)
             OR (n >= {quality_rules.BOILERPLATE_WORDS} AND (before OR 2 * same >= n)) AS bad FROM m),
s AS (SELECT doc_id, count(*) FILTER (WHERE before) AS dup, count(*) FILTER (WHERE bad) AS removed,
             coalesce(sum(size) FILTER (WHERE bad), 0) / sum(size) AS share FROM f GROUP BY 1),
o AS (SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, coalesce(removed, 0) AS n_lines_removed, coalesce(share, 0.0) AS lost_share
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN s USING (doc_id)),
b AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM o)
SELECT *, NOT base_failed AND lost_share <= {quality_rules.MAX_LOST} AS kept FROM b""")
def op7(spark, sf_dir):
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"))


@query("op8_decontaminate")
def op8(spark, sf_dir):
    return decontaminate.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_url_filter")
def op9(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@query("op10_line_dedup", f"""
WITH l AS (SELECT doc_id, i, l[i] AS line FROM (SELECT doc_id, l, generate_subscripts(l, 1) AS i FROM (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
k AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             '{ASCII_UPPER}', '{ASCII_LOWER}') AS key FROM l),
h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
j AS (SELECT k.doc_id, i, line, h.keeper IS NOT NULL AND h.keeper <> k.doc_id AS dropped FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256 FROM j GROUP BY doc_id""")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.with_bitmaps(docs, line_dedup.keep_bitmaps(docs))

    def digest(rows):
        for doc_id, text, keep in rows:
            n, lines = (text or "").count("\n") + 1, line_dedup.kept_lines(text, keep)
            yield doc_id, n, n - len(lines), hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()
    return map_rows(kept.select("doc_id", "text", "_line_keep"), digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


@query("op11_conversation_repair", oracles.REPAIR)
def op11(spark, sf_dir):
    convs = table(spark, sf_dir, "conversations")
    repair = conversation_repair.repair_conversations(conversation_repair.damage(convs))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    turns = repair.turns.select("conv_id", "part", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    ids = convs.schema["conv_id"].dataType.simpleString()

    def digest(batches):
        # A conversation's digest is one sequential pass: lines are streamed, none is held.
        now, sha = None, None
        for batch in batches:
            done = []
            for conv, line in zip(batch["conv_id"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if sha is not None and conv == now:
                    sha.update(b"\n")
                else:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                sha.update(line.encode("utf-8", "surrogatepass"))
            yield pa.record_batch([pa.array([c for c, _ in done], batch["conv_id"].type), pa.array([d for _, d in done], pa.string())],
                                  names=["conv_id", "repaired_sha256"])
        if sha is not None:
            yield pa.record_batch([pa.array([now], batch["conv_id"].type), pa.array([sha.hexdigest()], pa.string())],
                                  names=["conv_id", "repaired_sha256"])

    shas = (turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").select("conv_id", "line")
            .mapInArrow(digest, f"conv_id {ids}, repaired_sha256 string"))
    empty = F.lit(None).cast("string")
    rows = (repair.conversations.withColumn("repaired_sha256", empty)
            .unionByName(shas.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in counts), empty.alias("audit"), "repaired_sha256"))
            .unionByName(convs.select("conv_id").distinct().select("conv_id", *(F.lit(0).cast("long").alias(c) for c in counts), empty.alias("audit"),
                                                                   empty.alias("repaired_sha256"))))
    return (rows.groupBy("conv_id")
            .agg(*(F.sum(c).alias(c) for c in counts), F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                 F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))


@query("op12_spelling_variants", oracles.VARIANTS)
def op12(spark, sf_dir):
    return spelling.group_variants(spelling.count_words(spelling.typos(spelling.runs(table(spark, sf_dir, "documents")))))


@query("op13_packing")
def op13(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
