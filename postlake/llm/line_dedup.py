"""Line dedup: range-partitioned hashes, sorted by document, streamed.

A line's key is the line without ASCII white space at its ends, A-Z
lower-cased.  Keys of at least ``min_chars`` code points that at least
``min_docs`` documents hold lose all their lines except in the largest
``doc_id`` that holds them.

1. Each document turns into one row per (128-bit key hash, document) with the
   positions of that key: the pre-aggregation, before anything is shuffled.
2. The rows are range-partitioned by (hash, doc_id descending) and sorted.  A
   hash that holds a third of all rows spans many ranges.
3. Each range is streamed.  As the largest document comes first, any hash that
   begins inside the range is decided on the spot, holding back at most
   ``min_docs - 1`` documents.  Only the first hash of a range may have begun
   earlier and only the last may go on; these leave one summary row each.
4. The summaries (two rows a range at most, so their broadcast is bounded by
   the number of partitions) decide what the ranges could not.
5. Per document the dropped positions become one zlib-compressed bitmap.

Cases: a null text is an empty one with one empty line.  A row with null
``doc_id`` keeps all its lines and counts for no key.  Repeated ``doc_id``s
count as one document; rows are told apart by their text, equal rows get equal
bitmaps.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import map_rows, slices, written

MIN_CHARS = 40
MIN_DOCS = 5
BLANK = b" \t\n\x0b\x0c\r"

_KEYS = "k1 long, k2 long, doc_id long, text_hash long, pos array<int>"
_RUNS = "kind int, k1 long, k2 long, doc_id long, text_hash long, pos array<int>, n_docs long"
_DROP, _OPEN, _SUMMARY = 0, 1, 2


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document and key: hash, document, positions of its lines."""

    def keys(rows):
        for doc_id, text_hash, text in rows:
            found: dict[bytes, list[int]] = {}
            for i, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
                if len(line) >= min_chars:
                    key = line.strip(BLANK).lower()
                    if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= min_chars):
                        found.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
            if found:
                hashes = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2).tolist()
                for (k1, k2), pos in zip(hashes, found.values(), strict=True):
                    yield k1, k2, doc_id, text_hash, pos

    return map_rows(docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text"), keys, _KEYS)


def _stream(min_docs: int):
    """The pass over one sorted range; rows out: see ``_RUNS``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_RUNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head = None, False  # head: the range's first key, which may have begun before
        keeper, last, n, held = None, None, 0, []
        out: list[tuple] = []

        def summary():
            return (_SUMMARY, *key, keeper, None, None, n)

        def rows():
            for batch in batches:
                for part in slices(batch):
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        def packed():
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        for k1, k2, doc, text_hash, pos in rows():
            if (k1, k2) != key:
                if head:
                    out.append(summary())
                head, key = key is None, (k1, k2)
                keeper, last, n, held = doc, None, 0, []
            if doc != last:
                n, last = n + 1, doc
            if head:
                out.append((_OPEN, k1, k2, doc, text_hash, pos, None))
            elif n < min_docs:
                held.append((k1, k2, doc, text_hash, pos))
            else:
                out += [(_DROP, None, None, d, t, p, None) for _, _, d, t, p in (*held, (k1, k2, doc, text_hash, pos)) if d != keeper]
                held = []
            if len(out) >= 5_000:
                yield packed()
                out = []
        if key is not None:
            out += [(_OPEN, *x, None) for x in held]
            out.append(summary())
        if out:
            yield packed()

    return run


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_hash, n_dropped, keep): documents that lose lines.

    ``keep`` is a zlib-compressed bitmap (little bit order, 1 = keep) up to the
    last dropped line; lines beyond it stay, as do all lines of documents
    without a row.
    """
    keys = written(line_keys(docs, min_chars), "line-keys")
    ranges = keys.repartitionByRange("k1", "k2", F.desc("doc_id")).sortWithinPartitions("k1", "k2", F.desc("doc_id"), "text_hash")
    runs = written(ranges.mapInArrow(_stream(min_docs), _RUNS), "line-runs")
    edges = (runs.where(F.col("kind") == _SUMMARY).groupBy("k1", "k2")
             .agg(F.sum("n_docs").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs))
    late = (runs.where(F.col("kind") == _OPEN).join(F.broadcast(edges), ["k1", "k2"])
            .where("doc_id != keeper"))
    cols = ("doc_id", "text_hash", "pos")
    drops = (runs.where(F.col("kind") == _DROP).select(*cols).union(late.select(*cols))
             .groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("pos")).alias("pos")))

    def pack(rows):
        for doc_id, text_hash, pos in rows:
            pos = np.unique(np.asarray(pos, np.int64))
            bits = np.ones((int(pos[-1]) // 8 + 1) * 8, bool)
            bits[pos] = False
            yield doc_id, text_hash, len(pos), zlib.compress(np.packbits(bits, bitorder="little").tobytes())

    return map_rows(drops, pack, "doc_id long, text_hash long, n_dropped long, keep binary")


def kept_lines(text: str | None, keep: bytes | None) -> list[str]:
    """The lines of ``text`` that a bitmap of ``keep_bitmaps`` leaves."""
    lines = (text or "").split("\n")
    if keep is None:
        return lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    return [x for i, x in enumerate(lines) if i >= len(bits) or bits[i]]


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, name: str = "_line_keep") -> DataFrame:
    """``docs`` with its bitmap (null: nothing dropped) in a column ``name``."""
    right = bitmaps.select(F.col("doc_id").alias("_line_id"), F.col("text_hash").alias("_line_text"), F.col("keep").alias(name))
    return docs.join(right, (docs["doc_id"].cast("long") == right["_line_id"]) & (F.xxhash64(docs["text"]) == right["_line_text"]),
                     "left").drop("_line_id", "_line_text")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with dropped lines gone from ``text`` (and from ``n_chars``,
    where there is such a column); other columns and untouched rows as given."""
    out = with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
    cut = F.udf(lambda text, keep: "\n".join(kept_lines(text, keep)), "string", useArrow=True)
    out = out.withColumn("text", F.when(F.col("_line_keep").isNull(), F.col("text")).otherwise(cut("text", "_line_keep")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_line_keep").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
