"""WARC archives by transaction assembly.

Writing: each page becomes a request record, a response (or revisit) record and
a metadata record that name the response by ``WARC-Concurrent-To``.  The three
are one text row, and Spark's text writer makes the gzipped archives: records
end with an empty line, which is the row separator.  Of pages with equal
payloads of at least ``MIN_REVISIT`` bytes the one with the largest page_id is
the response, the others are revisits without payload.  The groups are found
by a partial aggregate over digests; only groups of two or more are joined
back, from a written table whose size lets Spark decide how.

Reading: each archive is decompressed and cut into records as a stream, then
the request, response and metadata rows are joined through their
concurrent-to identifiers to one nested row per capture.

Cases: a null payload is the empty one, a null url or page_id is left out of
the record (null when read).  Every row is a capture with an id of its own,
also where rows are equal (``pages`` must give its rows in the same order each
time, as tables do); equal payloads with equal page_id tie by url, then by the
row's place, and one is the response.  An empty table gives an empty result.  Other columns stay out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.common import written

MIN_REVISIT = 1000
#: Captures per archive file at most: what one reading task holds compressed.
CAPTURES_PER_FILE = 10_000
#: Decompressed bytes taken at a time.
CHUNK = 4 << 20
_EOL = "\r\n"

_RECORD = ("record_id string, type string, concurrent_to string, target_uri string, refers_to string, "
           "payload_digest string, payload_sha1 string, payload_bytes long, fields map<string,string>, payload binary")


def _line(name: str, value) -> F.Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(_EOL)), F.lit(""))


def _uuid(kind: str, *parts) -> F.Column:
    h = F.md5(F.concat_ws("\t", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))
    return F.concat(F.lit("<urn:uuid:"), *(x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
                                           for x in ([F.lit("-")] * bool(i) + [F.substring(h, a, n)])), F.lit(">"))


def _record(kind, record_id, headers: list, content_type: str, block) -> F.Column:
    return F.concat(F.lit("WARC/1.1" + _EOL), _line("WARC-Type", kind), _line("WARC-Record-ID", record_id), *headers,
                    _line("Content-Type", F.lit(content_type)), _line("Content-Length", F.octet_length(block)),
                    F.lit(_EOL), block)


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, date: str = "2024-01-01T00:00:00Z",
                   captures_per_file: int = CAPTURES_PER_FILE) -> None:
    """Writes ``pages`` (page_id, url, html) as gzipped WARC files below ``path``."""
    rows = pages.select("page_id", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html"), "digest": F.sha1(F.col("html").cast("binary")), "row": F.monotonically_increasing_id()})
    groups = written(rows.where(F.col("size") >= min_revisit).groupBy("digest")
                     .agg(F.max(F.struct("page_id", "url", "row")).alias("kept"), F.count("*").alias("n"))
                     .where("n > 1").select("digest", "kept"), "warc-groups")
    rows = rows.join(groups, "digest", "left")
    revisit = F.col("kept").isNotNull() & (F.col("row") != F.col("kept.row"))
    rows = rows.withColumn("revisit", revisit).withColumn("refers", F.when(F.col("revisit"), F.col("kept")))
    ids = [F.col("page_id"), F.col("url"), F.col("digest"), F.col("row")]
    own = _uuid("response", *ids)
    uri, day = _line("WARC-Target-URI", F.col("url")), _line("WARC-Date", F.lit(date))
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    beside = _line("WARC-Concurrent-To", own)
    request = F.concat(F.lit("GET "), F.coalesce(F.regexp_extract("url", r"^[^:/]*://[^/?#]*([^#\s]*)", 1), F.lit("/")),
                       F.lit(f" HTTP/1.1{_EOL}{_EOL}"))
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8{_EOL}Content-Length: "),
                      F.col("size").cast("string"), F.lit(_EOL * 2), F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")))
    fields = F.concat(_line("page-id", F.col("page_id")), _line("payload-bytes", F.col("size")),
                      _line("refers-to-page-id", F.col("refers.page_id")))
    kind = F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    to = F.when(F.col("revisit"), _uuid("response", F.col("refers.page_id"), F.col("refers.url"), F.col("digest"), F.col("refers.row")))
    profile = F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    capture = F.concat_ws(_EOL * 2,
                          _record(F.lit("request"), _uuid("request", *ids), [day, uri, beside], "application/http; msgtype=request", request),
                          _record(kind, own, [day, uri, digest, _line("WARC-Refers-To", to), _line("WARC-Profile", profile)],
                                  "application/http; msgtype=response", answer),
                          _record(F.lit("metadata"), _uuid("metadata", *ids), [day, uri, beside], "application/warc-fields", fields))
    (rows.select(capture.alias("value")).write.option("lineSep", _EOL * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", captures_per_file).text(path))


def _inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of an archive: plain, or gzip of one or more members."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    rest = memoryview(content)
    while len(rest):
        z = zlib.decompressobj(31)
        while not z.eof and len(rest):
            out = z.decompress(rest, CHUNK)
            rest = memoryview(z.unused_data if z.eof else z.unconsumed_tail)
            yield out
            if not out and not z.eof and not len(rest):
                return


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; header names in lower case."""
    buffer, chunks = bytearray(), _inflated(content)

    def fill(n: int) -> bool:
        while len(buffer) < n and (more := next(chunks, None)) is not None:
            buffer.extend(more)
        return len(buffer) >= n

    while True:
        while fill(2) and buffer[:2] == b"\r\n":
            del buffer[:2]
        at = buffer.find(b"\r\n\r\n")
        while at < 0:
            if not fill(len(buffer) + 1):
                return
            at = buffer.find(b"\r\n\r\n")
        lines = bytes(buffer[:at]).decode("utf-8", "replace").split(_EOL)
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers.get("content-length", 0))
        if not fill(at + 4 + size):
            raise ValueError("archive ends inside a record")
        block = bytes(buffer[at + 4:at + 4 + size])
        del buffer[:at + 4 + size]
        yield headers, block


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives below ``path``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_RECORD))

    def rows(content):
        for h, block in records(content):
            kind, fields, payload = h.get("content-type", ""), {}, None
            if kind.startswith("application/http"):
                payload = block.partition(b"\r\n\r\n")[2]
            elif kind == "application/warc-fields":
                fields = dict(x.split(": ", 1) for x in block.decode("utf-8", "replace").split(_EOL) if ": " in x)
            yield (h.get("warc-record-id"), h.get("warc-type"), h.get("warc-concurrent-to"), h.get("warc-target-uri"),
                   h.get("warc-refers-to"), h.get("warc-payload-digest"),
                   None if payload is None else hashlib.sha1(payload).hexdigest(), None if payload is None else len(payload),
                   list(fields.items()), payload if with_payload else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for row in rows(content.as_buffer().to_pybytes()):
                    held.append(row)
                    size += 300 + len(row[-1] or b"")
                    if size > CHUNK:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    def _batch(held):
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, _RECORD)


def assemble(recs: DataFrame) -> DataFrame:
    """One nested row per capture: ``response``, ``request``, ``metadata``."""
    def side(kind: str):
        mine = recs.where(F.col("type") == kind).dropDuplicates(["concurrent_to"])
        return mine.select(F.col("concurrent_to").alias(f"_{kind}"), F.struct("record_id", "target_uri", "fields", "payload").alias(kind))

    main = recs.where(F.col("type").isin("response", "revisit")).dropDuplicates(["record_id"])
    main = main.select("record_id", F.struct(*(c for c in recs.columns if c not in ("concurrent_to", "fields"))).alias("response"))
    for kind in ("request", "metadata"):
        other = side(kind)
        main = main.join(other, main["record_id"] == other[f"_{kind}"], "left").drop(f"_{kind}")
    return main.drop("record_id")
