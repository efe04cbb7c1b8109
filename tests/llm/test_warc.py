import gzip
import hashlib
import uuid

from postlake.llm import warc
from postlake.llm.queries import QUERIES
from postlake.session import shared_dir
from tests.conftest import SF001


def captures(spark, rows, **kw):
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string, type string"), path, **kw)
    return warc.assemble(warc.read_records(spark, path)).collect()


def brute(rows):
    top = {}
    for p, _, h in rows:
        if len((h or "").encode()) >= 1000:
            top[h] = max(top.get(h, p), p)
    return sorted((p, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
                   "response" if top.get(h, p) == p else "revisit", None if top.get(h, p) == p else top[h]) for p, _, h in rows)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, QUERIES["op6_warc"](spark, SF001).collect())) == brute(rows)


def test_revisits_and_contents(spark, tmp_path):
    big, other = "é" * 600 + "\r\n\r\nWARC/1.1\r\n", "z" * 1000
    rows = [(i, f"http://h{i}.org/a?b", big) for i in range(40)] + [(50, "http://x.org", "s" * 999), (51, None, "s" * 999),
            (52, "u\r\nWARC-Type: bad", other), (53, "u", None), (54, "u", ""), (55, "http://y.org/é", "x" * 300_000), (49, "u", other)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(map(tuple, QUERIES["op6_warc"](spark, str(tmp_path)).collect())) == brute(rows)
    got = {int(c.metadata.fields["page-id"]): c for c in captures(spark, [(*r, "x") for r in rows], captures_per_file=7)}
    assert len(got) == len(rows)
    for p, url, html in rows:
        r = got[p].response
        assert bytes(r.payload) == ((html or "").encode() if r.type == "response" else b"")
        assert got[p].request.payload is not None and r.payload_digest == "sha1:" + hashlib.sha1((html or "").encode()).hexdigest()
        if r.type == "revisit":
            assert r.refers_to == got[int(got[p].metadata.fields["refers-to-page-id"])].response.record_id
    assert got[51].response.target_uri is None and got[52].response.target_uri == "u%0D%0AWARC-Type: bad"


def test_repeated_and_null_rows(spark):
    h = "q" * 2000
    got = captures(spark, [(1, "u", h, "t")] * 3 + [(None, "v", h, "t"), (1, "t", h, None)])
    assert sorted((c.metadata.fields.get("page-id"), c.response.type) for c in got if c.metadata.fields.get("page-id")) == [
        ("1", "response"), ("1", "revisit"), ("1", "revisit"), ("1", "revisit")]
    assert len({c.response.record_id for c in got}) == 5 and len({c.response.refers_to for c in got}) == 2
    assert [c.response.type for c in got if not c.metadata.fields.get("page-id")] == ["revisit"]
    assert captures(spark, []) == []


def test_every_row_gives_a_result(spark, tmp_path):
    rows = [(1, "u", "q" * 2000)] * 3 + [(2, "u", "q" * 2000), (3, None, "s"), (3, None, "s"), (4, "w", None), (4, "w", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(map(tuple, QUERIES["op6_warc"](spark, str(tmp_path)).collect()), key=str) == sorted(brute(rows), key=str)


def test_reader_takes_members_and_plain_archives():
    one = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    members = gzip.compress(one) + gzip.compress(one * 2)
    assert [b for _, b in warc.records(members)] == [b"hello"] * 3
    assert [b for _, b in warc.records(one * 2)] == [b"hello"] * 2
    assert list(warc.records(b"")) == []
