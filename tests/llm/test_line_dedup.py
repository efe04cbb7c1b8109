import hashlib
import random
import re

from postlake.llm import line_dedup
from postlake.llm.queries import QUERIES
from tests.conftest import SF001

BLANK = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in BLANK.sub("", line))


def brute(rows, min_chars=40, min_docs=5):
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and d is not None:
                holders.setdefault(key(line), set()).add(d)
    drop = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    return [(d, [x for x in (t or "").split("\n") if d is None or drop.get(key(x), d) == d]) for d, t in rows]


def texts(rows):
    return sorted(((d, "\n".join(x)) for d, x in brute(rows)), key=str)


def test_query_equals_brute_force(spark, documents):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in QUERIES["op10_line_dedup"](spark, SF001).collect()}
    for (d, text), (_, kept) in zip(documents, brute(documents), strict=True):
        n = text.count("\n") + 1
        assert got[d] == (n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())


def cut(frame, rows, n=5):
    docs = frame([t for _, t in rows], [d for d, _ in rows])
    return sorted(((r.doc_id, r.text or "") for r in line_dedup.dedup_lines(docs, min_docs=n).collect()), key=str)


def test_hot_lines_over_many_ranges(spark, frame):
    """Lines held by most documents span ranges; results stay those of brute force."""
    rnd = random.Random(7)
    lines = [f"  Common LINE number {i} of a great many é documents here\t" for i in range(6)]
    rows = [(i, "\n".join([rnd.choice(lines[:2]), *rnd.sample(lines, rnd.randrange(4)), f"own {i} " * 9, ""])) for i in range(400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert cut(frame, rows) == texts(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_edge_cases(spark, frame):
    line = "x" * 40
    rows = [(i, line) for i in range(5)] + [(5, None), (6, ""), (7, "é" * 39), (None, line), (4, line), (3, f"{line}\n{line}\nkept")]
    assert cut(frame, rows) == texts(rows)
    assert line_dedup.dedup_lines(frame([])).count() == 0
    short = [(i, "é" * 39) for i in range(9)]
    assert cut(frame, short) == sorted(short, key=str)


def test_other_columns_stay(spark, frame):
    docs = frame(["y" * 50] * 6).selectExpr("*", "'a' AS pos", "1 AS keep", "2 AS text_hash", "3 AS kind")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and sorted(r.n_chars for r in out.collect()) == [0] * 5 + [50]
