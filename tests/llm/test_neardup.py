import random
import re

import numpy as np
import pytest

from postlake.llm import neardup
from postlake.llm.queries import QUERIES
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """{doc_id: (n, component)} of (doc_id, text) rows with distinct ids."""
    sets = {d: shingle_set(t) for d, t in rows}
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    holders = {}
    for d in sorted(sets):
        near = {e for s in sets[d] for e in holders.get(s, ())}
        for e in near:
            i = len(sets[d] & sets[e])
            if 100 * i >= 75 * (len(sets[d]) + len(sets[e]) - i):
                a, b = sorted((find(d), find(e)))
                label[b] = a
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_equals_brute_force(spark, documents):
    rows = QUERIES["op2_neardup"](spark, SF001).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(documents)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def cluster(seed, n):
    """Near copies of two texts, with changes spread around the threshold, and copies of copies."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)]
    bases = [[rnd.choice(vocab) for _ in range(120)] for _ in range(2)]
    out = [" ".join(b) for b in bases]
    for i in range(n):
        w = list(rnd.choice(bases)) if i % 5 else out[rnd.randrange(len(out))].split()
        for _ in range(rnd.randrange(0, 7)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        out.append(" ".join(w))
    return out + [" ".join(rnd.choice(vocab) for _ in range(60)) for _ in range(20)] + out[:10]


@pytest.mark.parametrize(("limit", "few"), [(1_000, 10**6), (40, 10**6), (40, 0)])
def test_dense_groups_whole_and_in_blocks(spark, frame, limit, few):
    texts = cluster(limit, 250)
    random.Random(1).shuffle(texts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    got = result(neardup.near_duplicates(frame(texts), group_docs=limit, broadcast_rows=few))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(list(enumerate(texts)))


def test_recall_of_the_forest(spark):
    """Pairs near the threshold meet in the forest."""
    rnd = random.Random(4)
    rows, want = [], set()
    for i in range(150):
        w = [f"{i}_{rnd.randrange(10**6)}" for _ in range(130)]
        v = list(w)
        for j in (10, 50, 90):
            v[j] = f"x{rnd.random()}"
        for k, words in enumerate((w, v)):
            s = neardup.shingles(" ".join(words))
            rows.append((2 * i + k, bytearray(neardup.signature(s).tobytes())))
        want.add((2 * i, 2 * i + 1))
    pairs = neardup.candidate_pairs(spark.createDataFrame(rows, "node long, sig binary").repartition(3)).collect()
    assert want <= {tuple(sorted((p.a, p.b))) for p in pairs}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 299)]
    got = {r.node: r.comp for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 10 for i in range(10, 61)}, 100: 100, **{200 + i: 100 for i in range(50)}, 299: 299, 300: 299}


def test_overlaps_in_any_blocks():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 300, 80).astype(np.uint64)) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    apart = ~np.eye(30, dtype=bool)  # a set's own size is not looked for
    assert (neardup.overlaps(sets)[apart] == np.array(want)[apart]).all()
    assert neardup.overlaps(sets[:7], sets[7:]).tolist() == [x[7:] for x in want[:7]]


def test_edge_cases(spark, frame):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(0, None), (1, ""), (2, " \n"), (3, "a b c"), (4, "A  B\tC"), (5, "a b c d e"), (6, "a b c d e f g h"), (7, "a b c d e f g"),
            (8, long), (9, long + " end"), (10, "\x1ca\x1cb"), (11, "é É"), (12, "é É")]
    got = result(neardup.near_duplicates(frame([t for _, t in rows], [d for d, _ in rows]).selectExpr("*", "1 AS node", "2 AS unit", "3 AS comp")))
    assert got == brute(rows)
    assert neardup.near_duplicates(frame([])).count() == 0


def test_repeated_and_null_ids(spark, frame):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    docs = frame([a, a, b, b, None, a], [5, 5, 5, 9, None, None])
    rows = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(5, 5, True)] * 3 + [(9, 5, False)] + [(None, None, False)] * 2, key=str)
    left = neardup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted((r.doc_id for r in left.collect()), key=str) == [5, 5, 5, None, None]
