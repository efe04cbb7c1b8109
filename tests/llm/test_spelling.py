"""Spelling variants against all pairs, with the trie, with hashed keys, and mixed."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postlake.llm import spelling
from postlake.llm.queries import QUERIES


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def rows_of(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def vocabulary(seed, letters="abé", sizes=(4, 10), n=400):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(n)}
    words |= {"a" * k for k in range(4, 9)}
    return {w: rng.choice([2, 3, 9, 30, 400, 5000]) for w in words}


@pytest.mark.parametrize("seed,trie_letters,sizes", [(1, 32, (4, 10)), (2, 6, (4, 10)), (3, 3, (4, 9))])
def test_dense_vocabulary(spark, seed, trie_letters, sizes):
    counts = vocabulary(seed, sizes=sizes)
    got = rows_of(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), 4, 10, trie_letters))
    assert got == brute(counts)


def test_every_edit_place_and_chains(spark):
    word = "mississippi"
    counts = {word: 1000}
    for i in range(len(word) + 1):
        counts.setdefault(word[:i] + "x" + word[i:], 3)
        counts.setdefault(word[:i] + word[i + 1:], 4)
        counts.setdefault(word[:i] + "é" + word[i + 1:], 5)
    for k, n in enumerate([2, 20, 200, 2000, 20000, 200000]):  # a chain of forms
        counts["chainedwords" + "abcdef"[:k]] = n
    got = rows_of(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute(counts)
    assert got["chainedwords"][1] == "chainedwordsabcde"


def contract(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return brute({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def test_query_equals_the_contract(spark, tmp_path):
    rng = random.Random(9)
    stems = ["spelling", "variants", "Übergröße", "naïveté", "relational", "frontier", "ÿÿÿÿÿÿÿ", "lettersÀlà"]
    long = "pneumono" * 6
    rows = [(i, " ".join(rng.choice(stems) + rng.choice(["", "", "s", "x"]) for _ in range(60))) for i in range(60)]
    rows += [(None, "spelling Spelling nullsdocument"), (7, None), (8, ""), (9, "12 . spelling_variants|frontier"), (5, rows[5][1]), (5, rows[5][1])]
    rows += [(100 + i, f"{long}o {long} {long}") for i in range(3)] + [(200, ("longword" * 40_000 + " ") * 2 + ("longword" * 40_000 + "s ") * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.withColumn("n", F.lit("clash")).withColumn("word", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(QUERIES["op12_spelling_variants"](spark, str(tmp_path))) == contract(rows)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op12_spelling_variants"](spark, str(tmp_path)).count() == 0
