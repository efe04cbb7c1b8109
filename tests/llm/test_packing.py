"""Packing: pieces give back the library's ids, sequences have no padding, neighbours meet."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlake.llm import packing
from postlake.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def check(rows, texts, library, window=4096, with_ids=True):
    """``texts``: (doc_id, text), doc_ids distinct."""
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
        ids = np.array(want[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert (r["ids"] == ids) if with_ids else (r["ids_crc32"] == zlib.crc32(ids))
        assert r["doc_tokens"] == len(want[r["doc_id"]]) and r["length"] > 0
    assert pieces.keys() == want.keys()
    for doc, ps in pieces.items():
        ps.sort(key=lambda r: r["start"])
        assert [r["start"] for r in ps] == [0, *np.cumsum([r["length"] for r in ps]).tolist()[:-1]]
        assert sum(r["length"] for r in ps) == len(want[doc])
    for ps in sequences.values():
        ps.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in ps] == [0, *np.cumsum([r["length"] for r in ps]).tolist()[:-1]]
        size = sum(r["length"] for r in ps)
        assert size == window or (size < window and size & (size - 1) == 0)


def test_documents_of_the_table(spark, frame, documents, library):
    check(packing.pack_documents(frame([t for _, t in documents]), tokenizer_path(), shard_docs=60).collect(), list(enumerate(t for _, t in documents)), library)


def test_awkward_texts(spark, tmp_path, library):
    texts = [None, "", " ", "a", "<|endoftext|> and <|startoftext|>", "Ünïcode ǅ ΑΣ", "!!! ' 's 'll 12 3", "x" * 70_000, "word " * 4095, "word " * 4096,
             "the end " * 30_000, "a</w> b</w>", "same"] + ["same text again"] * 3
    rows = list(enumerate(texts)) + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("start", F.lit(7))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    check(QUERIES["op13_packing"](spark, str(tmp_path)).collect(), rows, library, with_ids=False)


def test_repeated_rows_and_empty_table(spark, frame):
    got = packing.pack_documents(frame(["one two"] * 4, [5] * 4), tokenizer_path(), window=8).collect()
    assert sum(r["length"] for r in got) == 4 * 3
    assert packing.pack_documents(frame([]), tokenizer_path()).count() == 0


def test_scores_are_bm25():
    rng = random.Random(3)
    rests = [np.array([rng.randrange(40) for _ in range(rng.randrange(1, 30))], "<u4").tobytes() for _ in range(50)]
    idf, mean = np.linspace(0.1, 3, 41), 14.0
    ids = [np.frombuffer(r, "<u4").tolist() for r in rests]
    index = packing.Shard(rests, idf, mean)
    for q in (ids[0], ids[7], [40], []):
        want = [sum(idf[t] * d.count(t) * 2.2 / (d.count(t) + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in set(q)) for d in ids]
        assert np.allclose(index.scores(np.array(q, "<u4").tobytes()), want)


def test_neighbours_share_windows():
    rng = random.Random(4)
    topics = [[100 * k + j for j in range(60)] for k in range(8)]
    rests, topic = [], []
    for i in range(160):
        topic.append(i % 8)
        rests.append(np.array([rng.choice(topics[i % 8]) if rng.random() < 0.5 else rng.randrange(900, 1000) for _ in range(40)], "<u4").tobytes())
    df = np.bincount(np.concatenate([np.unique(np.frombuffer(r, "<u4")) for r in rests]), minlength=1000)
    idf = np.log1p((160 - df + 0.5) / (df + 0.5))
    full = [s for s in packing.fill_windows(rests, idf, 40.0, 256) if sum(n for *_, n in s) == 256]
    pure = sum(max(np.bincount([topic[d] for d, *_ in s])) / len(s) for s in full) / len(full)
    assert len(full) == 25 and pure > 0.85  # 1/8 by chance


ODD = ["a.b.,c ...x. don't. o'clock's! 's.t", "é. ÷. ø; ß: 1. 12.5, ²! x y\x1cz.\x85w", "İ. ΑΣ. ǅ, K; 漢字. é. ́.", " a. b", "<|endoftext|>. <|startoftext|>a.", None, "", "  \n\t ",
       "The the THE. (the) \"the,\" the?! the:the"]


@pytest.mark.parametrize("cache", [500_000, 6])
def test_chunks_give_the_ids_of_whole_texts(library, monkeypatch, cache):
    monkeypatch.setattr(packing, "CACHE_WORDS", cache)
    with open(tokenizer_path(), encoding="utf-8") as f:
        coder = packing.Encoder(f.read())
    rng = random.Random(6)
    odd = "aB1²'.,;!?:é÷Σİ漢́ \x1c\x85 \n"
    for texts in (ODD, ["".join(rng.choice(odd) for _ in range(rng.randrange(40))) for _ in range(300)], ODD[::-1]):
        want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert coder.encode(texts) == want
        assert [coder.encode([t])[0] for t in texts] == want


def test_known_chunks_are_not_divided_again():
    with open(tokenizer_path(), encoding="utf-8") as f:
        coder = packing.Encoder(f.read())
    want = coder.encode(["One two, three.", "Été. two"])
    coder.latin = coder.lines = None  # any use of the word pattern fails
    assert coder.encode(["ONE\ttwo, three.", "été. TWO"]) == want


def test_postings_of_used_documents_go(monkeypatch):
    rests = [np.array([i % 7, 10 + i % 5, 20], "<u4").tobytes() for i in range(100)]
    left, keep = [], packing.Shard.keep
    monkeypatch.setattr(packing.Shard, "keep", lambda self, unused: keep(self, unused) or left.append((len(self.doc), 3 * int(unused.sum()))))
    assert sum(n for s in packing.fill_windows(rests, np.ones(21), 3.0, 16) for *_, n in s) == 300
    assert len(left) > 5 and all(n == m for n, m in left) and left[-1][0] < 60
