import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from postlake.llm import bpe
from postlake.llm.queries import QUERIES, tokenizer_path
from tests.conftest import SF001


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def mine():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return bpe.WordBpe(f.read())


def same(mine, library, texts):
    for text, (ids, decoded) in zip(texts, mine.encode(texts), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert decoded == library.decode(want, skip_special_tokens=False) == mine.decode(want)


def test_query_equals_library(spark, documents, library):
    got = {r.doc_id: r for r in QUERIES["op3_bpe"](spark, SF001).collect()}
    assert len(got) == len(documents)
    for d, text in documents:
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[d].n_tokens == len(ids) and got[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_awkward_texts(mine, library):
    rnd = random.Random(3)
    words = [t.replace(mine.suffix, "") for t in mine.vocab]
    texts = ["", None, " ", "a", "It's WE'LL they'd", "<|endoftext|>x<|startoftext|><|endoftext|>", "İSTANBUL ΣΑΣ ẞ", "é \x1c\x85　b",
             "x" * 3000, "ab" * 2500, "漢字 123 ½² 😀👍🏽!!", "\n\t", "' 's"]
    texts += ["".join(rnd.choice("aeinthrs'dΣİßéñ漢😀1½ \n!?<|") for _ in range(200)) for _ in range(100)]
    texts += [" ".join("".join(rnd.choice(words) for _ in range(rnd.randrange(1, 4))) for _ in range(2000))]
    same(mine, library, texts)


def test_speculation_equals_merging(mine, monkeypatch):
    """Accepted proposals are what merging makes; some need merging; the heap agrees."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("theinandores") for _ in range(rnd.randrange(1, 14))) for _ in range(4000)]
    mine.cache = {}
    mine.learn(set(words))
    want = {w: mine.exact(w) for w in words}
    assert all(np.frombuffer(mine.cache[w][0], "<u4").tolist() == want[w] for w in words)
    assert 0 < sum(mine.propose(w) != want[w] for w in set(words)) < len(set(words))
    monkeypatch.setattr(bpe, "LONG", 2)
    assert all(mine.exact(w) == want[w] for w in words)


def test_small_cache_and_round_trip(mine, library, monkeypatch, documents):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    same(mine, library, [t for _, t in documents[:40]])
    _, decoded = mine.encode(["Hello wörld, 12 café"])[0]
    assert mine.readable(decoded) == "hello wörld , 1 2 café"


def test_rows_and_columns(spark, frame):
    docs = frame(["a b", None, "a b"], [1, None, 1]).selectExpr("*", "1 AS ids", "2 AS decoded")
    out = sorted(bpe.encode_documents(docs, tokenizer_path()).collect(), key=str)
    assert [(r.doc_id, len(r.ids) // 4) for r in out] == [(1, 2), (1, 2), (None, 0)]
    assert bpe.encode_documents(frame([]), tokenizer_path()).count() == 0
