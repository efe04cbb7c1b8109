"""The pipeline against its stages by brute force, one after the other."""

import hashlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from postlake.llm import quality_rules
from postlake.llm.queries import tokenizer_path
from tests.conftest import SF001
from tests.llm import test_decontaminate, test_line_dedup, test_neardup


def test_run_equals_brute_force(spark, documents):
    rows = [(d, t) for d, t in documents if quality_rules.judge(t)[6]]
    rows = [(d, "\n".join(x)) for d, x in test_line_dedup.brute(rows)]
    comp = test_neardup.brute(rows)
    rows = [(d, t) for d, t in rows if comp[d][1] == d]
    bad = test_decontaminate.brute(rows, test_decontaminate.items_of(SF001))
    rows = [(d, t) for d, t in rows if d not in bad]
    lib = Tokenizer.from_file(tokenizer_path())
    lib.no_padding()
    lib.no_truncation()
    want = {d: np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for d, t in rows}
    got = corpus_pipeline.run(spark, SF001).collect()
    assert {r.doc_id: bytes(r.ids) for r in got} == want and len(got) == len(want) < len(documents)
    assert all(r.ids_sha256 == hashlib.sha256(want[r.doc_id]).hexdigest() and r.n_tokens == len(want[r.doc_id]) // 4 for r in got)


def test_stages_keep_columns_and_take_awkward_tables(spark, frame):
    good = "The quick brown fox jumps over the lazy dog and runs far away from here. "
    docs = frame([good, good, None, "", good * 40, good + "more and more words", good], [1, 2, 3, 4, 5, None, 1])
    docs = docs.selectExpr("*", "1 AS kept", "2 AS node", "3 AS pos", "4 AS key")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        assert stage(spark, docs.limit(0), SF001).count() == 0 and out.count() <= 7
