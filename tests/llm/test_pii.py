import hashlib
import itertools
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from postlake.llm import pii
from postlake.llm.queries import QUERIES
from tests.conftest import SF001


def good_card(t):
    d = [int(c) for c in re.sub(r"\D", "", t)][::-1]
    return 14 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


RULES = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", good_card),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 10 <= len(re.sub("[^0-9]", "", t)) <= 15))


def brute(text):
    return [x[2] for x in sorted((m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, ok) in enumerate(RULES)
                                 for m in re.finditer(p, text) if ok(m[0]))]


def test_query_equals_brute_force(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op4_pii"](spark, SF001).collect()}
    assert len(got) == len(documents)
    for d, text in documents:
        want = brute(text)
        assert got[d].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (got[d].n_email, got[d].n_ip, got[d].n_card, got[d].n_phone) == tuple(sum(x.startswith(k[0]) for x in want) for k in RULES)
        assert set(want) <= set(got[d].spans.split(",")) | {""}


@settings(max_examples=600, deadline=None)
@given(st.text("a1@._%+-() 9é\n", max_size=40))
def test_base_spans_of_any_text(text):
    assert [f"{k}:{s}:{e}" for s, e, k in pii.base_spans(text)] == brute(text)


def test_long_runs_take_linear_time():
    text = "a" * 300_000 + " " + "1" * 300_000 + " " + "+1((" * 50_000 + "a@" * 50_000
    assert pii.base_spans(text) == []


def test_viterbi_equals_enumeration():
    crf = pii.trained()
    lines = [crf.numbers(x.split()) for x in ("call (555) 123-4567", "Dr. Marlo Thest", "ssn 123-45-6789 at", "at at dot com", "x", "555 123 4567")]
    got = crf.label(lines)
    step = crf.w["step"]
    for i, codes in enumerate(lines):
        e = crf.emissions(np.array([codes]))[0]
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(codes)),
                   key=lambda p: e[0, p[0]] + sum(step[a, b] + e[j + 1, b] for j, (a, b) in enumerate(zip(p, p[1:], strict=False))))
        assert tuple(got[i][:len(codes)].tolist() if i in got else [0] * len(codes)) == best


def test_held_out_accuracy():
    crf, table = pii.trained(), pii.sentences(300, seed=909)
    found = crf.label([crf.numbers(w) for w, _ in table])
    said = [pii.LABELS[k] for i, (w, _) in enumerate(table) for k in (found[i][:len(w)] if i in found else [0] * len(w))]
    want = [x for _, labels in table for x in labels]
    assert np.mean([a == b for a, b in zip(said, want, strict=True)]) >= 0.985
    assert np.mean([a == b for a, b in zip(said, want, strict=True) if b != "O"]) >= 0.95


def test_crf_adds_spans(spark, frame):
    long = "the and of to " * 20_000
    texts = ["please call (555) 123-4567 now", "we met Dr. Marlo Thest there.", "mail the.42@mail3.example.com please", None, "", long + "\nssn: 123-45-6789", long]
    docs = frame(texts, [0, 1, 2, 3, None, 5, 5]).selectExpr("*", "1 AS spans")
    got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in pii.find_pii(docs).collect()), key=str)
    assert got == sorted([(0, [("local_phone", 12, 26)]), (1, [("name", 11, 22)]), (2, [("email", 5, 29)]), (3, []), (None, []), (5, []),
                          (5, [("national_id", len(long) + 6, len(long) + 17)])], key=str)
    assert pii.find_pii(frame([])).count() == 0


def test_model_spans_beside_many_base_spans(spark, frame, monkeypatch):
    """The merge of sorted spans drops what a comparison of all pairs drops."""
    import random
    rnd = random.Random(3)
    text = " ".join(rnd.choice(["a@b.org", "1.2.3.4", "+49 171 2345678", "word", "x@y.z.com"]) for _ in range(400))
    base = pii.base_spans(text)
    more = [(s, s + rnd.randrange(9), "name") for s in sorted(rnd.randrange(len(text)) for _ in range(600))]
    monkeypatch.setattr(pii, "crf_spans", lambda crf, texts: [more for _ in texts])
    monkeypatch.setattr(pii, "KINDS", (*pii.KINDS, "name"))
    monkeypatch.setattr(pii, "map_rows", lambda df, fn, schema: list(fn([(0, text)])))
    got = [(x["start"], x["end"], x["kind"]) for x in pii.find_pii(frame([text]))[0][1]]
    want = base + [x for x in more if x[0] < x[1] and not any(s < x[1] and x[0] < e for s, e, _ in base)]
    assert sorted(got) == sorted(want) and len(want) > len(base)
