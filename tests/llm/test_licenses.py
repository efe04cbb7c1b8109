import re

from postlake.llm import licenses
from postlake.llm.queries import QUERIES
from tests.conftest import SF001

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = (("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl")


def brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for p, label in BASE for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def base(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_query_equals_brute_force(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op5_licenses"](spark, SF001).collect()}
    assert len(got) == len(documents)
    for d, text in documents:
        assert base(got[d]) == brute(text), text
        assert set(got[d].base_labels.split(",")) <= set(got[d].labels.split(",")) | {""} and 0 <= got[d].score <= 1


def test_plan_has_no_python(spark):
    from pyspark.sql import functions as F
    docs = spark.range(9).select(F.col("id").alias("doc_id"), F.lit("MIT License").alias("text"))
    plan = licenses.scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_templates_and_edge_cases(spark, frame):
    notice = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
              "that the following conditions are met")
    texts = ["MIT License, mit-license mit license", "x " * 5000 + notice.upper() + " the end", None, "", "Mit lİcense ſ general public licenses",
             "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "general public license public license",
             notice.replace("source and", "source or"), "MIT License, mit-license mit license", "mit\x00license 'MIT' LICENSE", "Émit license"]
    ids = [0, 1, 2, 3, None, 5, 6, 7, 8, 0, 10, 11]
    docs = frame(texts, ids).selectExpr("*", "1 AS norm", "2 AS text_hash", "3 AS labels")
    rows = sorted(licenses.scan_licenses(docs).collect(), key=lambda r: (str(r.doc_id), r.n_words))
    want = sorted(zip(ids, texts, strict=True), key=lambda x: (str(x[0]), brute(x[1])[0]))
    assert [(r.doc_id, *base(r)) for r in rows] == [(d, *brute(t)) for d, t in want]
    labels = {r.doc_id: (r.labels, r.score) for r in rows}
    assert labels[1] == ("bsd", 1.0) and labels[5][0] == "cc-by-nc" and labels[6] == ("gpl", 1.0) and labels[0] == ("mit", 1.0)
    assert labels[8] == labels[3] == labels[None] == ("", 0.0)
    assert licenses.scan_licenses(frame([])).count() == 0


def test_notice_file_with_all_templates(spark, frame):
    notices = " ; ".join(text for *_, text in licenses.TEMPLATES)
    prose = ["plain words of a page"] * 40
    rows = {r.doc_id: r for r in licenses.scan_licenses(frame([notices, *prose, *(text for *_, text in licenses.TEMPLATES)])).collect()}
    assert [m.template for m in sorted(rows[0].matches, key=lambda m: m.template)] == list(range(len(licenses.TEMPLATES)))
    assert set(rows[0].labels.split(",")) == {label for label, *_ in licenses.TEMPLATES}
