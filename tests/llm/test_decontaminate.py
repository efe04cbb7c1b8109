import random

import duckdb
import pytest

from postlake.llm import decontaminate as d
from postlake.llm.queries import QUERIES
from tests.conftest import SF001


def items_of(sf):
    return duckdb.connect().execute(f"select item_id, text from read_parquet('{sf}/benchmark.parquet') order by 1").fetchall()


def tokens(text):
    """(canonical word, placeholder value or None), one word at a time."""
    out, end, number = [], True, False
    for w in (text or "").split():
        body = w.strip(d._MARKS)
        low, kind = body.lower(), None
        if any(c in "0123456789" for c in body):
            kind = "<num>"
        elif low in d.UNITS and number:
            kind = "<unit>"
        elif len(body) > 1 and body[0].isupper() and body[1:].islower() and not end:
            kind = "<name>"
        out.append((kind or low, low if kind else None))
        end, number = w.rstrip("\"')”»’")[-1:] in (".", "!", "?", ":"), kind == "<num>"
    return out


def brute(rows, items):
    """{doc_id: sorted items}."""
    def wins(t):
        w = tokens(t)
        return [(i, tuple(x for x, _ in w[i:i + 5]), [v for _, v in w[i:i + 5]]) for i in range(len(w) - 4)
                if sum(v is None for _, v in w[i:i + 5]) >= 3]
    index, size = {}, {}
    for item, text in set(items):
        size[item] = len(wins(text))
        for i, key, values in wins(text):
            index.setdefault(key, []).append((item, i, values))
    found = {}
    whole = {item: tokens(text) for item, text in items if 0 < len(tokens(text)) < 5}
    for doc, text in rows:
        for line in [*(text or "").split("\n"), *([text] if len((text or "").split()) < 5 else [])]:
            words = tokens(line)
            for item, own in whole.items():
                same = [w for w, _ in words] == [w for w, _ in own] and sum(v is None for _, v in own) >= 3
                if words == own or same:
                    found.setdefault(doc, set()).add(item)
        lines = {}
        for at, key, values in wins(text):
            for item, i, want in index.get(key, ()):
                lines.setdefault((item, at - i), []).append((i, [(k, a, b) for k, a, b in zip(key, want, values, strict=True) if a is not None]))
        good = {}
        for (item, shift), hits in lines.items():
            pairs = {p for _, ps in hits for p in ps}
            bad = {p for p in pairs for q in pairs if p[0] == q[0] and (p[1] == q[1]) != (p[2] == q[2])}
            good[item, shift] = {i for i, ps in hits if not bad & set(ps)}
        for item in {i for i, _ in good}:
            mine = [g for (i, _), g in good.items() if i == item]
            run = any(all(j in g for j in range(i, i + d.RUN)) for g in mine for i in g)
            if run or len(set().union(*mine)) >= d.SHARE * size[item]:
                found.setdefault(doc, set()).add(item)
    return {doc: sorted(x) for doc, x in found.items()}


def test_query_equals_brute_force(spark, documents):
    got = {r.doc_id: r["items"] for r in QUERIES["op8_decontaminate"](spark, SF001).collect()}
    want = brute(documents, items_of(SF001))
    assert got == want and want


ITEMS = [(0, "If Anna has 12 red apples and Anna gives 5 of them to Bruno, how many apples are left for Anna at the end?"),
         (1, "the train leaves the big old station at 9 and runs 300 km without any stop until noon today"),
         (1, "the train leaves the big old station at 9 and runs 300 km without any stop until noon today"),
         (2, "too short item"), (3, None), (4, "")]


def flagged(spark, frame, texts, ids=None, **kw):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS key", "'x' AS slots")
    docs = frame(texts, ids).selectExpr("*", "1 AS item_id", "2 AS key")
    return docs, bench, {(r.doc_id, r.item_id): r for r in d.contaminated(docs, bench, **kw).collect()}


@pytest.mark.parametrize("limit", [d.BROADCAST_BYTES, 0])
def test_reparameterised_questions(spark, frame, limit):
    rnd = random.Random(1)
    prose = " ".join(rnd.choice("some words of plain prose that go on".split()) for _ in range(3000))
    texts = ["If Carla has 40 red apples and Carla gives 7 of them to Denis, how many apples are left for Carla at the end?",
             "If Carla has 40 red apples and Maria gives 7 of them to Carla, how many apples are left for Denis at the end?",
             f"{prose} THE TRAIN leaves the big old station at 8 and runs 250 miles without any stop until noon today {prose}",
             prose, None, "", "too short item", ITEMS[1][1], ITEMS[1][1], "the train leaves the big old station"]
    ids = [0, 1, 2, 3, 4, 5, 6, None, 8, 9]
    docs, bench, got = flagged(spark, frame, texts, ids, broadcast_bytes=limit)
    assert set(got) == {(0, 0), (2, 1), (None, 1), (6, 2), (8, 1)}
    assert got[0, 0].reparameterised and got[2, 1].reparameterised and not got[8, 1].reparameterised
    assert {k: v for k, v in brute(list(zip(ids, texts, strict=True)), ITEMS).items()} == {0: [0], 2: [1], None: [1], 6: [2], 8: [1]}
    left = d.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5, 9]


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contaminated(frame(["a b c d e f"]), none).count() == 0
    assert flagged(spark, frame, [])[2] == {}


def test_repeated_rows(spark, frame):
    rows = flagged(spark, frame, [ITEMS[1][1], ITEMS[1][1], "clean text of no interest at all"], [3, 3, 3])
    assert set(rows[2]) == {(3, 1)}
    assert [r.text[:5] for r in d.drop_contaminated(rows[0], rows[1]).collect()] == ["clean"]


def matched(spark, frame, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in d.contaminated(frame(texts), bench).collect()}


def test_verbatim_passages_with_names_and_numbers(spark, frame):
    item = ("in the old days the general George Washington met 12 envoys from France and 3 men from Spain near the river where "
            "they spoke about trade and peace for a long time before all of them went back home over the hills to tell what "
            "had been said there and why it mattered so much")
    names = "Ask Anna Bell Carl Dorn Emil Frey Gina Holt 12 13 14"
    texts = ["zz " + " ".join(item.split()[:18]) + " qq", " ".join(item.split()[:12]) + " qq", "zz " + names + " qq", names.replace("Carl", "Kurt"),
             # the skipped window is bridged where the values map one to one
             "ss the general Peter Hamilton met 15 envoys from Russia and 4 men from Turkey near the river where they qq"]
    assert matched(spark, frame, [item, names], texts) == {(0, 0), (2, 1), (4, 0)}


def test_equal_windows_and_line_starts(spark, frame):
    item = "We ask how Anna can help Anna now that Anna has lost the book of Anna in town"
    texts = [item.replace("of Anna", "of Maria"), "Quiz\nWhat is the capital of France?", "Quiz\nWhat is the capital of Spain?",
             "he said what is\nthe capital of\nFrance to them"]
    assert matched(spark, frame, [item, "What is the capital of France?"], texts) == {(0, 0), (1, 1), (2, 1), (3, 1)}


def test_short_items_are_matched_whole(spark, frame):
    items = ["too short item", "Anna ate 12 plums", "What is 7?", "5 days", "Yes", "", None, "one\ntwo words"]
    texts = ["intro of many words that goes on\nTOO short item.\nand on it goes for many words", "this text is too short item of nothing at all",
             "Quiz\nAnna ate 40 plums\nend", "anna ate plums 12", "What is 8?", "so what is 7?\nwhat is 7?", "it took 5\ndays", "in 5\n5 days", "yes", "no\nyes and no",
             "one two words", "", None]
    assert matched(spark, frame, items, texts) == {(0, 0), (2, 1), (5, 2), (7, 3), (8, 4), (10, 7)}
    want = brute(list(enumerate(texts)), list(enumerate(items)))
    assert {(d_, i) for d_, own in want.items() for i in own} == {(0, 0), (2, 1), (5, 2), (7, 3), (8, 4), (10, 7)}
