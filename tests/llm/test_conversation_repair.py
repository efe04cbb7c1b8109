"""Conversation repair against a plain dynamic programme and a row-by-row model."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from postlake.llm import conversation_repair as cr
from postlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def reference(rows):
    """Cheapest, then least edits by a table over (row, state)."""
    best = {cr.START: (0, "")}

    def better(table, state, cost, audit):
        if state not in table or (cost, audit) < table[state]:
            table[state] = (cost, audit)

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit) in list(table.items()):
                better(table, cr.MADE[state], cost + 2, audit + "I")
        return table

    for initial, fault in rows:
        now = {}
        for state, (cost, audit) in inserted(dict(best)).items():
            better(now, state, cost + 3, audit + "D")
            if fault != cr.FORCED:
                cut = 1 if fault else 0
                if (state, initial) in cr.KEPT:
                    better(now, cr.KEPT[state, initial], cost + cut, audit + "K")
                better(now, cr.MADE[state], cost + 2 + cut, audit + "R")
        best = now
    ends = inserted(dict(best))
    return min(ends[s] for s in (cr.START, cr.ASSISTANT) if s in ends)


@pytest.mark.parametrize("block", [1, 3, 16])
def test_search_equals_dynamic_programme(monkeypatch, block):
    monkeypatch.setattr(cr, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        rows = [(rng.choice("suax"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(0, 22))]
        assert cr.whole(rows) == reference(rows), rows


def test_stretches_join_up_to_the_whole():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(rng.choice("suua-"), rng.choice([0, 0, 1, 2])) for _ in range(rng.randrange(2, 60))]
        cuts = sorted({0, len(rows), *(rng.randrange(len(rows)) for _ in range(3))})
        parts = [cr.compose(rows[a:b], (0, 1, 2, 3)) for a, b in zip(cuts, cuts[1:], strict=False)]
        pairs = cr.finish([(s.cost, s.rank) for s in parts])
        audit = "".join(s.audit[4 * p + q] for s, (p, q) in zip(parts, pairs, strict=True)) + cr.CLOSING[pairs[-1][1]]
        cost = sum(s.cost[4 * p + q] for s, (p, q) in zip(parts, pairs, strict=True)) + 2 * len(cr.CLOSING[pairs[-1][1]])
        assert (cost, audit) == reference(rows)


def model(convs):
    """The contract, row by row (turns of one conversation are distinct or equal rows)."""
    damaged = {}
    for conv, turn, role, text in convs:
        damaged.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in damaged.items():
        said = {id(r): hashlib.md5(f"{'' if conv is None else '='+str(conv)}\n{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest() for r in rows}
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, said[id(r)]))
        faults, seen = [], set()
        for _, role, text in rows:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("b" if not shown else "d" if (role, text) in seen else "" if shown[-1] in ".!?" else "t")
            seen.add((role, text))
        coded = [(r[1][:1], {"b": 2, "d": 2, "t": 1, "": 0}[f]) for r, f in zip(rows, faults, strict=True)]
        cost, audit = reference(coded)
        lines, state, todo = [], cr.START, iter(rows)
        for edit in audit:
            row = None if edit == "I" else next(todo)
            if edit == "K":
                state = cr.KEPT[state, row[1][:1]]
                lines.append(f"{row[1]}:{row[2]}")
            elif edit != "D":
                state = cr.MADE[state]
                lines.append(f"{cr.ROLE[state]}:{row[2] if row else ''}")
        turns = [r[0] for r in rows if r[0] is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(a[1][:1] + b[1][:1] not in cr.ADJACENT for a, b in zip(rows, rows[1:], strict=False)), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def awkward():
    rng = random.Random(11)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(0, 9)):
            rows.append((conv, turn * rng.choice([1, 1, 2]) if turn else None if conv and conv % 5 == 0 else 0,
                         rng.choice(["user", "assistant", "system", "tool", "", None]),
                         rng.choice(["Yes.", "No", "Why?\n ", "", None, "  ", "A. b", "Ü!"])))
    # turns of one conversation: distinct, but for repeated rows
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    rows += [(90, 3, "user", "twice.")] * 3 + [(91, None, None, None)] * 2
    roles = ("user", "assistant", "user", "system")
    rows += [(77, t, rng.choice(roles), f"turn {t}{rng.choice(['.', '', '!'])}") for t in range(300)]
    return rows


def result(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("clash")).withColumn("row", F.lit(1)).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got}


@pytest.mark.parametrize("partitions", [1, 13])
def test_query_equals_the_contract(spark, tmp_path, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = awkward()
        got, want = result(spark, rows, tmp_path), model(rows)
        assert {k: v for k, v in got.items() if v != want.get(k)} == {}
        assert got.keys() == want.keys()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table_and_long_text(spark, tmp_path):
    assert result(spark, [], tmp_path / "none") == {}
    rows = [(1, 0, "user", "x" * 2_000_000 + "?"), (1, 1, "assistant", None)]
    assert result(spark, rows, tmp_path / "long") == model(rows)
