"""Conversation structure repair by iterative-deepening A*.

A conversation is legal if its roles' initials read ``(s?(ua)+)?``.  The cheapest
edits that make it so are searched for: Keep (0), Rerole to user or assistant
(2), Delete (3; the only edit of blank rows and of repeats), Insert an empty
user or assistant turn (2); a truncated row that stays adds 1.  Of equally
cheap edit sequences the one whose initials are ASCII-least wins.

The search is depth-first in ASCII edit order (D, I, K, R) under cost bounds
that grow by one.  What the remaining rows cost in any case (deletions that
must be, truncated rows) is the estimate; a transposition table holds the
largest budget with which a state (row, role before it) failed.  The first
accepting path under the first bound that has one is the answer.

Scale: the search needs no texts.  Narrow rows (initial, fault, digests) are
range-partitioned by conversation and turn, so one conversation of any size
spreads over many tasks.  Tasks cut long stretches into blocks of ``BLOCK``
rows, search each block from every role state to every other, and compose the
blocks.  That is exact: an Insert belongs to the row after it, so all edit
sequences of a block end with the edit of its last row, none is the prefix of
another, and equal costs are settled by the first block in which they differ.
Only stretches at a partition's borders (two a partition at most) wait for
their neighbours; they are composed by conversation, one small row a stretch.
Identical rows collapse before the shuffle.  Texts move once, to join the edits.

Cases: null role or text is one space; null ``conv_id`` is a conversation of
its own; null turns come first.  Rows of equal turn are ordered by a digest of
role and text.  An empty role has no legal initial.  An empty table gives no
rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import map_rows, written

#: Rows that one search takes at most.
BLOCK = 16
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
FINE, TRUNCATED, FORCED = 0, 1, 2
#: Role states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn that Rerole or Insert makes.
MADE = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state after keeping a row of some initial.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: Inserts that end a conversation legally, by state.
CLOSING = ("", "II", "I", "")
#: Initials that may follow each other.
ADJACENT = {"su", "ua", "au"}
NEVER = 1 << 60
BLANK = " \t\n\x0b\x0c\r"


def search(rows: list[tuple[str, int]], start: int, goal: int | None) -> tuple[int, str] | None:
    """Cheapest, then ASCII-least edits of ``rows`` (initial, fault) from state
    ``start`` to ``goal``; without a goal, to the conversation's legal end,
    where inserts may follow the last row.  None if there is no way."""
    n = len(rows)
    if goal == SYSTEM and start != SYSTEM and not any(r == "s" and f != FORCED for r, f in rows):
        return None
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (DELETE if rows[i][1] == FORCED else CUT if rows[i][1] == TRUNCATED else 0)
    failed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def walk(i: int, state: int, budget: int) -> bool:
        if least[i] > budget or failed.get((i, state), -1) >= budget:
            return False
        if i == n and (state == goal if goal is not None else not CLOSING[state]):
            return True
        steps = []
        if i < n:
            initial, fault = rows[i]
            steps.append(("D", i + 1, state, DELETE))
        if i < n or goal is None:
            steps.append(("I", i, MADE[state], INSERT))
        if i < n and fault != FORCED:
            if (after := KEPT.get((state, initial))) is not None:
                steps.append(("K", i + 1, after, KEEP + fault * CUT))
            steps.append(("R", i + 1, MADE[state], REROLE + fault * CUT))
        for edit, j, after, cost in steps:
            path.append(edit)
            if cost <= budget and walk(j, after, budget - cost):
                return True
            path.pop()
        failed[i, state] = budget
        return False

    # Delete all, then insert what is missing, is always possible but for system.
    for bound in range(least[0], DELETE * n + 3 * INSERT + 1):
        if walk(0, start, bound):
            return bound, "".join(path)
    return None


class Stretch(NamedTuple):
    """Edits of consecutive rows for each pair of states (index 4 * before + after).

    ``rank`` orders the ends of one start by their edits.
    """
    cost: list[int]
    rank: list[int]
    audit: list[str]


def compose(rows: list[tuple[str, int]], starts: tuple[int, ...]) -> Stretch:
    """The best edits of ``rows`` from each of ``starts`` to every state."""
    known: dict[tuple, tuple[int, str] | None] = {}

    def best(block, p, q):
        key = (block, p, q)
        if key not in known:
            known[key] = search(list(block), p, q) if q != START or p == START else None
        return known[key]

    blocks = [tuple(rows[i:i + BLOCK]) for i in range(0, len(rows), BLOCK)]
    out = Stretch([NEVER] * 16, [0] * 16, [""] * 16)
    for start in starts:
        # state -> (cost, rank among states); a trail of choices per block
        live, trail = {start: (0, 0)}, []
        for block in blocks:
            step = {}
            for q in range(4):
                ways = [(c + got[0], r, got[1], p) for p, (c, r) in live.items() if (got := best(block, p, q))]
                if ways:
                    step[q] = min(ways)
            order = sorted(step, key=lambda q: step[q][1:3])
            live = {q: (step[q][0], order.index(q)) for q in step}
            trail.append({q: (w[3], w[2]) for q, w in step.items()})
        for q, (cost, rank) in live.items():
            parts, state = [], q
            for choice in reversed(trail):
                state, edits = choice[state]
                parts.append(edits)
            out.cost[4 * start + q], out.rank[4 * start + q] = cost, rank
            out.audit[4 * start + q] = "".join(reversed(parts))
    return out


def finish(stretches: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """(state before, state after) of each of a conversation's stretches, given
    as (cost, rank), for the cheapest, then ASCII-least whole."""
    rest = [[2 * len(x) for x in CLOSING]]
    for cost, _ in reversed(stretches):
        rest.append([min(cost[4 * p + q] + rest[-1][q] for q in range(4)) for p in range(4)])
    state, out = START, []
    for (cost, rank), after in zip(stretches, rest[-2::-1], strict=True):
        q = min(range(4), key=lambda q: (cost[4 * state + q] + after[q], rank[4 * state + q]))
        out.append((state, q))
        state = q
    return out


def whole(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    if len(rows) <= BLOCK:
        return search(rows, START, None)
    s = compose(rows, (START,))
    (p, q), = finish([(s.cost, s.rank)])
    return s.cost[4 * p + q] + 2 * len(CLOSING[q]), s.audit[4 * p + q] + CLOSING[q]


def made_turns(audit: str, state: int, keys: list[bytes | None]) -> Iterator[tuple[bytes | None, str | None]]:
    """(row, new role) of each turn that stays: no row for an inserted turn, no
    new role for a kept one.  ``keys`` names the rows in order."""
    row = iter(keys)
    for edit in audit:
        if edit == "I":
            state = MADE[state]
            yield None, ROLE[state]
        else:
            key = next(row)
            if edit == "R":
                state = MADE[state]
                yield key[:16], ROLE[state]
            elif edit == "K":
                state = KEPT[state, chr(key[16])]
                yield key[:16], None


SEGMENT = ("conv_id {id}, part int, seq int, border boolean, blank long, duplicate long, truncated long, illegal long, "
           "first string, last string, cost array<long>, rank array<int>, audit array<string>, rows array<binary>")


def segments(rows: DataFrame) -> DataFrame:
    """One row per conversation and partition of ``rows`` (sorted, columns
    conv_id, initial, fault, repeat, copies, row)."""
    def measure(conv, part, seq, border, found):
        seen, keys, counts, illegal, before = [], [], [0, 0, 0], 0, None
        for initial, fault, repeat, copies, row in found:
            # what counts: blank, else duplicate, else truncated; copies of a
            # row that is not blank are duplicates
            kind = 0 if fault == FORCED else 1 if repeat else 2 if fault == TRUNCATED else None
            for k in range(copies):
                now = 1 if k and kind != 0 else kind
                if now is not None:
                    counts[now] += 1
                seen.append((initial, FORCED if now in (0, 1) else fault))
                # the initial travels with the row's name; it is read for kept rows only
                keys.append(row + (initial.encode() if initial in ("s", "u", "a") else b"-") if not k else b"")
                if before is not None and before + initial not in ADJACENT:
                    illegal += 1
                before = initial
        if border:
            s = compose(seen, (START, SYSTEM, USER, ASSISTANT))
        else:
            cost, audit = whole(seen)
            s = Stretch([cost], [0], [audit])
        return (conv, part, seq, border, *counts, illegal, seen[0][0], before, s.cost, s.rank, s.audit, keys)

    ddl = SEGMENT.format(id=rows.schema["conv_id"].dataType.simpleString())
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def grouped():
            now, held = None, []
            for batch in batches:
                for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if held and conv != now:
                        yield now, held
                        held = []
                    now = conv
                    held.append(row)
            if held:
                yield now, held

        def packed(found):
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

        ready, late, seq = [], None, 0
        for conv, held in grouped():
            if late:
                ready.append(measure(late[0], part, seq, seq == 0, late[1]))
                seq += 1
            late = conv, held
            if len(ready) >= 500:
                yield packed(ready)
                ready = []
        if late:
            ready.append(measure(late[0], part, seq, True, late[1]))
        if ready:
            yield packed(ready)

    return rows.select("conv_id", "initial", "fault", "repeat", "copies", "row").mapInArrow(run, ddl)


def named_rows(convs: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and two digests: ``said`` of conversation, role
    and text, ``row`` of these and the turn."""
    def marked(c):
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    blank = F.lit(" ")
    convs = convs.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    said = F.md5(F.concat(marked("conv_id"), F.lit("\n"), F.length("role"), F.lit(":"), "role", "text").cast("binary"))
    convs = convs.withColumn("said", said)
    return convs.withColumn("row", F.unhex(F.md5(F.concat("said", marked("turn")).cast("binary"))))


class Repair(NamedTuple):
    conversations: DataFrame
    turns: DataFrame


def repair_conversations(convs: DataFrame) -> Repair:
    """``conversations``: per conv_id gaps, blank, duplicate, truncated, illegal,
    cost and audit.  ``turns``: the repaired turns (conv_id, part, place, role,
    text), in the order of (part, place)."""
    named = named_rows(convs)
    shown = F.rtrim("text", F.lit(BLANK))
    fault = F.when(shown == "", FORCED).when(F.right(shown, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    rows = (named.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "said", "row")
            .groupBy("conv_id", "turn", "initial", "fault", "said", "row").agg(F.count("*").alias("copies")))
    # The first turn of what is said more than once; a null turn comes first.
    again = (rows.groupBy("said").agg(F.count("*").alias("n"), F.count("turn").alias("turns"), F.min("turn").alias("least"))
             .filter("n > 1").select("said", F.expr("if(turns < n, null, least)").alias("at"), F.lit(True).alias("known")))
    rows = (rows.join(again, "said", "left")
            .withColumn("repeat", F.coalesce(F.col("known") & ~F.col("turn").eqNullSafe(F.col("at")), F.lit(False))))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "said"]
    cut = written(segments(rows.repartitionByRange(*order).sortWithinPartitions(*order)), "repair-segments")

    def join_up(pdf):
        pdf = pdf.sort_values("part")
        pairs = finish(list(zip(pdf["cost"], pdf["rank"], strict=True)))
        more = [a + b not in ADJACENT for a, b in zip(pdf["last"], pdf["first"][1:], strict=False)] + [False]
        closing = [""] * (len(pdf) - 1) + [CLOSING[pairs[-1][1]]]
        pdf["start"], pdf["end"] = zip(*pairs, strict=True)
        pdf["more"], pdf["closing"] = more, closing
        return pdf[["part", "seq", "start", "end", "more", "closing"]]

    # Two rows a partition at most; those of one conversation meet in one group.
    chosen = (cut.filter("border").select("conv_id", "part", "seq", "cost", "rank", "first", "last").groupBy("conv_id")
              .applyInPandas(join_up, "part int, seq int, start int, end int, more boolean, closing string"))
    pair = F.expr("if(border, 4 * start + end + 1, 1)")
    cut = (cut.join(F.broadcast(chosen), ["part", "seq"], "left")
           .select("conv_id", "part", "blank", "duplicate", "truncated", (F.col("illegal") + F.coalesce(F.col("more").cast("long"), F.lit(0))).alias("illegal"),
                   F.element_at("cost", pair).alias("cost"), F.coalesce("closing", F.lit("")).alias("closing"),
                   F.element_at("audit", pair).alias("audit"), F.coalesce("start", F.lit(START)).alias("start"), "rows"))
    cut = cut.withColumn("cost", F.col("cost") + 2 * F.length("closing")).withColumn("audit", F.concat("audit", "closing"))
    return Repair(summarise(rows, cut), repaired_turns(named, cut))


def summarise(rows: DataFrame, cut: DataFrame) -> DataFrame:
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    span = rows.groupBy("conv_id").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.countDistinct("turn").alias("n"))
    wide = F.expr("cast(hi as decimal(20)) - lo + 1 - n").cast("long")
    gaps = span.select("conv_id", F.coalesce(wide, F.lit(0)).alias("gaps"), *(F.lit(0).alias(c) for c in counts),
                       F.lit(None).cast("struct<part:int,audit:string>").alias("piece"))
    parts = cut.select("conv_id", F.lit(0).cast("long").alias("gaps"), *counts, F.struct("part", "audit").alias("piece"))
    return (parts.unionByName(gaps).groupBy("conv_id")
            .agg(F.sum("gaps").alias("gaps"), *(F.sum(c).alias(c) for c in counts), F.array_sort(F.collect_list("piece")).alias("pieces"))
            .withColumn("audit", F.array_join("pieces.audit", "")).drop("pieces"))


def repaired_turns(named: DataFrame, cut: DataFrame) -> DataFrame:
    ids = cut.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {ids}, part int, place long, row binary, new string"

    def run(found):
        for conv, part, audit, start, keys in found:
            for place, (row, new) in enumerate(made_turns(audit, start, keys)):
                yield conv, part, place, row, new

    made = map_rows(cut.select("conv_id", "part", "audit", "start", "rows"), run, ddl)
    texts = named.groupBy("row").agg(F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    own = (made.filter("row is not null").join(texts, "row")
           .select("conv_id", "part", "place", F.coalesce("new", "role").alias("role"), "text"))
    added = made.filter("row is null").select("conv_id", "part", "place", F.col("new").alias("role"), F.lit("").alias("text"))
    return own.unionByName(added)


def damage(convs: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1
    empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the
    user's.  Nulls are one space, but conv_id and turn stay null."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return (convs.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                         F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                         F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(1), F.lit(2)))
                                   .otherwise(F.array(F.lit(1)))).alias("_copy"))
            .drop("_copy"))
