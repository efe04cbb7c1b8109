"""Benchmark decontamination by template canonicalisation.

Words lose marks at their ends and case; numbers, names (capitalised words
inside a sentence) and units (unit words after a number) become typed
placeholders.  Windows of five canonical words, or of as many more as it takes
to hold three literal ones, are the templates' keys.  Windows of five plain
words are keys as well, so verbatim copies never depend on placeholders.  A
capitalised word at the start of a line is read both as a name and as the
start of a sentence.

1. The benchmark's windows are hashed; a bitmap of fixed size (``BITS``) over
   them is sent to every task.  It can only let too many windows through.
2. Each document's windows that pass the bitmap are hash-joined with the
   benchmark's.  The benchmark side is broadcast if its measured size is below
   ``BROADCAST_BYTES``; beyond, both sides are shuffled.  Results are the same.
3. Per document, item and alignment the values behind the placeholders must
   map one to one; windows with a value that maps to two are dropped.  Equal
   windows whose values differ consistently are re-parameterised copies.
   Windows of equal plain words always stay.
4. A document is contaminated by an item if it holds at least ``SHARE`` of the
   item's windows with three literal words in five, or ``RUN`` windows of any
   kind in a row (13 words).  An item without such windows is matched by the
   share of its plain windows.
5. An item of under five words is matched whole by a line, or a whole document,
   of just its words: as a template if it has three literal words, else by
   equal plain words.  Inside running text so few words are no evidence.
   Without such items no lines are looked up.

Cases: null and blank texts match nothing, as items and as documents.  An item's
repeated rows count once.  Rows
with a null doc_id are judged too; rows that repeat a doc_id are judged by
text.  Empty tables give empty results.  Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import map_rows, written

WINDOW, LITERALS = 5, 3
SHARE, RUN = 0.75, 9
BITS = 24
BROADCAST_BYTES = 32 << 20
#: Word forms kept per worker process; beyond, the memory starts anew.
MEMORY = 300_000
#: Unit words (fixed values).
UNITS = frozenset(
    "m km cm mm mile miles metre metres meter meters foot feet inch inches yard yards g kg mg gram grams pound pounds ton tons "
    "s sec second seconds min minute minutes hour hours day days week weeks month months year years l litre litres liter liters "
    "ml gallon gallons dollar dollars cent cents euro euros percent degree degrees mph kmh".split())

_NAME, _END, _NUMBER, _UNIT = 1, 2, 4, 8
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…“”‘’«»¿¡–—"
_DIGIT = re.compile("[0-9]")
_PLACE = {_NUMBER: np.uint64(0x1111111111111111), _NAME: np.uint64(0x2222222222222222), _UNIT: np.uint64(0x3333333333333333)}
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_memory: dict[str, int] = {}
_powers = [np.zeros(0, np.uint64)] * 2


def _code(word: str) -> int:
    """Hash of a word's literal form, its flags in the low four bits."""
    body = word.strip(_MARKS)
    flags = _END * (word.rstrip("\"')”»’")[-1:] in (".", "!", "?", ":")) | _NUMBER * bool(_DIGIT.search(body))
    if not flags & _NUMBER and len(body) > 1 and body[0].isupper() and body[1:].islower():
        flags |= _NAME
    low = body.lower()
    return xxhash.xxh64_intdigest(low) & ~15 | flags | _UNIT * (low in UNITS)


def canonical(text: str | None) -> tuple[list[str], np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(words, literal codes, readings, line bounds) of a text.  A reading is
    (codes, kind of placeholder or 0).  The first takes line breaks as spaces,
    the second, if it differs, as sentence ends."""
    lines = [line.split() for line in (text or "").split("\n")]
    words = [w for line in lines for w in line]
    if len(_memory) > MEMORY:
        _memory.clear()
    for w in set(words):
        if w not in _memory:
            _memory[w] = _code(w)
    raw = np.fromiter(map(_memory.__getitem__, words), np.uint64, len(words))
    flags = (raw & np.uint64(15)).astype(np.int64)
    begins = np.append(True, flags[:-1] & _END > 0)[:len(words)]
    after_number = np.append(False, flags[:-1] & _NUMBER > 0)[:len(words)]
    kind = np.where(flags & _NUMBER, _NUMBER, np.where((flags & _UNIT > 0) & after_number, _UNIT, np.where((flags & _NAME > 0) & ~begins, _NAME, 0)))
    plain = raw & ~np.uint64(15)
    bounds = np.cumsum([0] + [len(line) for line in lines])
    broken = kind.copy()
    broken[(starts := bounds[bounds < len(words)])[kind[starts] == _NAME]] = 0
    kinds = [kind] if np.array_equal(kind, broken) else [kind, broken]
    return words, plain, [(_placed(plain, k), k) for k in kinds], bounds


def _placed(plain: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Codes with placeholders for the words of a kind."""
    codes = plain.copy()
    for place, code in _PLACE.items():
        codes[kind == place] = code
    return codes


def _whole_lines(plain: np.ndarray, kind: np.ndarray, at: np.ndarray, end: np.ndarray):
    """(start, hash, kind or None) of short lines [at, end) as a whole."""
    if len(at):
        kind = kind.copy()
        kind[at[kind[at] != _NUMBER]] = 0  # a line's first word begins a sentence and follows no number
        literal = np.append(0, np.cumsum(kind == 0))
        literal = literal[end] - literal[at]
        template = (literal >= LITERALS) & (literal < end - at)
        yield at[template], end[template], _hashes(_placed(plain, kind), at[template], end[template]), kind
        yield at, end, _hashes(plain, at, end), None


def _hashes(codes: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the codes in [at, end), from sums of prefixes."""
    n = len(codes)
    if len(_powers[0]) < n:
        _powers[:] = [np.cumprod(np.full(2 * n, x)) for x in (_STEP, _BACK)]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * _powers[0][:n], out=sums[1:])
    h = (sums[end] - sums[at]) * _powers[1][at]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(29)


def windows(codes: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of the template windows: five words, or as many more
    as it takes to hold enough literal ones."""
    n = max(0, len(codes) - WINDOW + 1)
    literal = np.flatnonzero(kind == 0)
    last = np.searchsorted(literal, np.arange(n)) + LITERALS - 1
    at = np.flatnonzero(last < len(literal))
    end = np.maximum(at + WINDOW, literal[last[at]] + 1)
    return at, end, _hashes(codes, at, end)


def _slots(words, kind, at: int, n: int = WINDOW) -> list[str]:
    """Values behind the placeholders of a window, with their place and type."""
    return [f"{i}:{kind[at + i]}:{words[at + i].strip(_MARKS).lower()}" for i in range(n) if kind[at + i]]


def _window_rows(rows, passed=None, whole=True):
    """(*key, start, hash, slots, start counts into the share, whole line) of
    all windows and, if asked for, of short lines as a whole."""
    for *key, text in rows:
        words, plain, readings, bounds = canonical(text)
        lines = {(0, len(words))} if whole else set()
        lines |= set(zip(bounds.tolist(), bounds[1:].tolist(), strict=False)) if whole and passed is not None else set()
        short = np.array(sorted((i, j) for i, j in lines if 0 < j - i < WINDOW), np.int64).reshape(-1, 2)
        for at, end, h, kind in _whole_lines(plain, readings[-1][1], short[:, 0], short[:, 1]):
            if passed is not None and len(at):
                keep = passed(h)
                at, end, h = at[keep], end[keep], h[keep]
            for i, j, x in zip(at.tolist(), end.tolist(), h.view(np.int64).tolist(), strict=True):
                yield *key, i, x, [] if kind is None else _slots(words, kind, i, j - i), True, True
        n = max(0, len(words) - WINDOW + 1)
        found, enough = [], np.zeros(n, bool)
        for r, (codes, kind) in enumerate(readings):
            at, end, h = windows(codes, kind)
            if r:  # only windows that differ from the first reading's
                other = np.append(0, np.cumsum(kind != readings[0][1]))
                new = other[end] > other[at]
                at, h = at[new], h[new]
            else:
                enough[at[end == at + WINDOW]] = True
            found.append((at, h, kind))
        if passed is None and not enough.any():  # too few literal words: equal values only
            found, enough = [], np.ones(n, bool)
        places = np.append(0, np.cumsum(readings[0][1] > 0))
        at = np.flatnonzero(places[WINDOW:] > places[:-WINDOW]) if found else np.arange(n)
        found.append((at, _hashes(plain, at, at + WINDOW), None))
        for at, h, kind in found:
            if passed is not None and len(at):
                keep = passed(h)
                at, h = at[keep], h[keep]
            for i, x in zip(at.tolist(), h.view(np.int64).tolist(), strict=True):
                yield *key, i, x, [] if kind is None else _slots(words, kind, i), bool(enough[i]), False


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_at, key, item_slots, counts, whole, n_windows) of all items."""
    rows = map_rows(benchmark.select("item_id", "text").dropDuplicates(), _window_rows,
                    "item_id long, item_at int, key long, item_slots array<string>, counts boolean, whole boolean")
    rows = written(rows.dropDuplicates(["item_id", "item_at", "key"]), "item-windows")
    size = rows.groupBy("item_id").agg(F.count_distinct(F.when(F.col("counts"), F.col("item_at"))).alias("n_windows"))
    return rows.join(size, "item_id")


def bitmap(items: DataFrame) -> np.ndarray:
    """Bits of the windows' hashes: ``2 ** BITS``, whatever the benchmark's size."""
    bit = F.shiftrightunsigned("key", 64 - BITS)
    words = items.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - BITS}) & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _consistent(hits) -> set[int]:
    """Places of the windows whose values all map one to one."""
    forth, back = {}, {}
    for _, _, pairs in hits:
        for i, d in pairs:
            forth.setdefault(i, set()).add(d)
            back.setdefault(d, set()).add(i)
    return {at for at, _, pairs in hits if all(len(forth[i]) == 1 == len(back[d]) for i, d in pairs)}


def _aligned(rows):
    """Judges one alignment: consistent windows and their longest run."""
    for *key, n, found in rows:
        hits = [(h["item_at"], h["counts"], [(i.split(":", 1)[1], d.split(":", 1)[1]) for i, d in zip(h["item_slots"], h["slots"], strict=True)])
                for h in found]
        # windows beyond five words are judged by all, but take none away
        good = sorted(_consistent([h for h in hits if h[1]]) | _consistent(hits))
        if good:
            run = best = 1
            for a, b in zip(good, good[1:], strict=False):
                run = run + 1 if b == a + 1 else 1
                best = max(best, run)
            counted = {at for at, counts, _ in hits if counts}
            yield *key, n, [at for at in good if at in counted], best, any(i != d for _, _, pairs in hits for i, d in pairs)


def contaminated(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text_hash, item_id, share, run, reparameterised): one row per
    contaminated document and item."""
    items = written(benchmark_windows(benchmark), "items")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(items))
    size, whole = items.agg(F.sum(F.lit(64) + F.octet_length(F.array_join("item_slots", ","))), F.max("whole")).first()

    def passed(h):
        return (bits.value[(h >> np.uint64(64 - BITS + 6)).astype(np.int64)] >> ((h >> np.uint64(64 - BITS)) & np.uint64(63)) & np.uint64(1)) > 0

    own = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    found = map_rows(own, lambda rows: (r[:-2] for r in _window_rows(rows, passed, bool(whole))), "doc_id long, text_hash long, at int, key long, slots array<string>")
    hits = found.join(F.broadcast(items) if (size or 0) <= broadcast_bytes else items.hint("merge"), "key")
    hits = hits.where("transform(slots, s -> substring_index(s, ':', 2)) = transform(item_slots, s -> substring_index(s, ':', 2))")
    group = ("doc_id", "text_hash", "item_id")
    lines = (hits.withColumn("shift", F.col("at") - F.col("item_at")).groupBy(*group, "shift", "n_windows")
             .agg(F.collect_set(F.struct("item_at", "counts", "item_slots", "slots")).alias("hits")))
    judged = map_rows(lines.select(*group, "n_windows", "hits"), _aligned,
                      "doc_id long, text_hash long, item_id long, n_windows long, good array<int>, run int, changed boolean")
    by_item = judged.groupBy(*group).agg((F.size(F.array_distinct(F.flatten(F.collect_list("good")))) / F.first("n_windows")).alias("share"),
                                         F.max("run").alias("run"), F.max("changed").alias("reparameterised"))
    return by_item.where((F.col("share") >= SHARE) | (F.col("run") >= RUN))


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document: its items, sorted, and the best match."""
    return (contaminated(docs, benchmark).groupBy("doc_id")
            .agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("share").alias("best_share"),
                 F.max("run").cast("long").alias("longest_run"), F.max("reparameterised").alias("reparameterised"))
            .withColumn("n_items", F.size("items").cast("long")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, as they are."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad_id"]) & (F.xxhash64(docs["text"]) == bad["_bad_hash"]), "left_anti")
