"""Quality rules: line-first cleaning.

Every line is judged on its own by three rules: punctuation (a line made of
marks: too many ``#*$%&|<>`` or repeated exclamation marks for its words),
navigation (a menu: short entries between ``|`` or ``>`` bars) and boilerplate
(a longer line that the document has already had,
or one that stutters: half of its words repeat the word before).  Failing lines
are removed: ``clean`` and ``clean_documents`` return what is left.
A document that loses more than ``MAX_LOST`` of its word characters is
rejected.  The base statistics and their verdict hold besides: fewer than ten
words, or more than a fifth of the words in repeated 5-word windows.

Cases: a null or empty text has no words and fails the base.  Every input row
gives one row, repeated rows and null ids too; other columns are not read.
Texts of any length are judged whole, in memory in proportion to the text.
"""

from __future__ import annotations

import re
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import map_rows

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Texts of more words count their windows in arrays, with the same result.
LONG = 200_000
#: Marks per word from which a line fails the punctuation rule.
MAX_MARKS = 0.6
#: Entries of a menu line at least, and bars per word from which it fails.
MIN_ENTRIES, MAX_BARS = 4, 0.5
#: Lines of so many words are boilerplate if had before or stuttering.
BOILERPLATE_WORDS = 6
MAX_LOST = 0.5

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_MARKS = re.compile(rb"[#*$%&<>]+|!!+")
#: ``>`` between entries: no tag's end, quote mark, arrow or comparison.
_TAGS, _ARROWS = re.compile(rb"</?[A-Za-z][^<>]*>"), re.compile(rb"(?<![<>=\s-])\s*>(?=\s*[^\s<>=])")
_COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, kept boolean, n_lines_removed long, lost_share double")


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that the text has twice or more."""
    n = len(words)
    if n <= size:
        return 0
    if n > LONG:
        again = _repeats_in_arrays(words, size)
    else:
        windows = Counter(zip(*(words[k:] for k in range(size)), strict=False))
        if len(windows) == n - size + 1:
            return 0
        again = [i for i, w in enumerate(zip(*(words[k:] for k in range(size)), strict=False)) if windows[w] > 1]
    covered = end = 0
    for i in again:
        covered += i + size - max(i, end)
        end = i + size
    return covered


def _repeats_in_arrays(words: list[bytes], size: int) -> list[int]:
    """Starts of windows found twice or more; for long texts, where arrays
    take a tenth of the memory of word tuples."""
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    win = a
    for k in range(1, size):  # exact window numbers, one more word each time
        _, win = np.unique(win[: len(a) - k] * len(ids) + a[k:], return_inverse=True)
    return np.flatnonzero(np.bincount(win)[win] > 1).tolist()


def failed_rule(line: bytes, words: list[bytes], seen_before: bool) -> str | None:
    """The rule that a line with these words fails, if any."""
    n = len(words)
    if n == 0:
        return None
    bars = line.count(b"|")
    if b">" in line:
        bars += len(_ARROWS.findall(_TAGS.sub(b" ", line)))
    if bars + 1 >= MIN_ENTRIES and bars >= MAX_BARS * (n - bars):
        return "navigation"
    if len(_MARKS.findall(line)) >= MAX_MARKS * n and n >= 3:
        return "punctuation"
    if n >= BOILERPLATE_WORDS and (seen_before or 2 * sum(map(eq, words, words[1:])) >= n):
        return "boilerplate"
    return None


def judge(text: str | None) -> tuple:
    """The statistics and verdict of one text (see ``_COLUMNS``)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    n_repeat = repeated_words(words)
    seen: set[bytes] = set()
    n_dup = removed = lost = total = 0
    for line in data.split(b"\n"):
        own = line.split()
        if not own:
            continue
        size = sum(map(len, own))
        before = line in seen
        seen.add(line)
        n_dup += before
        total += size
        if failed_rule(line, own, before):
            removed, lost = removed + 1, lost + size
    failed = len(words) < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * len(words)
    share = lost / total if total else 0.0
    return (len(words), chars, len(_SYMBOLS.findall(data)), n_dup, n_repeat, failed,
            not failed and share <= MAX_LOST, removed, share)


def clean(text: str | None) -> str | None:
    """The text without its failing lines; all else stays as it is."""
    if text is None:
        return None
    seen: set[bytes] = set()
    out = []
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        if not failed_rule(line, line.split(), line in seen):
            out.append(line)
        seen.add(line)
    return b"\n".join(out).decode("utf-8", "surrogatepass")


def clean_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with the cleaned text."""
    return docs.withColumn("text", F.udf(clean, "string", useArrow=True)("text"))


def judge_documents(docs: DataFrame) -> DataFrame:
    """doc_id with the statistics, ``base_failed``, ``kept`` and line figures."""
    return map_rows(docs.select("doc_id", "text"), lambda rows: ((d, *judge(t)) for d, t in rows),
                    f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_COLUMNS}")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, as they are."""
    good = F.udf(lambda text: judge(text)[6], "boolean", useArrow=True)
    return docs.where(good("text"))
