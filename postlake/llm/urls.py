"""URL filter: rules first, then host word segmentation and naive Bayes.

1. Host and path come from the url by expressions.  A rule (verdict, host,
   path) fits its host and all subdomains if the path starts with the rule's;
   the longest fitting rule decides.
2. The words in the text of all pages are counted exactly.  Substrings of the
   distinct host labels are joined with these counts, so each label travels
   with its own words, and unigram Viterbi splits it.  A word in a label has at
   most ``MAX_LABEL`` letters, the length of a label in the domain name system;
   unseen words have any length.
3. The pages that a rule decides are the labelled rows of a multinomial naive
   Bayes model over segmented host words and path words, counted exactly.
4. Pages without a rule get the verdict of the log odds (block above 0).

The work is in joins of written tables.  Keys with over 1/``HOT`` of the rows
(a host, label or token of many pages) are fewer than ``HOT``, so these few are
broadcast and no join meets a hot key.  Words of up to three letters, which
stand in most labels, are at most 26 + 26^2 + 26^3 and travel with the task.
No count depends on the corpus's size otherwise: no sketch, buckets or cuts.

Cases: a null url or one without ``://`` has empty host and path; then no rule
fits and the class priors decide.  Without labelled rows all log odds are 0:
allow.  Every row gives one row; repeated rows and null ids too.  Other columns
are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import ascii_lower, map_rows, slices, written

#: (verdict, host, path); fixed values.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MAX_LABEL = 63
SHORT = 3
HOT = 1_000
#: Words a task counts before it passes its counts on.
HELD = 1 << 18
#: Cost of an unseen word's letter.
LETTER = 2.5

_TAGS = re.compile(r"<(?:script|style)[^>]*>.*?</(?:script|style)>|<[^>]*>", re.S | re.I)
_WORDS = re.compile(r"[a-z]+")
#: Parts of a host between separators: numbers and the labels beside them.
_PARTS = r"[0-9]+|[^0-9.\-_:@]+"
_TOKENS = r"[\p{L}\p{M}\p{N}]+"


def with_host_path(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.select("page_id", ascii_lower(F.coalesce(F.regexp_extract("url", pattern, 1), F.lit(""))).alias("host"),
                        F.coalesce(F.regexp_extract("url", pattern, 2), F.lit("")).alias("path"))


def with_rule(hosts: DataFrame, rules=RULES) -> DataFrame:
    """Adds the longest fitting rule (host and path joined) and its verdict."""
    rule = verdict = F.lit(None).cast("string")
    for says, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return hosts.withColumns({"rule": rule, "rule_verdict": verdict})


def page_words(html: str | None) -> list[str]:
    return _WORDS.findall(_TAGS.sub(" ", html or "").lower())


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) of all words in the text of all pages."""
    def rows(total):
        return pa.record_batch({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for html in part.column(0).to_pylist():
                    total.update(page_words(html))
            if len(total) > HELD:
                yield rows(total)
                total = Counter()
        yield rows(total)

    return pages.select("html").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Segmenter:
    """Unigram Viterbi; ``counts`` hold the short words, ``split`` gets the others."""

    def __init__(self, counts: dict[str, int], total: int):
        self.counts, self.total = counts, total
        self.unseen = -math.log(total + 1)

    def log_probability(self, word: str, more: dict[str, int]) -> float:
        """An unseen word costs more than any seen one, and more with its length."""
        n = more.get(word) or self.counts.get(word)
        return math.log(n / self.total) if n else self.unseen - LETTER * len(word)

    def split(self, label: str, more: dict[str, int]) -> list[str]:
        best, back, longest = [0.0], [0], max([SHORT, *map(len, more)])
        start, at = 0.0, 0      # where an unseen word best begins
        for j in range(1, len(label) + 1):
            if best[-1] + LETTER * (j - 1) > start:
                start, at = best[-1] + LETTER * (j - 1), j - 1
            options = [(start - LETTER * j + self.unseen, at)]
            for i in range(max(0, j - longest), j):
                if n := more.get(label[i:j]) or self.counts.get(label[i:j]):
                    options.append((best[i] + math.log(n / self.total), i))
            score, i = max(options)
            best.append(score)
            back.append(i)
        out, j = [], len(label)
        while j:
            out.append(label[back[j]:j])
            j = back[j]
        return out[::-1]


def by_frequency(rows: DataFrame, lookup: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``lookup`` (unique ``key``, its count ``n``
    among ``total`` rows): the few hot keys by broadcast, the others by shuffle."""
    hot, rest = lookup.where(F.col("n") * HOT > total).drop("n"), lookup.where(F.col("n") * HOT <= total).drop("n")
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(others.join(rest, key))


def segments(labels: DataFrame, words: DataFrame) -> DataFrame:
    """Adds ``words``, the label's segmentation, to the rows (label, n)."""
    total = words.agg(F.sum("n")).first()[0] or 0
    short = words.where(F.length("word") <= SHORT).toArrow()
    segmenter = Segmenter(dict(zip(short["word"].to_pylist(), short["n"].to_pylist(), strict=True)), total)
    cut = labels.where(F.length("label") > SHORT).select("label", F.explode(F.expr(f"sequence(1, length(label) - {SHORT})")).alias("i"))
    cut = cut.select("label", "i", F.explode(F.expr(f"sequence({SHORT + 1}, least({MAX_LABEL}, length(label) - i + 1))")).alias("k"))
    cut = cut.select("label", F.expr("substring(label, i, k)").alias("word")).where("word rlike '^[a-z]+$'")
    known = cut.join(words, "word").groupBy("label").agg(F.collect_set(F.struct("word", "n")).alias("known"))

    def split(rows):
        for label, n, known in rows:
            more = {w["word"]: w["n"] for w in known or ()}
            yield label, n, [f"#{len(label)}"] if label[0] in "0123456789" else segmenter.split(label, more)

    return map_rows(labels.join(known, "label", "left").select("label", "n", "known"), split, "label string, n long, words array<string>")


def host_words(hosts: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds ``words``, the segmented parts of the host in order, to (host, n)."""
    parts = written(hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit(_PARTS), F.lit(0))).alias("at", "label")), "url-parts")
    labels = written(parts.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "url-labels")
    split = written(segments(labels, written(word_counts(pages), "url-words")), "url-segments")
    joined = by_frequency(parts, split, "label", parts.count())
    lists = joined.groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words"))
    return hosts.join(lists, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))


def with_log_odds(rows: DataFrame) -> DataFrame:
    """Adds ``log_odds`` to the rows without ``rule_verdict``, by multinomial
    naive Bayes over ``tokens``, fitted on those with one.  ``row`` is unique."""
    block, allow = (F.sum((F.col("rule_verdict") == c).cast("long")) for c in ("block", "allow"))
    prior = rows.agg(block, allow).first()
    tokens = rows.select("row", "rule_verdict", F.explode("tokens").alias("token"))
    model = written(tokens.groupBy("token").agg(F.coalesce(block, F.lit(0)).alias("b"), F.coalesce(allow, F.lit(0)).alias("a"),
                                                F.count(F.lit(1)).alias("n")), "url-tokens")
    size = model.agg(F.sum("b"), F.sum("a"), F.sum((F.col("a") + F.col("b") > 0).cast("long")), F.sum("n")).first()
    b, a, types, total = (int(x or 0) for x in size)
    # odds of a token that no labelled row has; the others by what they add to that
    unseen = math.log(max(1, a + types) / max(1, b + types))
    seen = model.where("a + b > 0").select("token", "n", F.log((F.col("b") + 1) / (F.col("a") + 1)).alias("odds"))
    adds = by_frequency(tokens.where("rule_verdict is null").select("row", "token"), seen, "token", total).groupBy("row").agg(F.sum("odds").alias("adds"))
    start = math.log(((prior[0] or 0) + 1) / ((prior[1] or 0) + 1))
    odds = F.round(F.lit(start) + F.size("tokens") * F.lit(unseen) + F.coalesce("adds", F.lit(0.0)), 9)
    scored = rows.where("rule_verdict is null").join(adds, "row", "left").withColumn("log_odds", odds).drop("adds")
    return scored.unionByName(rows.where("rule_verdict is not null").withColumn("log_odds", F.lit(None).cast("double")))


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, log_odds (null where a rule decides)
    and the tokens that were scored: ``h:`` words of the host and ``p:`` words
    of the path, numbers by length."""
    ruled = with_rule(with_host_path(pages), rules)
    hosts = written(host_words(written(ruled.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "url-hosts"), pages), "url-host-words")
    total = hosts.agg(F.sum("n")).first()[0] or 0
    path = F.transform(F.regexp_extract_all("path", F.lit(_TOKENS), F.lit(0)), lambda t: F.concat(
        F.lit("p:"), F.when(t.rlike("^[0-9]+$"), F.concat(F.lit("#"), F.length(t))).otherwise(F.lower(t))))
    rows = by_frequency(ruled, hosts, "host", total).select(
        F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", "rule", "rule_verdict",
        F.concat(F.transform("words", lambda w: F.concat(F.lit("h:"), w)), path).alias("tokens"))
    judged = with_log_odds(written(rows, "url-rows"))
    verdict = F.coalesce("rule_verdict", F.when(F.col("log_odds") > 0, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "log_odds", "tokens")
