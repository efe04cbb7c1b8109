"""Spelling variant grouping by a relational trie frontier.

Two words are near if one inserted, deleted or replaced code point makes one
into the other.  A word's form is its near word of largest count, if that count
is ``RATIO`` times its own or more; the root follows forms to the last.

Near words are found in a trie held as an edge table (node, next letter), node
by node: the frontier's states (word, position, node, edits) are joined with
the edges of one depth at a time.  A state without an edit takes every edge (an
exact step, a replaced or an inserted letter), one with an edit only the edge
of the word's next letter.  States with one edit that end in a word with their
own word used up are near pairs.

One edit leaves one half of a word as it is.  So each word starts below the
trie node of its exact first half, in a second trie of reversed words below
its last half, where few words are left; each depth's edges are read once.  A
repeated letter can be inserted or deleted at several places; only the last
counts, so each pair has one path.  An edge knows the lengths and next
letters of the words below it, which prunes states that cannot go on.  Every frontier is written to
the shared folder, which cuts the lineage.

A step a letter would not do for endless words.  Pairs whose longer word has
more than ``TRIE_LETTERS`` code points are found by hashes of the word without
each one of its letters (computed in linear time), joined and then compared;
the result is the same.

Cases: null text has no words, a null ``doc_id`` counts as an empty one.  Words
without near words have n_near 0.  Equal counts: the smallest word is the form.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import ascii_lower, written
from postlake.session import shared_dir

LETTERS = "A-Za-zÀ-ÿ"
MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
#: Depth of the trie, at most 62 (lengths below an edge are bits of a long).
TRIE_LETTERS = 32
#: Words with one letter in so many are damaged (``typos``).
TYPO_EVERY = 31


def runs(docs: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(doc_id, run): the maximal lower-cased letter runs of every text that are
    long enough (``typos`` never lengthens one)."""
    found = F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(f"[{LETTERS}]{{{min_letters},}}+"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def typos(found: DataFrame) -> DataFrame:
    """The runs as words; where ``TYPO_EVERY`` divides the crc32 of doc_id:run,
    the letter at crc32 modulo length is left out."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    return (found.withColumn("h", h)
            .select(F.when(F.col("h") % TYPO_EVERY != 0, F.col("run"))
                    .otherwise(F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))).alias("word")))


def count_words(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words long and frequent enough."""
    return (words.filter(F.char_length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_count))


def _head(col: str, letters) -> F.Column:
    return F.col(col).substr(F.lit(1), letters)


def _letter(col: str, at) -> F.Column:
    """The letter behind ``at`` letters; empty at the end."""
    return F.col(col).substr(at + 1, F.lit(1))


def _bit(at) -> F.Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def _letter_bit(letter) -> F.Column:
    """One of 64 bits for a letter (none for the empty one: bit 0)."""
    return _bit((F.ascii(letter) % 64).cast("int"))


def trie_pairs(words: DataFrame, min_letters: int, trie_letters: int) -> DataFrame:
    """(word, near, near_n) of near words of up to ``trie_letters`` letters and
    at least ``min_letters`` (4 or more).

    Words and nodes start with a mark of their trie: > forward, < reversed.
    """
    spark = words.sparkSession
    size = F.char_length("word")
    both = words.filter(size <= trie_letters).select(
        "n", F.explode(F.array(F.concat(F.lit(">"), "word"), F.concat(F.lit("<"), F.reverse("word")))).alias("word"))
    letters = size - 1
    # The half that stays: it and the other trie's make up the whole word.
    both = both.withColumn("half", F.when(F.col("word").startswith(">"), F.floor(letters / 2)).otherwise(F.ceil(letters / 2)).cast("int"))
    base = f"{shared_dir(spark)}/llm-trie-{uuid.uuid4().hex}"
    first = min_letters // 2
    edges = (both.withColumn("depth", F.explode(F.sequence(F.lit(first), letters - 1)))
             .groupBy("depth", _head("word", F.col("depth") + 1).alias("node"), _letter("word", F.col("depth") + 1).alias("letter"))
             .agg(F.bit_or(_bit(letters - 1 - F.col("depth"))).alias("below"), F.bit_or(_letter_bit(_letter("word", F.col("depth") + 2))).alias("then"),
                  F.max(F.when(letters - 1 == F.col("depth"), F.col("n"))).alias("ends")))
    edges.write.partitionBy("depth").parquet(f"{base}/edges")
    starts = both.select("word", F.col("half").alias("pos"), _head("word", F.col("half") + 1).alias("node"), F.lit(0).alias("edits"),
                         F.lit(None).cast("long").alias("ends"), "half")
    starts.write.partitionBy("half").parquet(f"{base}/starts")
    state, edge = "word string, pos int, node string, edits int, ends long", "node string, letter string, below long, then long, ends long"
    # At most TRIE_LETTERS numbers each.
    held = {kind: {r[0] for r in spark.read.schema(f"{c} int").parquet(f"{base}/{kind}").select(c).distinct().collect()}
            for kind, c in (("edges", "depth"), ("starts", "half"))}

    def part(kind, column, value, schema):
        if value in held[kind]:
            return spark.read.schema(schema).parquet(f"{base}/{kind}/{column}={value}")
        return spark.createDataFrame([], schema)

    length = F.char_length("word") - 1
    ahead = _letter("word", F.col("pos") + 1)
    frontier, levels = spark.createDataFrame([], state), []
    for depth in range(first, max(held["edges"], default=-1) + 1):
        here = frontier.unionByName(part("starts", "half", depth, state))
        # A letter less: the last of its kind in a row, no step in the trie.
        fewer = (here.filter((F.col("edits") == 0) & (F.col("pos") < length) & (ahead != _letter("word", F.col("pos") + 2)))
                 .withColumn("pos", F.col("pos") + 1).withColumn("edits", F.lit(1)))
        open_ = here.unionByName(fewer).filter((F.col("edits") == 0) | (F.col("pos") < length)).withColumn("next", ahead)
        step = (open_.join(part("edges", "depth", depth, edge).withColumnRenamed("ends", "child_ends"), "node")
                .filter("edits = 0 or letter = next"))
        ways = F.when(F.col("letter") == F.col("next"), F.array(F.struct((F.col("pos") + 1).alias("pos"), F.col("edits"))))
        ways = ways.when(F.col("pos") < length, F.array(F.struct((F.col("pos") + 1).alias("pos"), F.lit(1).alias("edits")),
                                                        F.struct(F.col("pos"), F.lit(1).alias("edits"))))
        ways = ways.otherwise(F.array(F.struct(F.col("pos"), F.lit(1).alias("edits"))))
        # Words below the edge must be as long as the state asks for, and go on with its next letter.
        ways = F.filter(ways, lambda w: (w["edits"] == 0) | ((F.col("below").bitwiseAND(_bit(length - w["pos"])) != 0) & (
            (w["pos"] == length) | (F.col("then").bitwiseAND(_letter_bit(_letter("word", w["pos"] + 1))) != 0))))
        made = (step.select("word", F.concat("node", "letter").alias("node"), F.col("child_ends").alias("ends"), F.explode(ways).alias("way"))
                .select("word", "way.pos", "node", "way.edits", "ends"))
        path = f"{base}/level-{depth + 1}"
        made.write.parquet(path)
        frontier = spark.read.schema(state).parquet(path)
        levels.append(path)
    if not levels:
        return spark.createDataFrame([], "word string, near string, near_n long")
    reached = spark.read.schema(state).parquet(*levels).filter("ends is not null")
    # At a word's last letter but one without an edit, that letter may go, too.
    ended = reached.filter(((F.col("edits") == 1) & (F.col("pos") == length)) | ((F.col("edits") == 0) & (F.col("pos") == length - 1)))
    forward = F.col("node").startswith(">")
    half = F.floor(length / 2).cast("int")

    def plain(c):
        body = F.col(c).substr(F.lit(2), F.char_length(c))
        return F.when(forward, body).otherwise(F.reverse(body))
    # What the forward trie finds (equal first halves), the other need not.
    return (ended.select(plain("word").alias("word"), plain("node").alias("near"), F.col("ends").alias("near_n"), forward.alias("forward"), half.alias("half"))
            .filter(F.col("forward") | (_head("word", F.col("half")) != _head("near", F.col("half"))))
            .select("word", "near", "near_n"))


#: Kinds of keys besides a blanked letter's place.
WHOLE, LESS = -1, -2
_PRIMES = (2_147_483_629, 2_147_483_587)
_BASES = (1_000_003, 998_244_353)


def letter_keys(word: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Hashes of the whole word, of the word without each letter, and of the
    word with each letter blanked; polynomial hashes, in linear time."""
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(codes)
    full, less, blank = 0, np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for p, b in zip(_PRIMES, _BASES, strict=True):
        power = np.ones(n, np.uint64)
        have = 1
        while have < n:  # powers by doubling
            k = min(have, n - have)
            power[have:have + k] = power[:k] * pow(b, have, p) % p
            have += k
        terms = codes * power % p
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]) % p
        inverse = pow(b, -1, p)
        less = (less << np.uint64(31)) + (upto[:-1] + (upto[-1] + p - upto[1:]) % p * inverse) % p
        blank = (blank << np.uint64(31)) + (upto[-1] + p - terms) % p
        full = (full << 31) + int(upto[-1])
    return full, less.astype(np.int64), blank.astype(np.int64)


def long_pairs(words: DataFrame, trie_letters: int) -> DataFrame:
    """(word, near, near_n) of near words, the longer with more than
    ``trie_letters`` letters: hashed keys, then a comparison."""
    schema = pa.schema([("id", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), ("place", pa.int32()), ("key", pa.int64())])

    def keys(batches):
        for batch in batches:
            for word, i in zip(batch["word"].to_pylist(), batch["id"].to_pylist(), strict=True):
                full, less, blank = letter_keys(word)
                n = len(word)
                parts = [(np.array([WHOLE]), np.array([0]), np.array([full]))]
                if n > trie_letters:
                    less, place = np.unique(less, return_index=True)
                    parts += [(np.arange(n), np.arange(n), blank), (np.full(len(less), LESS), place, less)]
                for at, place, key in parts:
                    for k in range(0, len(key), 1 << 18):  # rows of one Arrow batch
                        m = len(key[k:k + (1 << 18)])
                        yield pa.record_batch([pa.array(np.full(m, i)), pa.array(np.full(m, n, np.int32)), pa.array(at[k:k + m].astype(np.int32)),
                                               pa.array(place[k:k + m].astype(np.int32)), pa.array(key[k:k + m].astype(np.int64))], schema=schema)

    # Numbers stand for the words: a word's keys are as many as its letters.
    longs = written(words.filter(F.char_length("word") >= trie_letters).select(F.monotonically_increasing_id().alias("id"), "word", "n"), "long-words")
    keyed = written(longs.select("id", "word").mapInArrow(keys, "id long, size int, at int, place int, key long"), "long-keys")
    blank, whole = keyed.filter("at >= 0").drop("place"), keyed.filter(F.col("at") == WHOLE)
    same = (blank.join(blank.withColumnRenamed("id", "other"), ["size", "at", "key"]).filter("id <> other")
            .select("id", "other", F.col("at").alias("place"), F.lit(1).alias("own")))
    less = (keyed.filter(F.col("at") == LESS).join(whole.select(F.col("id").alias("other"), (F.col("size") + 1).alias("size"), "key"), ["size", "key"])
            .select("id", "other", "place", F.lit(0).alias("own")))
    met = (same.unionByName(less).join(longs, "id")
           .join(longs.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n")), "other"))
    rest = F.char_length("word")
    met = met.filter((_head("word", F.col("place")) == _head("near", F.col("place")))
                     & (F.col("word").substr(F.col("place") + 2, rest) == F.col("near").substr(F.col("place") + 1 + F.col("own"), rest)))
    back = met.filter("own = 0").select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return met.select("word", "near", "near_n").unionByName(back)


def group_variants(words: DataFrame, min_letters: int = MIN_LETTERS, ratio: int = RATIO, trie_letters: int = TRIE_LETTERS) -> DataFrame:
    """word, n, n_near, form, form_n, root for each row of ``words`` (word, n)."""
    words = written(words.select("word", "n"), "words")
    pairs = trie_pairs(words, min_letters, trie_letters).unionByName(long_pairs(words, trie_letters))
    best = (pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("top")))
    formed = (words.join(best, "word", "left")
              .withColumn("has", F.coalesce(-F.col("top.n") >= ratio * F.col("n"), F.lit(False)))
              .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("has"), F.col("top.near")).alias("form"),
                      F.when(F.col("has"), -F.col("top.n")).alias("form_n")))
    formed = written(formed, "forms")
    # Each form has ``ratio`` times the count of its word, so chains are short
    # (no cycles); pointers double until none moves.
    roots = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(ahead, "root", "left_semi").isEmpty():
            break
        roots = written(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return (formed.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
