"""Packing by lexical retrieval: BM25 neighbours fill each window.

Documents become token ids, each closed by an end id.  Windows hold ``WINDOW``
ids.  Full windows of a long document stand alone; what remains of each document
(less than a window) is packed with its lexical neighbours: a seed document
queries the BM25 inverted index of its shard, and the unused documents it
returns, best first, fill the window.  The one that does not fit is cut, and its
rest seeds the next window, so windows have no padding.  A shard's last window
is cut into sequences whose lengths are powers of two, which need none either.

Terms are token ids.  Their document counts come from all documents (a table no
larger than the vocabulary).  Shards are ranges of (the rest's two rarest terms
by the vocabulary's order, doc_id), so neighbours tend to share a shard, and a
term that many documents share is split by doc_id.  A shard has about ``SHARD_DOCS`` rests,
each below a window, and is one task's work: its index is a sorted array of
postings, a query adds up those of the seed's terms, of all unused documents.  Where
no unused document shares a term, the next of the shard follows.

Encoding looks up what stands between white space or signs in a cache, each
distinct chunk of a batch once; the tokenizers library merges the new words of a batch together,
and the end mark of a word's last token tells them apart.

Cases: null is the empty text, of which only the end id is left.  Repeated rows
are packed each for itself.  Texts are taken whole.  An empty table gives no
rows.  Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.bpe import loaded
from postlake.llm.common import slices, written

WINDOW = 4096
END_ID = 2
#: Documents of one index shard, on average.
SHARD_DOCS = 1_000
#: Chunks that a worker remembers.
CACHE_WORDS = 500_000
#: A letter or digit and a sign behind it, which begins a word.
MARK = r"([a-zà-öø-ÿ0-9])([.,;:!?])"
#: BM25's usual saturation and length weights.
K1, B = 1.2, 0.75


class _Lists:
    """Lists of ids, one behind the other: list ``i`` is ``flat[ends[i]:ends[i + 1]]``."""

    def __init__(self, flat: np.ndarray, ends: np.ndarray):
        self.flat, self.ends = flat, ends

    @classmethod
    def of(cls, lists: list[list[int]]) -> _Lists:
        return cls(np.array([t for x in lists for t in x], "<u4"), np.append(0, np.cumsum([len(x) for x in lists], dtype=np.int64)))

    @classmethod
    def joined(cls, a: _Lists, b: _Lists) -> _Lists:
        return cls(np.append(a.flat, b.flat), np.append(a.ends, a.ends[-1] + b.ends[1:]))

    def take(self, at: np.ndarray) -> _Lists:
        first, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        ends = np.append(0, np.cumsum(sizes))
        return _Lists(self.flat[np.repeat(first - ends[:-1], sizes) + np.arange(ends[-1])], ends)


class Encoder:
    """Ids of texts, with a cache of chunks; words as in the tokenizer file.

    A chunk is what stands between ASCII white space, or between it and a
    ``MARK``.  No word spans these places, so a chunk's ids follow from the
    chunk alone."""

    def __init__(self, spec: str):
        import tokenizers
        self.words = loaded(spec)
        # The library's merges alone: words come normalised, divided and spelled.
        plain = json.loads(spec) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None,
                                    "added_tokens": [], "truncation": None, "padding": None}
        self.library = tokenizers.Tokenizer.from_str(json.dumps(plain))
        # Words and line ends; with the classes written out for texts within Latin-1.
        pattern = rf"\n|{self.words.word.pattern}"
        self.lines = regex.compile(pattern)
        for kind in "LN":
            pattern = pattern.replace(rf"\p{{{kind}}}", "".join(c for c in map(chr, range(256)) if unicodedata.category(c)[0] == kind))
        self.latin = re.compile(pattern)
        suffix = self.words.suffix
        self.last = np.zeros(self.words.size, bool)
        self.last[[i for t, i in self.words.vocab.items() if t.endswith(suffix)]] = True
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in self.words.special.items()}
        # Place of each known chunk, in order; its ids, and the call that last met it.
        self.known: dict[str, int] = {}
        self.ids, self.met, self.calls = _Lists.of([]), np.zeros(0, np.int64), 0

    def learn(self, words: list[str]) -> _Lists:
        """Ids of distinct words by the library's merges."""
        apart = self.words.spell[ord("\n")]  # no word holds a line end
        lines = [self.words.spelled("\n".join(words[i:i + 200])).replace(apart, " ") for i in range(0, len(words), 200)]
        ids = np.array([t for x in self.library.encode_batch_fast(lines, add_special_tokens=False) for t in x.ids], "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) == len(words):
            return _Lists(ids, np.append(0, ends))
        # a token inside a word that looks like a word's last one
        return _Lists.of([self.words.exact(w) for w in words])

    def find(self, chunks: list[str]) -> np.ndarray:
        """Place of each chunk, -1 if it is not known."""
        return np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))

    def add(self, chunks: list[str], ids: _Lists) -> None:
        """New chunks, each with its list of ids."""
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks)), strict=True))
        self.ids = _Lists.joined(self.ids, ids)

    def meet(self, chunks: list[str]) -> np.ndarray:
        """Places of new chunks: first their words become known, then those that are no such word."""
        text = "\n".join(chunks)
        try:
            text.encode("latin-1")
            words = self.latin.findall(text)
        except UnicodeEncodeError:
            words = self.lines.findall(text)
        words.append("\n")
        new = [w for w in dict.fromkeys(words) if w not in self.known and w != "\n"]
        self.add(new, self.learn(new))
        at, places = self.find(words), self.find(chunks)
        rest = np.flatnonzero(places < 0)
        places[rest] = len(self.known) + np.arange(len(rest))
        made, stops = self.ids.take(at[at >= 0]), np.flatnonzero(at < 0)
        ends = np.append(0, stops - np.arange(len(stops)))  # of the chunks, in words
        self.add([chunks[i] for i in rest.tolist()], _Lists(made.flat, made.ends[ends]).take(rest))
        self.met = np.append(self.met, np.full(len(self.known) - len(self.met), self.calls))
        return places

    def forget(self) -> None:
        """Of too many chunks, those not met for longest."""
        if len(self.known) > CACHE_WORDS:
            keep = np.zeros(len(self.known), bool)
            keep[np.argsort(self.met, kind="stable")[-CACHE_WORDS // 2:]] = True
            self.known = dict(zip(compress(self.known, keep.tolist()), range(int(keep.sum())), strict=True))
            self.ids, self.met = self.ids.take(np.flatnonzero(keep)), self.met[keep]

    def plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts in which no special token is looked for."""
        chunks = pc.ascii_split_whitespace(pc.replace_substring_regex(pa.array(map(self.words.normal, texts), pa.large_string()), MARK, r"\1 \2"))
        ends, coded = chunks.offsets.to_numpy(), chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.calls += 1
        at = self.find(distinct)
        self.met[at[at >= 0]] = self.calls
        if len(new := np.flatnonzero(at < 0)):
            at[new] = self.meet([distinct[i] for i in new.tolist()])
        got = self.ids.take(at[coded.indices.to_numpy()])
        flat, ends = got.flat.tobytes(), (4 * got.ends[ends]).tolist()
        self.forget()
        return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split, special = self.words.specials, self.words.special
        texts = [t or "" for t in texts]
        pieces = {i: [x for x in split.split(t) if x] for i, t in enumerate(texts) if any(s in t for s in special)}
        out = self.plain(["" if i in pieces else t for i, t in enumerate(texts)])
        if pieces:
            rest = iter(self.plain([x for p in pieces.values() for x in p if x not in special]))
            for i, p in pieces.items():
                out[i] = b"".join(self.special[x] if x in special else next(rest) for x in p)
        return out


@lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    return Encoder(spec)


def encode_documents(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, doc_tokens, windows, rest, term_1, term_2) of every text: its ids
    and the end id as full windows and the rest, and the rest's two rarest
    terms by the vocabulary's order (``path``: tokenizer file)."""
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    key = docs.schema["doc_id"].dataType.simpleString()
    end, step = np.array([end_id], "<u4").tobytes(), 4 * window
    names = ["doc_id", "doc_tokens", "windows", "rest", "term_1", "term_2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for ids in encoder(spec.value).encode(part["text"].to_pylist()):
                    ids += end
                    full = len(ids) - len(ids) % step
                    rest = ids[full:]
                    rows.append((len(ids) // 4, [ids[i:i + step] for i in range(0, full, step)], rest, *_rarest(rest)))
                types = (pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.int64(), pa.int64())
                yield pa.record_batch([part["doc_id"], *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, doc_tokens long, windows array<binary>, rest binary, term_1 long, term_2 long")


def _rarest(rest: bytes) -> tuple[int, int]:
    """The two largest ids, -1 where there is none."""
    ids = np.frombuffer(rest, "<u4")
    first = ids.max(initial=0)
    others = ids[ids < first]
    return (int(first) if len(ids) else -1), (int(others.max()) if len(others) else -1)


def _terms(rest: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, sorted, and how often each stands there."""
    ids = np.sort(np.frombuffer(rest, "<u4"))
    if not len(ids):
        return ids, np.zeros(0, np.int64)
    at = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(ids)]])
    return ids[at[:-1]], at[1:] - at[:-1]


def _documents_with(coded: DataFrame, column: str) -> DataFrame:
    """(term, n): documents that hold each term, added up per task first."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for (rest,) in zip(batch[0].to_pylist(), strict=True):
                terms, _ = _terms(rest)
                if len(terms):
                    if terms[-1] >= len(total):
                        total = np.concatenate([total, np.zeros(int(terms[-1]) + 1 - len(total), np.int64)])
                    total[terms] += 1
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["term", "n"])
    return coded.select(column).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Shard:
    """BM25 index over the rests of a shard (``rests``: ids as bytes)."""

    def __init__(self, rests: list[bytes], idf: np.ndarray, mean: float):
        found = [_terms(r) for r in rests]
        sizes = np.array([len(t) for t, _ in found])
        doc = np.repeat(np.arange(len(rests)), sizes)
        term = np.concatenate([t for t, _ in found]).astype(np.int64) if rests else np.zeros(0, np.int64)
        tf = np.concatenate([c for _, c in found]).astype(float) if rests else np.zeros(0)
        length = np.array([len(r) // 4 for r in rests], float)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / mean))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight, term = doc[order], weight[order], term[order]
        self.terms, self.first = np.unique(term, return_index=True)
        self.stop = np.append(self.first[1:], len(term))
        self.size = len(rests)

    def scores(self, ids: bytes) -> np.ndarray:
        """Every kept document's score for the terms of ``ids``, 0 for others."""
        terms, _ = _terms(ids)
        at = np.searchsorted(self.terms, terms)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)]
        counts = self.stop[at] - self.first[at]
        # positions of all the terms' postings, one run behind the other
        where = np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        return np.bincount(self.doc[where], self.weight[where], self.size)

    def keep(self, unused: np.ndarray) -> None:
        """Drops the postings of documents that are no longer asked for."""
        kept = unused[self.doc]
        before = np.append(0, np.cumsum(kept))
        self.doc, self.weight = self.doc[kept], self.weight[kept]
        self.first, self.stop = before[self.first], before[self.stop]


def fill_windows(rests: list[bytes], idf: np.ndarray, mean: float, window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) in ids; every id is in one."""
    index = Shard(rests, idf, mean)
    sizes = [len(r) // 4 for r in rests]
    unused = np.array(sizes) > 0
    following, held = 0, len(rests)
    seed, start = -1, 0
    now, room = [], window
    while True:
        if seed < 0:
            while following < len(rests) and not unused[following]:
                following += 1
            if following == len(rests):
                break
            seed, start = following, 0
            unused[seed] = False
        # The seed's rest opens the window, its neighbours follow.
        n = sizes[seed] - start
        now, room = [(seed, start, n)], window - n
        free = np.flatnonzero(unused)
        if len(free) < 0.875 * held:
            index.keep(unused)
            held = len(free)
        cut = -1
        for near in free[np.argsort(-index.scores(rests[seed])[free], kind="stable")].tolist():
            if not room:
                break
            unused[near] = False
            n = min(sizes[near], room)
            now.append((near, 0, n))
            room -= n
            if n < sizes[near]:
                cut, start = near, n
        seed = cut
        if room:
            break
        yield now
        now = []
    # What is left is less than a window: powers of two, largest first.
    left = [list(p) for p in now]
    total = sum(p[2] for p in left)
    while total:
        room = take = 1 << (total.bit_length() - 1)
        part = []
        while room:
            doc, begin, n = left[0]
            n = min(n, room)
            part.append((doc, begin, n))
            room -= n
            if n == left[0][2]:
                left.pop(0)
            else:
                left[0][1:] = [begin + n, left[0][2] - n]
        yield part
        total -= take


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id,
    offset and the piece's ids (little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    key = docs.schema["doc_id"].dataType.simpleString()
    coded = written(encode_documents(docs, path, window, end_id), "packing-ids")
    # Every full window is a sequence of its own.
    whole = (coded.filter(F.col("doc_tokens") >= window).select("doc_id", "doc_tokens", F.posexplode("windows").alias("at", "ids"))
             .select("doc_id", (F.col("at").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"), "doc_tokens",
                     (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids"))
    left = F.col("doc_tokens") % window
    rests = coded.filter(left > 0)
    n_docs, mean = rests.agg(F.count("*"), F.avg(left)).first()
    counts = _documents_with(rests, "rest").toPandas()  # at most the vocabulary
    idf = np.zeros(int(counts["term"].max()) + 1 if n_docs else 1)
    n_with = counts["n"].to_numpy(float)
    idf[counts["term"].to_numpy(np.int64)] = np.log1p((n_docs - n_with + 0.5) / (n_with + 0.5))
    held, mean = spark.sparkContext.broadcast(idf), float(mean or 1)

    def pack(batches):
        shard, held_rows = TaskContext.get().partitionId(), [b for b in batches if b.num_rows]
        if not held_rows:
            return
        table = pa.Table.from_batches(held_rows)
        ids, tokens, rests = (table[c].to_pylist() for c in ("doc_id", "doc_tokens", "rest"))
        out = []
        for k, sequence in enumerate(fill_windows(rests, held.value, mean, window)):
            offset = 0
            for doc, start, n in sequence:
                first = tokens[doc] - len(rests[doc]) // 4
                out.append((ids[doc], first + start, n, tokens[doc], 2 * ((shard << 32) + k), offset, rests[doc][4 * start:4 * (start + n)]))
                offset += n
            if len(out) >= 1_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(rows):
        types = [pa.int64()] * 5 + [pa.binary()]
        cols = list(zip(*rows, strict=True))
        return pa.record_batch([pa.array(cols[0], id_type), *(pa.array(c, t) for c, t in zip(cols[1:], types, strict=True))],
                               names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    order = ["term_1", "term_2", "doc_id"]
    packed = (rests.select("doc_id", "doc_tokens", "rest", "term_1", "term_2").repartitionByRange(n_docs // shard_docs + 1, *order).sortWithinPartitions(*order).select("doc_id", "doc_tokens", "rest")
              .mapInArrow(pack, f"doc_id {key}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"))
    return packed.unionByName(whole)
