"""BPE encoding and decoding: speculate and verify.

The tokenizer file is of the kind "BPE with word ends": text is normalised
(NFC, lower case), divided into words by a pattern, bytes are spelled as
printable characters, and merges run inside a word whose last character
carries a suffix.

Distinct words of a batch are encoded together.  Greedy longest match proposes
tokens.  A sequence of tokens is the result of the merges exactly if each token
is what the merges make of its own characters and each adjacent pair stays
apart when the two are encoded together; both are checked for all pairs of the
batch at once, in numpy, by unfolding the two tokens along their facing edges
and looking for a merge across the border that would have come first.  Words
with a failing pair are merged step by step.

Cases: null is the empty text: no ids, empty decoding.  Special tokens that
stand literally in a text become their ids, as the tokenizers library does.
Texts are taken whole; memory follows the longest text and a word cache of at
most twice ``CACHE_WORDS`` words and those of one batch.  Character classes and
lower case are those of the installed ``regex`` and Python, which differ from
the library's for characters assigned after Unicode 15.  Every row gives one row; other columns stay out.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from postlake.llm.common import map_rows

CACHE_WORDS = 150_000
#: Symbols from which a word's merges go through a heap.
LONG = 1_000
_NEVER = 1 << 40
_NONE = (_NEVER, -1)
_SPACE = r"\t-\r \x85\xa0  -     　"


def byte_alphabet() -> list[str]:
    """The printable character of each byte: itself where it has a visible
    Latin-1 form, else the next free one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder over the tables of one tokenizer file."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        model = conf["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.token = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        split = next(p["pattern"]["Regex"] for p in conf["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.alphabet = byte_alphabet()
        self.spell = dict(enumerate(self.alphabet))
        n = max(self.token) + 1
        self.size = n
        # rank[t]: order of the merge that makes t, -1 for single characters.
        self.left, self.right, self.rank = np.arange(n), np.arange(n), np.full(n, -1)
        pairs = {}  # (a, b) -> rank and made token
        for r, (a, b) in enumerate(x if isinstance(x, list) else x.split(" ") for x in model["merges"]):
            t = self.vocab[a + b]
            pairs[self.vocab[a], self.vocab[b]] = (r, t)
            self.left[t], self.right[t], self.rank[t] = self.vocab[a], self.vocab[b], r
        self.merge = {a * n + b: x for (a, b), x in pairs.items()}
        keys = np.array([a * n + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_key = np.append(keys[order], -1)
        self.pair_rank = np.append(np.array([r for r, _ in pairs.values()], np.int64)[order], 0)
        merged = np.flatnonzero(self.rank >= 0)
        own = np.ones(n, bool)
        own[merged] = self.apart(self.left[merged], self.right[merged], self.rank[merged])
        for t in merged[np.argsort(self.rank[merged])]:  # a token whose parts fail fails
            own[t] &= own[self.left[t]] and own[self.right[t]]
        self.greedy = {t: i for t, i in self.vocab.items() if own[i] and i not in self.special.values()}
        self.reach: dict[str, int] = {}  # longest token by its first two characters
        for t in self.greedy:
            self.reach[t[:2]] = max(self.reach.get(t[:2], 0), len(t))
        # words of now and of the time before: what is in use stays
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def apart(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = _NEVER) -> np.ndarray:
        """Whether tokens ``a`` and ``b``, each its own encoding, stay apart
        while merges of a rank below ``limit`` run over the two together.

        Seen backwards, the merge of highest rank among the two border tokens
        was the last one; before it the border lay between its part and the
        other token.  A pair of border tokens that were both there could have
        merged if its merge has a rank below that of the merge next undone.
        """
        a, b = a.copy(), b.copy()
        limit = np.broadcast_to(np.asarray(limit, np.int64), a.shape).copy()
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x * self.size + y
            at = np.searchsorted(self.pair_key[:-1], key)
            r = np.where(self.pair_key[at] == key, self.pair_rank[at], _NEVER)
            # Both parts exist from rank max(rank x, rank y) on; the pair is
            # taken if its merge comes before the limit.  At equal rank the
            # leftmost pair is taken first, which ``limit`` holds too.
            bad = r < limit[live]
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            done = bad | ((rx < 0) & (ry < 0))
            undo_x = rx > ry
            # a merge inside the left token wins ties against the border pair,
            # one inside the right token loses them
            limit[live] = np.where(undo_x, rx, ry + 1)
            a[live] = np.where(undo_x, self.right[x], x)
            b[live] = np.where(undo_x, y, self.left[y])
            live = live[~done]
        return good

    def spelled(self, word: str) -> str:
        return word.encode("utf-8", "replace").decode("latin-1").translate(self.spell)

    def exact(self, word: str) -> list[int]:
        """The merges, step by step: lowest rank first, leftmost on ties."""
        text = self.spelled(word)
        ids = [self.vocab[c] for c in text[:-1]] + [self.vocab[text[-1] + self.suffix]]
        n, merge = self.size, self.merge
        if len(ids) > LONG:
            return self.exact_long(ids)
        ranks = [merge.get(a * n + b, _NONE)[0] for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (rank := min(ranks)) != _NEVER:
            i = ranks.index(rank)
            ids[i:i + 2] = [merge[ids[i] * n + ids[i + 1]][1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = merge.get(ids[i] * n + ids[i + 1], _NONE)[0]
            if i:
                ranks[i - 1] = merge.get(ids[i - 1] * n + ids[i], _NONE)[0]
        return ids

    def exact_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over linked symbols, for very long words."""
        n, merge, size = self.size, self.merge, len(ids)
        after, before, gone = list(range(1, size + 1)), list(range(-1, size - 1)), -1

        def pair(i):
            j = after[i]
            return (merge.get(ids[i] * n + ids[j], _NONE)[0], i, ids[i], ids[j]) if j < size else (_NEVER, i, 0, 0)

        heap = [x for i in range(size) if (x := pair(i))[0] != _NEVER]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if ids[i] != a or (j := after[i]) >= size or ids[j] != b:
                continue
            ids[i], ids[j] = merge[a * n + b][1], gone
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0 and (x := pair(k))[0] != _NEVER:
                    heapq.heappush(heap, x)
        return [t for t in ids if t != gone]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over the word's characters."""
        text = self.spelled(word)
        end, whole = len(text), text + self.suffix
        n, greedy, reach = len(whole), self.greedy, self.reach
        out, i = [], 0
        while i < end:
            most = i + reach.get(whole[i:i + 2], 1)
            if most >= n and (t := greedy.get(whole[i:])) is not None:
                out.append(t)
                break
            for j in range(min(most, end - 1), i, -1):
                if (t := greedy.get(whole[i:j])) is not None:
                    out.append(t)
                    i = j
                    break
            else:
                return []
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Puts the encodings of ``words`` into the cache."""
        words = list(words)
        if not words:
            return
        tokens = [self.propose(w) for w in words]
        sizes = np.array([len(t) for t in tokens], np.int64)
        flat = np.fromiter((t for x in tokens for t in x), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        codes = flat[pair] * self.size + flat[pair + 1]
        codes, back = np.unique(codes, return_inverse=True)
        failing = set(owner[pair[~self.apart(codes // self.size, codes % self.size)[back]]].tolist())
        for i, w in enumerate(words):
            ids = self.exact(w) if i in failing or not tokens[i] else tokens[i]
            self.cache[w] = np.array(ids, "<u4").tobytes(), " ".join(self.token[t] for t in ids)

    def normal(self, text: str) -> str:
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # one character at a time: no final sigma

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        return self.word.findall(self.normal(text))

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """For each text its ids (little-endian unsigned 32 bit) and decoding."""
        parts = []
        for text in texts:
            pieces = self.specials.split(text or "") if self.specials else [text or ""]
            parts.append([([x], True) if x in self.special else (self.words(x), False) for x in pieces if x])
        if len(self.cache) > CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        new = {w for p in parts for ws, special in p if not special for w in ws} - self.cache.keys()
        known = new & self.older.keys()
        self.cache |= {w: self.older[w] for w in known}
        self.learn(new - known)
        for t, i in self.special.items():
            self.cache[t] = np.array([i], "<u4").tobytes(), t
        out = []
        for p in parts:
            got = [self.cache[w] for ws, _ in p for w in ws]
            out.append((b"".join(x for x, _ in got), self.join(x for _, x in got)))
        return out

    def join(self, tokens: Iterable[str]) -> str:
        """The decoding: the file names no decoder, so tokens join by spaces."""
        return " ".join(tokens)

    def decode(self, ids: Iterable[int]) -> str:
        return self.join(self.token[int(i)] for i in ids)

    def readable(self, decoded: str) -> str:
        """Readable text of a decoding: bytes and word ends resolved."""
        back = {c: b for b, c in enumerate(self.alphabet)}
        raw = decoded.replace(" ", "").replace(self.suffix, " ")
        return bytes(back.get(c, 32) for c in raw).decode("utf-8", "replace").rstrip()


@lru_cache(maxsize=2)
def loaded(spec: str) -> WordBpe:
    """One encoder per worker process and tokenizer file, with its word cache."""
    return WordBpe(spec)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids binary, decoded string) of every text.

    ``path`` is read on the driver only; the file's content (bounded by the
    vocabulary) is broadcast and its tables are built once per Python worker.
    """
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(rows):
        for (doc_id, _), (ids, decoded) in zip(rows, loaded(spec.value).encode([t for _, t in rows]), strict=True):
            yield doc_id, ids, decoded

    return map_rows(docs.select("doc_id", "text"), run,
                    f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")
