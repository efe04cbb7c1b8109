"""Personal data: patterns plus a linear-chain conditional random field.

Four patterns find the base kinds (email, ip, card, phone).  Beside them every
line is labelled by a linear-chain CRF over word-shape features: the shape of a
word and of its neighbours (runs of letter and digit classes) and whether the
words are cues such as titles or "phone".  It finds what the patterns cannot:
names after a title, phone numbers in local form, national numbers and spelled
out addresses.  The CRF is trained by gradient on a small labelled table made
by rule from a seed (``SENTENCES`` rows, a fixed bound); the forward-backward
pass runs over all sentences at once.  Decoding is Viterbi in numpy over
batches of lines of like length.  Spans of the CRF that overlap no base span
are added; base spans always stay.

Cases: null is the empty text.  Texts and lines are taken whole; lines are
decoded in blocks of ``BLOCK`` words, a longer line alone.  Every row gives
one row; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from postlake.llm.common import map_rows

BASE = ("email", "ip", "card", "phone")
LABELS = ("O", "B-name", "I-name", "B-local_phone", "I-local_phone", "B-national_id", "B-spelled_email", "I-spelled_email")
KINDS = (*BASE, "name", "local_phone", "national_id", "spelled_email")
SENTENCES = 500
BLOCK = 200_000
#: Word forms kept per worker process; beyond, the memory starts anew.
MEMORY = 300_000

# Possessive runs that begin where a run begins: linear in any text.
_LOCAL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@")
_LOCAL_HERE = re.compile(r"[A-Za-z0-9._%+-]++@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKS = str.maketrans("", "", " ().-+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, at = [], 0
    while (m := (_LOCAL_HERE.match(text, at) if out and at == out[-1][1] else None) or _LOCAL.search(text, at)):
        d = _DOMAIN.match(text, m.end())
        at = d.end() if d else m.end()
        if d:
            out.append((m.start(), d.end()))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start and then kind."""
    out = [(s, e, "email") for s, e in _emails(text)] if "@" in text else []
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := m[0].translate(_MARKS)) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(m[0].translate(_MARKS)) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


#: Cue words by class (fixed values).
CUES = {
    "title": "mr mrs ms dr prof herr frau monsieur madame señor señora",
    "phone": "phone tel telephone mobile cell fax call telefon teléfono",
    "id": "ssn social security passport national dni nif nino",
    "at": "at arroba", "dot": "dot punkt punto point",
    "mail": "mail email e-mail contact reach write",
}
_CUE = {w: i + 1 for i, ws in enumerate(CUES.values()) for w in ws.split()}
def _letters(run: str) -> str:
    if run.isupper():
        return "X" if len(run) == 1 else "XX"
    return "x" if run.islower() else "Xx" if run[0].isupper() and run[1:].islower() else "xX"


_SHAPES = ((re.compile(r"[0-9]+"), lambda m: "d" * min(len(m[0]), 5)), (re.compile(r"[^\W\d_]+"), lambda m: _letters(m[0])))


def shape(word: str) -> str:
    """Runs of letters by case and of digits by length, marks as they are."""
    out, i, body = [], 0, word.rstrip(",;:!?.")
    if body.isalpha():
        return _letters(body)
    while i < len(body) and len(out) < 8:
        for pattern, form in _SHAPES:
            if m := pattern.match(body, i):
                out.append(form(m))
                i = m.end()
                break
        else:
            out.append(body[i])
            i += 1
    return "".join(out) + ("…" if i < len(body) else "")


def cue(word: str) -> int:
    return _CUE.get(word.strip(",;:!?.()\"").lower(), 0)


def sentences(n: int = SENTENCES, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """The labelled table, by rule: (words, labels)."""
    r = np.random.default_rng(seed)
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    syllables = ["an", "th", "er", "ion", "the", "ou", "re", "qu", "el", "st", "ich", "mar", "lo", "é"]
    word = lambda: "".join(pick(syllables) for _ in range(int(r.integers(1, 4))))
    digits = lambda k: "".join(str(int(r.integers(10))) for _ in range(k))
    titles, phones, ids = (CUES[k].split() for k in ("title", "phone", "id"))

    def name():
        t = pick(titles).title() + pick(["", "."])
        ws = [word().title() for _ in range(int(r.integers(1, 3)))]
        return [t, *ws], ["O", "B-name", *["I-name"] * (len(ws) - 1)]

    def phone():
        form = pick([[f"({digits(3)})", f"{digits(3)}-{digits(4)}"], [f"{digits(3)}-{digits(3)}-{digits(4)}"], [f"{digits(3)}-{digits(4)}"],
                     [digits(3), digits(3), digits(4)], [f"{digits(3)}.{digits(3)}.{digits(4)}"], [f"0{digits(2)}", digits(4), digits(4)]])
        c = pick(phones) + pick(["", ":"])
        return [pick([c, c.title()]), *form], ["O", "B-local_phone", *["I-local_phone"] * (len(form) - 1)]

    def national():
        c = pick(ids)
        return [pick([c, c.upper()]) + pick(["", ":"]), f"{digits(3)}-{digits(2)}-{digits(4)}"], ["O", "B-national_id"]

    def spelled():
        ws = [word(), pick(CUES["at"].split()), word(), pick(CUES["dot"].split()), pick(["com", "org", "net"])]
        return [pick(CUES["mail"].split()), *ws], ["O", "B-spelled_email", *["I-spelled_email"] * 4]

    def plain():
        k = int(r.integers(9))
        ws = {8: [pick([word(), *CUES["at"].split(), "dot", "at,"])] * int(r.integers(2, 9)),0: [digits(int(r.integers(1, 17)))], 1: [word().title(), word().title()], 2: [f"{digits(1)}.{digits(1)}"], 3: ["at", word()],
              4: [f"{digits(4)}-{digits(2)}-{digits(2)}"], 5: [pick(titles), word()], 6: [pick(phones), word(), digits(3)],
              7: [f"{word()}.{digits(2)}@{word()}.com"]}[k]
        return ws, ["O"] * len(ws)

    out = []
    for _ in range(n):
        words, labels = [], []
        for part in [pick([name, phone, national, spelled, plain, plain, plain, plain]) for _ in range(int(r.integers(0, 3)))]:
            k = int(r.integers(0, 6))
            words += [w.title() if r.random() < 0.15 else w for w in (word() + pick(["", "", ",", "."]) for _ in range(k))]
            labels += ["O"] * k
            ws, ls = part()
            words, labels = words + ws, labels + ls
        k = int(r.integers(1, 7))
        words, labels = words + [word() for _ in range(k)], labels + ["O"] * k
        words[-1] += pick(["", ".", ","])
        out.append((words, labels))
    return out


class ShapeCrf:
    """Linear-chain CRF: shapes and cues of a word and its two neighbours."""

    def __init__(self, shapes: list[str]):
        self.shapes = {s: i + 1 for i, s in enumerate(shapes)}  # 0: unseen or beyond the line
        n, k = len(LABELS), len(CUES) + 1
        self.w = {"shape": np.zeros((3, len(shapes) + 1, n)), "cue": np.zeros((3, k, n)), "step": np.zeros((n, n)), "first": np.zeros(n)}
        self.memory: dict[str, int] = {}
        self.fused: list[np.ndarray] | None = None

    def numbers(self, words: list[str]) -> list[int]:
        """Shape and cue of each word as one number."""
        memory, out = self.memory, []
        if len(memory) > MEMORY:
            memory.clear()
        for w in words:
            if (x := memory.get(w)) is None:
                x = memory[w] = self.shapes.get(shape(w), 0) * 16 + cue(w)
            out.append(x)
        return out

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Scores of each label per word; ``codes`` is padded with -1."""
        pad = np.pad(np.maximum(codes, 0), ((0, 0), (1, 1)))
        n, out = codes.shape[1], 0
        for k in range(3):
            part = pad[:, k:k + n]
            out = out + self.w["shape"][k][part >> 4] + self.w["cue"][k][part & 15]
        out[:, 0] += self.w["first"]
        return out

    def fit(self, table, steps: int = 160, rate: float = 0.1, decay: float = 1e-3) -> None:
        """Adam on the log-likelihood; forward-backward over all rows at once."""
        length = np.array([len(w) for w, _ in table])
        codes, gold = (np.full((len(table), length.max()), -1) for _ in range(2))
        for i, (words, labels) in enumerate(table):
            codes[i, :len(words)], gold[i, :len(words)] = self.numbers(words), [LABELS.index(x) for x in labels]
        live, n = codes >= 0, len(LABELS)
        pad = np.pad(np.maximum(codes, 0), ((0, 0), (1, 1)))
        truth = np.eye(n)[np.maximum(gold, 0)] * live[..., None]
        m, v = ({k: np.zeros_like(x) for k, x in self.w.items()} for _ in range(2))
        for t in range(1, steps + 1):
            e, a = self.emissions(codes), self.w["step"]
            total = lambda x, axis: (lambda top: np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis))(x.max(axis, keepdims=True))
            f, b = np.zeros_like(e), np.zeros_like(e)
            f[:, 0] = e[:, 0]
            for j in range(1, e.shape[1]):
                f[:, j] = np.where(live[:, j, None], total(f[:, j - 1, :, None] + a, 1) + e[:, j], f[:, j - 1])
            for j in range(e.shape[1] - 2, -1, -1):
                b[:, j] = np.where(live[:, j + 1, None], total(a + (e[:, j + 1] + b[:, j + 1])[:, None], 2), b[:, j + 1])
            z = total(f[:, -1], 1)
            unary = np.exp(f + b - z[:, None, None]) * live[..., None]
            g = {k: np.zeros_like(x) for k, x in self.w.items()}
            pair = np.exp(f[:, :-1, :, None] + a + (e[:, 1:] + b[:, 1:])[:, :, None] - z[:, None, None, None]) * live[:, 1:, None, None]
            g["step"] = pair.sum((0, 1)) - np.einsum("ijk,ijl->kl", truth[:, :-1], truth[:, 1:])
            off = unary - truth
            g["first"] = off[:, 0].sum(0)
            for k in range(3):
                part = pad[:, k:k + codes.shape[1]]
                np.add.at(g["shape"][k], part >> 4, off)
                np.add.at(g["cue"][k], part & 15, off)
            for k, x in g.items():
                x = x / len(table) + decay * self.w[k] / 10
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-9)
        self.w = {k: x.astype(np.float32) for k, x in self.w.items()}
        self.memory, self.fused = {}, None

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a padded batch with a label but O, and their best labels.

        Scores run label by label over all rows at once.  A row whose best
        score is that of the all-O path (summed alike, so exactly equal) needs
        no tracing back.
        """
        steps, rows = codes.shape[1], codes.shape[0]
        pad = np.pad(np.maximum(codes, 0), ((0, 0), (1, 1))).T
        length = (codes >= 0).sum(1)
        fused, a = self._tables()
        kept = np.empty((steps, len(LABELS), rows), np.float32)
        best = plain = None
        for j in range(steps):
            e = fused[0][:, pad[j]] + fused[1][:, pad[j + 1]] + fused[2][:, pad[j + 2]]
            if j == 0:
                best = e + self.w["first"][:, None]
                plain = best[0]
            else:
                on = length > j
                step = (best[:, None, :] + a[:, :, None]).max(0) + e
                best = np.where(on, step, best)
                plain = np.where(on, plain + a[0, 0] + e[0], plain)
            kept[j] = best
        some = np.flatnonzero(best.max(0) > plain)
        out = np.zeros((len(some), steps), np.int8)
        if len(some):
            at = best[:, some].argmax(0)
            for j in range(steps - 1, -1, -1):
                out[:, j] = np.where(length[some] > j, at, 0)
                if j:
                    back = (kept[j - 1][:, some] + a[:, at]).argmax(0)
                    at = np.where(length[some] > j, back, at)
        return some, out

    def _tables(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Emissions by code for each neighbour, and the step scores."""
        if self.fused is None:
            codes = np.arange((len(self.shapes) + 1) * 16)
            cue = np.minimum(codes & 15, len(CUES))
            self.fused = [np.ascontiguousarray((self.w["shape"][k][codes >> 4] + self.w["cue"][k][cue]).T.astype(np.float32)) for k in range(3)]
        return self.fused, self.w["step"]

    def label(self, lines: list[list[int]]) -> dict[int, np.ndarray]:
        """Labels by line number, for the lines that have any but O."""
        order = sorted((i for i, x in enumerate(lines) if x), key=lambda i: len(lines[i]))
        found, i = {}, 0
        while i < len(order):
            j, room = i, BLOCK
            while j < len(order) and (j == i or room >= len(lines[order[j]])):
                room -= len(lines[order[j]])
                j += 1
            codes = np.full((j - i, len(lines[order[j - 1]])), -1, np.int32)
            for k, n in enumerate(order[i:j]):
                codes[k, :len(lines[n])] = lines[n]
            for k, labels in zip(*self.viterbi(codes), strict=True):
                found[order[i + k]] = labels
            i = j
        return found


@lru_cache(maxsize=2)
def trained(n: int = SENTENCES) -> ShapeCrf:
    table = sentences(n)
    crf = ShapeCrf(sorted({shape(w) for ws, _ in table for w in ws}))
    crf.fit(table)
    return crf


def crf_spans(crf: ShapeCrf, texts: list[str]) -> list[list[tuple[int, int, str]]]:
    """Spans of the CRF's kinds in each text, marks at their ends left out."""
    lines, place = [], []
    for i, text in enumerate(texts):
        at = 0
        for line in text.split("\n"):
            lines.append(crf.numbers(line.split()))
            place.append((i, at))
            at += len(line) + 1
    out = [[] for _ in texts]
    for n, labels in crf.label(lines).items():
        i, at = place[n]
        end = texts[i].find("\n", at)
        words = [m.span() for m in re.finditer(r"\S+", texts[i][at:end if end >= 0 else None])]
        kind = None
        for (s, e), k in zip(words, labels.tolist(), strict=False):
            name = LABELS[k]
            if name[0] == "I" and kind == name[2:]:
                out[i][-1] = (out[i][-1][0], at + e, kind)
            elif name[0] == "B":
                out[i].append((at + s, at + e, name[2:]))
            kind = name[2:] if name != "O" and (name[0] == "B" or kind == name[2:]) else None
    trim = lambda t, s, e: (s, s + len(t[s:e].rstrip(".,;:!?\"')")))
    return [[(*trim(t, s, e), k) for s, e, k in sorted(o)] for t, o in zip(texts, out, strict=True)]


def find_pii(docs: DataFrame, crf: ShapeCrf | None = None) -> DataFrame:
    """(doc_id, spans array<struct<start, end, kind>>), by start and kind."""
    crf = crf or trained()

    def scan(rows):
        texts = [t or "" for _, t in rows]
        for (doc_id, _), text, more in zip(rows, texts, crf_spans(crf, texts), strict=True):
            spans = base_spans(text)
            starts, reach = [s for s, _, _ in spans], [0, *accumulate((e for _, e, _ in spans), max)]
            # the furthest end of the base spans that start before a span's end
            spans += [x for x in more if x[0] < x[1] and reach[bisect_left(starts, x[1])] <= x[0]]
            spans.sort(key=lambda x: (x[0], KINDS.index(x[2])))
            yield doc_id, [{"start": s, "end": e, "kind": k} for s, e, k in spans]

    return map_rows(docs.select("doc_id", "text"), scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                    "spans array<struct<start:long,end:long,kind:string>>")
