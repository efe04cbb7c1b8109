"""Secret scan: patterns plus a character convolutional network.

Three patterns find the base kinds (assign, access, hex).  Beside them every
candidate, a run of at least ``MIN_CANDIDATE`` key characters with a letter or
a digit, is scored with its context by a small convolutional network in numpy:
characters are embedded with a channel that marks the candidate, convolved,
max- and mean-pooled, and put through a logistic layer.  It is trained on
labelled findings, its score is calibrated on a second part of them (Platt
scaling) and the threshold is the largest that keeps ``MIN_RECALL`` of that
part's secrets.  Runs are split at base spans, so a key beside one is scored.
A run longer than the network sees is also scored piece by piece: every part
between slashes and overlapping windows along it, each with the run's context.
Candidates that reach the threshold become spans of kind ``model``, the best
first; a piece that overlaps a better span of its run is dropped.

The findings are made by rule from a seed (``FINDINGS`` rows, a fixed bound):
keys of usual shapes in usual contexts, and look-alikes such as words, paths,
identifiers, numbers, versions, UUIDs, encoded images and lock-file digests.
Training takes seconds on the driver; the weights (a few kB) travel with the
task.

Cases: null is the empty text.  Texts are scanned whole; candidates are scored
in blocks, so memory follows the longest text.  Every row gives one row; other
columns are not read.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from postlake.llm.common import map_rows

KINDS = ("assign", "access", "hex", "model")
FINDINGS = 8_000
MIN_RECALL = 0.98
MIN_CANDIDATE = 16
BEFORE, INSIDE, AFTER = 24, 48, 12
WIDTH = BEFORE + INSIDE + AFTER
#: Distance of the overlapping windows along a long run.
STEP = 12
BLOCK = 2_048

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_CANDIDATE},}}")
_ALNUM, _PART = re.compile("[A-Za-z0-9]"), re.compile(rf"[A-Za-z0-9+_=-]{{{MIN_CANDIDATE},}}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start and then kind."""
    out = []
    lower = text.lower()
    if any(c in lower for c in _CUES):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Candidate runs of the text, split at base spans."""
    out, i, reach = [], 0, 0
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        while i < len(base) and base[i][0] < e:
            if base[i][0] > max(s, reach):
                out.append((max(s, reach), base[i][0]))
            reach, i = max(reach, base[i][1]), i + 1
        out.append((max(s, reach), e))
    return [(s, e) for s, e in out if e - s >= MIN_CANDIDATE and _ALNUM.search(text, s, e)]


def pieces(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """What is scored of a run: itself and, if it is longer than the network
    sees, its parts between slashes and overlapping windows."""
    if end - start <= INSIDE:
        return [(start, end)]
    parts = {m.span() for m in _PART.finditer(text, start, end)}
    parts |= {(max(start, min(i, end - INSIDE)), min(i + INSIDE, end)) for i in range(start, end, STEP)}
    return [(start, end), *sorted(p for p in parts if p != (start, end) and _ALNUM.search(text, *p))]


def best(scored: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """A run's spans, of its pieces that reach the threshold: itself, else the
    best pieces that overlap no better one (the shorter of equal ones)."""
    if scored and scored[0][:2] == (min(s for s, _, _ in scored), max(e for _, e, _ in scored)):
        scored = scored[:1]
    out: list[tuple[int, int, float]] = []
    for s, e, p in sorted(scored, key=lambda x: (-x[2], x[1] - x[0], x[0])):
        at = bisect_left(out, (e,))
        if not at or out[at - 1][1] <= s:
            out.insert(at, (s, e, p))
    return out


def window(text: str, start: int, end: int, run: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Character numbers of a candidate and around it (around its run, for a
    piece of one), and the mark of its own ones.  Long candidates show their
    first and last characters."""
    own = text[start:end]
    if len(own) > INSIDE:
        own = own[:INSIDE // 2] + own[-(INSIDE // 2):]
    start, end = run or (start, end)
    before, after = text[max(0, start - BEFORE):start].rjust(BEFORE, "\0"), text[end:end + AFTER].ljust(AFTER, "\0")
    chars = np.frombuffer((before + own.ljust(INSIDE, "\0") + after).encode("utf-32-le", "surrogatepass"), "<u4")
    mark = np.zeros(WIDTH, np.float32)
    mark[BEFORE:BEFORE + len(own)] = 1
    return np.minimum(chars, 128).astype(np.int64), mark


class CharCnn:
    """Embedding, one convolution, max and mean pooling, logistic output."""

    def __init__(self, seed: int = 7, dim: int = 8, kernel: int = 5, filters: int = 24):
        r = np.random.default_rng(seed)
        self.kernel = kernel
        self.p = {"e": r.normal(0, 0.4, (129, dim)), "w": r.normal(0, 0.25, (kernel * (dim + 1), filters)),
                  "b": np.zeros(filters), "v": r.normal(0, 0.3, 2 * filters), "c": np.zeros(1)}
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, chars, mark):
        x = np.concatenate([self.p["e"][chars], mark[..., None]], -1)
        n = x.shape[1] - self.kernel + 1
        cols = np.concatenate([x[:, k:k + n] for k in range(self.kernel)], -1)
        h = np.maximum(cols @ self.p["w"] + self.p["b"], 0)
        top = h.argmax(1)
        pooled = np.concatenate([np.take_along_axis(h, top[:, None], 1)[:, 0], h.mean(1)], -1)
        return cols, h, top, pooled, pooled @ self.p["v"] + self.p["c"][0]

    def logits(self, chars, mark) -> np.ndarray:
        return np.concatenate([self._forward(chars[i:i + BLOCK], mark[i:i + BLOCK])[-1] for i in range(0, len(chars), BLOCK)]
                              or [np.zeros(0)])

    def probability(self, chars, mark) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.logits(chars, mark) + self.shift)))

    def _gradient(self, chars, mark, y):
        cols, h, top, pooled, z = self._forward(chars, mark)
        dz = (1 / (1 + np.exp(-z)) - y) / len(y)
        f = h.shape[2]
        g = {"v": pooled.T @ dz, "c": dz.sum(keepdims=True)}
        dp = dz[:, None] * self.p["v"]
        dh = np.repeat(dp[:, None, f:] / h.shape[1], h.shape[1], 1)
        b, j = np.ogrid[:len(y), :f]
        dh[b, top, j] += dp[:, :f]
        dh *= h > 0
        g["w"], g["b"] = np.tensordot(cols, dh, ([0, 1], [0, 1])), dh.sum((0, 1))
        dcols, dim = dh @ self.p["w"].T, self.p["e"].shape[1]
        dx = np.zeros((*chars.shape, dim))
        for k in range(self.kernel):
            dx[:, k:k + h.shape[1]] += dcols[..., k * (dim + 1):k * (dim + 1) + dim]
        g["e"] = np.zeros_like(self.p["e"])
        np.add.at(g["e"], chars, dx)
        return g

    def fit(self, chars, mark, y, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 7) -> None:
        r, t = np.random.default_rng(seed), 0
        m, s = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for _ in range(epochs):
            order = r.permutation(len(y))
            for i in range(0, len(y), batch):
                pick, t = order[i:i + batch], t + 1
                for k, g in self._gradient(chars[pick], mark[pick], y[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.99 ** t)) + 1e-8)

    def calibrate(self, chars, mark, y, min_recall: float = MIN_RECALL) -> None:
        """Platt scaling, then the largest threshold of the asked recall."""
        z = self.logits(chars, mark)
        for _ in range(300):
            d = 1 / (1 + np.exp(-(self.scale * z + self.shift))) - y
            self.scale -= 0.1 * float((d * z).mean())
            self.shift -= 0.1 * float(d.mean())
        found = np.sort(self.probability(chars, mark)[y > 0])
        self.threshold = float(min(found[int((1 - min_recall) * len(found))], 0.99))


def findings(n: int = FINDINGS, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """Labelled findings by rule: (text, start, end, 1 secret / 0 look-alike)."""
    r = np.random.default_rng(seed)
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    draw = lambda chars, k: "".join(pick(chars) for _ in range(int(k)))
    syllables = ("an th er ion the ou re qu el st ich en ro po lo gy de part ment his to ry con sys tem in ter nal us mod ule ser vice "
                 "da ta base fig ur a tion ch pre form able").split()
    onsets = "b bl br c ch cl cr d dr f fl fr g gl gr h j k l m n p ph pl pr qu r s sc sh sl sp st str t th tr v w wh y z".split() + [""] * 6
    vowels, codas = "a e i o u a e i o ai ea ee ie oo ou ow y".split(), "b ck d f g k l ll m n nd ng nk nt p r rd rk rn rt s ss st t th x".split() + [""] * 12
    spoken = lambda: draw(onsets, 1) + pick(vowels) + pick(codas)
    word = lambda: draw(syllables, r.integers(1, 5)) if r.random() < 0.5 else "".join(spoken() for _ in range(int(r.integers(1, 4))))
    num = lambda hi=1000: str(int(r.integers(hi)))
    uuid = lambda: "-".join(draw("0123456789abcdef", k) for k in (8, 4, 4, 4, 12))
    alnum, b64 = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    secrets = (lambda: draw("0123456789abcdef", pick([20, 24, 31, 32, 40, 64])), lambda: draw("0123456789ABCDEF", pick([24, 32, 40])),
               lambda: draw(alnum, r.integers(18, 44)), lambda: draw(b64, r.integers(20, 60)) + pick(["", "=", "=="]),
               lambda: pick(["ghp_", "sk_live_", "xoxb-", "glpat-", "pk_test_"]) + draw(alnum, r.integers(20, 36)),
               lambda: f"eyJ{draw(alnum, 17)}" + draw(alnum + "-_", r.integers(10, 40)), lambda: draw(string.ascii_letters, r.integers(24, 44)))
    decoys = (lambda: "/".join([word() for _ in range(4)] + [num()]), lambda: "_".join([word() for _ in range(4)] + [num()]),
              lambda: "-".join([word() for _ in range(4)] + [num(99)]), lambda: "".join(word().title() for _ in range(5)) + num(99),
              lambda: f"20{r.integers(10, 30)}-0{r.integers(1, 9)}-{r.integers(10, 28)}T{r.integers(10, 24)}", lambda: "=" * 15 + word() + num(9),
              lambda: draw("0123456789", r.integers(15, 20)) + pick("kxmL"), lambda: word() * 4 + num(99),
              lambda: pick("ab0") * int(r.integers(15, 40)) + "1x", lambda: "-".join(draw("0123456789", 4) for _ in range(4)) + "x",
              lambda: "".join(word() for _ in range(6)) + num(9), lambda: f"v{num(20)}-{num(20)}-rc{num(9)}-{word()}-{word()}",
              lambda: "".join(word().upper() for _ in range(5)) + num(99), lambda: "".join(word() for _ in range(5)),
              lambda: pick(["-", "_", "/"]).join(word() for _ in range(5)), lambda: "".join(word().title() for _ in range(4)),
              lambda: "_".join(word().upper() for _ in range(4)), lambda: draw("0123456789", r.integers(16, 40)), lambda: word() + "-" * 20,
              uuid, uuid, lambda: "/".join([word(), uuid(), word()]))
    encoded = (("data:image/png;base64,", "iVBORw0KGgo"), ("data:image/jpeg;base64,", "/9j/4AAQSkZJRg"), ("url(data:font/woff2;base64,", "d09GMgABAAAAA"),
               ("src='data:image/gif;base64,", "R0lGODlh"), ('"integrity": "', "sha512-"), ('integrity="', "sha384-"), ("integrity ", "sha1-"), ("checksum = ", "sha256-"))
    shown = ("{}", "{}", 'key = "{}"', "Authorization: Bearer {}", '"client_secret": "{}"', "export X={}", "{} is used", "see {},", "<{}>", "id {}")
    out = []
    for _ in range(n):
        y = int(r.integers(2))
        own = pick(secrets if y else decoys)().ljust(MIN_CANDIDATE, "7" if y else "a")
        frame = pick(shown)
        before = " ".join(word() for _ in range(int(r.integers(0, 6)))) + pick([" ", "\n", " "]) + frame.split("{}")[0]
        if not y and r.random() < 0.2:  # the start of encoded data, or a window along it
            lead, head = pick(encoded)
            before, own = before + lead, (pick([head, ""]) + draw(b64, 60))[:INSIDE]
        out.append((before + own + frame.split("{}")[1] + " " + " ".join(word() for _ in range(4)), len(before), len(before) + len(own), y))
    return out


def arrays(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    both = [window(t, s, e) for t, s, e, _ in rows]
    return np.array([c for c, _ in both]), np.array([m for _, m in both]), np.array([y for *_, y in rows], float)


@lru_cache(maxsize=4)
def trained(n: int = FINDINGS, min_recall: float = MIN_RECALL) -> CharCnn:
    """The network, fitted on three quarters of the findings and calibrated on the rest."""
    chars, mark, y = arrays(findings(n))
    cut = 3 * n // 4
    net = CharCnn()
    net.fit(chars[:cut], mark[:cut], y[:cut])
    net.calibrate(chars[cut:], mark[cut:], y[cut:], min_recall)
    return net


def find_secrets(docs: DataFrame, net: CharCnn | None = None) -> DataFrame:
    """(doc_id, spans array<struct<start, end, kind, score>>), by start and kind.

    The score is the network's for kind ``model`` and 1 for base kinds.
    """
    net = net or trained()

    def scores(text, todo):
        for i in range(0, len(todo), BLOCK):
            both = [window(text, s, e, run) for s, e, run in todo[i:i + BLOCK]]
            yield from net.probability(np.array([c for c, _ in both]), np.array([m for _, m in both])).tolist()

    def scan(rows):
        for doc_id, text in rows:
            text = text or ""
            own = base_spans(text)
            todo = [(s, e, run) for run in candidates(text, own) for s, e in pieces(text, *run)]
            found: dict[tuple[int, int], list] = {}
            for (s, e, run), p in zip(todo, scores(text, todo), strict=True):
                if p >= net.threshold:
                    found.setdefault(run, []).append((s, e, p))
            spans = [(s, e, k, 1.0) for s, e, k in own] + [(s, e, "model", p) for hits in found.values() for s, e, p in best(hits)]
            spans.sort(key=lambda x: (x[0], KINDS.index(x[2])))
            yield doc_id, [{"start": s, "end": e, "kind": k, "score": p} for s, e, k, p in spans]

    return map_rows(docs.select("doc_id", "text"), scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                    "spans array<struct<start:long,end:long,kind:string,score:double>>")
