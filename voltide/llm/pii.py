"""Personal data: patterns, and a character-level bidirectional LSTM with CRF
transitions that adds what the patterns miss.

The network is trained in numpy on the driver, from at most ``SAMPLE_WINDOWS``
stretches of text around labelled spans (the patterns' own matches in the
table), and from variants of these kinds of data written in other ways, put into
the same surroundings next to harmless numbers. It reads every stretch of a text
in which a digit or an at sign occurs: all its labels need one. Windows of
``WINDOW`` characters overlap by half; the scores of overlapping windows are
blended, and one CRF path is decoded for each connected stretch as a whole. A
span is added if the path gives it with a mean posterior of ``MIN_POSTERIOR``
and no pattern has a span there.

Positions are in code points, ends exclusive. Cases: null and empty texts have
no spans; texts of any length are read whole, window by window; with no
labelled stretch (empty table) the network learns from the variants alone;
repeated rows get equal spans. Only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
WINDOW = 64
STRIDE = WINDOW // 2
SAMPLE_WINDOWS = 1_000
HIDDEN = 24
EMBEDDED = 16
#: Steps of the fit, however many examples there are.
STEPS = 420
BATCH = 32
SEED = 42
MIN_POSTERIOR = 0.9
CUE = re.compile(r"[0-9@]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(x: str) -> str:
    return "".join(c for c in x if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return sum(values[0::2] + [v * 2 - 9 * (v > 4) for v in values[1::2]]) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign takes the longest local part that no match before it used."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at += 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    out += [(2, *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# --- the network ---------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
_FORBIDDEN = -1e4


def allowed_transitions() -> np.ndarray:
    """0 where one tag may follow another, else a large negative number."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        out[:, inside] = _FORBIDDEN
        out[[inside - 1, inside], inside] = 0
    return out


def char_ids(text: str) -> np.ndarray:
    """Printable ASCII by itself, line feeds, other controls, everything else."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where((code >= 32) & (code < 127), code - 31, np.where(code == 10, 96, np.where(code < 32, 97, 98)))


N_CHARS = 99


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


def _lstm(x: np.ndarray, w: dict[str, np.ndarray], side: str, keep: bool):
    """Hidden states of (steps, batch, in), and what the gradient needs."""
    n, batch, _ = x.shape
    h = c = np.zeros((batch, HIDDEN))
    pre = x @ w[f"x{side}"] + w[f"b{side}"]
    out, saved = np.empty((n, batch, HIDDEN)), []
    for t in range(n):
        z = pre[t] + h @ w[f"h{side}"]
        gates, g = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        before, c = c, f * c + i * g
        tc = np.tanh(c)
        if keep:
            saved.append((h, before, i, f, o, g, tc))
        h = o * tc
        out[t] = h
    return out, saved


def _lstm_gradient(d_out, x, saved, w, side, grads):
    dx = np.empty_like(x)
    dh = dc = np.zeros((x.shape[1], HIDDEN))
    for t in range(len(x) - 1, -1, -1):
        h, before, i, f, o, g, tc = saved[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        grads[f"x{side}"] += x[t].T @ dz
        grads[f"h{side}"] += h.T @ dz
        grads[f"b{side}"] += dz.sum(0)
        dx[t] = dz @ w[f"x{side}"].T
        dh, dc = dz @ w[f"h{side}"].T, dc * f
    return dx


def _logsumexp(x, axis):
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _messages(emissions: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log messages of (steps, batch, tags)."""
    n = len(emissions)
    a, b = np.empty_like(emissions), np.zeros_like(emissions)
    a[0] = emissions[0] + moves[0]  # a stretch starts as after an outside character
    for t in range(1, n):
        a[t] = emissions[t] + _logsumexp(a[t - 1][:, :, None] + moves, 1)
    for t in range(n - 2, -1, -1):
        b[t] = _logsumexp(moves + (emissions[t + 1] + b[t + 1])[:, None, :], 2)
    return a, b


@dataclass
class Tagger:
    """Weights of the network."""

    w: dict[str, np.ndarray]

    def moves(self) -> np.ndarray:
        return self.w["moves"] + allowed_transitions()

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """(steps, batch, tags) of (steps, batch) characters."""
        x = self.w["chars"][ids]
        ahead, _ = _lstm(x, self.w, "f", False)
        back, _ = _lstm(x[::-1], self.w, "r", False)
        return np.concatenate([ahead, back[::-1]], 2) @ self.w["out"] + self.w["bias"]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(kind, start, end) of all decoded spans of a whole text."""
        out = []
        for start, scores in self._stretches(text):
            for kind, a, b in self._decoded(scores):
                if CUE.search(text, start + a, start + b):
                    out.append((kind, start + a, start + b))
        return out

    def _stretches(self, text: str) -> Iterator[tuple[int, np.ndarray]]:
        """Start and blended scores of each connected run of windows with a cue."""
        cues = np.array([m.start() for m in CUE.finditer(text)])
        if not len(cues):
            return
        cell = cues // STRIDE
        first = np.unique(np.concatenate([np.maximum(cell - 1, 0), cell]))
        ids = char_ids(text)
        size = (first[-1] * STRIDE) + WINDOW
        ids = np.concatenate([ids, np.ones(max(0, size - len(ids)), np.int64)])
        edge = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(float)
        for run in np.split(first, np.flatnonzero(np.diff(first) > 2) + 1):
            low = int(run[0]) * STRIDE
            total = np.zeros((int(run[-1]) * STRIDE + WINDOW - low, TAGS))
            weight = np.zeros(len(total))
            for k in range(0, len(run), 256):
                part = run[k : k + 256] * STRIDE
                e = self.emissions(ids[part[None, :] + np.arange(WINDOW)[:, None]])
                for j, p in enumerate(part - low):
                    total[p : p + WINDOW] += e[:, j] * edge[:, None]
                    weight[p : p + WINDOW] += edge
            scores = total / np.maximum(weight, 1e-9)[:, None]
            scores[weight == 0, 1:] = _FORBIDDEN / 10
            yield low, scores[: len(text) - low]

    def _decoded(self, scores: np.ndarray) -> list[tuple[int, int, int]]:
        moves = self.moves()
        best, back = scores[0] + moves[0], []
        for s in scores[1:]:
            ways = best[:, None] + moves
            back.append(ways.argmax(0))
            best = ways.max(0) + s
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        path.reverse()
        found, k = [], 0
        while k < len(path):
            if path[k] % 2 == 1:
                stop = k + 1
                while stop < len(path) and path[stop] == path[k] + 1:
                    stop += 1
                found.append(((path[k] - 1) // 2, k, stop))
                k = stop
            else:
                k += 1
        if not found:
            return []
        a, b = _messages(scores[:, None, :], moves)
        posterior = np.exp(a + b - _logsumexp(a[-1], 1)[None, :, None])[:, 0]
        return [(kind, s, e) for kind, s, e in found if posterior[np.arange(s, e), path[s:e]].mean() >= MIN_POSTERIOR]


def train(examples: list[tuple[str, list[tuple[int, int, int]]]], seed: int = SEED) -> Tagger:
    """Adam on the CRF's log likelihood of windows with labelled spans."""
    rng = np.random.default_rng(seed)
    w = {"chars": rng.normal(0, 0.3, (N_CHARS, EMBEDDED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), "bias": np.zeros(TAGS), "moves": np.zeros((TAGS, TAGS))}
    for side in "fr":
        w |= {f"x{side}": rng.normal(0, EMBEDDED**-0.5, (EMBEDDED, 4 * HIDDEN)), f"h{side}": rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)), f"b{side}": np.zeros(4 * HIDDEN)}
        w[f"b{side}"][HIDDEN : 2 * HIDDEN] = 1
    ids, tags = np.ones((len(examples), WINDOW), np.int64), np.zeros((len(examples), WINDOW), np.int64)
    for k, (text, spans) in enumerate(examples):
        x = char_ids(text[:WINDOW])
        ids[k, : len(x)] = x
        for kind, a, b in spans:
            tags[k, a:b] = 2 + 2 * kind
            if 0 <= a < WINDOW:
                tags[k, a] = 1 + 2 * kind
    tagger = Tagger(w)
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    order = np.concatenate([rng.permutation(len(examples)) for _ in range(-(-STEPS * BATCH // len(examples)))])
    for t in range(1, STEPS + 1):
        rows = order[(t - 1) * BATCH : t * BATCH]
        grads = _gradient(tagger, ids[rows].T, tags[rows].T)
        norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
        rate = 0.02 * (1 - t / STEPS) + 1e-4
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return tagger


def _gradient(tagger: Tagger, ids: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean negative log likelihood of (steps, batch) windows."""
    w, moves = tagger.w, tagger.moves()
    n, batch = ids.shape
    x = w["chars"][ids]
    ahead, kept_f = _lstm(x, w, "f", True)
    back, kept_r = _lstm(x[::-1], w, "r", True)
    states = np.concatenate([ahead, back[::-1]], 2)
    e = states @ w["out"] + w["bias"]
    a, b = _messages(e, moves)
    total = _logsumexp(a[-1], 1)
    d = np.exp(a + b - total[None, :, None])
    grads = {k: np.zeros_like(g) for k, g in w.items()}
    grads["moves"][0] += d[0].sum(0)
    for t in range(1, n):
        pair = a[t - 1][:, :, None] + moves + (e[t] + b[t])[:, None, :] - total[:, None, None]
        grads["moves"] += np.exp(pair).sum(0)
    np.subtract.at(grads["moves"], (np.concatenate([np.zeros((1, batch), int), tags[:-1]]), tags), 1)
    d[np.arange(n)[:, None], np.arange(batch)[None, :], tags] -= 1
    d /= batch
    grads["moves"] /= batch
    grads["out"] = np.einsum("tbh,tbk->hk", states, d)
    grads["bias"] = d.sum((0, 1))
    ds = d @ w["out"].T
    dx = _lstm_gradient(ds[:, :, :HIDDEN], x, kept_f, w, "f", grads)
    dx += _lstm_gradient(ds[::-1, :, HIDDEN:], x[::-1], kept_r, w, "r", grads)[::-1]
    np.add.at(grads["chars"], ids, dx)
    return grads


# --- training stretches --------------------------------------------------------


def _variant(kind: int, rng: np.random.Generator) -> str:
    """Personal data of a kind, written in a way of its own."""
    number = lambda n: "".join(str(int(d)) for d in rng.integers(0, 10, n))
    word = lambda: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, rng.integers(2, 9)))
    pick = lambda *x: x[int(rng.integers(len(x)))]
    if kind == 0:
        return f"{word()}{pick('.', '_', '')}{number(2)}{pick('@', ' @ ', '(@)', ' [at] ')}{word()}{number(1)}{pick('.', '.', ' [dot] ')}{pick('com', 'org', 'net', 'example.com')}"
    if kind == 1:
        return pick(".", ".", "[.]").join(str(int(x)) for x in rng.integers(0, 256, 4))
    if kind == 2:
        d = number(15)
        d += next(c for c in "0123456789" if luhn(d + c))
        return pick("", " ", "-", ".").join(d[k : k + 4] for k in range(0, 16, 4))
    return f"{pick('+' + number(1) + ' ', '+' + number(2) + ' ', '', '00' + number(2) + ' ')}({number(3)}){pick(' ', '')}{number(3)}{pick('-', ' ', '.')}{number(4)}"


def _harmless(rng: np.random.Generator) -> str:
    """Numbers and signs that are no personal data."""
    number = lambda a, b: str(int(rng.integers(a, b)))
    kinds = (
        lambda: number(0, 10**6),
        lambda: f"{number(1900, 2100)}-{number(10, 13)}-{number(10, 29)}",
        lambda: f"{number(1, 9)}.{number(0, 99)}",
        lambda: f"{number(0, 24)}:{number(10, 60)}",
        lambda: f"({number(1, 200)})",
        lambda: "".join("0123456789abcdef"[int(c)] for c in rng.integers(0, 16, int(rng.integers(8, 41)))),
        lambda: f"{number(1, 999)},{number(100, 999)}.{number(10, 99)}",
        lambda: f"v{number(0, 20)}.{number(0, 20)}.{number(0, 20)}",
        lambda: "@" + "".join(chr(97 + int(c)) for c in rng.integers(0, 26, 6)),
        lambda: "".join(str(int(d)) for d in rng.integers(0, 10, int(rng.integers(7, 24)))),
    )
    return kinds[int(rng.integers(len(kinds)))]()


def examples(labelled: list[tuple[str, list[tuple[int, int, int]]]], n_variants: int = SAMPLE_WINDOWS, seed: int = SEED) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """The labelled stretches and as many variants in their surroundings."""
    rng = np.random.default_rng(seed)
    around = [t for t, _ in labelled if t] or ["the text of a page, and more of it. Then a line\nof words"]
    out = [(t[:WINDOW], [(k, a, b) for k, a, b in s if b <= WINDOW]) for t, s in labelled]
    for k in range(n_variants):
        plain = CUE.sub("x", around[int(rng.integers(len(around)))])
        cut = int(rng.integers(0, max(1, min(len(plain), 30))))
        before, after = plain[:cut], plain[cut:]
        if before and before[-1].isalnum():
            before += " "
        if k % 3 == 0:
            out.append(((before + _harmless(rng) + " " + after)[:WINDOW], []))
            continue
        kind = int(rng.integers(len(KINDS)))
        data = _variant(kind, rng)
        out.append(((before + data + " " + after)[:WINDOW], [(kind, len(before), min(WINDOW, len(before) + len(data)))]))
    return out


def labelled_stretches(docs: DataFrame, text_col: str = "text", n: int = SAMPLE_WINDOWS) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """At most ``n`` stretches of ``WINDOW`` characters around pattern matches,
    drawn from all documents by hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text in batch.column("text").to_pylist():
                if not text or not CUE.search(text):
                    continue
                found = base_spans(text)
                for _, a, b in found:
                    low = max(0, a - (a * 7 + b) % 24)
                    here = [(k, s - low, e - low) for k, s, e in found if low <= s and e <= low + WINDOW]
                    texts.append(text[low : low + WINDOW])
                    spans.append([x for s in _apart(here) for x in s])
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.int32()))], ["text", "spans"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(cut, "text string, spans array<int>")
    rows = found.distinct().orderBy(F.xxhash64("text"), "text").limit(n).collect()
    return [(r[0], [tuple(r[1][k : k + 3]) for k in range(0, len(r[1]), 3)]) for r in rows]


def _apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that overlap none before them, in order of their starts."""
    out: list[tuple[int, int, int]] = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        if not out or a >= out[-1][2]:
            out.append((k, a, b))
    return out


def fit_tagger(docs: DataFrame, text_col: str = "text") -> Tagger:
    return train(examples(labelled_stretches(docs, text_col)))


def all_spans(text: str, tagger: Tagger) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Pattern spans, and pattern and added spans, by kind, then start."""
    if not CUE.search(text):
        return [], []
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    more = []
    for k, a, b in tagger.spans(text):
        at = int(np.searchsorted([x[0] for x in taken], b)) if taken else 0
        if not any(a < y for _, y in taken[max(0, at - 4) : at]):
            more.append((k, a, b))
    return base, sorted(base + more)


_PLACE = "struct<kind:string,start:long,end:long>"
_ARROW_PLACES = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_personal_data(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``base`` and ``spans`` (kind, start, end)."""
    model = docs.sparkSession.sparkContext.broadcast(tagger)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]
        for batch in batches:
            base, spans = [], []
            for text in batch.column("text"):
                found, every = all_spans(text.as_py() or "", model.value)
                base.append(named(found))
                spans.append(named(every))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(base, _ARROW_PLACES), pa.array(spans, _ARROW_PLACES)], ["id", "base", "spans"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = d.mapInArrow(rows, f"id {d.schema['id'].dataType.simpleString()}, base array<{_PLACE}>, spans array<{_PLACE}>")
    return out.withColumnRenamed("id", id_col)
