"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a small network by the
non-negative unbiased risk: with class prior p, the risk of the negatives is
R_u(-) - p R_p(-), and where a batch makes it negative the step goes the other
way. The prior is estimated from the same sample: a classifier of positives
against unlabelled text is fitted first, and the prior is the least ratio of the
two groups above any threshold, each with its confidence margin.

The fit uses at most ``SAMPLE_POSITIVE`` positives and ``SAMPLE_UNLABELLED``
unlabelled rows, drawn by the hash of the id; their features, not their texts,
reach the driver. Every document is then scored where it lies, over its whole
text.

Cases: null and empty texts have zero features and get a score like any other;
ids with contradicting labels are not trusted; a null id is never trusted nor
held out; without a positive or without unlabelled rows every score is 0.5;
repeated rows get equal scores. Only id and text are read; labels enter the fit
alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.llm.text import NOT_BLANK, column_bytes, row_ranges, word_hashes, word_spans

SAMPLE_POSITIVE = 20_000
SAMPLE_UNLABELLED = 20_000
HIDDEN = 24
EPOCHS = 60
BATCH = 512
SEED = 42
BATCH_BYTES = 4 << 20

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "line": b"\n",
    "blank": b" \t\r\x0b\x0c",
    "stop": b".",
    "comma": b",;:",
    "shout": b"!?",
    "symbol": b"#*$%&<>|",
    "bar": b"|",
    "mark": b"\"'()[]{}-_/\\=+@^~`",
    "other": bytes(range(128, 256)),
}
_MEMBER = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASSES.items()}
FEATURES = [
    *(f"share_{k}" for k in _CLASSES),
    "log_bytes",
    "log_words",
    "word_bytes",
    "word_bytes_sd",
    "shouted_words",
    "capital_words",
    "symbol_words",
    "next_equal",
    "distinct_words",
    "distinct_lines",
    "log_line_words",
    "empty_lines",
]


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of numbers for each whole text."""
    data, offsets = column_bytes(texts)
    found = [_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in row_ranges(offsets, BATCH_BYTES)]
    return np.concatenate(found) if found else np.zeros((0, len(FEATURES)))


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    sums = {k: np.concatenate([[0], np.cumsum(m[data], dtype=np.int64)]) for k, m in _MEMBER.items()}
    out = [np.diff(s[offsets]) / size for s in sums.values()]
    starts, ends, rows = word_spans(data, offsets, NOT_BLANK)
    words = np.diff(rows)
    doc = np.repeat(np.arange(n), words)
    per_word = lambda x: np.bincount(doc, weights=x, minlength=n) / np.maximum(words, 1)
    length = (ends - starts).astype(float)
    mean = per_word(length)
    upper, lower = (sums[k][ends] - sums[k][starts] for k in ("upper", "lower"))
    hashes = word_hashes(data, starts, ends)
    equal = np.zeros(len(starts), bool)
    equal[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    distinct = np.array([len(np.unique(hashes[rows[i] : rows[i + 1]])) for i in range(n)])
    lines = [data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n") for i in range(n)]
    out += [
        np.log1p(np.diff(offsets)),
        np.log1p(words),
        mean,
        np.sqrt(np.maximum(per_word(length * length) - mean * mean, 0)),
        per_word((upper > 1) & (lower == 0)),
        per_word(_MEMBER["upper"][data[starts]] if len(starts) else np.zeros(0)),
        per_word(_MEMBER["symbol"][last] | _MEMBER["shout"][last]),
        per_word(equal),
        distinct / np.maximum(words, 1),
        np.array([len(set(x)) / len(x) for x in lines]),
        np.log1p(words / np.array([len(x) for x in lines])),
        np.array([sum(not y.strip() for y in x) / len(x) for x in lines]),
    ]
    return np.stack(out, 1)


@dataclass
class Network:
    """Standardised features, one hidden layer, one output (positive: good)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float = 0.5

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def output(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh(self.standard(x) @ w1 + b1) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.output(x))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _trained(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int) -> Network:
    """Adam on the non-negative risk, or (no prior) on plain log loss of
    positives against unlabelled rows."""
    rng = np.random.default_rng(seed)
    every = np.concatenate([positive, unlabelled])
    net = Network(every.mean(0), every.std(0) + 1e-6, [])
    d = every.shape[1]
    w = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    p_all, u_all = net.standard(positive), net.standard(unlabelled)
    batches = max(1, -(-len(u_all) // BATCH))
    t = 0
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS) + 1e-4
        p_order = np.resize(rng.permutation(len(p_all)), batches * max(1, min(BATCH, len(p_all))))
        for p_rows, u_rows in zip(np.array_split(p_order, batches), np.array_split(rng.permutation(len(u_all)), batches), strict=True):
            x = np.concatenate([p_all[p_rows], u_all[u_rows]])
            a = np.tanh(x @ w[0] + w[1])
            z = a @ w[2] + w[3][0]
            is_p = np.arange(len(x)) < len(p_rows)
            if prior is None:
                g = (sigmoid(z) - is_p) * np.where(is_p, 0.5 / len(p_rows), 0.5 / len(u_rows))
            else:
                s = sigmoid(z)
                slope = s * (1 - s)
                # Sigmoid loss: of a positive 1 - s, of a negative s.
                negative = s[~is_p].mean() - prior * s[is_p].mean()
                to_negative = np.where(is_p, -prior / len(p_rows), 1 / len(u_rows)) * slope
                g = -to_negative if negative < 0 else np.where(is_p, -prior / len(p_rows), 0.0) * slope + to_negative
            ga = np.outer(g, w[2]) * (1 - a * a)
            grads = [x.T @ ga + 1e-5 * w[0], ga.sum(0), a.T @ g + 1e-5 * w[2], np.array([g.sum()])]
            t += 1
            for k, grad in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                w[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    net.weights = w
    return net


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among unlabelled rows from the scores of both: the
    least upper-confidence ratio of their shares above a threshold."""
    p, u = np.sort(positive), np.sort(unlabelled)
    at = np.unique(p)
    above_p, above_u = 1 - np.searchsorted(p, at) / len(p), 1 - np.searchsorted(u, at) / len(u)
    margin = np.sqrt(np.log(4 / delta) / (2 * len(p))) + np.sqrt(np.log(4 / delta) / (2 * len(u)))
    k = int(np.argmin((above_u + margin) / above_p))
    return float(np.clip(above_u[k] / above_p[k], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = SEED) -> Network:
    """Prior first (fitted on one half, estimated on the other), then the
    non-negative risk on all rows."""
    if not len(positive) or not len(unlabelled):
        d = len(FEATURES)
        return Network(np.zeros(d), np.ones(d), [np.zeros((d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)])
    rng = np.random.default_rng(seed)
    p, u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
    a, b = (len(p) + 1) // 2, (len(u) + 1) // 2
    half = _trained(positive[p[:a]], unlabelled[u[:b]], None, seed)
    rest_p, rest_u = (p[a:], u[b:]) if len(p) > 1 and len(u) > 1 else (p, u)
    prior = estimated_prior(half.output(positive[rest_p]), half.output(unlabelled[rest_u]))
    net = _trained(positive, unlabelled, prior, seed + 1)
    net.prior = prior
    return net


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sampled(ids: DataFrame, n: int) -> DataFrame:
    return ids.where("id IS NOT NULL").distinct().orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(n)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Network:
    """The classifier from the labels of the rows that are not held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("q")).where(~held_out(F.col("id")))
    trusted = known.groupBy("id").agg(F.min("q").alias("q")).where("q = 1").select("id")
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # Both id lists are bounded by the sample sizes.
    roles = _sampled(trusted, SAMPLE_POSITIVE).withColumn("role", F.lit(1)).union(_sampled(d.select("id").where(~held_out(F.col("id"))), SAMPLE_UNLABELLED).withColumn("role", F.lit(0)))
    chosen = d.join(F.broadcast(roles.groupBy("id").agg(F.collect_set("role").alias("roles"))), "id").select("id", "text", "roles")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("roles"), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))], ["id", "roles", "x"])

    kind = d.schema["id"].dataType.simpleString()
    rows = chosen.mapInArrow(features, f"id {kind}, roles array<int>, x array<float>").toArrow().sort_by("id")
    if not rows.num_rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros((0, len(FEATURES))))
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)).astype(float)
    roles = rows["roles"].to_pylist()
    return fit(x[[1 in r for r in roles]], x[[0 in r for r in roles]])


def score_documents(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``score`` and ``predicted``."""
    model = docs.sparkSession.sparkContext.broadcast(net)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.value.score(text_features(batch.column("text"))))], ["id", "score"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = d.mapInArrow(scored, f"id {d.schema['id'].dataType.simpleString()}, score double")
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
