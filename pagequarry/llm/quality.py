"""Document quality from a linear-chain conditional random field over lines.

A document is a chain of its lines that are not blank, each of them good or bad. A line is
described by shares of kinds of characters, by its words and their repeats, and by the same of
the lines before and after it. The field is trained on documents whose quality is known: all
lines of a document take its label, and each document weighs the same. A document's score is the
mean of its lines' marginal probabilities of being good, weighted by their length.

Forward and backward messages are products of 2 x 2 matrices, one a line, so those of all lines
of a piece of the table come from one segmented prefix scan, however long a text is.

Training reads SAMPLE_DOCS documents at most, those with the least hashes of their ids, and
keeps a few numbers for each line of them as a table. Each step of the optimiser is one
pass over it, which returns a sum of gradients for each task.

Texts without a line that holds a word (nulls and empty texts among them) score the share of good
documents in the sample; without labels it is a half. Labels that repeat an id count by their mean,
null ones not at all. Repeated documents are scored each. Extra columns are kept; result
columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.llm.words import find_words, slices, text_bytes
from pagequarry.session import Workspace

SAMPLE_DOCS = 4000
THRESHOLD = 0.3
STEPS = 60
RIDGE = 1e-3
PARTS = 8  # tasks of a training pass


def _mask(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


_UPPER = _mask((0x41, 0x5A))
_LETTER = _mask((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_CLASSES = [
    _UPPER,
    _mask((0x30, 0x39)),
    _mask((0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B)),  # marks of prose
    _mask((0x21, 0x21), (0x3F, 0x3F)),
    _mask((0x23, 0x26), (0x2A, 0x2B), (0x2F, 0x2F), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7E)),
    _mask((0x20, 0x20), (0x09, 0x09)),
    _mask((0x80, 0xFF)),
]
FEATURES = len(_CLASSES) + 9


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features [lines, FEATURES], bytes of each line, lines of each text) of lines with a word."""
    texts = len(offsets) - 1
    found = find_words(data, offsets)
    inside = data != 0x0A
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    line = np.searchsorted(starts, found.starts, "right") - 1
    words = np.bincount(line, minlength=len(starts))
    held = words > 0
    number = np.cumsum(held) - 1
    starts, ends, words, line = starts[held], ends[held], words[held], number[line]
    size = (ends - starts).astype(float)
    many = len(starts)
    out = np.zeros((many, FEATURES), np.float32)
    counts = np.bincount(np.searchsorted(offsets, starts, "right") - 1, minlength=texts)[:texts]
    if not many:
        return out, size, counts
    for k, table in enumerate(_CLASSES):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=total[1:])
        out[:, k] = (total[ends] - total[starts]) / size
    hashes = found.hashes(lower=True)
    bits = np.uint64(max(1, many.bit_length()))
    key = np.sort(line.astype(np.uint64) << (np.uint64(64) - bits) | hashes >> bits)
    fresh = np.r_[True, key[1:] != key[:-1]]
    distinct = np.bincount((key[fresh] >> (np.uint64(64) - bits)).astype(np.int64), minlength=many)
    again = np.r_[False, (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])]
    length = found.ends - found.starts
    first, last = data[found.starts], data[found.ends - 1]
    k = len(_CLASSES)
    out[:, k] = np.log1p(size)
    out[:, k + 1] = np.log1p(words)
    out[:, k + 2] = np.bincount(line, weights=length, minlength=many) / words
    out[:, k + 3] = distinct / words
    out[:, k + 4] = np.bincount(line, weights=again, minlength=many) / words
    out[:, k + 5] = np.bincount(line, weights=length == 1, minlength=many) / words
    out[:, k + 6] = np.bincount(line, weights=_UPPER[first], minlength=many) / words
    out[:, k + 7] = np.bincount(line, weights=~_LETTER[last], minlength=many) / words
    # a line that repeats the one before it: equal words in equal order
    total = np.bincount(line, weights=(hashes >> np.uint64(40)).astype(float) * (1 + np.arange(len(line)) - np.r_[0, np.cumsum(words)][line]), minlength=many)
    out[1:, k + 8] = (total[1:] == total[:-1]) & (words[1:] == words[:-1])
    head = np.cumsum(counts) - counts
    out[head[counts > 0], k + 8] = 0
    return out, size, counts


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and of the line after (0 beyond an end), and 1."""
    many, width = own.shape
    out = np.zeros((many, 3 * width + 1))
    out[:, :width] = own
    out[1:, width : 2 * width] = own[:-1]
    out[:-1, 2 * width : 3 * width] = own[1:]
    ends = np.cumsum(counts)
    heads = (ends - counts)[counts > 0]
    out[heads, width : 2 * width] = 0
    out[ends[counts > 0] - 1, 2 * width : 3 * width] = 0
    out[:, -1] = 1
    return out


def _scan(m: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of the matrices from the head of each chain to each place, and the logs of their scale."""
    scale = m.max(axis=(1, 2))
    p, log = m / scale[:, None, None], np.log(scale)
    step = 1
    while len(place) and step <= place.max():
        at = np.flatnonzero(place >= step)
        new = p[at - step] @ p[at]
        scale = new.max(axis=(1, 2))
        log_new = log[at - step] + log[at] + np.log(scale)
        p[at], log[at] = new / scale[:, None, None], log_new
        step *= 2
    return p, log


def forward_backward(
    node: np.ndarray, transition: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains of ``counts`` lines: log partition of each chain, P(state) and P(pair) of each line.

    ``node`` [lines, 2] and ``transition`` [2, 2] are log potentials. The pair of a line is that
    with the line before; a head has none, and zeros.
    """
    lines = len(node)
    counts = counts[counts > 0]
    ends = np.cumsum(counts)
    heads = ends - counts
    place = np.arange(lines) - np.repeat(heads, counts)
    top = node.max(axis=1, keepdims=True)
    emit = np.exp(node - top)
    step = np.exp(transition - transition.max())
    m = step[None] * emit[:, None, :]
    m[heads] = emit[heads][:, None, :]
    forward, log = _scan(m, place)
    alpha = forward[:, 0]
    # backward: the transposed products, from the tail
    back = np.ones((lines, 2, 2))
    inner = np.flatnonzero(place[1:] > 0)  # lines that have a next one
    back[inner] = np.transpose(m[inner + 1], (0, 2, 1))
    back[ends - 1] = 1.0
    later = (np.repeat(ends, counts) - 1 - np.arange(lines))[::-1]
    beta = _scan(back[::-1], later)[0][::-1][:, 0]
    state = alpha * beta
    state /= state.sum(axis=1, keepdims=True)
    pair = np.zeros((lines, 2, 2))
    tail = inner + 1
    pair[tail] = alpha[tail - 1][:, :, None] * m[tail] * beta[tail][:, None, :]
    pair[tail] /= pair[tail].sum(axis=(1, 2), keepdims=True)
    # scales that were taken off come back
    shift = np.add.reduceat(top[:, 0], heads) + (counts - 1) * transition.max() if len(counts) else np.zeros(0)
    return log[ends - 1] + np.log(alpha[ends - 1].sum(axis=1)) + shift, state, pair


def loss(weights: np.ndarray, x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of chains whose lines all have the chain's label, and its gradient.

    Each chain counts by one over its number of lines. Weights: one a feature, for the state good,
    then the four transitions.
    """
    width = x.shape[1]
    node = np.zeros((len(x), 2))
    node[:, 1] = x @ weights[:width]
    labels, counts = labels[counts > 0], counts[counts > 0]
    logz, state, pair = forward_backward(node, weights[width:].reshape(2, 2), counts)
    share = 1 / counts
    own = np.repeat(labels, counts)
    inner = np.ones(len(x), bool)
    inner[np.cumsum(counts) - counts] = False
    kept = np.where(labels == 1, weights[width + 3], weights[width]) * (counts - 1)
    gold = np.bincount(np.repeat(np.arange(len(counts)), counts), weights=node[:, 1] * own, minlength=len(counts)) + kept
    line_share = np.repeat(share, counts)
    grad = np.zeros(width + 4)
    grad[:width] = x.T @ ((state[:, 1] - own) * line_share)
    expected = (pair[inner] * line_share[inner][:, None, None]).sum(axis=0)
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = line_share[inner & (own == k)].sum()
    grad[width:] = (expected - seen).ravel()
    return float(((logz - gold) * share).sum()), grad


def minimise(f, x: np.ndarray, steps: int = STEPS, memory: int = 10) -> np.ndarray:
    """Limited-memory BFGS with halved steps; ``f`` gives a value and a gradient."""
    value, grad = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(grad).max() < 1e-4:
            break
        q, kept = grad.copy(), []
        for s, y in reversed(pairs):
            a = s @ q / (s @ y)
            kept.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= s @ y / (y @ y)
        for (s, y), a in zip(pairs, reversed(kept)):
            q += s * (a - y @ q / (s @ y))
        size = 1.0 if pairs else min(1.0, 1 / np.abs(grad).sum())
        for _ in range(12):
            new_value, new_grad = f(x - size * q)
            if new_value <= value - 1e-4 * size * (grad @ q):
                break
            size /= 2
        else:
            break
        s, y = -size * q, new_grad - grad
        close = value - new_value < 1e-6 * max(abs(value), 1e-12)
        x, value, grad = x + s, new_value, new_grad
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        if close:
            break
    return x


@dataclass(frozen=True)
class Field:
    """A trained field: features are centred and scaled, then weighed."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    prior: float

    def scaled(self, own: np.ndarray) -> np.ndarray:
        return (own - self.mean) / self.deviation

    def score(self, own: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the lines' marginals, for each text."""
        out = np.full(len(counts), self.prior)
        if not len(own) or not len(self.weights):
            return out
        x = with_neighbours(self.scaled(own), counts)
        node = np.zeros((len(x), 2))
        node[:, 1] = x @ self.weights[: x.shape[1]]
        _, state, _ = forward_backward(node, self.weights[x.shape[1] :].reshape(2, 2), counts)
        doc = np.repeat(np.arange(len(counts)), counts)
        good = np.bincount(doc, weights=state[:, 1] * size, minlength=len(counts))
        total = np.bincount(doc, weights=size, minlength=len(counts))
        some = counts > 0
        out[some] = np.clip(good[some] / total[some], 0, 1)
        return out


def _sampled(docs: DataFrame, labels: DataFrame, ws: Workspace, sample: int) -> DataFrame:
    """(label, lines, features binary) of documents with the least hashes of labelled ids."""
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = known.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    least = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    least = ws.save(least, "sample")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own, _, counts = line_features(*text_bytes(part.column("text")))
                at = np.r_[0, np.cumsum(counts)]
                packed = [own[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(counts, pa.int32()), pa.array(packed, pa.binary())],
                    names=["label", "lines", "features"],
                )

    # at most ``sample`` ids are broadcast
    chosen = docs.select("doc_id", "text").join(F.broadcast(least), "doc_id").select("label", "text")
    made = chosen.mapInArrow(described, "label int, lines int, features binary")
    return ws.save(made.repartition(PARTS), "described")


def _passed(table: DataFrame, partial) -> np.ndarray:
    """Sum over tasks of the vectors ``partial`` makes of (labels, counts, features), in a fixed order."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            counts = batch.column("lines").to_numpy().astype(np.int64)
            x = np.frombuffer(b"".join(batch.column("features").to_pylist()), np.float32).reshape(-1, FEATURES)
            total = total + partial(batch.column("label").to_numpy().astype(float), counts, x.astype(float))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["data"])

    parts = table.mapInArrow(own, "data binary").withColumn("part", F.spark_partition_id()).collect()
    return sum((np.frombuffer(r["data"]) for r in sorted(parts, key=lambda r: r["part"])), np.zeros(1))


def train(docs: DataFrame, labels: DataFrame, ws: Workspace, sample: int = SAMPLE_DOCS, steps: int = STEPS) -> Field:
    """A field from docs(doc_id, text) and labels(doc_id, label 0 or 1)."""
    table = _sampled(docs, labels, ws, sample)

    def moments(own: np.ndarray, counts: np.ndarray, x: np.ndarray) -> np.ndarray:
        w = np.repeat(1 / np.maximum(counts, 1), counts)[:, None]
        return np.r_[len(own), own.sum(), w.sum(), (w * x).sum(axis=0), (w * x * x).sum(axis=0)]

    sums = _passed(table, moments)
    if len(sums) == 1:
        return Field(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(0), 0.5)
    documents, good, lines = sums[:3]
    prior = (good + 1) / (documents + 2)
    if not lines:
        return Field(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(0), float(prior))
    mean = sums[3 : 3 + FEATURES] / lines
    spread = np.sqrt(np.maximum(sums[3 + FEATURES :] / lines - mean**2, 0))
    field = Field(mean, np.where(spread > 1e-6, spread, 1.0), np.zeros(0), float(prior))

    def objective(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def partial(own: np.ndarray, counts: np.ndarray, x: np.ndarray) -> np.ndarray:
            value, grad = loss(weights, with_neighbours(field.scaled(x), counts), counts, own)
            return np.r_[value, grad]

        total = _passed(table, partial) / documents
        return total[0] + RIDGE / 2 * weights @ weights, total[1:] + RIDGE * weights

    weights = minimise(objective, np.zeros(3 * FEATURES + 1 + 4), steps)
    return Field(field.mean, field.deviation, weights, field.prior)


def score(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """docs(text, ...) with score (0 to 1) and predicted (1 from ``threshold`` on)."""
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([f for f in docs.schema.fields if f.name in rest]).add("score", "double").add("predicted", "integer")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = field.score(*line_features(*text_bytes(part.column("text"))))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(made), pa.array((made >= threshold).astype(np.int32))],
                    names=[*rest, "score", "predicted"],
                )

    return docs.select(*rest).mapInArrow(scored, schema)
