"""Secret scans: fixed patterns, and Markov models of random and ordinary strings.

Two first-order character models are trained from samples the patterns label:
random strings are the values inside pattern matches, ordinary identifiers are
all other runs of identifier characters that are too short to be a secret; the
longer ones have no label. Both are tables of transition counts over 66 character classes,
summed by Spark over every whole text, so their size does not depend on the data.
A long run of identifier characters is a secret if the random model explains it
better by ``threshold`` nats per character.

Nulls and empty texts have no spans. Repeated rows each get their own result.
Extra columns are kept; result columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.llm.words import slices, text_bytes

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
# A pattern with a least length finds the same as filtering maximal runs does.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
MIN_CANDIDATE = 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_CANDIDATE)
THRESHOLD = 0.75
SMOOTHING = 20

# Character classes of the models: 0 is everything outside identifiers.
_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(_ALPHABET) + 1
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(_ALPHABET)] = np.arange(1, STATES)


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret value) of the pattern matches, in order."""
    found = []
    if ":" in text or "=" in text:
        found += [
            (m.start(), 0, m.end(), m.start(2))
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= MIN_VALUE
        ]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def _long_runs(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which bytes are in a run of at least MIN_CANDIDATE identifier characters."""
    change = np.zeros(len(inside) + 1, bool)
    change[1:-1] = inside[1:] != inside[:-1]
    change[offsets] = True
    edge = np.flatnonzero(change)
    size = np.diff(np.r_[edge, len(inside)])
    return np.repeat(size >= MIN_CANDIDATE, size)[: len(inside)] & inside


def _count_labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, STATES * STATES), np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_bytes(part.column(0))
            random = np.zeros(len(data), bool)
            for k, text in enumerate(part.column(0).to_pylist()):
                if spans := base_spans(text or ""):
                    head = None if len(text) == offsets[k + 1] - offsets[k] else text
                    for _, _, end, value in spans:
                        a, b = value, end
                        if head is not None:  # from code points to bytes
                            a = len(text[:value].encode())
                            b = a + len(text[value:end].encode())
                        random[offsets[k] + a : offsets[k] + b] = True
            if len(data) < 2:
                continue
            state = _CLASS[data].astype(np.int64)
            pair = state[:-1] * STATES + state[1:]
            inside = random[:-1] & random[1:]
            # both characters belong to identifiers, and no text ends between them
            real = (state[:-1] > 0) & (state[1:] > 0)
            real[offsets[(offsets > 0) & (offsets < len(data))] - 1] = False
            counts[1] += np.bincount(pair[real & inside], minlength=STATES * STATES)
            ordinary = real & ~(random[:-1] | random[1:]) & ~_long_runs(state > 0, offsets)[1:]
            counts[0] += np.bincount(pair[ordinary], minlength=STATES * STATES)
    label, pair = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(counts[label, pair])],
        names=["label", "pair", "n"],
    )


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio, random over ordinary, of each transition: [STATES, STATES].

    At most 2 * 66 * 66 counts reach the driver. A model's transitions are smoothed
    by SMOOTHING virtual ones from its characters' own frequencies, and those by one
    virtual sample of each character.
    """
    rows = (
        docs.select("text")
        .mapInArrow(_count_labelled, "label int, pair int, n long")
        .groupBy("label", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros((2, STATES, STATES))
    for row in rows:
        counts[row["label"], row["pair"] // STATES, row["pair"] % STATES] += row["n"]
    single = counts.sum(axis=1, keepdims=True) + 1
    counts += SMOOTHING * single / single.sum(axis=2, keepdims=True)
    log = np.log(counts / counts.sum(axis=2, keepdims=True))
    return log[1] - log[0]


def markov_spans(text: str, ratio: np.ndarray, threshold: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) of long identifier runs that look random."""
    found = []
    for m in CANDIDATE.finditer(text):
        state = _CLASS[np.frombuffer(m.group().encode("latin-1"), np.uint8)]
        mean = ratio[state[:-1], state[1:]].mean()
        if mean >= threshold and len(set(m.group())) >= 8:  # ===== and the like are rules
            found.append((m.start(), 3, m.end()))
    return found


def find_spans(
    text: str | None, ratio: np.ndarray, threshold: float = THRESHOLD
) -> list[tuple[int, int, int]]:
    """All (start, kind, end) by start, then kind; base spans always stay.

    A run that is, or lies in, a base span adds nothing and is left out.
    """
    if not text:
        return []
    base = [(start, kind, end) for start, kind, end, _ in base_spans(text)]
    extra = [
        span
        for span in markov_spans(text, ratio, threshold)
        if not any(start <= span[0] and span[2] <= end for start, _, end in base)
    ]
    return sorted(base + extra)


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("kind", T.StringType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs(text, ...) with ``spans``: array of (start, kind, end), in code points.

    The texts never leave their rows: one pass trains the models, one scans.
    """
    rest = [c for c in docs.columns if c != "spans"]
    ratio = train(docs)
    schema = T.StructType([f for f in docs.schema.fields if f.name != "spans"]).add("spans", SPANS)
    kind_type = pa.list_(
        pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
    )

    def spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"start": s, "kind": KINDS[k], "end": e} for s, k, e in find_spans(t, ratio, threshold)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spans, kind_type)], names=[*rest, "spans"]
            )

    return docs.select(*rest).mapInArrow(spans_of, schema)


def redact(docs: DataFrame, threshold: float = THRESHOLD, mark: str = "[secret]") -> DataFrame:
    """docs with every secret replaced by ``mark``; other texts and columns as they are.

    Overlapping spans become one mark. Null texts stay null.
    """
    ratio = train(docs)

    def clean(text: str | None) -> str | None:
        spans = find_spans(text, ratio, threshold)
        if not spans:
            return text
        out, at = [], 0
        for start, _, end in spans:
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            texts = [clean(t) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(cleaned, docs.schema)
