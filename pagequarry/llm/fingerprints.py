"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

A paragraph (the text between line ends) is hashed to a wide vector; a document's
fingerprint is the sum of its paragraphs' vectors. 128 lanes from SHAKE-128 are
summed modulo 2**16: they tell multisets apart, whatever the order. 256 more lanes,
also modulo 2**16, are a signed count sketch of the paragraph's runs of three
words: their cosine estimates how much of two documents is the same. Both parts
are sums, so paragraphs can be added and taken away without the rest of the text.

A null counts as an empty text, which has one empty paragraph. Ids are taken in
ascending order, nulls first; rows with the same id in order of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagequarry.llm.ranges import id_bounds
from pagequarry.llm.words import find_words, mix, window_hashes

EXACT, NEAR = 128, 256
LANES = EXACT + NEAR
SHINGLE = 3


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of LANES numbers of 16 bits for each text."""
    out = np.zeros((len(texts), LANES), np.uint16)
    lines: list[bytes] = []
    owner: list[int] = []
    for k, text in enumerate(texts):
        parts = text.encode("utf-8", "surrogatepass").split(b"\n")
        vectors = b"".join(hashlib.shake_128(p).digest(2 * EXACT) for p in parts)
        exact = np.frombuffer(vectors, "<u2").reshape(-1, EXACT)
        out[k, :EXACT] = exact.sum(axis=0, dtype=np.uint16)
        lines += parts
        owner += [k] * len(parts)
    if texts:
        out[:, EXACT:] = _near(lines, np.array(owner), len(texts))
    return out


def _near(lines: list[bytes], owner: np.ndarray, n: int) -> np.ndarray:
    data = np.frombuffer(b"".join(lines), np.uint8)
    offsets = np.zeros(len(lines) + 1, np.int64)
    np.cumsum([len(x) for x in lines], out=offsets[1:])
    words = find_words(data, offsets)
    counts, hashes = words.counts, words.hashes()
    # a short paragraph is one run of the words it has
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    first = words.first[short]
    both = hashes[first] + np.where(counts[short] == 2, hashes[np.minimum(first + 1, len(hashes) - 1)] * np.uint64(3), np.uint64(0)) if len(short) else np.zeros(0, np.uint64)
    runs = window_hashes(hashes, SHINGLE)
    line = words.doc
    inside = line[: len(runs)] == line[SHINGLE - 1 :] if len(runs) else np.zeros(0, bool)
    value = np.concatenate([runs[inside], mix(both)])
    who = owner[np.concatenate([line[: len(runs)][inside], short])].astype(np.int64)
    lane = (value % np.uint64(NEAR)).astype(np.int64)
    sign = np.where(value >> np.uint64(63), 1.0, -1.0)
    sums = np.bincount(who * NEAR + lane, weights=sign, minlength=n * NEAR)
    return sums.astype(np.int64).reshape(n, NEAR).astype(np.uint16)


def updated(before: np.ndarray, inserted: list[str], deleted: list[str]) -> np.ndarray:
    """Fingerprints after paragraphs came and went: one text of either for each row."""
    return before + fingerprints(inserted) - fingerprints(deleted)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of rows, 1 if equal, else the estimated cosine, not below 0."""
    x, y = (v[:, EXACT:].astype(np.int16).astype(np.float64) for v in (a, b))
    norm = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = np.divide((x * y).sum(axis=1), norm, out=np.zeros(len(x)), where=norm > 0)
    return np.where((a == b).all(axis=1), 1.0, np.clip(cosine, 0.0, 1.0))


def fingerprint_column(texts: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint`` (binary, LANES little-endian numbers of 16 bits) to each row."""
    rest = [c for c in texts.columns if c != "fingerprint"]
    schema = texts.select(*rest).schema.add("fingerprint", "binary")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = fingerprints([t or "" for t in batch.column(text).to_pylist()])
            column = pa.array([r.astype("<u2").tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*rest, "fingerprint"])

    return texts.select(*rest).mapInArrow(add, schema)


_LEAST = np.iinfo(np.int64).min


def map_neighbours(
    docs: DataFrame, compare: Callable[[list, list, list], dict[str, list]], schema: str
) -> DataFrame:
    """Rows of ``compare(ids, texts, next texts)`` for each row of docs(doc_id, text) and its next.

    Ranges of ids become buckets; the texts are shuffled once, by bucket, and
    streamed through in order. The first row of each bucket also visits the one
    before it. Only the bounds of the ranges, one id for each, reach the driver.
    """
    spark = docs.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = id_bounds(docs, wanted, int(_LEAST))
    if not len(bounds):
        return spark.createDataFrame([], schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(int(_LEAST)).to_numpy(zero_copy_only=False)
            bucket = np.searchsorted(bounds, ids, "right") - 1
            visits = np.flatnonzero(bounds[bucket] == ids)
            take = np.concatenate([np.arange(len(ids)), visits])
            where = np.concatenate([bucket, (bucket[visits] - 1) % len(bounds)])
            guest = np.concatenate([np.zeros(len(ids), bool), np.ones(len(visits), bool)])
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(take)).columns, pa.array(where, pa.int32()), pa.array(guest)],
                names=["doc_id", "text", "bucket", "guest"],
            )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple = ()  # the row before
        for batch in batches:
            ids, texts, buckets, guests = (c.to_pylist() for c in batch.columns)
            pairs: list[tuple] = []
            for row in zip(ids, texts, buckets, guests):
                if kept and kept[2] == row[2] and not kept[3]:
                    pairs.append((kept[0], kept[1], row[1]))
                kept = row
            yield from packed(pairs)

    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def packed(pairs: list[tuple], rows: int = 500, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
        start = 0
        while start < len(pairs):
            end, size = start, 0
            while end < len(pairs) and end - start < rows and (size < most or end == start):
                size += len(pairs[end][1]) + len(pairs[end][2])
                end += 1
            made = compare(*(list(x) for x in zip(*pairs[start:end])))
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)
            start = end

    shape = "doc_id long, text string, bucket int, guest boolean"
    return (
        docs.mapInArrow(deal, shape)
        .repartition(wanted, "bucket")
        .sortWithinPartitions("bucket", "guest", "doc_id", "text")
        .mapInArrow(walk, schema)
    )
