"""Words and their hashes for whole Arrow columns of texts, without a loop over words.

Words are runs of bytes other than space and 0x09 to 0x0D. All functions work on
the UTF-8 bytes of a column; a null counts as an empty text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # texts are worked on in pieces of about this size
PIECE_BYTES = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _random.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3: a bijection that spreads all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def release_memory() -> None:
    """Give what is free back to the system: workers are used again, and wait with all they hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): text ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``size`` bytes of text, one row at least."""
    _, offsets = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end
    release_memory()


def gathered(
    batches: Iterator[pa.RecordBatch], column: str, size: int
) -> Iterator[pa.RecordBatch]:
    """Join consecutive batches until they hold about ``size`` bytes of text."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            total += batch.column(batch.schema.get_field_index(column)).nbytes
        if total >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


@dataclass
class Words:
    """Places of words in ``data``: word ``i`` of all is ``data[starts[i]:ends[i]]``.

    ``first[d]`` is the number of the first word of text ``d``; ``first[-1]`` is
    the number of words. ``doc`` has the text of each word.
    """

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, lower)


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def column_words(column: pa.Array) -> Words:
    return find_words(*text_bytes(column))


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    """A 64-bit hash of each span of bytes; no span may be empty, none may overlap."""
    out = np.zeros(len(starts), np.uint64)
    done = np.cumsum(ends - starts)
    first = 0
    while first < len(starts):  # in pieces, for the sake of memory
        least = done[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(done, least + PIECE_BYTES, "right")))
        out[first:last] = _span_hashes(data, starts[first:last], ends[first:last], lower)
        first = last
    return out


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    lengths = ends - starts
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    place = np.arange(total) - np.repeat(before, lengths)
    value = data[place + np.repeat(starts, lengths)]
    if lower:
        value = _LOWER[value]
    weight = _PLACE[place & 4095]
    if total and place.max() > 4095:  # beyond the table, places repeat with other weights
        weight = weight + (place >> 12).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C16)
    sums = np.add.reduceat(_BYTE[value] * weight, before)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_STEP = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive words, over text ends too."""
    n = max(len(words) - size + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(size if n else 0):
        total += words[k : k + n] * _STEP[k]
    return mix(total)


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, texts) of the windows that lie within one text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    texts = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(before - first[:-1], counts), texts


def ragged(values: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Cut ``values`` into pieces of the given lengths."""
    return np.split(values, np.cumsum(lengths)[:-1]) if len(lengths) else []


def binary_column(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """One binary value for each run of ``lengths[i]`` numbers."""
    values = np.ascontiguousarray(values)
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    offsets *= values.itemsize
    made = pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(values)]
    )
    return made.cast(pa.binary())


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """|a & b| for each a in ``left`` and b in ``right``, over values that both sides have."""
    a, b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)

    def places(sets: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(common, flat)
        ok = common[np.minimum(at, len(common) - 1)] == flat
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        return row[ok], at[ok]

    if not len(common):
        return out
    (ra, ca), (rb, cb) = places(left, a), places(right, b)
    for start in range(0, len(common), 4096):  # dense in strips of bounded width
        width = min(4096, len(common) - start)
        x = np.zeros((len(left), width), np.float32)
        y = np.zeros((len(right), width), np.float32)
        inside = (ca >= start) & (ca < start + width)
        x[ra[inside], ca[inside] - start] = 1
        inside = (cb >= start) & (cb < start + width)
        y[rb[inside], cb[inside] - start] = 1
        out += x @ y.T
    return out
