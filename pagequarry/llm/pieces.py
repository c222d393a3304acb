"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Symbols are merged by an agenda of candidate merges, best score first, ties from
the left. With dropout, a candidate is skipped for good if a keyed hash of it is
below ``alpha``: the hash knows the seed, the word, its document and place, and the
places merged, so every occurrence drops on its own and a run can be repeated on any
cluster. Without dropout the ids are the library's own. Any segmentation decodes to
the whole text.

Each distinct word of a piece of a table, with its leading spaces, is merged once without
dropout. Occurrences that skip none of these merges take its ids; the others share
their state until a candidate is skipped in some and merged in others, so work is done once
for each distinct path, all at once as arrays; words over LOCKSTEP characters by a heap.

Null and empty texts have no ids. A U+2581 in a text, which the format uses for
spaces, is written as bytes and so is not lost. Lone surrogates cannot be in a
table's text. Extra columns are kept; ``ids`` replaces a column of that name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.llm.tokens import spread
from pagequarry.llm.words import gathered, mix, slices, span_hashes, text_bytes

ALPHA = 0.1
SEED = 1
ENCODED_BYTES = 4 << 20  # of text at once: words repeat
LOCKSTEP = 32
CHUNK = 100_000  # occurrences at once
_SPACE = "▁"
_NEVER = np.iinfo(np.int32).max
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Merges and pieces of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.size = size
        pieces = [sp.id_to_piece(k) for k in range(size)]
        normal = [
            k for k in range(size)
            if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k) or sp.is_byte(k))
        ]
        if any(_SPACE in p.lstrip(_SPACE) for p in (pieces[k] for k in normal)):
            raise ValueError("pieces that go on after a space are not supported")
        self.bytes = np.zeros(256, np.int64)
        spelled = [b""] * size
        for k in range(size):
            if sp.is_byte(k):
                value = int(pieces[k][3:-1], 16)
                self.bytes[value], spelled[k] = k, bytes([value])
        by_text = {pieces[k]: k for k in normal}
        for k in normal:
            spelled[k] = pieces[k].replace(_SPACE, " ").encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        # a character is its piece, or -1
        singles = {ord(p): k for p, k in by_text.items() if len(p) == 1}
        self.characters = np.full(0x110000, -1, np.int32)
        self.characters[list(singles)] = list(singles.values())
        order = sorted({sp.get_score(k) for k in normal}, reverse=True)
        place = {score: n for n, score in enumerate(order)}
        self.rank = np.full(size, _NEVER, np.int32)
        for k in normal:
            self.rank[k] = place[sp.get_score(k)]
        keys, merged = [], []
        for piece, k in by_text.items():
            for cut in range(1, len(piece)):
                a, b = by_text.get(piece[:cut]), by_text.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a * size + b)
                    merged.append(k)
        # a hash table with open addresses, at most a quarter full
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        self.keys = np.full(1 << int(64 - self.shift), -1, np.int64)
        self.merged = np.full(len(self.keys), -1, np.int32)
        for key, k, slot in zip(keys, merged, self._slots(np.array(keys, np.int64)).tolist()):
            while self.keys[slot] >= 0:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.merged[slot] = key, k

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _ODD) >> self.shift).astype(np.int64)

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that a and b make, or -1."""
        key = np.ascontiguousarray(a.astype(np.int64) * self.size + b)
        slot = self._slots(key)
        there = self.keys[slot]
        made = np.where((there == key) & (a >= 0) & (b >= 0), self.merged[slot], -1)
        others = np.nonzero((there != key) & (there >= 0) & (a >= 0) & (b >= 0))
        key, slot = key[others], slot[others]
        while len(key):
            slot = (slot + 1) % len(self.keys)
            there = self.keys[slot]
            made[others] = np.where(there == key, self.merged[slot], -1)
            on = (there != key) & (there >= 0)
            others, key, slot = tuple(x[on] for x in others), key[on], slot[on]
        return made


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _places(start, middle, end) -> np.ndarray:
    """A hash of the merge of [start, middle) and [middle, end)."""
    a, b, c = (np.asarray(x).astype(np.uint64) for x in (start, middle, end))
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + mix(b * np.uint64(0xC2B2AE3D27D4EB4F) + c))


def _dropped(keys: np.ndarray, places: np.ndarray, alpha: float) -> np.ndarray:
    """Is the merge of these places skipped in the occurrences of these keys? Both are mixed already."""
    if alpha >= 1:
        return np.ones(np.broadcast_shapes(keys.shape, places.shape), bool)
    return (keys ^ places) * _ODD < np.uint64(alpha * 2.0**64)


def segment_long(symbols: list[int], key: int, alpha: float, v: Vocabulary) -> list[tuple[int, int, int]]:
    """(id, start, end) of each piece of one word, by a heap."""
    n = len(symbols)
    ids, end = list(symbols), list(range(1, n + 1))
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[int, int, int, int, int]] = []
    word = np.array([key], np.uint64)

    def offer(i: int) -> None:
        j = after[i]
        if j >= n or ids[i] < 0 or ids[j] < 0:
            return
        made = int(v.merge(np.array([ids[i]]), np.array([ids[j]]))[0])
        if made >= 0 and not _dropped(word, _places([i], [j], [end[j]]), alpha)[0]:
            heapq.heappush(heap, (int(v.rank[made]), i, j, end[j], made))

    for i in range(n - 1):
        offer(i)
    gone = [False] * n
    while heap:
        _, i, j, stop, made = heapq.heappop(heap)
        if gone[i] or gone[j] or after[i] != j or end[j] != stop:
            continue
        ids[i], end[i], gone[j] = made, stop, True
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [(ids[i], i, end[i]) for i in range(n) if not gone[i]]


def segment(symbols: np.ndarray, sizes: np.ndarray, keys: np.ndarray, alpha: float, v: Vocabulary) -> np.ndarray:
    """Ids [words, width] of words given as rows of symbols, -2 where there is none."""
    ids, _, path = segment_paths(symbols, sizes, np.arange(len(symbols)), keys, alpha, v)
    return ids[path]


def _offers(ids: np.ndarray, at: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(rank, piece) of the pairs at the places ``at`` of each row."""
    row = np.arange(len(ids))[:, None]
    made = v.merge(ids[row, at], ids[row, at + 1])
    return np.where(made >= 0, v.rank[made], _NEVER), made


def _state(symbols: np.ndarray, sizes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, ...]:
    """(ids, start of each piece, rank and piece of each pair) of words as rows of symbols."""
    n, width = symbols.shape
    ids = np.where(np.arange(width) < sizes[:, None], symbols, -2).astype(np.int32)
    start = np.minimum(np.arange(width + 1, dtype=np.int32), sizes[:, None].astype(np.int32))
    return ids, start, *_offers(ids, np.broadcast_to(np.arange(width - 1), (n, width - 1)), v)


def _place_of(start: np.ndarray, best: np.ndarray) -> np.ndarray:
    here = np.arange(len(start))
    return _places(start[here, best], start[here, best + 1], start[here, np.minimum(best + 2, start.shape[1] - 1)])


def _merged(state: tuple[np.ndarray, ...], best: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, ...]:
    """The state after each row has merged the pair at ``best``."""
    ids, start, rank, made = state
    width = ids.shape[1]
    at = best[:, None]
    column, symbol, edge = np.arange(width - 1), np.arange(width), np.arange(width + 1)
    new = np.take_along_axis(made, at, axis=1)
    ids = np.take_along_axis(ids, np.minimum(symbol + (symbol > at), width - 1), axis=1)
    np.put_along_axis(ids, at, new, axis=1)
    ids[:, -1] = -2
    start = np.take_along_axis(start, np.minimum(edge + (edge > at), width), axis=1)
    move = np.minimum(column + (column >= at), width - 2)
    rank, made = np.take_along_axis(rank, move, axis=1), np.take_along_axis(made, move, axis=1)
    rank[:, -1] = _NEVER
    near = np.concatenate([np.maximum(at - 1, 0), np.minimum(at, width - 2)], axis=1)
    r, m = _offers(ids, near, v)
    np.put_along_axis(rank, near, r, axis=1)
    np.put_along_axis(made, near, m, axis=1)
    return ids, start, rank, made


def segment_plain(symbols: np.ndarray, sizes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, hash of the place of each merge, number of merges) of words without dropout."""
    n, width = symbols.shape
    if width < 2:
        ids = np.where(np.arange(width) < sizes[:, None], symbols, -2).astype(np.int32)
        return ids, np.zeros((n, 0), np.uint64), np.zeros(n, np.int64)
    out, places, many = np.full((n, width), -2, np.int32), np.zeros((n, width - 1), np.uint64), np.zeros(n, np.int64)
    state, word = _state(symbols, sizes, v), np.arange(n)
    for turn in range(width):
        best = state[2].argmin(axis=1)
        open_ = state[2][np.arange(len(word)), best] < _NEVER
        out[word[~open_]] = state[0][~open_]
        many[word[~open_]] = turn
        word, best, state = word[open_], best[open_], tuple(x[open_] for x in state)
        if not len(word):
            break
        places[word, turn] = _place_of(state[1], best)
        state = _merged(state, best, v)
    return out, places, many


def segment_paths(
    symbols: np.ndarray, sizes: np.ndarray, words: np.ndarray, keys: np.ndarray, alpha: float, v: Vocabulary
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids [paths, width], word of each path, path of each occurrence).

    Words are rows of symbols; ``words`` and ``keys`` have an entry for each occurrence.
    Symbols without a piece stay as -1, and there is -2 where there is none. The first
    paths are the words without dropout, for occurrences that skip none of its merges.
    For the others, in each round every path tries its best candidate; occurrences that
    skip it part from it.
    """
    plain, places, many = segment_plain(symbols, sizes, v)
    path = words.astype(np.int64)
    active = np.arange(len(words))  # occurrences that skip nothing so far
    skips = np.zeros(len(words), bool)
    for turn in range(places.shape[1] if alpha > 0 else 0):
        active = active[many[words[active]] > turn]
        gone = _dropped(keys[active], places[words[active], turn], alpha)
        skips[active[gone]] = True
        active = active[~gone]
    active = np.flatnonzero(skips)
    if not len(active):
        return plain, np.arange(len(symbols)), path
    some, node = np.unique(words[active], return_inverse=True)  # row of each open occurrence
    word, keys = some, keys[active]
    state = _state(symbols[some], sizes[some], v)
    done, number = [(plain, np.arange(len(symbols)))], len(symbols)
    while len(word):
        best = state[2].argmin(axis=1)
        open_ = state[2][np.arange(len(word)), best] < _NEVER
        if not open_.all():
            done.append((state[0][~open_], word[~open_]))
            goes = open_[node]
            path[active[~goes]] = number + (np.cumsum(~open_) - 1)[node[~goes]]
            number += len(done[-1][1])
            active, keys, node = active[goes], keys[goes], (np.cumsum(open_) - 1)[node[goes]]
            word, best, state = word[open_], best[open_], tuple(x[open_] for x in state)
            if not len(word):
                break
        child = node * 2 + _dropped(keys, _place_of(state[1], best)[node], alpha)
        taken = np.zeros(2 * len(word), bool)
        taken[child] = True
        kept, skipped = np.flatnonzero(taken[::2]), np.flatnonzero(taken[1::2])
        number_of = np.zeros(2 * len(word), np.int64)
        number_of[2 * kept] = np.arange(len(kept))
        number_of[2 * skipped + 1] = len(kept) + np.arange(len(skipped))
        node = number_of[child]
        merged = _merged(tuple(x[kept] for x in state), best[kept], v)
        rest = tuple(x[skipped] for x in state)
        rest[2][np.arange(len(skipped)), best[skipped]] = _NEVER
        word = np.concatenate([word[kept], word[skipped]])
        state = tuple(np.concatenate(pair) for pair in zip(merged, rest))
    return np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done]), path


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a word with its leading spaces begins: at a space after another character."""
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
    cut[offsets] = True
    cut[-1] = False
    return np.flatnonzero(cut)


def encode_texts(
    data: np.ndarray, offsets: np.ndarray, docs: np.ndarray, path: str,
    alpha: float = ALPHA, seed: int = SEED,
) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in order, number of ids of each). ``docs`` is a 64-bit name of each text."""
    return encode_both(data, offsets, docs, path, alpha, seed)[0]


def encode_both(
    data: np.ndarray, offsets: np.ndarray, docs: np.ndarray, path: str,
    alpha: float = ALPHA, seed: int = SEED,
) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """What :func:`encode_texts` gives with ``alpha``, and without dropout."""
    v = vocabulary(path)
    starts = word_starts(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        return none, none
    ends = np.r_[starts[1:], len(data)]
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    head = np.zeros(len(starts), bool)  # the first word of a text gets a space
    head[first[:-1][np.diff(first) > 0]] = True
    key = span_hashes(data, starts, ends) ^ np.where(head, np.uint64(0xD6E8FEB86659FD93), np.uint64(0))
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order][1:] != key[order][:-1]]
    one, many = order[new], np.diff(np.r_[np.flatnonzero(new), len(order)])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    if alpha > 0:
        place = (np.arange(len(starts)) - first[doc]).astype(np.uint64)
        key = mix(key ^ mix(docs[doc] ^ mix(place + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))))
    # the distinct words in a row, as characters
    lengths = (ends - starts)[one]
    text = spread(data, starts[one], lengths)
    text = np.insert(text, (np.cumsum(lengths) - lengths)[head[one]], 0x20)
    ends = np.cumsum(lengths + head[one])
    code = np.frombuffer(text.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    characters = np.r_[0, np.cumsum((text & 0xC0) != 0x80)]
    at = characters[ends - lengths - head[one]]
    sizes = characters[ends] - at
    symbols = v.characters[np.where(code == 0x20, 0x2581, np.where(code == 0x2581, 0xFFFF, code))]
    symbols[code == 0x2581] = -1
    made, counts, taken, plain = _segment_all(symbols, code, at, sizes, order, many, key, alpha, v)
    begin = np.cumsum(counts) - counts

    def of(path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.r_[0, np.cumsum(counts[path])]
        return spread(made, begin[path], counts[path]).astype(np.int32), np.diff(total[first])

    plain = of(plain[which])
    return (of(taken) if alpha > 0 else plain), plain


def _segment_all(symbols, code, at, sizes, order, many, key, alpha, v) -> tuple[np.ndarray, ...]:
    """(ids of all paths, number of ids of each, path of each occurrence, path of each word without dropout).

    ``order`` has the occurrences of each distinct word, ``many`` their number, and
    ``key`` the key of each occurrence. Unknown characters become bytes.
    """
    begin = np.cumsum(many) - many
    path, plain = np.zeros(len(order), np.int64), np.zeros(len(many), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []  # ids, and number of ids of each path
    number = low = 0
    for width in (2, 4, 6, 8, 10, 12, 16, 24, LOCKSTEP):
        some = np.flatnonzero((sizes > low) & (sizes <= width))
        low = width
        total = np.cumsum(many[some])
        cuts = np.flatnonzero(np.diff(total // CHUNK)) + 1
        for words in np.split(some, cuts) if len(some) else []:
            place = np.minimum(at[words][:, None] + np.arange(width), len(symbols) - 1)
            whole = spread(order, begin[words], many[words])
            row = np.repeat(np.arange(len(words)), many[words])
            ids, word, found = segment_paths(symbols[place], sizes[words], row, key[whole], alpha, v)
            known = ids > -2
            flat, own = ids[known], known.sum(axis=1)
            if (flat == -1).any():
                flat, own = _with_bytes(flat, own, words[word], symbols, code, at, sizes, v)
            parts.append((flat, own))
            path[whole] = number + found
            plain[words] = number + np.arange(len(words))
            number += len(own)
    for word in np.flatnonzero(sizes > LOCKSTEP).tolist():
        a, b = int(at[word]), int(at[word] + sizes[word])
        long = symbols[a:b].tolist()
        places = order[begin[word] : begin[word] + many[word]] if alpha > 0 else order[:0]
        for k in (-1, *places.tolist()):
            drop = alpha if k >= 0 else 0.0
            flat = np.array([x for x, _, _ in segment_long(long, int(key[k]), drop, v)], np.int64)
            own = np.array([len(flat)])
            if (flat == -1).any():
                flat, own = _with_bytes(flat, own, np.array([word]), symbols, code, at, sizes, v)
            parts.append((flat, own))
            if k < 0:
                plain[word] = number
            else:
                path[k] = number
            number += 1
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), path, plain


def _with_bytes(flat, own, words, symbols, code, at, sizes, v) -> tuple[np.ndarray, np.ndarray]:
    """Put the byte pieces of the characters without a piece, which never merge, in their places."""
    place = spread(np.arange(len(symbols)), at[words], sizes[words])
    unknown = code[place][symbols[place] == -1]
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in unknown.tolist()]
    many = np.ones(len(flat), np.int64)
    many[flat == -1] = [len(r) for r in raw]
    out = np.repeat(flat, many)
    out[out == -1] = v.bytes[np.frombuffer(b"".join(raw), np.uint8)]
    bounds = np.r_[0, np.cumsum(many)][np.r_[0, np.cumsum(own)]]
    return out, np.diff(bounds)


def decode_ids(ids: np.ndarray, counts: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts; the space before the first word is not part of it."""
    v = vocabulary(path)
    lengths = v.lengths[ids]
    data = spread(v.spelled, v.starts[ids], lengths)
    bounds = np.r_[0, np.cumsum(lengths)][np.r_[0, np.cumsum(counts)]]
    keep = np.ones(len(data), bool)
    some = bounds[:-1][np.diff(bounds) > 0]
    keep[some[data[some] == 0x20]] = False
    return data[keep], np.r_[0, np.cumsum(keep)][bounds]


def names_of(ids: pa.Array) -> np.ndarray:
    """A 64-bit name of each document id."""
    numbers = ids.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
    return mix(numbers.astype(np.int64).view(np.uint64))


def encode(docs: DataFrame, path: str, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """docs(doc_id, text, ...) with ``ids``, an array of int."""
    rest = [c for c in docs.columns if c != "ids"]
    schema = T.StructType([f for f in docs.schema.fields if f.name != "ids"]).add("ids", T.ArrayType(T.IntegerType()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", ENCODED_BYTES):
            for part in slices(batch, "text", ENCODED_BYTES):
                ids, counts = encode_texts(
                    *text_bytes(part.column("text")), names_of(part.column("doc_id")), path, alpha, seed
                )
                offsets = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
                column = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*rest, "ids"])

    return docs.select(*rest).mapInArrow(add, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded(ids, ...) with ``text``; null ids give an empty text."""
    rest = [c for c in encoded.columns if c != "text"]
    schema = T.StructType([f for f in encoded.schema.fields if f.name != "text"]).add("text", "string")
    encoded = encoded.select(*rest).withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            counts = column.value_lengths().to_numpy().astype(np.int64)
            data, offsets = decode_ids(column.flatten().to_numpy(), counts, path)
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*rest, "text"])

    return encoded.mapInArrow(add, schema)
