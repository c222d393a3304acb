"""Byte-level BPE ids of whole columns of texts, with each distinct chunk encoded once.

A text is cut before a space that stands between two characters that are no white
space. The byte-level pattern always ends a token there, whatever is around it,
so the ids of a text are the ids of its chunks in order.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np

from pagequarry.llm.words import span_hashes

CACHED = 1_000_000  # chunks that a worker keeps, at about 30 bytes each
TOGETHER = 2_000  # new chunks that are encoded as one text


class Known:
    """Ids of chunks that were encoded before: sorted hashes, and for each where its ids lie."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, known) of each key; a place means nothing where a key is not known."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def add(self, keys: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Of sorted new keys, the first that there is room for."""
        n = max(CACHED - len(self.keys), 0)
        keys, lengths = keys[:n], lengths[:n]
        if not len(keys):
            return
        places = np.searchsorted(self.keys, keys)
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.keys = np.insert(self.keys, places, keys)
        self.starts = np.insert(self.starts, places, starts)
        self.lengths = np.insert(self.lengths, places, lengths)
        self.ids = np.concatenate([self.ids, ids[: int(lengths.sum())]])


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), Known()


@lru_cache(maxsize=2)
def token_bytes(path: str) -> np.ndarray:
    """How many bytes of text each id stands for; a token has one character for each byte."""
    encoder = tokenizer(path)[0]
    out = np.zeros(vocabulary_size(path), np.int64)
    for token, number in encoder.get_vocab().items():
        out[number] = len(token)
    for number, added in encoder.get_added_tokens_decoder().items():  # these are plain text
        out[number] = len(added.content.encode())
    return out


def vocabulary_size(path: str) -> int:
    return max(tokenizer(path)[0].get_vocab().values()) + 1


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the chunks of all texts, in order; empty texts have none."""
    plain = (data > 0x20) & (data < 0x7F)
    lead = (data >= 0xC3) & (data <= 0xDF)  # of two bytes, none of them white space
    before = plain.copy()
    before[1:] |= lead[:-1] & (data[1:] >= 0x80)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        cut[1:-2] = (data[1:-1] == 0x20) & before[:-2] & (plain | lead)[2:]
    cut[offsets] = True
    cut[-1] = False
    return np.flatnonzero(cut)


def spread(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[starts[i]:starts[i] + lengths[i]]`` for all i, one after the other."""
    before = np.cumsum(lengths) - lengths
    return values[np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)]


def encode_chunks(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, joins: np.ndarray, path: str
) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the chunks in order, number of ids of each); ``joins``: may follow one another in a text.

    Such chunks are encoded many at a time, since a token ends between them; the bytes that
    tokens stand for tell where. Where they do not, chunks are encoded each by itself.
    """
    encoder, size = tokenizer(path)[0], token_bytes(path)
    lengths = np.zeros(len(starts), np.int64)
    alone = [np.flatnonzero(~joins)]
    places, made = [], []
    together = np.flatnonzero(joins)
    for a in range(0, len(together), TOGETHER):
        own = together[a : a + TOGETHER]
        n = ends[own] - starts[own]
        text = bytes(spread(data, starts[own], n)).decode("utf-8", "replace")
        ids = np.array(encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        last, done = np.cumsum(n), np.cumsum(size[ids])
        at = np.searchsorted(done, last)
        if len(done) and at[-1] == len(done) - 1 and (done[at] == last).all():
            lengths[own] = np.diff(at, prepend=-1)
            places.append(own)
            made.append(ids)
        else:
            alone.append(own)
    alone = np.concatenate(alone)
    for a in range(0, len(alone), TOGETHER):
        own = alone[a : a + TOGETHER]
        texts = [bytes(data[s:e]).decode("utf-8", "replace") for s, e in zip(starts[own], ends[own])]
        each = [x.ids for x in encoder.encode_batch_fast(texts, add_special_tokens=False)]
        lengths[own] = [len(x) for x in each]
        places.append(own)
        made.append(np.array(list(chain.from_iterable(each)), np.uint32))
    # from the order in which they were made to that of the chunks
    place = np.concatenate(places)
    begin = np.empty(len(place), np.int64)
    begin[place] = np.cumsum(lengths[place]) - lengths[place]
    return spread(np.concatenate(made), begin, lengths), lengths


def encode_texts(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in order, number of ids of each text)."""
    known = tokenizer(path)[1]
    starts = chunk_starts(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
    ends = np.r_[starts[1:], len(data)]
    # cut at a space on both sides, not by the end of a text
    inner = ~np.isin(starts, offsets)
    joins = inner & np.r_[inner[1:], False]
    keys, first, which = np.unique(
        span_hashes(data, starts, ends), return_index=True, return_inverse=True
    )
    at, found = known.find(keys)
    new = np.flatnonzero(~found)
    begin, lengths = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    begin[found], lengths[found] = known.starts[at[found]], known.lengths[at[found]]
    flat = known.ids
    if len(new):
        own = first[new]
        ids, n = encode_chunks(data, starts[own], ends[own], joins[own], path)
        begin[new], lengths[new] = len(flat) + np.cumsum(n) - n, n
        flat = np.concatenate([flat, ids])
        known.add(keys[new], n, ids)
    own = lengths[which]
    ids = spread(flat, begin[which], own)
    total = np.r_[0, np.cumsum(own)]
    return ids, np.diff(total[np.searchsorted(starts, offsets)])
