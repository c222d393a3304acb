"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Counts of words and of word pairs over all training texts are quantised on a log
scale. A Bloom filter holds one entry for each level up to an n-gram's own, so
its count is found by probing level after level until one is missing. The filter
is cut by hash into buckets and grows with the n-grams: each bucket has the bits its
entries need, is probed where it lies, and nothing of it is left out at any size.

A text's probability mixes two models: words alone, with one virtual count for
each word of the vocabulary and for an unknown one, and pairs interpolated with
words. The weight of pairs is the share of training tokens whose pair repeats.

Counts never gather in one place. Texts are dealt out in blocks; a block sends its
distinct words and pairs to buckets of hashes, which add up and send each block the
levels (of words, exact totals too), in the block's order. Texts are shuffled twice,
from the input. Only a few sums over all buckets reach the driver.

``Scores.model`` is a filter of bounded size to carry to other texts, made if it is
asked for; it keeps what is frequent (``least``). No score of ``score`` depends on it.

Null and empty texts are a single end token. Repeated rows are scored each.
Extra columns are kept; result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.llm.ranges import release, text_size
from pagequarry.llm.words import column_words, mix, slices, window_hashes
from pagequarry.session import Workspace

FILTER_BITS = 1 << 29  # 64 MB, the most that is carried to other texts
PROBES = 5
BASE = 1.5
LEVELS = 128
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
END = np.uint64(0x7F4A7C159E3779B9)
WORD, PAIR = 0, 1
LEAST = (0, 1)  # lowest level that is entered: pairs seen once say nothing
KEY_TYPE = ("<u8", "<u4")  # a pair is sent as the last 32 bits of its key
_KIND = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E3779B97F4A7C15))


def level_of(counts: np.ndarray) -> np.ndarray:
    """0 for a count of 1, and one more for each factor of BASE."""
    return np.minimum(np.floor(np.log(counts) / np.log(BASE) + 1e-9), LEVELS - 1).astype(np.int64)


def _level_counts() -> np.ndarray:
    """The count that stands for each level: the middle of those that have it; [-1] is 0."""
    edges = BASE ** np.arange(LEVELS + 1)
    low, high = np.ceil(edges[:-1] - 1e-9), np.maximum(np.ceil(edges[1:] - 1e-9) - 1, 1)
    return np.r_[np.where(high >= low, np.sqrt(low * np.maximum(high, low)), edges[:-1]), 0.0]


LEVEL_COUNT = _level_counts()


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens with an end after each text, number of tokens of each text)."""
    words = column_words(column)
    counts = words.counts + 1
    out = np.full(int(counts.sum()), END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(counts) - 1] = False
    out[inside] = words.hashes(lower=True)
    return out, counts


def pair_hashes(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each token and the one before it; before the first there is an end."""
    return window_hashes(np.r_[END, tokens], 2) if len(counts) else np.zeros(0, np.uint64)


def short_keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bucket (the first ``bits``) and 32 more bits of a hash: what the filter knows."""
    return hashes >> np.uint64(32 - bits)


@dataclass
class Filter:
    """Bits of buckets, one after the other; an n-gram's probes stay in its bucket."""

    bits: np.ndarray  # bytes
    bucket_bits: int  # log2 of the number of buckets
    least: tuple[int, int]  # the lowest level kept, of words and of pairs
    total: float = 0.0  # quantised counts of all words that are kept
    tokens: int = 0
    vocabulary: int = 0
    pair_weight: float = 0.0

    def levels(self, short: np.ndarray, kind: int) -> np.ndarray:
        """Level of each short key, or -1; keys below the lowest kept level are unknown."""
        size = len(self.bits) * 8 >> self.bucket_bits
        level = np.full(len(short), -1, np.int64)
        active = np.arange(len(short))
        base = (short >> np.uint64(32)).astype(np.int64) * size
        for q in range(self.least[kind], LEVELS):
            for n in range(PROBES):
                at = base[active] + probe(short[active], kind, q, n, size)
                active = active[(self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0]
                if not len(active):
                    return level
            level[active] = q
        return level


def probe(short: np.ndarray, kind: int, level: int, n: int, size: int) -> np.ndarray:
    """Place, in its bucket, of the n-th bit of the entry for one level of each key."""
    h = mix(short * _KIND[kind] + np.uint64(level + 1))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h + np.uint64(n) * step) % np.uint64(size)).astype(np.int64)


def set_bits(field: np.ndarray, short: np.ndarray, level: np.ndarray, kind: int, least: int) -> None:
    """Enter each key, at each level from ``least`` to its own, into one bucket's bits."""
    for q in range(least, int(level.max(initial=0)) + 1):
        own = short[level >= q]
        for n in range(PROBES):
            field[probe(own, kind, q, n, len(field))] = True


def bucket_filter(short: np.ndarray, level: np.ndarray, kind: int) -> Filter:
    """The filter of the entries of one bucket, as large as they need; keys are within the bucket."""
    need = int(PROBES / np.log(2.0) * (level - LEAST[kind] + 1).sum())
    field = np.zeros(max(64, -(-need // 64) * 64), bool)
    set_bits(field, short, level, kind, LEAST[kind])
    return Filter(np.packbits(field, bitorder="little"), 0, LEAST)


def _gather(table: pa.Table, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(kind, bucket, keys, training counts) of one block, for all its words and pairs."""
    words, pairs = [], []
    for batch in table.to_batches():
        for part in slices(batch, "text"):
            tokens, counts = token_hashes(part.column("text"))
            train = np.repeat(np.array(part.column("train").to_pylist(), bool), counts)
            words.append((tokens, train))
            pairs.append((short_keys(pair_hashes(tokens, counts), bits), train))
    for kind, found, shift in ((WORD, words, 64 - bits), (PAIR, pairs, 32)):
        hashes, train = (np.concatenate(x) for x in zip(*found))
        keys, which = np.unique(hashes, return_inverse=True)
        counts = np.bincount(which, train, len(keys)).astype(np.int64)
        bucket = (keys >> np.uint64(shift)).astype(np.int64)
        if len(keys):
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            for a, b in zip(first, np.r_[first[1:], len(keys)]):
                yield kind, int(bucket[a]), keys[a:b], counts[a:b]


def _packed_counts(counts: np.ndarray) -> bytes:
    """A byte for each count, most being small, then those of 255 and more as 64 bits."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _counts(raw: bytes, n: int) -> np.ndarray:
    """The ``n`` counts that ``_packed_counts`` packed."""
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<i8", offset=n)
    return out


@dataclass
class Scores:
    """What ``fit`` leaves: sums over all n-grams, and for each block the levels of its
    words and pairs and the exact totals of its words."""

    answers: DataFrame  # kind, _block, bucket, levels (one more than each, 0 if unknown), totals
    entries: DataFrame  # of each bucket
    blocks: int
    bucket_bits: int
    filter_bits: int
    histogram: np.ndarray  # n-grams of each kind and level
    tokens: int
    vocabulary: int
    pair_weight: float

    @property
    def total(self) -> float:
        """Quantised counts of all words."""
        return float((self.histogram[WORD] * LEVEL_COUNT[:LEVELS]).sum())

    @cached_property
    def model(self) -> Filter:
        return _build(self)


def _dealt(docs: DataFrame, blocks: int) -> DataFrame:
    return docs.withColumn("_block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))


def fit(
    docs: DataFrame,
    ws: Workspace,
    filter_bits: int = FILTER_BITS,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> Scores:
    """Learn from docs(doc_id, text, train) where train is true; count the words of all."""
    size = text_size(docs)
    blocks = max(1, -(-size // block_bytes))
    bits = max(1, int(size // bucket_bytes).bit_length())

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        rows = list(_gather(table, bits))
        return pa.table(
            {
                "kind": pa.array([r[0] for r in rows], pa.int32()),
                "bucket": pa.array([r[1] for r in rows], pa.int32()),
                "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "keys": pa.array([r[2].astype(KEY_TYPE[r[0]]).tobytes() for r in rows], pa.binary()),
                "counts": pa.array([_packed_counts(r[3]) for r in rows], pa.binary()),
            }
        )

    def add_up(key: tuple, table: pa.Table) -> pa.Table:
        kind, bucket = key[0].as_py(), key[1].as_py()
        block = table.column("block").to_pylist()
        raw = table.column("keys").to_pylist()
        own = [np.frombuffer(x, KEY_TYPE[kind]) for x in raw]
        n = np.concatenate([_counts(x, len(k)) for x, k in zip(table.column("counts").to_pylist(), own)])
        keys, which = np.unique(np.concatenate(own), return_inverse=True)
        totals = np.bincount(which, n, len(keys)).astype(np.int64)
        # within the bucket a key is its last 32 bits
        keys = short_keys(keys, bits) & np.uint64(0xFFFFFFFF) if kind == WORD else keys.astype(np.uint64)
        level = np.full(len(keys), -1, np.int64)
        level[totals > 0] = level_of(totals[totals > 0])
        stored = level >= LEAST[kind]
        found = bucket_filter(keys[stored], level[stored], kind).levels(keys, kind)
        cuts = np.cumsum([len(x) for x in own])[:-1]
        levels = [x.tobytes() for x in np.split((found + 1).astype(np.uint8)[which], cuts)]
        exact = [x.astype("<i8").tobytes() for x in np.split(totals[which], cuts)] if kind == WORD else [None] * len(own)
        keys |= np.uint64(bucket) << np.uint64(32)
        histogram = np.bincount(level[level >= 0], minlength=LEVELS).tolist()
        n = len(block)
        return pa.table(
            {
                "kind": pa.array([kind] * (n + 1), pa.int32()),
                "bucket": pa.array([bucket] * (n + 1), pa.int32()),
                "block": pa.array([*block, None], pa.int32()),
                "totals": pa.array([*exact, None], pa.binary()),
                "entries": pa.array([None] * n + [keys[stored].tobytes()], pa.binary()),
                "levels": pa.array([*levels, level[stored].astype(np.uint8).tobytes()], pa.binary()),
                "tokens": pa.array([None] * n + [int(totals.sum())], pa.int64()),
                "repeated": pa.array([None] * n + [int(totals[totals > 1].sum())], pa.int64()),
                "histogram": pa.array([None] * n + [histogram], pa.list_(pa.int64())),
            }
        )

    texts = _dealt(docs.select("doc_id", "text", F.coalesce("train", F.lit(False)).alias("train")), blocks)
    sent = texts.groupBy("_block").applyInArrow(gather, "kind int, bucket int, block int, keys binary, counts binary")
    counted = ws.save(
        sent.groupBy("kind", "bucket").applyInArrow(
            add_up,
            "kind int, bucket int, block int, totals binary, entries binary, levels binary, "
            "tokens long, repeated long, histogram array<long>",
        ),
        "counted",
    )
    release(docs.sparkSession)
    entries = counted.where("block IS NULL")
    answers = counted.where("block IS NOT NULL").select("kind", F.col("block").alias("_block"), "bucket", "levels", "totals")
    histogram, tokens, repeated = _sums(entries)
    share = float(np.clip(repeated / max(tokens, 1), 0.01, 0.99))
    return Scores(answers, entries, blocks, bits, filter_bits, histogram, tokens, int(histogram[WORD].sum()), share)


def _sums(entries: DataFrame) -> tuple[np.ndarray, int, int]:
    """(n-grams of each kind and level, training tokens, those whose pair repeats)."""
    # two rows of at most LEVELS numbers
    rows = (
        entries.select("kind", "tokens", "repeated", F.posexplode("histogram").alias("level", "n"))
        .groupBy("kind", "level")
        .agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"), F.sum("repeated").alias("repeated"))
        .collect()
    )
    histogram = np.zeros((2, LEVELS), np.int64)
    tokens, repeated = 0, [0, 0]
    for row in rows:
        histogram[row["kind"], row["level"]] = row["n"]
        repeated[row["kind"]] = row["repeated"]
        tokens = row["tokens"] if row["kind"] == WORD else tokens
    return histogram, int(tokens), int(repeated[PAIR])


def _build(fitted: Scores) -> Filter:
    """Choose what fits, set the bits bucket by bucket, and join the buckets' bits."""
    histogram, bits, filter_bits = fitted.histogram, fitted.bucket_bits, fitted.filter_bits
    least = list(LEAST)
    wanted = PROBES / np.log(2.0)

    def needed() -> float:
        # of a level q from the least kept one on, q - least + 1 entries
        return wanted * sum(
            (histogram[k, least[k] :] * np.arange(1, LEVELS - least[k] + 1)).sum() for k in (WORD, PAIR)
        )

    while needed() > filter_bits and least[PAIR] < LEVELS - 1:
        least[PAIR] += 1
    while needed() > filter_bits and least[WORD] < LEVELS - 1:
        least[WORD] += 1
    buckets = 1 << bits
    size = max(64, 1 << max(0, int(np.ceil(np.log2(max(needed(), 1) / buckets)))))
    size = min(size, max(64, filter_bits // buckets))

    def bits_of(key: tuple, table: pa.Table) -> pa.Table:
        field = np.zeros(size, bool)
        for kind, raw, levels in zip(*(table.column(c).to_pylist() for c in ("kind", "entries", "levels"))):
            set_bits(field, np.frombuffer(raw, np.uint64), np.frombuffer(levels, np.uint8), kind, least[kind])
        made = np.packbits(field, bitorder="little").tobytes()
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([made], pa.binary())})

    parts = fitted.entries.select("kind", "bucket", "entries", "levels")
    parts = parts.groupBy("bucket").applyInArrow(bits_of, "bucket int, bits binary")
    whole = np.zeros((buckets, size // 8), np.uint8)
    for row in parts.toLocalIterator():  # filter_bits in all
        whole[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    known = histogram[WORD].copy()
    known[: least[WORD]] = 0
    total = float((known * LEVEL_COUNT[:LEVELS]).sum())
    kept = (least[WORD], least[PAIR])
    return Filter(whole.reshape(-1), bits, kept, total, fitted.tokens, fitted.vocabulary, fitted.pair_weight)


def score(docs: DataFrame, fitted: Scores) -> DataFrame:
    """docs(doc_id, text, train, ...), as given to ``fit``, with n_tokens, n_known,
    train_tokens, base_score and score (both log10 probabilities of the text)."""
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "_block")
    docs = docs.select(*[c for c in docs.columns if c not in new])
    names, bits = docs.columns, fitted.bucket_bits
    total, known, vocabulary, weight = fitted.total, fitted.tokens, fitted.vocabulary, fitted.pair_weight
    schema = T.StructType([*docs.schema.fields])
    for name in new[:3]:
        schema = schema.add(name, "long")
    schema = schema.add("base_score", "double").add("score", "double")

    def score_block(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        made = []
        answers = answers.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        kind = answers.column("kind").to_numpy()
        raw = answers.column("levels").to_pylist()
        # the count of each word and pair of the block, by key
        word, pair = (
            LEVEL_COUNT[np.concatenate([np.frombuffer(raw[k], np.uint8) for k in np.flatnonzero(kind == x)]).astype(np.int64) - 1]
            for x in (WORD, PAIR)
        )
        totals = np.concatenate([np.frombuffer(x, "<i8") for x in answers.column("totals").to_pylist() if x is not None])
        parts = [part for batch in table.to_batches() for part in slices(batch, "text")]
        found = [token_hashes(p.column("text")) for p in parts]
        pairs = [short_keys(pair_hashes(t, n), bits) for t, n in found]
        keys, pair_keys = (np.unique(np.concatenate(x)) for x in ([t for t, _ in found], pairs))
        # one distribution over the vocabulary and one unknown word
        log_word = np.log((word + 1) / (total + vocabulary + 1))
        base = np.log10(totals + 1) - np.log10(known + vocabulary + 1)
        for part, (tokens, counts), own in zip(parts, found, pairs):
            at = np.searchsorted(keys, tokens)
            first = np.cumsum(counts) - counts
            before = np.r_[np.searchsorted(keys, END), at[:-1]]
            share = np.minimum(pair[np.searchsorted(pair_keys, own)] / np.maximum(word[before], 1), 1.0)
            log_pair = np.log(weight * share + (1 - weight) * np.exp(log_word[at]))
            alone = np.add.reduceat(log_word[at], first) + np.log(1 - weight)
            joint = np.add.reduceat(log_pair, first) + np.log(weight)
            values = {
                "n_tokens": counts,
                "n_known": np.add.reduceat((totals[at] > 0).astype(np.int64), first),
                "train_tokens": np.full(len(counts), known),
                "base_score": np.add.reduceat(base[at], first),
                "score": np.logaddexp(alone, joint) / np.log(10.0),
            }
            out = pa.Table.from_batches([part]).select(names)
            for name, column in values.items():
                out = out.append_column(name, pa.array(column))
            made.append(out)
        return pa.concat_tables(made)

    blocks = _dealt(docs, fitted.blocks)
    return blocks.groupBy("_block").cogroup(fitted.answers.groupBy("_block")).applyInArrow(score_block, schema)
