import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import lm
from tests.llm.data import EDGES, corpus, frame


def scored(spark, ws, rows, **options):
    docs = frame(spark, rows, ("score", "n_known")).withColumn("train", F.coalesce(F.col("doc_id") % 7 != 2, F.lit(True)))
    fitted = lm.fit(docs, ws, **options)
    return fitted, lm.score(docs, fitted).collect()


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def counts(rows):
    c = Counter()
    for i, t, *_ in rows:
        if i is None or i % 7 != 2:
            c.update(tokens(t))
    return c


@pytest.mark.parametrize("block, bucket", [(8 << 20, 4 << 20), (4_000, 3_000)])
def test_base_same_as_brute_force(spark, ws, block, bucket):
    rows = corpus() + EDGES
    _, got = scored(spark, ws, rows, block_bytes=block, bucket_bytes=bucket)
    c = counts(rows)
    n, v = sum(c.values()), len(c)
    want = sorted(
        (
            (i, len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tokens(t)), 6))
            for i, t, *_ in rows
        ),
        key=repr,
    )
    have = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=repr)
    assert have == want
    assert all(r["score"] <= 0 for r in got)


def test_probabilities_of_words_sum_to_one(spark, ws):
    rows = corpus()
    fitted, _ = scored(spark, ws, rows)
    model, c = fitted.model, counts(rows)
    keys = [k for k in c if k is not None]
    import pyarrow as pa

    hashes = np.r_[lm.token_hashes(pa.array([b" ".join(keys).decode()]))[0]]
    rough = lm.LEVEL_COUNT[model.levels(lm.short_keys(hashes, model.bucket_bits), lm.WORD)]
    assert len(rough) == model.vocabulary == len(c)
    # a false hit of one probe chain raises a count a little
    assert ((rough + 1).sum() + 1) / (model.total + model.vocabulary + 1) == pytest.approx(1.0, abs=0.05)
    true = np.array([c[k] for k in keys] + [c[None]])
    assert (np.abs(np.log(rough / true)) < 0.5).mean() > 0.95


def test_small_filter_keeps_frequent_entries(spark, ws):
    fitted, got = scored(spark, ws, corpus(), filter_bits=1 << 12)
    assert len(fitted.model.bits) * 8 <= 1 << 12
    assert fitted.model.least[lm.PAIR] > 1
    assert all(math.isfinite(r["score"]) for r in got)


def test_pairs_help_on_copies(spark, ws):
    rows = corpus()
    learned = [r for r in rows if r[0] % 7 != 2][:20]
    copies = [(100_000 * 7 + 2 + 7 * k, t, "x", "s", 1) for k, (_, t, *_) in enumerate(learned)]
    _, got = scored(spark, ws, rows + rows + copies)
    held = [r for r in got if r["doc_id"] >= 700_000]
    assert len(held) == 20 and all(r["score"] > r["base_score"] for r in held)


def test_empty_table(spark, ws):
    assert scored(spark, ws, [])[1] == []


def test_levels():
    n = np.arange(1, 5000)
    level = lm.level_of(n)
    assert level[0] == 0 and (np.diff(level) >= 0).all()
    assert (np.abs(np.log(lm.LEVEL_COUNT[level] / n)) <= np.log(lm.BASE) + 1e-9).all()


def test_a_block_sends_a_pair_once():
    import pyarrow as pa

    table = pa.table({"text": ["a b " * 3000, "a b c"], "train": [True, True]})
    sent = {kind: (keys, n) for kind, _, keys, n in lm._gather(table, 0)}
    keys, n = sent[lm.PAIR]
    assert len(keys) == len(set(keys.tolist())) == 6 and n.max() == 3001
    assert len(lm._packed_counts(n)) < 6 + 8 * 3
    for values in (n, np.array([0, 1, 254, 255, 256, 2**40])):
        assert lm._counts(lm._packed_counts(values), len(values)).tolist() == values.tolist()


def test_no_count_is_dropped_beyond_any_filter_size(spark, ws):
    """A bound on the filter that is carried elsewhere changes no score."""
    rows = corpus()
    _, wide = scored(spark, ws, rows)
    _, narrow = scored(spark, ws, rows, filter_bits=1 << 12)
    assert sorted((r["doc_id"], r["score"]) for r in wide) == sorted((r["doc_id"], r["score"]) for r in narrow)


def test_buckets_know_every_entry():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**32, 20_000).astype(np.uint64))
    level = np.random.default_rng(4).geometric(0.4, len(keys))
    for kind in (lm.WORD, lm.PAIR):
        found = lm.bucket_filter(keys, level, kind).levels(keys, kind)
        assert (found >= level).all() and (found == level).mean() > 0.9
        other = np.arange(20_000, dtype=np.uint64) * np.uint64(7919)
        other = other[~np.isin(other, keys)]
        assert (lm.bucket_filter(keys, level, kind).levels(other, kind) < 0).mean() > 0.9
