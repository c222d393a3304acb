import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagequarry.llm import packing
from pagequarry.llm.tokens import encode_texts
from pagequarry.llm.words import text_bytes
from tests.llm.data import EDGES, corpus, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = [
    "two  spaces   three", " lead", "trail ", "   x 　y", "é è a b c", "don't can't I'll 's x's",
    "a\n\nb \n c\t d", "12 345 6,7", "的 是 a 的", "a <|endoftext|> b", "\U0001f600 \U0001f600x", "x \x85 y", "q \x1c z", "ÿ ¿a ×b",
]


def test_ids_same_as_tokenizer(tokenizer):
    texts = ODD + [t or "" for _, t, *_ in corpus() + EDGES]
    ids, counts = encode_texts(*text_bytes(pa.array(texts)), PATH)
    got = np.split(ids, np.cumsum(counts)[:-1])
    for text, own in zip(texts, got):
        assert own.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("group_rows", [100_000, 20])
def test_pieces_and_sequences(spark, ws, tokenizer, group_rows):
    rows, capacity = corpus() + EDGES, 256
    pieces = packing.tokenize(frame(spark, rows), PATH, capacity)
    packed = packing.pack(pieces.withColumns({"_row": F.lit(3), "_ROW_": F.lit(4)}), ws, capacity, group_rows)
    assert all(len(r["ids"]) == 2 * r["length"] for r in packed.select("ids", "length").limit(20).collect())
    got = packing.widened(packed).toPandas()
    assert set(got["_row"]) == {3} and set(got["_ROW_"]) == {4}
    whole = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, t, *_ in rows)
    made = []
    ordered = got.sort_values(["doc_id", "piece"])
    for _, own in ordered[ordered.doc_id.notna() & (ordered.doc_id != 1004)].groupby("doc_id"):
        assert own.piece.tolist() == list(range(len(own)))
        assert own.start.tolist() == [0, *np.cumsum(own.length)[:-1].tolist()]
        assert (own.length.iloc[1:] == capacity).all() and own.length.max() <= capacity
        made.append(np.concatenate([np.frombuffer(x, "<u4") for x in own.ids]).tolist())
    rest = ordered[ordered.doc_id.isna() | (ordered.doc_id == 1004)]
    made += [np.frombuffer(x, "<u4").tolist() for x in rest.ids]
    assert sorted(made) == whole
    assert all(zlib.crc32(x) == c for x, c in zip(got.ids, got.ids_crc32))
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1].tolist()]
        assert own.length.sum() <= capacity
    least = -(-got.length.sum() // capacity)
    assert got.sequence_id.nunique() <= (least + 2 if group_rows > len(rows) else least * 1.25)


def test_sum_of_squares_rule():
    """Placing one length by trying every open sequence gives the same."""
    pick = np.random.default_rng(2)
    lengths = np.minimum(pick.geometric(0.03, 300), 60)
    sequence, offset, fills = packing.sum_of_squares(lengths, 60)
    open_: list[int] = []
    for size in sorted(lengths.tolist(), reverse=True):
        def squares(fill):
            levels = [x for x in open_]
            levels[levels.index(fill)] = fill + size
            return sum(levels.count(x) ** 2 for x in set(levels) if x < 60)
        able = sorted({x for x in open_ if x + size <= 60})
        if able:
            best = min(able, key=lambda x: (squares(x), -x))
            open_[open_.index(best)] = best + size
        else:
            open_.append(size)
    assert sorted(open_) == sorted(fills.tolist())
    assert np.bincount(sequence, lengths).tolist() == fills.tolist()
    assert sorted(zip(sequence, offset)) == sorted(set(zip(sequence, offset)))


def test_equal_lengths_and_empty_table(spark, ws):
    same = spark.range(1000).selectExpr("id", "7L AS length", "1 AS offset")
    got = packing.pack(same, ws, 28, 64).toPandas()
    assert len(got) == 1000 and got.sequence_id.nunique() == 250
    none = packing.tokenize(frame(spark, []), PATH)
    assert packing.pack(none, ws).collect() == []
