from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from pagequarry.llm import pieces
from pagequarry.llm.words import text_bytes
from tests.llm.data import EDGES, corpus, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "Hello  world", "  lead", "a\n\nb", "é一\U0001f600x", "trail ", "a\tb", "ﬁ ½", "   ", "\x00z", "a <s> b",
    "y" * 40 + "  z" + "的" * 50, "\U0001f600" * 40, "internationalization of the unbelievable",
]
TEXTS = ODD + [t or "" for _, t, *_ in corpus(20) + EDGES[:8]]


def encoded(texts, **options):
    names = pieces.names_of(pa.array(range(len(texts))))
    ids, counts = pieces.encode_texts(*text_bytes(pa.array(texts)), names, PATH, **options)
    return np.split(ids, np.cumsum(counts)[:-1])


def test_without_dropout_same_as_library():
    sp = SentencePieceProcessor(model_file=PATH)
    for text, ids in zip(TEXTS, encoded(TEXTS, alpha=0.0)):
        assert ids.tolist() == sp.encode(text), text


@pytest.mark.parametrize("alpha", [0.1, 0.5, 1.0])
def test_dropout_decodes_to_the_text(alpha):
    sp = SentencePieceProcessor(model_file=PATH)
    ids = encoded(TEXTS, alpha=alpha)
    assert [sp.decode(x.tolist()) for x in ids] == TEXTS
    flat, counts = np.concatenate(ids), np.array([len(x) for x in ids])
    data, offsets = pieces.decode_ids(flat, counts, PATH)
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])] == TEXTS


def test_seeds_and_occurrences_vary_but_repeat():
    text = [" ".join(["internationalization"] * 40)]
    one, again, other = (encoded(text, alpha=0.3, seed=s)[0].tolist() for s in (1, 1, 2))
    assert one == again and one != other
    plain = encoded(text, alpha=0.0)[0]
    assert len(one) > len(plain)
    sp = SentencePieceProcessor(model_file=PATH)
    ways = {tuple(x.split(" ")) for x in " ".join(sp.id_to_piece(one)).split("▁")}
    assert len(ways) > 2


def test_all_dropped_is_characters():
    ids = encoded(["abc de"], alpha=1.0)[0]
    sp = SentencePieceProcessor(model_file=PATH)
    assert sp.id_to_piece(ids.tolist()) == ["▁", "a", "b", "c", "▁", "d", "e"]


def test_arrays_same_as_heap():
    v = pieces.vocabulary(PATH)
    pick = np.random.default_rng(1)
    for word in {w for t in TEXTS for w in t.split() if 1 < len(w) <= 32}:
        symbols = v.characters[[ord(c) for c in "▁" + word]]
        key = pick.integers(0, 2**63, dtype=np.uint64)
        row = pieces.segment(symbols[None, :], np.array([len(symbols)]), np.array([key]), 0.3, v)[0]
        assert row[row > -2].tolist() == [x for x, _, _ in pieces.segment_long(symbols.tolist(), int(key), 0.3, v)]


def test_frames(spark):
    rows = corpus(20) + EDGES + [(1008, "a ▁ space sign", "x", "s", 1)]
    made = pieces.encode(frame(spark, rows, ("ids",)), PATH)
    back = pieces.decode(made.withColumnRenamed("text", "before"), PATH).collect()
    assert len(back) == len(rows)
    assert all(r["text"] == (r["before"] or "") for r in back)
    assert pieces.encode(frame(spark, []), PATH).collect() == []


def test_every_occurrence_drops_on_its_own():
    """Many segmentations of one word, each that of a heap with the occurrence's own key."""
    n = 3000
    ids = encoded([" ".join(["international"] * n)], alpha=0.3)[0]
    sp = SentencePieceProcessor(model_file=PATH)
    ways = Counter(" ".join(sp.id_to_piece(ids.tolist())).split("▁")[1:])
    assert sum(ways.values()) == n and len(ways) > 100
    plain = sum(way.strip() == "international" for way in ways.elements()) / n
    v = pieces.vocabulary(PATH)
    symbols = v.characters[[ord(c) for c in "▁international"]]
    keys = np.random.default_rng(5).integers(0, 2**63, n, dtype=np.uint64)
    found, word, path = pieces.segment_paths(symbols[None, :], np.array([len(symbols)]), np.zeros(n, int), keys, 0.3, v)
    assert len(found) < n and not word.any()
    whole = 0
    for key, p in zip(keys[:500].tolist(), path[:500]):
        own = [x for x, _, _ in pieces.segment_long(symbols.tolist(), key, 0.3, v)]
        assert found[p][found[p] > -2].tolist() == own
        whole += len(own) == 1
    assert abs(whole / 500 - plain) < 0.1
