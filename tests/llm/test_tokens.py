import numpy as np
import pyarrow as pa
import public_tokenizers

from pagequarry.llm import tokens
from pagequarry.llm.words import text_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")


class Counting:
    """An encoder that counts the texts it is given."""

    def __init__(self, encoder):
        self.encoder, self.texts = encoder, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.encoder.encode_batch_fast(texts, **options)

    def __getattr__(self, name):
        return getattr(self.encoder, name)


def encoded(monkeypatch, texts, cached):
    """Ids of each text from an empty cache, and how many texts the encoder got."""
    encoder, known = Counting(tokens.tokenizer(PATH)[0]), tokens.Known()
    tokens.token_bytes(PATH)
    monkeypatch.setattr(tokens, "tokenizer", lambda path: (encoder, known))
    monkeypatch.setattr(tokens, "CACHED", cached)
    out = []
    for batch in (texts, texts[::-1]):  # the second from the cache, as far as it goes
        ids, counts = tokens.encode_texts(*text_bytes(pa.array(batch)), PATH)
        out.append([x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])])
    assert len(known.keys) <= cached and (np.diff(known.keys.astype(object)) > 0).all()
    return out[0], out[1][::-1], encoder


def test_new_chunks_are_encoded_together(monkeypatch):
    texts = [" ".join(f"w{a}x{b}," for b in range(50)) for a in range(40)]
    texts += ["", "a <|endoftext|> b é 的 x\n\ny  z", "\U0001f600 don't 12's é è ß"]
    want = [tokens.tokenizer(PATH)[0].encode(t, add_special_tokens=False).ids for t in texts]
    for cached in (0, 700, 1_000_000):
        first, again, encoder = encoded(monkeypatch, texts, cached)
        assert first == want and again == want
        assert encoder.texts < 300  # of some 2,000 distinct chunks
        monkeypatch.undo()


def test_chunks_alone_where_bytes_do_not_tell(monkeypatch):
    """Token sizes that do not fit the text, as with a tokenizer that changes it."""
    texts = ["one two three", "two four one five"]
    want = [tokens.tokenizer(PATH)[0].encode(t, add_special_tokens=False).ids for t in texts]
    tokens.tokenizer(PATH)
    monkeypatch.setattr(tokens, "token_bytes", lambda path: np.full(60_000, 3))
    starts = np.array([0, 3, 7])
    data = np.frombuffer(b" on two three", np.uint8)
    ids, n = tokens.encode_chunks(data, starts, np.array([3, 7, 13]), np.ones(3, bool), PATH)
    own = [tokens.tokenizer(PATH)[0].encode(t, add_special_tokens=False).ids for t in (" on", " two", " three")]
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == own
    ids, counts = tokens.encode_texts(*text_bytes(pa.array(texts)), PATH)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
