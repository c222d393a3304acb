"""The pipeline against a plain version of its stages, on the smallest given table."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_minhash, test_repeats, test_secrets
from tests.llm.data import EDGES, SCHEMA, corpus, frame

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of each stage over given and odd documents; each is written and read again."""
    root = tmp_path_factory.mktemp("stages")
    odd = [(r[0] + 10**6 if r[0] is not None else None, *r[1:]) for r in corpus(30) + EDGES + [(2000, test_secrets.SAMPLES[0], "x", "s", 1)]]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")])
    docs = docs.unionByName(frame(spark, odd))
    docs.write.parquet(f"{root}/input")
    docs = spark.read.parquet(f"{root}/input")
    out = [("input", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        before, docs = docs, spark.read.parquet(f"{root}/{name}")
        if name != "packing":
            assert docs.columns == before.columns
        out.append((name, docs.collect()))
    return dict(out)


def texts(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=repr)


def test_language_rejects_only_texts_without_one(stages):
    kept = set(texts(stages["language"]))
    for r in stages["input"]:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert ((r["doc_id"], r["text"]) in kept) == letters


def test_one_document_of_each_group_stays(stages):
    rows = [tuple(r) for r in stages["language"]]
    want = {i for i, _, c in test_minhash.expected(rows) if i == c}
    kept = [r["doc_id"] for r in stages["near_duplicates"]]
    assert set(kept) == want and len(kept) == len(want)


def test_repeated_windows_go(stages):
    rows = [tuple(r) for r in stages["near_duplicates"]]
    before = {r[0]: r[1] for r in rows}
    want = []
    for i, n, gone, kept in test_repeats.expected(rows):
        if gone < n:
            want.append((i, kept if gone else before[i]))
    assert texts(stages["substrings"]) == sorted(want, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in stages["substrings"])


def test_secrets_go_and_documents_stay(stages):
    after = {r["doc_id"]: r for r in stages["secrets"]}
    assert len(after) == len(stages["substrings"])
    for r in stages["substrings"]:
        if test_secrets.expected(r["text"]):
            assert "[secret]" in after[r["doc_id"]]["text"] and not test_secrets.expected(after[r["doc_id"]]["text"])
        else:
            assert after[r["doc_id"]]["text"] == r["text"]


def test_all_tokens_are_packed(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    length = {r["doc_id"]: 0 for r in stages["secrets"]}
    for r in stages["packing"]:
        length[r["doc_id"]] += r["length"]
    assert length == {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in stages["secrets"]}
    used = {}
    for r in stages["packing"]:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048


def test_packed_pieces_hold_the_texts(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made = {}
    for r in sorted(stages["packing"], key=lambda r: r["piece"]):
        made[r["doc_id"]] = made.get(r["doc_id"], b"") + bytes(r["ids"])
    for r in stages["secrets"]:
        want = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0]
        assert np.frombuffer(made[r["doc_id"]], "<u4").tolist() == want


def test_run_is_the_stages_in_turn(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "substrings", "secrets", "packing"]
    rows = corpus_pipeline.run(spark, SF).collect()
    digest = {hashlib.sha1(repr(tuple(r)).encode()).hexdigest() for r in rows}
    assert len(digest) == len(rows) > 100


def test_empty_table(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_mixtures_of_known_languages_stay(spark):
    words = {"x": "alba", "y": "gorn", "z": "tifs"}
    rows = [(k, f"{w} {w}en {w}or " * 30, c, "s", 1) for k, (c, w) in enumerate([*words.items()] * 5)]
    mixed = (100, " ".join(f"{w} {w}en {w}or " * 10 for w in words.values()), None, "s", 1)
    docs = frame(spark, [*rows, mixed, (101, "q", None, "s", 1)])
    assert {r["doc_id"] for r in corpus_pipeline.by_language(spark, docs, SF).collect()} == {r[0] for r in rows} | {100, 101}
