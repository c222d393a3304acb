"""The registered queries: each applies its operator to the whole given table."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm import fingerprints as fp
import corpus_pipeline
from pagequarry.llm import caps, languages, lm, minhash, packing, pieces, quality, repeats, secrets, variants, warc
from pagequarry.llm import whitening
from pagequarry.llm.ranges import small_batches
from pagequarry.llm.words import gathered, slices, text_bytes
from pagequarry.session import Workspace


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(documents(spark, sf_dir), Workspace(spark, "minhash"))


def remainder(modulus: int):
    """crc32 of the id as decimal text, modulo ``modulus``; a null id counts as no text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(modulus))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the two thirds that are not held out."""
    docs = documents(spark, sf_dir).withColumn("held_out", remainder(3) == 1)
    model = languages.learn(docs.where("NOT held_out").select("text", "lang"))
    found = languages.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("lang_shares").alias("n_langs"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a model of the six sevenths that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", (remainder(7) == 2).alias("held_out"))
    docs = docs.withColumn("train", ~F.col("held_out"))
    return lm.score(docs, lm.fit(docs, Workspace(spark, "lm"))).drop("text", "train")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document; kinds assign, access, hex are the base, markov is added."""
    spans = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))

    def joined(kept):
        named = F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(named, ",")

    base = F.filter("spans", lambda s: s["kind"] != "markov")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count("markov"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document without windows of 13 that an earlier document has."""
    found = repeats.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), Workspace(spark, "repeats"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def _edit_report(ids: list, texts: list[str], nexts: list[str]) -> dict[str, list]:
    own = fp.fingerprints(texts)
    # a row's next is nearly always the row after it, worked out already
    apart = [k for k, t in enumerate(nexts) if k + 1 == len(texts) or t is not texts[k + 1]]
    following = np.roll(own, -1, axis=0)
    following[apart] = fp.fingerprints([nexts[k] for k in apart])
    edited_sha, inserted, deleted = [], [], []
    for text, after in zip(texts, nexts):
        cut = len(text) - len(text) // 4
        head = after[: len(text) - cut]
        edited_sha.append(hashlib.sha256((text[:cut] + head).encode("utf-8", "surrogatepass")).hexdigest())
        line = text.rfind("\n", 0, cut) + 1  # paragraphs before it stay
        deleted.append(text[line:])
        inserted.append(text[line:cut] + head)
    edited = fp.updated(own, inserted, deleted)

    def shown(rows: np.ndarray) -> list[str]:
        return [base64.b64encode(r.astype("<u2").tobytes()).decode() for r in rows]

    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": edited_sha,
        "fingerprint": shown(own),
        "edited_fingerprint": shown(edited),
        "near_edited": fp.likeness(own, edited).tolist(),
        "near_next": fp.likeness(own, following).tolist(),
    }


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document, of its edited text, and their likeness."""
    return fp.map_neighbours(
        documents(spark, sf_dir),
        _edit_report,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as byte-level BPE ids in sequences of 2048 tokens; digests are of the packed ids."""
    import public_tokenizers

    ws = Workspace(spark, "packing")
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.tokenize(documents(spark, sf_dir), path)
    packed = packing.widened(packing.pack(pieces.drop("ids_crc32"), ws))
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document segmented with merge-dropout and without, and decoded again.

    ``lossless``: the dropped segmentation decodes to the text, byte for byte.
    """
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    schema = "doc_id long, n_bytes long, n_pieces long, n_plain long, ids_crc32 long, plain_crc32 long, lossless boolean"
    names = [x.split()[0] for x in schema.split(", ")]

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", pieces.ENCODED_BYTES):
            for part in slices(batch, "text", pieces.ENCODED_BYTES):
                data, offsets = text_bytes(part.column("text"))
                docs = pieces.names_of(part.column("doc_id"))
                (ids, counts), (plain, plain_counts) = pieces.encode_both(data, offsets, docs, path)
                back, ends = pieces.decode_ids(ids, counts, path)
                rows = range(part.num_rows)

                def crc(values: np.ndarray, lengths: np.ndarray) -> list[int]:
                    at = np.r_[0, np.cumsum(lengths)]
                    raw = values.astype("<u4")
                    return [zlib.crc32(raw[at[k] : at[k + 1]].tobytes()) for k in rows]

                same = [
                    bool(np.array_equal(back[ends[k] : ends[k + 1]], data[offsets[k] : offsets[k + 1]]))
                    for k in rows
                ]
                columns = [np.diff(offsets), counts, plain_counts, crc(ids, counts), crc(plain, plain_counts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns), pa.array(same)],
                    names=names,
                )

    return documents(spark, sf_dir).select("doc_id", "text").mapInArrow(report, schema)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived as whole-file gzip, normalised to members, and read back by index."""
    ws = Workspace(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.encode("html", "UTF-8").alias("payload")
    )
    raw = ws.save(warc.write(warc.with_types(pages, ws), ws.path("raw")), "raw_files")
    members = ws.save(warc.normalise(raw, ws.path("members")), "member_files")
    return warc.read(members).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors, by label."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return caps.near_vectors(vectors, Workspace(spark, "caps"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels of the four fifths that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", (remainder(5) == 0).alias("held_out"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(5) != 0)
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    field = quality.train(docs.where("NOT held_out"), labels, Workspace(spark, "quality"))
    return quality.score(docs, field).drop("text")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 32 leading components, with unit variance."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.whitened(vectors, Workspace(spark, "whitening"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, a keyed 31st of them misspelt, with their commonest neighbours."""
    ws = Workspace(spark, "variants")
    return variants.spelling_variants(documents(spark, sf_dir), ws, one_in=31)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_language_id": op2_language_id,
    "op3_lm_score": op3_lm_score,
    "op4_secret_scan": op4_secret_scan,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_fingerprint": op6_fingerprint,
    "op7_packing": op7_packing,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_warc": op9_warc,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_quality": op11_quality,
    "op12_whitening": op12_whitening,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {
    "op1_minhash_dedup": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh
            FROM d),
        classes AS (
            SELECT doc_id, len(sh) AS n, sh,
                CASE WHEN len(sh) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY list_sort(sh)) END AS class_id
            FROM s),
        own AS (SELECT doc_id, n, unnest(sh) AS x FROM classes WHERE doc_id = class_id),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM own a JOIN own b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
        reach(a, b) AS (
            SELECT doc_id, doc_id FROM classes WHERE doc_id = class_id
            UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, n AS n_shingles, class_id, component_id, doc_id = component_id AS kept
        FROM classes JOIN least ON class_id = a""",
    "op10_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
        pairs AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE isfinite(list_cosine_similarity(a.e, b.e)) AND list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(a, b) AS (
            SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN least ON least.a = vec_id LEFT JOIN links ON links.a = vec_id""",
    "op5_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                lambda x: x <> '') AS w FROM documents),
        win AS (
            SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d)),
        least AS (SELECT s, min(doc_id) AS first_id FROM win GROUP BY s HAVING count(*) > 1),
        hit AS (SELECT doc_id, p FROM win JOIN least USING (s) WHERE first_id < doc_id),
        gone AS (SELECT DISTINCT doc_id, p + unnest(range(0, 13)) AS p FROM hit),
        per_doc AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
        kept AS (
            SELECT doc_id, w, coalesce(ps, []) AS ps FROM d LEFT JOIN per_doc USING (doc_id))
        SELECT doc_id, len(w) AS n_words, len(ps) AS n_removed,
            sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(ps, i)), ' ')) AS kept_sha256
        FROM kept""",
    "op9_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
        last AS (SELECT html, max(page_id) AS last_id FROM p WHERE n >= 1000 GROUP BY html)
        SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
            CASE WHEN last_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN last_id <> page_id THEN last_id END AS refers_to
        FROM p LEFT JOIN last ON p.html = last.html AND n >= 1000""",
}
