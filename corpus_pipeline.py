"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its result is written as Parquet and read again. All but the last return
the columns of ``documents``. No stage reads other tables.

Rows without an id stay apart from each other and cannot be dropped as copies of
others. Null and empty texts are rejected by the first stage: they have no language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm import languages, minhash, packing, repeats, secrets
from pagequarry.llm.ranges import small_batches
from pagequarry.session import Workspace


# Intermediate tables of stages, which are of no use once the stage's result is written.
_OPEN: list[Workspace] = []


def _workspace(spark: SparkSession, docs: DataFrame, name: str) -> Workspace:
    """A folder for a stage's tables; those of earlier stages are deleted, unless ``docs`` reads them."""
    read = docs.inputFiles()
    for old in list(_OPEN):
        folder = f"/{old.root.rsplit('/', 1)[1]}/"
        if old.spark is not spark or not any(folder in file for file in read):
            _OPEN.remove(old)
            if old.spark is spark:
                old.close()
    _OPEN.append(Workspace(spark, name))
    return _OPEN[-1]


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents without a known language go; mixtures of known ones stay."""
    small_batches(spark)
    model = languages.learn(docs.select("text", "lang"))
    found = languages.identify(docs, model)
    return found.where(F.col("lang_pred") != languages.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near-duplicates the document with the least id stays.

    Rows that share an id are judged each by its own text; of those in one group one stays.
    """
    small_batches(spark)
    return minhash.kept_documents(docs, _workspace(spark, docs, "pipeline_minhash")).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: words of windows that an earlier document has go; a document left empty goes."""
    small_batches(spark)
    # smaller blocks than alone, since the executors still hold memory from the stages before
    found = repeats.remove_repeats(docs, _workspace(spark, docs, "pipeline_repeats"), block_bytes=5 << 20)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    found = found.where("n_removed < n_words OR n_removed = 0").withColumn("text", text)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: secrets become a mark; every document stays."""
    small_batches(spark)
    _workspace(spark, docs, "pipeline_secrets")
    cleaned = secrets.redact(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: pieces of documents, with their ids and the sequence and place they are packed in."""
    small_batches(spark)
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.tokenize(docs, path)
    return packing.widened(packing.pack(pieces, _workspace(spark, docs, "pipeline_packing")))


STAGES = [
    ("language", by_language),
    ("near_duplicates", near_duplicates),
    ("substrings", repeated_passages),
    ("secrets", without_secrets),
    ("packing", packed),
]

# SQL cannot express language identification, the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return docs
