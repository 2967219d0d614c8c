"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is written as Parquet and
read again as the next one's documents. All but the last return the columns they were given.

1. quality: documents that the quality classifier rejects (score under 0.3) go.
2. near_duplicates: of each group of documents linked by word shingles (five words, similarity 0.8 or more) the one
   with the least id stays.
3. decontaminate: documents of which a twentieth of the words or more stand in benchmark passages go.
4. secrets: credentials are cut out of the texts; values copied over many owners (examples, fixtures) stay.
5. encode: SentencePiece ids of each text, and whether decoding them gives the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm import base, decontaminate, jaccard, pieces, quality, secrets


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned from labelled training documents of this stage's input."""
    training = docs.where(base.fold(F.col("doc_id")) != 0)
    return quality.keep_good(docs, quality.train(training, base.table(spark, sf_dir, "labels")))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, size=5, share=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, base.table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, owner="source", repo=F.concat_ws("/", "source", "lang"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load()
    text_hash = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    decoded = pieces.encode(docs, vocabulary, F.col("doc_id"), F.col("lang"), F.col("source"), text_hash, decoded="decoded")
    return decoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.xxhash64("decoded") == F.col("text_hash")).alias("exact"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("encode", encode_stage),
]

#: Training, set joins and lattices are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = base.staged(docs, f"pipeline-{name}")
    return docs
