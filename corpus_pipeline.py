"""A training-data pipeline over ``documents``: quality rules, near-duplicates, secrets, mixing,
tokens.  Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes each stage's
result to the shared folder and reads it back as the next one's documents.

All stages but the last return the columns of documents.  Rows that a stage drops: texts that the
quality rules reject, all but one document of a group of near-duplicates, documents that the mix
does not take; a document that it takes twice comes twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import credentials, mixture, pieces, quality, simhash
from faultline.llm.common import saved, table, tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.assess(docs, model, prefix="_q_").filter("_q_kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return credentials.redact(credentials.scan(docs)).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixture.mix(docs).filter("mix_copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), round_trip=None)
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixing),
    ("sentencepiece", tokens),
]

#: Trained scores, components and random rounding have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
