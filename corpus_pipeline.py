"""A training-data pipeline over `documents`.

Stages, in order: toxicity (rejected documents go), near-duplicates (one document of
each group stays), benchmark decontamination (documents that hold a benchmark item go),
secret scan (found secrets are masked in the text), and byte-level BPE (one row per
document: its token count, ids digest and the digest of the decoded text).

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of `docs`.  Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm import decontam, toxicity
from pitlane.llm.bpe import encode_digests
from pitlane.llm.common import read_table, stored
from pitlane.llm.neardup import judged_sets, set_keys
from pitlane.llm.secrets import mask_secrets


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, fitted on the labelled documents of this input, does not reject."""
    weights = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, weights)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8): the least id.

    Rows without an id stay; of rows that repeat an id with the same text one stays.
    """
    judged = stored(judged_sets(docs, width=5, percent=80), "judged")
    lost = stored(judged.where("NOT kept").select("doc_id").distinct(), "lost")
    # An id may be repeated with another text, which stays although this one goes.
    mixed = stored(judged.where("kept").join(lost, "doc_id", "left_semi").select("doc_id").distinct(), "mixed")
    left = docs.join(lost, "doc_id", "left_anti").select(docs.columns)
    if mixed.limit(1).count():
        stay = judged.where("kept").join(mixed, "doc_id", "left_semi").select(F.col("doc_id").alias("_id"), F.col("set_key").alias("_key")).distinct()
        keyed = set_keys(docs.join(mixed, "doc_id", "left_semi").select(docs.columns), 5)
        same = keyed["doc_id"].eqNullSafe(stay["_id"]) & keyed["_set_key"].eqNullSafe(stay["_key"])
        left = left.unionByName(keyed.join(stay, same, "left_semi").select(docs.columns))
    # Repeated ids are rare, so only their rows are compared with each other.
    often = stored(judged.where("kept AND doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not often.limit(1).count():
        return left
    single = left.join(often, "doc_id", "left_anti").select(docs.columns)
    repeated = left.join(often, "doc_id", "left_semi").select(docs.columns)
    return single.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; secrets in the text become `[secret]`, and n_chars, if present, the new length."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row."""
    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask),
    ("byte_bpe", tokenize),
]
# Learned weights, sketches and walks are not SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
