"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes each stage's rows and reads them again.
All stages but the last return the columns of ``documents``, and more columns of any name pass through. An empty table gives no rows at each stage;
texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.llm import decontaminate, minhash, packing, secrets, tokens, toxicity
from lociq.llm.common import release, staged, table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of an expected severity below the limit. Null and empty texts stay, repeated rows are judged each."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the smallest doc_id.

    Repeated rows (doc_id and text) are one document, of which one row stays. Rows of one doc_id with different texts are judged each. Null and empty texts
    are like no other and stay; so do rows of a null doc_id, one of each text.
    """
    names = docs.columns
    key = "of_text"
    while key in names:
        key += "_"
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id", F.col("text_hash").alias(key))
    own = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    return own.join(gone, ["doc_id", key], "left_anti").dropDuplicates(["doc_id", key]).select(*(F.col(f"`{c}`") for c in names))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item. Null and empty texts stay, repeated rows are judged each."""
    return decontaminate.without_overlaps(docs, table(spark, sf_dir, "benchmark"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows a changed text. Null and empty texts stay as they are, and so do repeated rows."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset. Null and empty texts are one end id, repeated rows are packed each."""
    return packing.pack(docs, tokens.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity_filter), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secrets", secret_redaction), ("packing", best_fit_packing)]
# learned models, similarity components and token ids have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; what a stage wrote goes once the next one has read it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        last, docs = docs, staged(stage(spark, docs, sf_dir), name)
        release(last)
    return STAGES[-1][1](spark, docs, sf_dir)
