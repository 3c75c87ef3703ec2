"""A text corpus made ready for training: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the next stage's docs. All but the last return the columns of
`documents`."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerops.llm import bpe, line_dedup, mixing, simhash, toxicity
from ledgerops.llm.common import prepare, stored, table
from ledgerops.llm.queries import RANKS


def toxic_documents_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or over their language's toxicity limit go."""
    prepare(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(~F.col("rejected")).select(*docs.columns)


def common_lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten documents or more go, everywhere; n_chars follows."""
    prepare(spark)
    found = line_dedup.dedup_lines(docs, min_docs=10, shortest=1)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that with the smallest doc_id."""
    prepare(spark)
    return simhash.without_near_duplicates(docs, words=3, distance=2)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once for every time that the mix takes them, shard by shard."""
    prepare(spark)
    return mixing.mix(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every row that the mix gave."""
    prepare(spark)
    path = public_tokenizers.path(RANKS)
    coded = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxic_documents_out),
    ("line_dedup", common_lines_out),
    ("simhash_near_dedup", near_copies_out),
    ("mixing", mixed_sources),
    ("byte_bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before it is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Learned scores and a drawn mix have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None
