"""A corpus from raw documents.

Documents of no clear language go; blocks of lines that stand in an earlier document
go; of documents with nearly the same fingerprint one stays; documents that contain a benchmark item
go; what is left is encoded. Each stage gets what the one before kept, as a stored table.
"""

from pyspark.sql import DataFrame, SparkSession

from riskwindow.llm import bpe, common, decontam, langid, linededup, simhash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; dictionaries are learnt from the labelled ones."""
    return langid.keep_accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shorter texts without the common blocks of lines of earlier documents."""
    return linededup.drop_blocks(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints at most three bits apart: the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontam.keep_clean(docs, common.table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.digests(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: Compression, diffs, fingerprints and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage but the last is written and read again.

    What a stage stores on its way is deleted as soon as its result is written; the results of the stages stay.
    """
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
