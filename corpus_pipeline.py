"""From raw documents to packed training sequences, in stages of whole-table jobs.

Every stage reads the documents its predecessor kept, as a table in the shared folder, so
a lost executor costs at most the tasks of one stage.

Defined cases: documents with a null or empty text fail the quality rules; a document in no
language that can be told goes, unless no language can be learned at all; of documents whose
fingerprints are near, repeated rows and null ids among them, one row stays; without a
benchmark no document is contaminated; very long texts are worked through in runs and cut to
whole sequences; ties go as each operator says; an empty table stays empty; all stages but
the last keep the columns of the documents, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayflow.llm import bands, langid, packing, simhash, wumanber
from stayflow.llm.text import documents
from stayflow.session import materialize

#: The stages compress, classify, hash and tokenize; SQL cannot express them.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return bands.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, read without ambiguity."""
    return langid.keep_identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage of note."""
    return wumanber.decontaminate(docs, documents(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, placed in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
