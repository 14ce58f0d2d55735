"""Corpus pipeline: documents through the stages in order, each written as
Parquet and reread as the next one's input.

Quality rules drop what they reject; near-duplicate removal keeps one document
of each group at a similarity of 0.8 (rows that share a doc_id are one document); decontamination drops
documents with a benchmark passage; personal data is replaced; what remains is
packed. Null doc_ids and other columns pass through every filter.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, neardup, packing, pii, quality
from tidemark.llm.common import saved, table
from tidemark.llm.queries import PII_KEY


NEAR = 80  # per cent of similarity; op5 has a contract of its own


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), share=decontam.SHARE)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace_entities(docs, PII_KEY).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("replace_personal_data", replace_personal_data),
    ("pack", pack),
]

#: Learned rules, minhash and tokenizers have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
