"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read back as the next one's docs. All but the last return the columns of documents.

1. quality classifier: documents scored below 0.3 go;
2. quality rules: documents that fail the base rule or are mostly repeats go;
3. MinHash near-dedup (five-word shingles, similarity 0.8 or more): of each group the
   document with the least doc_id stays;
4. mixing: each source gives about its target of words; a document that is taken twice
   comes twice;
5. best-fit packing of all that is left into sequences of 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillcast.llm.common import table
from tillcast.llm.minhash import dedup
from tillcast.llm.mixing import mix
from tillcast.llm.packing import pack
from tillcast.llm.quality import filter_quality
from tillcast.llm.repetition import filter_repetition
from tillcast.session import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_quality(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_repetition(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: The classifier's fit, MinHash groups and token ids are beyond SQL; tests/llm compares the
#: pipeline with a plain version in Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
