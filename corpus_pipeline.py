"""Corpus pipeline: from the documents table to token ids.

Each stage takes (spark, docs, sf_dir), works on all documents the one before it kept, and
returns a DataFrame that is written as Parquet and read again for the next one. All but the
last return the columns of documents.

1. quality: documents that the ordinal quality classifier rejects go;
2. language: documents whose language the fused evidence does not identify go;
3. near_duplicates: of each component of the exact Jaccard join one document stays;
4. decontamination: spans of benchmark windows are cut out, documents without other words go;
5. tokens: byte-level BPE ids, with a digest of the decoded text.

A NULL id, text, language or source is carried along as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanmart.llm.bpe import encode_digests
from loanmart.llm.common import materialize, read_table, ship_package
from loanmart.llm.decontamination import cut
from loanmart.llm.jaccard import keep_one
from loanmart.llm.language import keep_identified
from loanmart.llm.quality import keep_selected
from loanmart.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_selected(docs, read_table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return cut(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return encode_digests(docs, tokenizer_path(), with_ids=True).select("doc_id", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The classifier's decisions are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage: doc_id, n_tokens, ids, decoded_sha256."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
