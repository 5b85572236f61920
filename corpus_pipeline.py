"""A training corpus from raw documents, in stages that each see all that the one before kept.

1. Documents whose language is not identified go.
2. Of each group of near copies one document stays.
3. Documents that hold a benchmark item go.
4. Secrets are replaced in the texts.
5. What is left is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starflow.llm.decontaminate import drop_leaks
from starflow.llm.jaccard import keep_one_of_each
from starflow.llm.langid import keep_identified, learn_languages
from starflow.llm.packing import pack_documents
from starflow.llm.secret_scan import redact_secrets
from starflow.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language the model, learnt from those that name one, does not reject."""
    return keep_identified(docs, learn_languages(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group linked by five-word shingles, at 80 per cent."""
    return keep_one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of the benchmark table."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets in their texts replaced."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's pieces stand in sequences of 4096 tokens."""
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [("language", language), ("near_copies", near_copies), ("leaks", leaks), ("secrets", secrets),
          ("packing", packing)]

#: Models and tokenizers are beyond SQL; the tests compare ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents, each result stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
