"""The corpus pipeline: documents to packed sequences in five stages.

Each stage reads what its predecessor kept, written as Parquet. All but the last
return the columns of ``documents``, whatever further columns there are and however they
are named. An empty table stays empty through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.llm.exact_dedup import deduplicated
from opslake.llm.graph import cut, delete
from opslake.llm.language_id import accepted
from opslake.llm.mixing import mix
from opslake.llm.ngram_join import ngram_join, without
from opslake.llm.packing import best_fit_packing
from opslake.session import checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; null, empty and letterless texts go. Repeated rows stay."""
    return accepted(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest (then the smallest doc_id, a null one last)
    stays, and of rows repeated whole one. Null texts count as empty, so all of them are one group."""
    return deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a similarity of 0.8, the smallest doc_id stays.
    Texts without a word, and rows without a doc_id, are in no group and stay; rows of one doc_id go or stay together."""
    gone = ngram_join(docs, k=5, per_mille=800).where("component_id <> doc_id").select(F.col("doc_id").alias("doc")).distinct()
    return without(docs, cut(gone))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by temperature: every row at least once, small sources up to twice. A null source is a
    source; texts without a word are drawn once."""
    return mix(docs, repetitions=2.0).select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every row with their places in sequences of at most 1024 tokens. A null or
    empty text is one piece of one token."""
    return best_fit_packing(docs)


STAGES = [("language_id", language), ("exact_dedup", exact_copies), ("ngram_jaccard_join", near_copies),
          ("temperature_mixing", mixture), ("best_fit_packing", packed)]

#: no stage but exact dedup can be expressed in SQL; the tests compare each with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again.
    A stage's rows are deleted once the next one's are written."""
    base = f"{checkpoint_dir(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
        if before:
            delete(spark, f"{base}/{before}")
        before = name
    return docs
