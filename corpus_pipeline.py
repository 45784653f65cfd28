"""From raw documents to packed sequences.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and is
stored as Parquet before the next one reads it.  All but the last return the columns
of ``docs`` as they were.  ``ORACLE_SQL`` is None: language models, sketches and a
tokenizer are beyond SQL; tests hold the result against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.llm.decontaminate import decontaminate
from passbook.llm.exact import exact_duplicates
from passbook.llm.language import held_out, predict, train
from passbook.llm.minhash import near_duplicates
from passbook.llm.packing import pack_documents
from passbook.llm.tables import stored
from passbook.llm.tokens import TOKENIZER

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a letter, whatever their language is taken for."""
    learned = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")))
    told = predict(F.col("text"), train(learned))
    return docs.where(~told["rejected"])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_duplicates(docs).where("kept").select("document.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near-duplicates, of its smallest doc_id.

    Rows are told apart by doc_id and text, so an unrelated text under the doc_id of one
    that goes stays.
    """
    gone = near_duplicates(docs).where("NOT stays")
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("version").alias("gone_version")).distinct()
    same = (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_version"])
    return docs.join(gone, same, "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are less than a twentieth."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(docs, benchmark).where("contaminated")
    found = found.select(F.col("doc_id").alias("bad_id"), "version").distinct()
    same = docs["doc_id"].eqNullSafe(found["bad_id"]) & (F.xxhash64(docs["text"]) == found["version"])
    return docs.join(found, same, "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a training sequence."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
