"""A training corpus from raw documents: each stage works on all that its predecessor kept.

Stages return the columns of documents, but for the last, which returns ids' digests in place of the text. Every case that
an operator defines (nulls, empty and very long texts, repeated rows, empty tables) holds for its stage; columns beyond
those of documents are handed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from calloom.llm import langid, line_quality, mixing, simhash
from calloom.llm.common import crc_bucket
from calloom.llm.queries import prepare, token_digests
from calloom.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines; n_chars follows the text."""
    prepare(spark)
    return line_quality.clean(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with a score that calibration accepts."""
    prepare(spark)
    model = langid.fit(docs.filter(crc_bucket(F.col("doc_id"), 4) != 2))
    return langid.predict(docs, model).filter("accepted").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics weigh what their targets say."""
    prepare(spark)
    return mixing.mix(mixing.measure(docs)).filter("kept").select(*docs.columns)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of ids, and digests of ids and of the text they decode to."""
    prepare(spark)
    return token_digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("mixing_weights", mixing_weights),
    ("encode_and_decode", encode_and_decode),
]

#: A trained stage and a tokenizer have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again, applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
