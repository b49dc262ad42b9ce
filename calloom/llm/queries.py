"""One query per training-data operator, over whole tables, and its DuckDB text where SQL can say it."""

from __future__ import annotations

import os
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from calloom.llm import (
    bloom_lm, bpe_automaton, byte_bpe, hard_negatives, langid, line_quality, mixing, simhash, source_divergence, token_counts,
    toxicity, vamana, warc_zip,
)
from calloom.llm.common import crc_bucket
from calloom.session import stage, tune


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the operators."""
    # whole texts travel through Arrow: small batches keep a worker's memory flat
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    # .. in bytes too: a thousand very long texts, or a few graphs of shards, are not one batch
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    # literal tables of ranks would fill the driver's memory as text of plans
    spark.conf.set("spark.sql.maxPlanStringLength", "20000")
    # Python workers import this package from where the driver has it, if their own path lacks it
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))
    return tune(spark)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zip.round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    full = F.col("payload").isNotNull()
    return records.select(
        F.col("key").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_bucket(F.col("doc_id"), 5) == 0
    docs = _table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    model = toxicity.fit(docs.filter(~F.col("held_out")), labels)
    return toxicity.predict(docs, model)


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_vamana(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~held_out))
    found = langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op7_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def token_digests(docs: DataFrame) -> DataFrame:
    """Ids and decoded texts of documents, as digests; other columns stay."""
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe_automaton.round_trip(docs, path)
    return coded.withColumns({
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256),
        "decoded_sha256": F.sha2(F.col("decoded"), 256),
    }).drop("ids", "decoded")


def op8_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_bucket(F.col("doc_id"), 7) == 2
    docs = _table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    return bloom_lm.score(docs, ~F.col("held_out"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    slim = stage(mixing.measure(docs).drop("text"))
    return mixing.mix(slim).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "kept"
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text"), path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(_table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = _table(spark, sf_dir, "embeddings").filter(finite).select(
        F.col("vec_id").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"),
    )
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


QUERIES = {
    "op1_warc_zip": op1_warc_zip,
    "op2_toxicity": op2_toxicity,
    "op3_line_quality": op3_line_quality,
    "op4_vamana": op4_vamana,
    "op5_simhash": op5_simhash,
    "op6_langid": op6_langid,
    "op7_bpe_automaton": op7_bpe_automaton,
    "op8_bloom_lm": op8_bloom_lm,
    "op9_mixing": op9_mixing,
    "op10_token_counts": op10_token_counts,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_source_divergence": op12_source_divergence,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op12_source_divergence": source_divergence.oracle_sql(),
    "op13_hard_negatives": hard_negatives.oracle_sql(),
    "op3_line_quality": line_quality.oracle_sql(),
    "op9_mixing": mixing.oracle_sql(),
    "op1_warc_zip": """
        with p as (
            select page_id, coalesce(html, '') as html, sha256(coalesce(html, '')) as payload_digest,
                   cast(strlen(coalesce(html, '')) as bigint) as payload_bytes
            from pages
        ),
        f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by payload_digest)
        select page_id, payload_bytes, payload_digest,
               case when page_id > first then 'revisit' else 'response' end as record_type,
               case when page_id > first then first end as refers_to
        from p left join f using (payload_digest)
    """,
}
