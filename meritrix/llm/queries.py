"""The queries op1 to op13 over the given tables, and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meritrix.llm import (
    bpe, chat, decontaminate, langid, merkle, ngram_join, oracle, pii, quality, repair, rules, sentencepieces,
    sharding, token_counts,
)
from meritrix.llm.tasks import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = dict(oracle.SQL)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold 0 of five is held out, fold 4 calibrates, the others fit."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                            fold_of_id=fold("doc_id", 5), held_out=0, calibration=4)


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_pii(table(spark, sf_dir, "documents")))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: What the added conversation -1 says in both of its turns.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


@query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.read_back(chat.windows(turns)))


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), [1.0] * 16, grown=[1.0] * 17)


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"), n=3, percent=90)


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.train(langid.training_rows(documents, fold("doc_id", 4), 2))
    return langid.predict(documents, model).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.digests(repair.damage(conversations), conversations)


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In a fifth of the rows, text is tampered with: its A-Z become lower case."""
    documents = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars"]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.when(fold("doc_id", 5) == 0, merkle.leaf([*columns, lower]))
    return merkle.digests(merkle.manifest(documents, [*columns, "text"], changed=changed))


@query
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``agrees``: the sentencepiece library gives the same ids."""
    return sentencepieces.round_trip_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), check=True)
