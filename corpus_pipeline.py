"""From raw documents to token ids, one stage after the other.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns the columns of ``documents``; the last returns token ids. Stages
read the columns of ``documents`` only and drop any others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meritrix.llm import bpe, decontaminate, langid, ngram_join, pii
from meritrix.llm.tasks import fold
from meritrix.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text below this share of the best language could be of several languages. Only
#: texts of a few words are: whether a text is of a learned language, its words decide.
LEAST_SCORE = 0.5
#: Near duplicates: five-word n-grams, Jaccard of 0.8 or more.
NGRAM, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: null texts, texts without a
    letter, those whose best language has a share below LEAST_SCORE, and those of
    whose words it knows too few (``langid.predict``). A missing ``lang`` is filled in. Without any labelled row nothing can be recognised."""
    docs = docs.select(*COLUMNS)
    model = langid.train(langid.training_rows(docs, fold("doc_id", 4), 2))
    found = langid.predict(docs, model, keep=COLUMNS[1:])
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE) & F.col("known")).select(
        "doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars")


def _row_id() -> Column:
    """Names a row by its id and text, rows with an id first; no part is null."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
                    F.xxhash64("text").alias("text_hash"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays;
    of repeated rows one. Empty texts are in no group and stay, unless repeated."""
    docs = docs.select(*COLUMNS).withColumn("row", _row_id())
    groups = ngram_join.components(docs, n=NGRAM, percent=PERCENT, id_col="row")
    first = groups.where("row = component_id").select("row").distinct()
    return docs.join(first, "row", "left_semi").dropDuplicates(["row"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null texts hold none; repeated
    rows and null ids are judged like any other; an empty table stays empty."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, benchmark, keep=COLUMNS[1:])
    return found.where(~F.col("contaminated")).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in angle brackets; ``n_chars`` follows
    the text (null for a null text). Every row stays, repeated ones and null ids, too."""
    found = pii.find_pii(docs, keep=("lang", "source"), mask=True)
    return found.select("doc_id", F.col("masked_text").alias("text"), "lang", "source",
                        F.length("masked_text").cast("bigint").alias("n_chars"))


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, round_trip): ``ids`` are the token ids
    in order, and ``round_trip`` tells that they decode to the text's bytes. A null text
    is encoded as an empty one; repeated rows and null ids stay; no rows give no rows."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    named = docs.select(*COLUMNS).withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    keep = ("lang", "source", "text_sha256")
    encoded = bpe.encode(named, ranks, public_tokenizers.PATTERN, keep=keep)
    back = bpe.decode(encoded, ranks, keep=("doc_id", *keep, "n_tokens"), keep_ids=True)
    ids = F.when(F.col("n_tokens") == 0, F.array().cast("array<int>")).otherwise(F.split("ids", " ").cast("array<int>"))
    return back.select("doc_id", "lang", "source", "n_tokens", ids.alias("ids"),
                       (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("language identification", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", mask_personal_data),
    ("byte-level BPE", encode_text),
]

#: Trained models and BPE are beyond SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
