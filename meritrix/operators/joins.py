"""Joins against dimensions and lookups.

Equi joins are left to the planner: a side whose size is known to be small is
broadcast, anything else is a sort-merge join that adaptive execution may
split. Where one key can hold a large share of the rows, ``lookup_join`` salts
exactly those keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_SHARE = 0.001  # a key with more than this share of the rows is hot
BROADCAST_BYTES = 64 << 20
TASK_ROWS = 1_000_000  # rows of a hot key in one task
NO_KEY_PARTS = 4_096  # parts of the rows without a key, which only have to go somewhere


def hot_keys(df: DataFrame, on, share: float = HOT_SHARE, weight: str | None = None) -> DataFrame:
    """Keys holding more than ``share`` of the rows: at most ``1/share`` of them."""
    return hot_key_salts(df, on, share, weight).select(*on)


def hot_key_salts(df: DataFrame, on, share: float = HOT_SHARE, weight: str | None = None,
                  task_rows: int = TASK_ROWS) -> DataFrame:
    """Hot keys with ``_salts``: as many parts as their counted rows need."""
    rows = F.sum(weight) if weight else F.count("*")
    counts = df.dropna(subset=list(on)).groupBy(*on).agg(rows.alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    parts = F.greatest(F.ceil(F.col("_n") / task_rows), F.lit(1)).cast("int")
    return counts.filter(F.col("_n") > total * share).select(*on, parts.alias("_salts"))


def salted_join(left: DataFrame, right: DataFrame, on, row_id, hot: DataFrame,
                how: str = "left", salts: int = 64) -> DataFrame:
    """Equi join that spreads each hot key over its ``_salts`` tasks (``salts``
    where ``hot`` does not count them).

    Right rows of a hot key are repeated once per salt; left rows pick a salt
    from a hash of ``row_id``, which a retried task repeats. Left rows with a
    NULL key match nothing and are spread over NO_KEY_PARTS.
    """
    on = list(on)
    if "_salts" not in hot.columns:
        hot = hot.withColumn("_salts", F.lit(salts))
    marks = F.broadcast(hot.select(*on, "_salts"))  # <= 1/share rows
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in on])
    spread = F.when(no_key, F.lit(NO_KEY_PARTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    l = left.join(marks, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*row_id), spread).cast("int")).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    r = right.join(marks, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return l.join(r, [*on, "_salt"], how).drop("_salt")


def size_of(df: DataFrame) -> int:
    """Bytes that the rows take in memory, about: texts by their length, other cells and
    each row at a flat rate. One sum that combines in the tasks."""
    per_row = F.lit(32)
    for f in df.schema.fields:
        text = isinstance(f.dataType, (T.StringType, T.BinaryType))
        per_row += (F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) if text else F.lit(0)) + 16
    return df.agg(F.coalesce(F.sum(per_row.cast("bigint")), F.lit(0)).alias("n")).first().n


def fits(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a frame is small enough to broadcast, by the bytes of its rows."""
    return size_of(df) <= most


def lookup_join(left: DataFrame, right: DataFrame, on, row_id, how: str = "left",
                most: int = BROADCAST_BYTES, hot: DataFrame | None = None) -> DataFrame:
    """Join a stored lookup: broadcast while its rows take at most ``most`` bytes, salted
    beyond that."""
    if fits(right, most):
        return left.join(F.broadcast(right), list(on), how)
    hot = hot_key_salts(left, on) if hot is None else hot
    return salted_join(left, right, on, row_id, hot, how)


def join_location(postings: DataFrame, dim: DataFrame) -> DataFrame:
    right = dim.select(
        "location_key", F.col("city").alias("location_city"), F.col("state").alias("location_state"),
        F.col("country").alias("location_country"),
    )
    return lookup_join(postings, right, ["location_city", "location_state", "location_country"], ["source", "job_id"])


def join_company(postings: DataFrame, dim: DataFrame) -> DataFrame:
    right = dim.select("company_key", F.col("company_name").alias("company_or_agency"))
    return lookup_join(postings, right, ["company_or_agency"], ["source", "job_id"])


def join_category(postings: DataFrame, dim: DataFrame) -> DataFrame:
    right = dim.select("category_key", F.col("category_name").alias("job_category"))
    return lookup_join(postings, right, ["job_category"], ["source", "job_id"])


def label_category(counts: DataFrame, dim: DataFrame) -> DataFrame:
    """Category group of rows already aggregated by ``job_category``; labels
    that the dimension lacks are 'Other'."""
    right = dim.select(F.col("category_name").alias("job_category"), F.col("category_group").alias("_group"))
    return (
        counts.join(right, "job_category", "left")
        .withColumn("category_group", F.coalesce("_group", F.lit("Other")))
        .drop("_group")
    )


def join_occupation(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts with a resolved occupation. The dimension has one row per code of
    the public occupation list (under a thousand), so it is always broadcast
    and a frequent occupation never piles up in one task."""
    return fact.join(F.broadcast(dim), "occupation_key")


def join_benchmark(postings: DataFrame, national: DataFrame) -> DataFrame:
    """Postings with the national wage row of their occupation, if any."""
    return postings.join(national.withColumnRenamed("occ_code", "soc_code"), "soc_code", "left")


def join_wage_occupation(oews: DataFrame, dim: DataFrame) -> DataFrame:
    right = dim.select("occupation_key", F.col("soc_code").alias("occ_code"))
    return oews.join(F.broadcast(right), "occ_code", "left")  # one row per public code


def without(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key is not among ``keys`` (NOT IN over non-null keys)."""
    return df.join(keys.select(*on), list(on), "left_anti")


def having_match(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_semi")


def merge_join(target: DataFrame, src: DataFrame, keys) -> DataFrame:
    """Both sides by key as structs ``t`` and ``s`` (NULL where absent)."""
    keys = list(keys)
    t = target.select(*keys, F.struct(*target.columns).alias("t"))
    s = src.select(*keys, F.struct(*src.columns).alias("s"))
    return t.join(s, keys, "full_outer")
