"""Surrogate keys that stay the same across refreshes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_HEX_DIGITS = 3  # 16**3 = 4096 buckets


def assign_keys(src: DataFrame, natural_keys, key_col: str, existing: DataFrame | None = None) -> DataFrame:
    """``src`` (unique on its natural keys) with a dense surrogate key.

    Keys of ``existing`` are kept; new rows continue after its largest key in
    the order (hash bucket, natural key). Hashing spreads unique keys evenly
    whatever they look like, each bucket is numbered on its own and only one
    row per bucket is summed up in order, so no task sees the whole table and
    a re-run gives the same numbers.
    """
    nat = list(natural_keys)
    if existing is None:
        known, top = src.withColumn(key_col, F.lit(None).cast("bigint")), F.lit(0)
    else:
        known = src.join(existing.select(*nat, F.col(key_col).cast("bigint").alias(key_col)), nat, "left")
        top = existing.agg(F.coalesce(F.max(key_col), F.lit(0))).scalar()
    is_new = F.col(key_col).isNull()
    text = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in nat])
    spread = known.withColumn("_bucket", F.substring(F.md5(text), 1, _HEX_DIGITS))

    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.filter(is_new).groupBy("_bucket").agg(F.count("*").alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    so_far = Window.partitionBy("_bucket").orderBy(*nat).rowsBetween(Window.unboundedPreceding, 0)
    number = top + F.col("_offset") + F.count_if(is_new).over(so_far)
    return (
        spread.join(F.broadcast(offsets), "_bucket", "left")  # at most 4096 rows
        .withColumn(key_col, F.coalesce(F.col(key_col), number))
        .select(key_col, *src.columns)
    )


def number_rows(df: DataFrame, natural_keys, key_col: str) -> DataFrame:
    """Dense numbers 1..n for rows that are unique on ``natural_keys``."""
    return assign_keys(df, natural_keys, key_col)
