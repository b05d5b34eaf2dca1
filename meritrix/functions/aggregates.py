"""Aggregate expressions and small aggregate shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meritrix.functions.derive import _col


def rounded(c: Column, digits: int = 0) -> Column:
    return F.round(c, digits)


def count_if(predicate: Column) -> Column:
    return F.count_if(predicate)


def count_distinct(c) -> Column:
    return F.count_distinct(_col(c))


def latest_by(value, order) -> Column:
    return F.max_by(_col(value), _col(order))


def representative(c) -> Column:
    """One value of the group; the smallest, so that re-runs agree."""
    return F.min(_col(c))


def distinct_list(c) -> Column:
    """Sorted distinct values. Only for columns with few distinct values per
    group (labels such as ``source``); members are rows of
    ``near_duplicate_members``, never a list."""
    return F.sort_array(F.collect_set(_col(c)))


def median(c) -> Column:
    return F.median(_col(c))


def percentile_cont(c, p: float) -> Column:
    return F.percentile(_col(c), F.lit(p))


def mean_of_months(m1, m2, m3) -> Column:
    """Mean of a quarter's months, a missing month counting as zero."""
    zero = F.lit(0)
    return (F.coalesce(_col(m1), zero) + F.coalesce(_col(m2), zero) + F.coalesce(_col(m3), zero)) / 3.0


def safe_ratio(n, d) -> Column:
    """n/d, NULL unless d is positive."""
    return F.when(_col(d) > 0, _col(n) / _col(d))


def count_by(df: DataFrame, keys, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def groups_over(df: DataFrame, keys, n: int = 1) -> DataFrame:
    return count_by(df, keys).filter(F.col("n") > n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct()


def collapse_max(df: DataFrame, keys, measures) -> DataFrame:
    """Column-wise maximum per key (not the latest row)."""
    return df.groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures])


def pivot_sector(df: DataFrame, keys, measures, sectors=("federal", "private")) -> DataFrame:
    """One column per (sector, measure); the sector list is fixed, so there is
    no extra pass to find the pivot values."""
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("sector") == s, F.col(m))).alias(f"{s}_{m}")
            for s in sectors
            for m in measures
        ]
    )


def share_of(counts: DataFrame, part_keys, count_col: str = "job_count", name: str = "pct_of_source") -> DataFrame:
    """Each row's percentage of its partition's total.

    The totals are a second, combinable aggregation joined back, not a window:
    a window would pull a whole partition (one source can be most of the rows
    when categories are free text) into one task. The totals have one row per
    value of ``part_keys``; joins pick their strategy from the real size.
    """
    totals = counts.groupBy(*part_keys).agg(F.sum(count_col).alias("_total"))
    t = totals.select(*[F.col(k).alias(f"_{k}") for k in part_keys], "_total")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in part_keys]
    share = F.round(F.col(count_col).cast("double") * 100.0 / F.col("_total"), 2)
    return (
        counts.join(t, same)
        .withColumn(name, share)
        .drop("_total", *[f"_{k}" for k in part_keys])
    )


def peak_to_trough(series: DataFrame, y0: int, y1: int, value: str = "state_employment") -> DataFrame:
    """Relative fall from the highest to the lowest value in a year window."""
    ends = series.filter(F.col("year").between(y0, y1)).agg(
        F.max(value).alias("peak"), F.min(value).alias("trough")
    )
    return ends.withColumn("drop_share", F.when(F.col("peak") > 0, 1 - F.col("trough") / F.col("peak")))


def counters(spark, **single_values: DataFrame) -> DataFrame:
    """One row holding the single value of each given one-row frame."""
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in single_values.items()])
