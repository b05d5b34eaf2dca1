"""Best-row, top-k, ordering and set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meritrix.operators.joins import NO_KEY_PARTS, fits, hot_key_salts
from meritrix.session import stored

#: Largest k for which Spark cuts a key's rows before the shuffle
#: (``spark.sql.optimizer.windowGroupLimitThreshold``).
GROUP_LIMIT = 1_000


def top_k_per_group(df: DataFrame, keys, order, k: int) -> DataFrame:
    """First ``k`` rows per key in ``order`` (which must be total).

    Up to GROUP_LIMIT the filter on the row number becomes a WindowGroupLimit
    before the shuffle: each map task sends at most ``k`` rows per key, so a key
    that holds a third of the table costs no more than any other. For a larger
    ``k`` the rows of a hot key are first cut to ``k`` in each of as many parts as its
    counted rows need; rows without a key have a fixed, large number of parts.
    """
    if k > GROUP_LIMIT:
        keys = list(keys)
        no_key = reduce(Column.__or__, [F.col(c).isNull() for c in keys])
        marks = F.broadcast(hot_key_salts(df, keys))  # keys over 0.1 % of the rows
        parts = F.when(no_key, F.lit(NO_KEY_PARTS)).otherwise(F.coalesce("_salts", F.lit(1)))
        dealt = df.join(marks, keys, "left").withColumn("_part", F.pmod(F.xxhash64(*df.columns), parts)).drop("_salts")
        df = _first(dealt, [*keys, "_part"], order, k).select(*df.columns)
    return _first(df, keys, order, k)


def _first(df: DataFrame, keys, order, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def keep_best(df: DataFrame, keys, order) -> DataFrame:
    return top_k_per_group(df, keys, order, 1)


def best_of_repeated(df: DataFrame, keys, order) -> DataFrame:
    """``keep_best`` for rows of which most have a key of their own: only those of repeated
    keys are shuffled and ranked, the others pass where they lie.

    Keys are counted by a hash first, which reads the key columns alone. Keys that share
    a hash are ranked for nothing, and lose no row. With more repeated keys than a
    broadcast takes, all rows are ranked.
    """
    mark = F.xxhash64(*keys)
    counted = df.groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = stored(counted.where("_n > 1").select("_mark"))
    if repeated.isEmpty():
        return df
    if not fits(repeated):
        return keep_best(df, keys, order)
    marked, few = df.withColumn("_mark", mark), F.broadcast(repeated)
    ranked = keep_best(marked.join(few, "_mark", "left_semi").drop("_mark"), keys, order)
    return marked.join(few, "_mark", "left_anti").drop("_mark").unionByName(ranked)


def any_row(df: DataFrame) -> Column:
    """Tie-breaker that makes an order repeatable at the cost of one sort key."""
    return F.xxhash64(*df.columns)


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    """ORDER BY .. LIMIT k; planned as TakeOrderedAndProject, never a full sort."""
    return df.orderBy(*order).limit(k)


def rows_of_top_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows of the ``n`` most frequent groups (ties by key)."""
    top = top_k(
        df.groupBy(key).agg(F.count("*").alias("_n")), [F.desc("_n"), F.asc(key)], n
    ).select(key)
    return df.join(F.broadcast(top), key, "left_semi")  # at most n rows


def diff_prev(df: DataFrame, part, order, value: Column) -> Column:
    """Change against the previous row of the partition."""
    return value - F.lag(value).over(Window.partitionBy(*part).orderBy(*order))


def sort_columns(mode: str) -> list[Column]:
    first = {
        "newest": F.desc_nulls_last("posted_date"),
        "oldest": F.asc_nulls_last("posted_date"),
        "salary_desc": F.desc_nulls_last("salary_max"),
        "salary_asc": F.asc_nulls_last("salary_min"),
    }[mode]
    return [first, F.asc("source"), F.asc("job_id")]


def resort(df: DataFrame, mode: str) -> DataFrame:
    return df.orderBy(*sort_columns(mode))


def union_all(dfs) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
