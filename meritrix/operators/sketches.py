"""Mergeable summaries: one stored row per group and period, merged for any longer period.

A quantile sketch (KLL) and a distinct-count sketch (HLL) of a day are a few kilobytes
whatever the day's rows, so medians and distinct counts over months read a few
rows per day instead of all postings. Days that change are summarised anew, the
others keep theirs. Exact counterparts are in ``operators.quantiles`` and below.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of the quantile sketches: the rank of an answer is within ``rank_error`` of the
#: asked one with 99 % confidence (the normalised error of such sketches).
KLL_K = 400
#: log2 of the registers of the distinct-count sketches.
HLL_LG = 12


def rank_error(k: int = KLL_K) -> float:
    """Normalised rank error of one answer with 99 % confidence."""
    return 2.296 / k ** 0.9021


def distinct_error(lg: int = HLL_LG, deviations: float = 3.0) -> float:
    """Relative error of a distinct count, as a number of standard deviations."""
    return deviations * 1.04 / math.sqrt(2 ** lg)


def summarised(rows: DataFrame, by: list[str], values: tuple[str, ...] = (), distinct: tuple[str, ...] = ()) -> DataFrame:
    """One row per group: ``n`` rows, ``kll_<column>`` for each column of numbers and
    ``hll_<column>`` for each column to count. Sketches are built on the map side and
    merged after the shuffle, so a hot group moves a sketch per task, not its rows.
    A group without a value has a NULL sketch."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in values:
        aggs += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)).alias(f"kll_{c}"), F.count(c).alias(f"n_{c}")]
    aggs += [F.hll_sketch_agg(c, F.lit(HLL_LG)).alias(f"hll_{c}") for c in distinct]
    out = rows.groupBy(*by).agg(*aggs)
    return out.withColumns({f"kll_{c}": F.when(F.col(f"n_{c}") > 0, F.col(f"kll_{c}")) for c in values}) if values else out


def merged(summaries: DataFrame, by: list[str]) -> DataFrame:
    """Summaries of fewer, larger groups, from those of their parts."""
    aggs = [F.sum("n").alias("n")]
    for c in summaries.columns:
        if c.startswith("kll_"):
            aggs.append(F.kll_merge_agg_double(c, F.lit(KLL_K)).alias(c))
            aggs.append(F.sum(f"n_{c[4:]}").alias(f"n_{c[4:]}"))
        elif c.startswith("hll_"):
            aggs.append(F.hll_union_agg(c).alias(c))
    out = summaries.groupBy(*by).agg(*aggs)
    kll = [c for c in summaries.columns if c.startswith("kll_")]
    return out.withColumns({c: F.when(F.col(f"n_{c[4:]}") > 0, F.col(c)) for c in kll}) if kll else out


def quantile_of(sketch: str, p: float) -> Column:
    """A value whose rank is about ``p``; NULL of a NULL sketch."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(p)))


def distinct_of(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)


def exact_distinct(rows: DataFrame, by: list[str], column: str, name: str = "n_distinct") -> DataFrame:
    """Distinct values per group by two combinable counts: the values of a hot group are
    spread over tasks, and only one number per group meets."""
    values = rows.dropna(subset=[column]).groupBy(*by, column).agg(F.lit(1).alias("one"))
    return values.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def ranks_of(rows: DataFrame, answers: DataFrame, by: list[str], column: str, answer: str) -> DataFrame:
    """(by, low, high, n): the share of a group's values below an answer and of those
    up to it, to hold an approximate quantile against the truth. Groups may be NULL."""
    named = answers.select(*(F.col(c).alias(f"_{c}") for c in by), F.col(answer).alias("_answer"))
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    met = rows.dropna(subset=[column]).join(named, same)
    return met.groupBy(*by).agg(
        (F.count_if(F.col(column) < F.col("_answer")) / F.count(F.lit(1))).alias("low"),
        (F.count_if(F.col(column) <= F.col("_answer")) / F.count(F.lit(1))).alias("high"), F.count(F.lit(1)).alias("n"))
