"""Row filters. All are plain predicates, so they reach the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean(df: DataFrame, lo: float = 10000, hi: float = 500000) -> DataFrame:
    """Usable postings: identified, with plausible and ordered pay (or none)."""
    smin, smax = F.col("salary_min"), F.col("salary_max")
    return df.filter(
        F.col("job_title").isNotNull()
        & F.col("source").isNotNull()
        & F.col("sector").isNotNull()
        & (smin.isNull() | smin.between(lo, hi))
        & (smax.isNull() | smax.between(lo, hi))
        & (smin.isNull() | smax.isNull() | (smin <= smax))
    )


def salary_in_range(df: DataFrame, lo: float = 15000, hi: float = 500000) -> DataFrame:
    return df.filter(F.col("salary_midpoint").between(lo, hi))


def disclosed(df: DataFrame) -> DataFrame:
    code = F.col("disclosure_code")
    return df.filter(code.isNull() | (code == ""))


def has_occupation(df: DataFrame) -> DataFrame:
    """Rows with an occupation code that is not the all-occupations total."""
    return df.filter(~F.col("occ_code").startswith("00-"))


def mapped(df: DataFrame) -> DataFrame:
    return df.filter(F.col("soc_code") != "99-9999")


def since(df: DataFrame, as_of, days: int | None = None, months: int | None = None,
          col: str = "posted_date") -> DataFrame:
    """Rows not older than a number of days or months before ``as_of``."""
    day = F.lit(as_of).cast("date")
    start = F.add_months(day, -months) if months is not None else F.date_sub(day, days)
    return df.filter(F.col(col) >= start)


def in_any(df: DataFrame, choices: dict) -> DataFrame:
    """``{column: allowed values}``; an empty list leaves the column free."""
    tests = [F.col(c).isin(list(values)) for c, values in choices.items() if values]
    return df.filter(reduce(Column.__and__, tests)) if tests else df


def date_between(df: DataFrame, lo=None, hi=None, col: str = "posted_date") -> DataFrame:
    if lo is not None:
        df = df.filter(F.col(col) >= F.lit(lo).cast("date"))
    if hi is not None:
        df = df.filter(F.col(col) <= F.lit(hi).cast("date"))
    return df


def min_support(df: DataFrame, n: int, cols=("federal_postings", "private_postings")) -> DataFrame:
    return df.filter(reduce(Column.__and__, [F.col(c) >= n for c in cols]))


def state_totals(df: DataFrame, fips: str | None = None, own: str | None = None) -> DataFrame:
    """All-industry rows of states, optionally one state and one ownership."""
    df = df.filter((F.col("area_type") == "state") & (F.col("industry_code") == "10"))
    if fips is not None:
        df = df.filter(F.col("area_fips").startswith(fips))
    return df if own is None else df.filter(F.col("own_label") == own)


def not_null(df: DataFrame, cols) -> DataFrame:
    return df.dropna(subset=list(cols))
