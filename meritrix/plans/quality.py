"""Data-quality checks on the unified postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.functions.aggregates import distinct_list, groups_over
from meritrix.functions.derive import norm_a, one_blank
from meritrix.operators.filters import clean, not_null
from meritrix.operators.windows import keep_best, top_k

POSTING_KEYS = ["source", "job_id"]
LOGICAL_KEYS = ["title_norm", "company_norm", "location_state", "posted_date"]


def pk_violations(df: DataFrame, keys=POSTING_KEYS) -> DataFrame:
    return groups_over(df, keys, 1)


def assert_unique(df: DataFrame, keys=POSTING_KEYS) -> None:
    """Raise when a key occurs more than once; reads back a single group."""
    if not pk_violations(df, keys).isEmpty():
        raise RuntimeError(f"duplicate keys over {list(keys)}; see pk_violations()")


def logical_key(postings: DataFrame) -> DataFrame:
    """Postings with a title and company, and the columns that identify one
    real-world posting. The NULL test is on stored columns, so it is pushed to
    the scan and not evaluated on the normalised text."""
    given = "job_title_normalized" in postings.columns
    title = F.col("job_title_normalized") if given else norm_a("job_title")
    rows = not_null(postings, ["job_title_normalized" if given else "job_title", "company_or_agency"])
    return rows.withColumns({"title_norm": one_blank(title), "company_norm": F.lower(F.trim("company_or_agency"))})


def near_duplicates(postings: DataFrame, limit: int | None = None) -> DataFrame:
    """Groups of postings that share title, company, state and date: one row per
    group with its count and sources, whatever its size. Counts combine before the
    shuffle. ``near_duplicate_members`` lists who is in them."""
    groups = (
        logical_key(not_null(postings, ["posted_date"])).groupBy(*LOGICAL_KEYS)
        .agg(F.count("*").alias("n_rows"), distinct_list("source").alias("sources"))
        .filter(F.col("n_rows") > 1)
    )
    order = [F.desc("n_rows"), *[F.asc(k) for k in LOGICAL_KEYS]]
    return groups.orderBy(*order) if limit is None else top_k(groups, order, limit)


def near_duplicate_members(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per group and posting. Groups are unique on their keys, so adaptive
    execution may split a group that holds a large share of the rows."""
    rows = logical_key(not_null(postings, ["posted_date"])).select(*LOGICAL_KEYS, "source", "job_id")
    wanted = groups.select(*[F.col(k).alias(f"_{k}") for k in LOGICAL_KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in LOGICAL_KEYS]
    return rows.join(wanted, same, "left_semi").distinct()


def jobs_clean(postings: DataFrame) -> DataFrame:
    return clean(postings)


def jobs_deduped(clean_postings: DataFrame) -> DataFrame:
    """One row per real-world posting: federal sources first, then the freshest."""
    rows = logical_key(clean_postings)
    order = [
        F.when(F.col("source").startswith("usajobs"), 0).otherwise(1),
        F.desc_nulls_first("ingestion_timestamp"),
        F.asc("job_id"),
    ]
    return keep_best(rows, LOGICAL_KEYS, order).select(*clean_postings.columns)


def quality_summary(postings: DataFrame) -> DataFrame:
    total = F.count("*")

    def missing(c):
        return F.count_if(F.col(c).isNull())

    return postings.groupBy("source").agg(
        total.alias("total_rows"),
        missing("job_title").alias("null_title"),
        missing("salary_min").alias("null_salary_min"),
        missing("salary_max").alias("null_salary_max"),
        missing("location_state").alias("null_state"),
        missing("location_city").alias("null_city"),
        missing("posted_date").alias("null_posted_date"),
        F.count_if(F.col("remote_type") == "unknown").alias("unknown_remote"),
        F.count_if(~F.col("experience_level").isin("entry", "mid", "senior")).alias("bad_exp_level"),
        F.round(F.count("salary_min").cast("double") * 100.0 / total, 1).alias("pct_has_salary"),
    ).orderBy("source")


def null_rates(postings: DataFrame) -> DataFrame:
    """Shares of missing pay and state and of unknown remote type, in percent."""
    s = quality_summary(postings)
    return s.select("source", *[
        F.round(F.col(c).cast("double") * 100.0 / F.col("total_rows"), 1).alias(name)
        for c, name in (("null_salary_min", "pct_null_salary"), ("null_state", "pct_null_state"),
                        ("unknown_remote", "pct_unknown_remote"))
    ])


def silver_row_counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy("source").agg(F.count("*").alias("n")).orderBy("source")


def quality_report(postings: DataFrame, limit: int = 50) -> dict[str, DataFrame]:
    return {
        "row_counts": silver_row_counts(postings),
        "pk_violations": pk_violations(postings),
        "near_duplicates": near_duplicates(postings, limit),
        "quality_summary": quality_summary(postings),
    }
