"""Analytical views over clean postings and the Gold facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.functions import derive as D
from meritrix.functions.aggregates import latest_by, pivot_sector, representative, safe_ratio, share_of
from meritrix.operators.filters import mapped, not_null, salary_in_range, since, state_totals
from meritrix.operators.joins import join_benchmark, join_occupation, label_category
from meritrix.operators.quantiles import group_quantiles
from meritrix.operators.windows import diff_prev

CLEAN_RANGE = (10000, 500000)      # what clean() lets through
MIDPOINT_RANGE = (15000, 500000)   # what salary_in_range() lets through


def _same(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join two aggregates of the same groups (NULL is a group, too)."""
    r = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    out = left.join(r, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], how)
    return out.drop(*[f"_{k}" for k in keys])


def salary_by_sector(clean: DataFrame) -> DataFrame:
    keys = ["sector", "source", "experience_level"]
    lo, hi = F.col("salary_min"), F.col("salary_max")
    base = clean.groupBy(*keys).agg(
        F.count("*").alias("job_count"),
        F.count_if(lo.isNotNull() | hi.isNotNull()).alias("jobs_with_salary"),
        F.round(F.avg(F.coalesce(lo, hi)), 0).alias("avg_salary_low"),
        F.round(F.avg(F.coalesce(hi, lo)), 0).alias("avg_salary_high"),
        F.round(F.avg(D.present_mean(lo, hi)), 0).alias("avg_salary_mid"),
    )
    spread = group_quantiles(
        clean, keys,
        {
            "median_salary_min": ("salary_min", 0.5),
            "median_salary_max": ("salary_max", 0.5),
            "p25_salary": ("salary_min", 0.25),
            "p75_salary": ("salary_max", 0.75),
        },
        *CLEAN_RANGE, few_groups=True,  # sector, source and level are fixed labels
    )
    rounded = spread.select(*keys, *[F.round(c, 0).alias(c) for c in spread.columns if c not in keys])
    return _same(base, rounded, keys)


def experience_by_sector(clean: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Counted per category first, labelled after: the join sees a few rows
    per category instead of every posting."""
    per_label = clean.groupBy("sector", "source", "experience_level", "employment_type", "job_category").agg(
        F.count("*").alias("n")
    )
    return experience_shares(per_label, dim_category)


def experience_shares(per_label: DataFrame, dim_category: DataFrame) -> DataFrame:
    """The view from its counts ``n`` per category."""
    counts = label_category(per_label, dim_category).groupBy(
        "sector", "source", "experience_level", "employment_type", "category_group"
    ).agg(F.sum("n").alias("job_count"))
    return share_of(counts, ["sector", "source"])


def geo_distribution(clean: DataFrame) -> DataFrame:
    return (
        not_null(clean, ["location_state"])
        .groupBy("location_state", "location_city", "location_country", "sector", "source", "experience_level")
        .agg(
            F.count("*").alias("job_count"),
            F.count_if("is_entry_level").alias("entry_level_count"),
            F.round(F.avg(F.coalesce("salary_min", "salary_max")), 0).alias("avg_salary"),
        )
    )


def remote_by_sector(clean: DataFrame) -> DataFrame:
    counts = clean.groupBy("sector", "source", "remote_type", "experience_level").agg(F.count("*").alias("job_count"))
    return share_of(counts, ["sector", "source"])


def category_by_sector(clean: DataFrame, dim_category: DataFrame) -> DataFrame:
    per_label = clean.groupBy("sector", "source", "job_category", "experience_level").agg(
        F.count("*").alias("job_count")
    )
    return share_of(label_category(per_label, dim_category), ["sector", "source"])


def top_employers(clean: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Postings per employer and level; ``sector`` is the posting's own."""
    per_name = not_null(clean, ["company_or_agency"]).groupBy(
        "sector", "source", "company_or_agency", "experience_level"
    ).agg(
        F.count("*").alias("job_count"),
        F.count_if("is_entry_level").alias("entry_level_count"),
        F.round(F.avg("salary_min"), 0).alias("avg_salary_min"),
    )
    return employers_labelled(per_name, dim_company)


def employers_labelled(per_name: DataFrame, dim_company: DataFrame) -> DataFrame:
    """The view from its counts per employer name."""
    parents = dim_company.select(F.col("company_name").alias("company_or_agency"), "agency_parent")
    return (
        per_name.join(parents, "company_or_agency", "left")
        .withColumn("employer_label", F.coalesce("agency_parent", "company_or_agency"))
        .drop("agency_parent")
        .orderBy(F.desc("job_count"))
    )


def posting_trends(clean: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Weekly volumes (weeks start on Monday) of the last months."""
    return (
        since(clean, as_of, months=months)
        .groupBy(F.date_trunc("week", "posted_date").cast("date").alias("week_start"),
                 "sector", "source", "experience_level")
        .agg(
            F.count("*").alias("job_count"),
            F.count_if("is_entry_level").alias("entry_level_count"),
            F.round(F.avg("salary_min"), 0).alias("avg_salary_min"),
        )
        .orderBy("week_start", "sector")
    )


def entry_salary_gap(clean: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Entry-level pay per category group and sector, with the change against
    the previous sector of the group."""
    entry = clean.filter(
        F.col("is_entry_level") & (F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull())
    ).withColumn("mid", D.present_mean("salary_min", "salary_max"))
    per_label = entry.groupBy("job_category", "sector", "mid").agg(
        F.count("*").alias("n"),
        F.sum("salary_min").alias("sum_min"), F.count("salary_min").alias("n_min"),
        F.sum("salary_max").alias("sum_max"), F.count("salary_max").alias("n_max"),
    )
    labelled = label_category(per_label, dim_category)
    keys = ["category_group", "sector"]
    base = labelled.groupBy(*keys).agg(
        F.sum("n").alias("job_count"),
        (F.sum("sum_min") / F.nullif(F.sum("n_min"), F.lit(0))).alias("mean_min"),
        (F.sum("sum_max") / F.nullif(F.sum("n_max"), F.lit(0))).alias("mean_max"),
    )
    middle = group_quantiles(labelled, keys, {"median_salary_mid": ("mid", 0.5)}, *CLEAN_RANGE,
                             weight="n", few_groups=True)  # fixed group and sector labels
    both = _same(base, middle, keys)
    gap = diff_prev(both, ["category_group"], ["sector"], F.col("mean_min"))
    return both.select(
        *keys, "job_count",
        F.round("mean_min", 0).alias("avg_salary_min"),
        F.round("mean_max", 0).alias("avg_salary_max"),
        F.round("median_salary_mid", 0).alias("median_salary_mid"),
        F.round(gap, 0).alias("salary_gap_vs_prev_sector"),
    )


def salary_gap(fact: DataFrame, dim_occupation: DataFrame, exact: bool = True) -> DataFrame:
    """Median advertised pay per occupation, federal against private."""
    rows = salary_in_range(fact).select("occupation_key", "sector", "salary_midpoint")
    group = ["occupation_key", "sector"]
    if exact:
        counts = rows.groupBy(*group).agg(F.count("*").alias("postings"))
        medians = _same(counts, group_quantiles(
            rows, group, {"median": ("salary_midpoint", 0.5)}, *MIDPOINT_RANGE,
            few_groups=True,  # occupations come from the resolver's lookup tables
        ), group)
    else:
        medians = rows.groupBy(*group).agg(
            F.percentile_approx("salary_midpoint", 0.5).alias("median"), F.count("*").alias("postings")
        )
    named = mapped(join_occupation(medians, dim_occupation))
    sides = pivot_sector(named, ["occupation_key", "soc_code", "soc_title", "soc_major_title"], ["median", "postings"])
    gap = F.col("federal_median") - F.col("private_median")
    return (
        sides.dropna(subset=["federal_median", "private_median"])
        .select(
            "soc_code", "soc_title", "soc_major_title", "federal_median", "federal_postings",
            "private_median", "private_postings",
            gap.alias("sector_gap_dollars"),
            safe_ratio(gap, F.col("private_median")).alias("sector_gap_pct"),
        )
        .orderBy(F.abs("sector_gap_dollars").desc_nulls_last(), "soc_code")
    )


def latest_national(fact_oews: DataFrame) -> DataFrame:
    """Most recent national wage row per occupation code."""
    newest = F.struct("survey_year", "tot_emp", "area")  # the year, then a fixed choice among its rows
    return fact_oews.filter(F.col("area_type") == 1).groupBy("occ_code").agg(
        representative("occ_title").alias("occ_title"),
        latest_by("a_median", newest).alias("national_a_median"),
        latest_by("a_pct25", newest).alias("national_a_pct25"),
        latest_by("a_pct75", newest).alias("national_a_pct75"),
        F.max("survey_year").alias("oews_reference_year"),
    )


def postings_vs_oews(fact: DataFrame, dim_occupation: DataFrame, fact_oews: DataFrame) -> DataFrame:
    """Each posting's pay against the national median of its occupation."""
    # attach the benchmark to the few occupations first, then join once
    bench = join_benchmark(
        mapped(dim_occupation), latest_national(fact_oews).drop("occ_title")
    )
    national = F.col("national_a_median")
    return join_occupation(salary_in_range(fact), bench).select(
        "posting_key", "sector", "posted_date", "soc_code", "soc_title", "soc_major_title",
        F.col("salary_midpoint").alias("advertised_salary"),
        "national_a_median", "national_a_pct25", "national_a_pct75", "oews_reference_year",
        safe_ratio(F.col("salary_midpoint") - national, national).alias("gap_vs_national_median"),
    )


def qcew_employment_trend(fact_qcew: DataFrame) -> DataFrame:
    return (
        state_totals(fact_qcew)
        .groupBy(F.left("area_fips", F.lit(2)).alias("state_fips"), "own_label", "year", "qtr")
        .agg(
            F.sum("avg_monthly_emplvl").alias("state_employment"),
            F.sum("total_qtrly_wages").alias("state_qtrly_wages"),
            F.avg("avg_wkly_wage").alias("state_avg_wkly_wage"),
        )
        .withColumn("quarter_start_date", D.quarter_start("year", "qtr"))
        .orderBy("state_fips", "own_label", "year", "qtr")
    )
