"""Parameterised reads: dashboards, filters, search and personal feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.functions import aggregates as A
from meritrix.functions import derive as D
from meritrix.operators.filters import date_between, in_any, mapped, min_support, salary_in_range, since, state_totals
from meritrix.operators.joins import having_match, join_occupation, label_category, lookup_join
from meritrix.operators.windows import resort, rows_of_top_groups, top_k, top_k_per_group
from meritrix.session import stored

JOB_COLUMNS = [
    "job_id", "source", "sector", "job_title", "company_or_agency", "location_city", "location_state",
    "salary_min", "salary_max", "experience_level", "employment_type", "remote_type", "posted_date",
    "apply_url", "job_category",
]
PREFERENCE_TYPES = ("experience_level", "sector", "location_state", "remote_type")


def federal_vs_private_gap(gap: DataFrame, min_postings: int = 1, k: int = 30) -> DataFrame:
    return top_k(
        min_support(gap, min_postings), [F.abs("sector_gap_dollars").desc_nulls_last(), F.asc("soc_code")], k
    ).withColumn("gap_direction", D.gap_direction("sector_gap_dollars"))


def soc_major_distribution(fact: DataFrame, dim_occupation: DataFrame) -> DataFrame:
    """Counted per key first; the dimension then labels a handful of rows."""
    per_key = fact.dropna(subset=["occupation_key"]).groupBy("occupation_key", "sector").agg(F.count("*").alias("n"))
    return majors_labelled(per_key, dim_occupation)


def majors_labelled(per_key: DataFrame, dim_occupation: DataFrame) -> DataFrame:
    """The distribution from its counts ``n`` per occupation key and sector."""
    return (
        mapped(join_occupation(per_key, dim_occupation))
        .groupBy("soc_major_title", "sector").agg(F.sum("n").alias("posting_count"))
        .orderBy(F.desc("posting_count"), "soc_major_title", "sector")
    )


def salary_by_occupation_top(fact: DataFrame, dim_occupation: DataFrame, n: int = 12) -> DataFrame:
    """Pay of every posting in the ``n`` most frequent occupations."""
    rows = mapped(join_occupation(salary_in_range(fact), dim_occupation))
    return rows_of_top_groups(rows, "soc_code", n).select("soc_code", "soc_title", "sector", "salary_midpoint")


def qcew_trend(fact_qcew: DataFrame, state_fips: str = "06", own: str = "Private") -> DataFrame:
    return (
        state_totals(fact_qcew, state_fips, own)
        .groupBy("year", "qtr")
        .agg(F.sum("avg_monthly_emplvl").alias("state_employment"), F.avg("avg_wkly_wage").alias("state_avg_wkly_wage"))
        .withColumn("quarter_date", D.quarter_start("year", "qtr"))
        .orderBy("year", "qtr")
    )


def qcew_state_options(fact_qcew: DataFrame, fips: DataFrame) -> DataFrame:
    """States of the lookup that occur in the data."""
    present = fact_qcew.filter(F.col("area_type") == "state").select(
        F.left("area_fips", F.lit(2)).alias("state_fips")
    ).distinct()
    return having_match(fips, present, ["state_fips"]).orderBy("state_name")


def headline_counters(fact: DataFrame, fact_qcew: DataFrame, dim_occupation: DataFrame) -> DataFrame:
    spark = fact.sparkSession
    return A.counters(
        spark,
        total_postings=fact.agg(F.count("*")),
        qcew_rows=fact_qcew.agg(F.count("*")),
        soc_codes_mapped=mapped(dim_occupation).agg(F.count("*")),
        latest_qcew_year=fact_qcew.agg(F.max("year")),
        earliest_qcew_year=fact_qcew.agg(F.min("year")),
    )


def filter_options(clean: DataFrame) -> dict[str, DataFrame]:
    return {
        "states": A.distinct_values(clean, "location_state").orderBy("location_state"),
        "categories": A.distinct_values(clean, "job_category").orderBy("job_category"),
    }


def cities_for_states(clean: DataFrame, states) -> DataFrame:
    """Cities of the given states; no states, no cities."""
    rows = clean.filter(F.col("location_state").isin(list(states))) if states else clean.limit(0)
    return A.distinct_values(rows, "location_city").orderBy("location_city")


def summary_stats(clean: DataFrame, as_of) -> DataFrame:
    recent = F.col("posted_date") >= F.date_sub(F.lit(as_of).cast("date"), 7)
    return clean.agg(
        F.count("*").alias("total_jobs"),
        F.count_if(F.col("sector") == "federal").alias("federal_jobs"),
        F.count_if(F.col("sector") == "private").alias("private_jobs"),
        F.count_if("is_entry_level").alias("entry_level_jobs"),
        F.count_if(recent).alias("jobs_last_7d"),
        F.count_distinct("location_state").alias("states_covered"),
    )


def posting_trend(clean: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (
        since(clean, as_of, days=days)
        .groupBy(F.date_trunc("day", "posted_date").cast("date").alias("day"), "sector")
        .agg(F.count("*").alias("job_count"))
        .orderBy("day", "sector")
    )


def _with_optional(df: DataFrame) -> DataFrame:
    absent = {c: F.lit(None).cast(t) for c, t in (("apply_url", "string"), ("close_date", "date")) if c not in df.columns}
    return df.withColumns(absent) if absent else df


def latest_jobs(clean: DataFrame, dim_category: DataFrame, filters: dict | None = None, as_of=None,
                days: int = 7, limit: int = 30) -> DataFrame:
    """Newest matching postings. The category label is looked up for the
    ``limit`` winners only."""
    rows = in_any(since(_with_optional(clean), as_of, days=days), filters or {})
    order = [F.desc("posted_date"), F.desc("ingestion_timestamp"), F.asc("source"), F.asc("job_id")]
    best = top_k(rows.select(*JOB_COLUMNS, "ingestion_timestamp"), order, limit)
    return label_category(best, dim_category).orderBy(*order).select(*JOB_COLUMNS, "category_group")


def search_jobs(clean: DataFrame, dim_category: DataFrame, filters: dict | None = None, date_from=None,
                date_to=None, limit: int = 200, sort: str = "newest") -> DataFrame:
    """Newest ``limit`` matches (undated ones first), shown in one of four orders."""
    rows = date_between(in_any(_with_optional(clean), filters or {}), date_from, date_to)
    order = [F.desc_nulls_first("posted_date"), F.asc("source"), F.asc("job_id")]
    best = top_k(rows.select(*JOB_COLUMNS, "close_date"), order, limit)
    labelled = label_category(best, dim_category).select(*JOB_COLUMNS, "close_date", "category_group")
    return labelled.orderBy(*order) if sort == "newest" else resort(labelled, sort)


def job_cards(jobs: DataFrame) -> DataFrame:
    """Display texts of a result list."""
    return jobs.select(
        "job_id", "source", D.salary_text("salary_min", "salary_max").alias("salary"),
        D.location_text("location_city", "location_state").alias("place"),
    )


def personal_feed(prefs: DataFrame, clean: DataFrame, as_of, days: int = 7, k: int = 8,
                  types=PREFERENCE_TYPES, require_any: bool = False, users: DataFrame | None = None) -> DataFrame:
    """The ``k`` newest postings for every user's preferences.

    ``prefs`` has rows ``(user_email, pref_type, pref_value)``; a user without
    values for a type takes any. ``users`` (user_email) adds those who have no
    preference at all. Users and postings are never paired up:

    1. the k newest postings of every combination of the preference columns,
       then of every combination with some columns left open ('*') -- at most k
       rows per combination survive, on the map side already;
    2. users with the same preferences are one set; each distinct set names the
       combinations it wants, an open type being '*';
    3. an equi join and k per set, then the sets' users. A posting matches exactly
       one combination of a set, so nothing is counted twice.
    """
    order = [F.desc("posted_date"), F.desc("ingestion_timestamp"), F.asc("source"), F.asc("job_id")]
    recent = since(clean, as_of, days=days)
    kept = [c for c in JOB_COLUMNS if c in recent.columns]
    cells = top_k_per_group(recent.select(*kept, "ingestion_timestamp"), list(types), order, k)
    for t in types:
        value = F.concat(F.lit("="), F.col(t))
        cells = cells.withColumn(f"c_{t}", F.explode(F.filter(F.array(value, F.lit("*")), lambda x: x.isNotNull())))
    combo = [f"c_{t}" for t in types]
    cells = stored(top_k_per_group(cells, combo, order, k))  # small, and read more than once

    # values that no recent posting has cannot match; dropping them keeps a
    # user's arrays no longer than the list of values in use
    in_use = reduce(DataFrame.unionByName, [
        cells.filter(F.col(f"c_{t}") != "*").select(F.lit(t).alias("pref_type"), F.col(t).alias("pref_value")) for t in types
    ]).distinct().withColumn("_used", F.lit(True))
    asked = prefs.filter(F.col("pref_type").isin(list(types))) if require_any else prefs
    known = asked.select("user_email", "pref_type", "pref_value").join(in_use, ["pref_type", "pref_value"], "left")
    if users is not None:
        known = known.unionByName(users.select("user_email"), allowMissingColumns=True)
    per_user = known.groupBy("user_email").agg(*[
        F.when(F.max(F.col("pref_type") == t), F.sort_array(F.collect_set(
            F.when((F.col("pref_type") == t) & F.col("_used"), F.concat(F.lit("="), F.col("pref_value")))
        ))).otherwise(F.array(F.lit("*"))).alias(f"c_{t}") for t in types
    ])
    members = per_user.select("user_email", F.sha2(F.to_json(F.struct(*combo)), 256).alias("set"), *combo)
    wishes = members.groupBy("set").agg(*[F.any_value(c).alias(c) for c in combo])
    for c in combo:
        wishes = wishes.withColumn(c, F.explode(c))
    matched = lookup_join(wishes, cells, combo, ["set"], how="inner")
    ranked = top_k_per_group(matched, ["set"], order, k).select("set", *kept)
    return lookup_join(members.select("user_email", "set"), ranked, ["set"], ["user_email"], how="inner").select(
        "user_email", *kept)


def recommended_jobs(prefs: DataFrame, clean: DataFrame, as_of) -> DataFrame:
    """Wider and shorter feed that ignores remote type; users without level,
    sector or state preferences get nothing."""
    return personal_feed(prefs, clean, as_of, days=14, k=6, types=PREFERENCE_TYPES[:3], require_any=True)


def peak_to_trough(trend: DataFrame, y0: int = 2007, y1: int = 2010) -> DataFrame:
    return A.peak_to_trough(trend, y0, y1)
