"""Silver -> Gold: dimensions, facts and the occupation back-fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.functions import derive as D
from meritrix.functions.aggregates import representative
from meritrix.operators.filters import not_null
from meritrix.operators.joins import (
    HOT_SHARE, fits, hot_key_salts, join_category, join_company, join_location, join_wage_occupation, salted_join,
)
from meritrix.operators.keys import assign_keys
from meritrix.operators.merge import insert_new, update_from, upsert
from meritrix.operators.windows import any_row, best_of_repeated, keep_best
from meritrix.schemas import FACT_OEWS_WAGES, FACT_QCEW, OEWS_MEASURES
from meritrix.session import stored


def date_spine(spark, start, end) -> DataFrame:
    """One row per day, both ends included; bounds may be dates or 1-row frames."""
    def bound(b):
        return b.scalar() if isinstance(b, DataFrame) else F.lit(b).cast("date")

    return spark.range(1).select(F.explode(F.sequence(bound(start), bound(end))).alias("full_date"))


def dim_date(spark, start="1990-01-01", end="2030-12-31", existing: DataFrame | None = None) -> DataFrame:
    days = date_spine(spark, start, end).select(*D.calendar_attributes("full_date"))
    return days if existing is None else insert_new(existing, days, ["date_key"])


def _refresh(src: DataFrame, natural, key_col: str, existing: DataFrame | None) -> DataFrame:
    """The labels are stored first: numbering and merging read them several times, and the
    postings that they come from should be read once."""
    keyed = assign_keys(stored(src), natural, key_col, existing)
    return keyed if existing is None else upsert(existing, keyed, natural, unique=True)


def dim_location(postings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    places = not_null(
        postings.select(
            F.col("location_city").alias("city"), F.col("location_state").alias("state"),
            F.col("location_country").alias("country"), "latitude", "longitude",
        ),
        ["city", "state", "country"],
    ).groupBy("city", "state", "country").agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")
    )
    src = places.select("city", "state", "country", D.census_region("state").alias("region"), "latitude", "longitude")
    return _refresh(src, ["city", "state", "country"], "location_key", existing)


def company_labels(postings: DataFrame) -> DataFrame:
    """One row per employer name. A name seen in both sectors counts as federal."""
    return (
        not_null(postings, ["company_or_agency"])
        .groupBy(F.col("company_or_agency").alias("company_name"))
        .agg(F.min("sector").alias("sector"))  # 'federal' < 'private'
        .withColumn("agency_parent", D.agency_parent("company_name", "sector"))
    )


def dim_company(postings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _refresh(company_labels(postings), ["company_name"], "company_key", existing)


def category_labels(postings: DataFrame) -> DataFrame:
    """The distinct category names with their group."""
    return (
        not_null(postings, ["job_category"])
        .select(F.col("job_category").alias("category_name")).distinct()
        .withColumn("category_group", D.category_group("category_name"))
    )


def dim_category(postings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _refresh(category_labels(postings), ["category_name"], "category_key", existing)


def dim_occupation(resolved: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    src = (
        resolved.groupBy("soc_code", "soc_major_group")
        .agg(representative("soc_title").alias("soc_title"))
        .select("soc_code", "soc_title", "soc_major_group", D.soc_major_title("soc_major_group").alias("soc_major_title"))
    )
    return _refresh(src, ["soc_code"], "occupation_key", existing)


def posting_measures(postings: DataFrame, best=keep_best) -> DataFrame:
    """Postings with their fact columns, the freshest row per posting key.

    Reducing to one row per key comes before the dimension joins: dimensions
    are unique on their names, so a join cannot bring duplicates back. ``best`` may
    be ``best_of_repeated`` for postings that hardly repeat a key.
    """
    order = [F.desc_nulls_last("ingestion_timestamp"), any_row(postings)]
    keyed = not_null(postings, ["source", "job_id"]).withColumn("posting_key", D.posting_key("source", "job_id"))
    rows = best(keyed, ["posting_key"], order)  # keep_best leaves the rows partitioned by posting_key
    absent = {
        c: F.lit(None).cast(t) for c, t in (("close_date", "date"), ("apply_url", "string")) if c not in rows.columns
    }
    return rows.withColumns({
        "date_key": D.date_key("posted_date"),
        "salary_midpoint": D.salary_midpoint("salary_min", "salary_max"),
        **absent,
    })


FACT_POSTING_COLUMNS = [
    "posting_key", "date_key", "location_key", "company_key", "category_key", "source", "sector",
    "experience_level", "is_entry_level", "employment_type", "remote_type", "salary_min", "salary_max",
    "salary_midpoint", "posted_date", "close_date", "apply_url",
]


def fact_job_postings(postings: DataFrame, dims: dict[str, DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """One row per posting with dimension keys (NULL where nothing matches).

    ``dims`` holds stored dimensions under location, company and category; a
    dimension left out gives NULL keys.
    """
    src = _with_dimensions(posting_measures(postings), dims).select(*FACT_POSTING_COLUMNS)
    if existing is None:
        return src.withColumn("occupation_key", F.lit(None).cast("bigint"))
    return upsert(existing, src, ["posting_key"], unique=True)


def _with_dimensions(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    for name, join in (("location", join_location), ("company", join_company), ("category", join_category)):
        rows = join(rows, dims[name]) if name in dims else rows.withColumn(f"{name}_key", F.lit(None).cast("bigint"))
    return rows


def fact_of_jobs(jobs: DataFrame, dims: dict[str, DataFrame], titles: tuple[DataFrame, DataFrame],
                 existing: DataFrame | None = None) -> DataFrame:
    """``fact_job_postings`` with the back-fill of ``update_postings_soc``, for stored
    postings that have one row per key. ``titles`` holds the resolved titles and the
    occupations.

    A posting meets its dimensions and its occupation where it lies. The fact that is
    there is met by keys only: few of its rows stay (those of postings that are gone)
    or give their occupation (postings whose title has none).
    """
    rows = posting_measures(jobs, best_of_repeated)
    titled = join_occupation_of_title(rows, *titles)
    src = _with_dimensions(titled, dims).select(*FACT_POSTING_COLUMNS, "occupation_key")
    if existing is None:
        return src
    keys = titled.select("posting_key", F.col("occupation_key").isNull().alias("_open"))
    met = existing.select("posting_key", F.col("occupation_key").alias("_held")).join(keys, "posting_key", "left")
    left = stored(met.filter("_open IS NULL OR (_open AND _held IS NOT NULL)"))
    held = left.filter("_open").select("posting_key", "_held")
    if not held.isEmpty():
        src = src.join(held, "posting_key", "left").withColumn(
            "occupation_key", F.coalesce("occupation_key", "_held")).drop("_held")
    gone = left.filter("_open IS NULL").select("posting_key")
    if not gone.isEmpty():
        src = existing.join(gone, "posting_key", "left_semi").unionByName(src, allowMissingColumns=True)
    return src.select(*existing.columns)


def fact_qcew(qcew: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    src = qcew.withColumn("date_key", D.quarter_date_key("year", "qtr")).withColumn(
        "location_key", F.lit(None).cast("bigint")
    ).select(*FACT_QCEW.fieldNames())
    return src if existing is None else upsert(existing, src, ["qcew_key"], unique=True)


def fact_oews_wages(oews: DataFrame, occupations: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    src = join_wage_occupation(oews, occupations).select(
        "oews_key", D.survey_date_key("survey_year").alias("date_key"), "occupation_key",
        F.lit(None).cast("bigint").alias("location_key"), "survey_year", "area", "area_title", "area_type",
        "occ_code", "occ_title", *OEWS_MEASURES,
    ).select(*FACT_OEWS_WAGES.fieldNames())
    return src if existing is None else upsert(existing, src, ["oews_key"], unique=True)


def join_occupation_of_title(rows: DataFrame, resolved: DataFrame, occupations: DataFrame, how: str = "left") -> DataFrame:
    """Rows with ``posting_key`` and ``job_title`` -> the same with the ``occupation_key``
    of the normalised title.

    Few titles are broadcast. Beyond that a common title may hold a large share
    of the postings; the resolver has counted them, so the hot titles come for
    free and only they are salted.
    """
    codes = resolved.select("title_normalized", "soc_code", "posting_count").join(
        F.broadcast(occupations.select("soc_code", "occupation_key")), "soc_code"  # one row per public code
    )
    keyed = rows.withColumn("title_normalized", D.norm_b("job_title"))
    right = codes.select("title_normalized", "occupation_key")
    if fits(resolved):
        joined = keyed.join(F.broadcast(right), "title_normalized", how)
    else:
        hot = hot_key_salts(codes, ["title_normalized"], HOT_SHARE, weight="posting_count")
        joined = salted_join(keyed, right, ["title_normalized"], ["posting_key"], hot, how)
    return joined.select(*rows.columns, "occupation_key")


def postings_to_soc(postings: DataFrame, resolved: DataFrame, occupations: DataFrame) -> DataFrame:
    """posting_key -> occupation_key through the normalised title."""
    keyed = postings.filter(F.col("job_title").isNotNull()).select(
        D.posting_key("source", "job_id").alias("posting_key"), "job_title")
    return join_occupation_of_title(keyed, resolved, occupations, "inner").select("posting_key", "occupation_key")


def update_postings_soc(fact: DataFrame, postings: DataFrame, resolved: DataFrame, occupations: DataFrame) -> DataFrame:
    """Back-fill the fact's occupation; postings without a title keep theirs."""
    pairs = postings_to_soc(postings, resolved, occupations)
    lookup = pairs.groupBy("posting_key").agg(representative("occupation_key").alias("occupation_key"))
    return update_from(fact, lookup, ["posting_key"], "occupation_key")


