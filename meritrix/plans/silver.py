"""Bronze -> Silver: conform postings, employment and wage records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.functions import derive as D
from meritrix.functions.aggregates import mean_of_months
from meritrix.operators.filters import disclosed, has_occupation
from meritrix.operators.merge import upsert, upsert_if_newer
from meritrix.operators.windows import any_row, best_of_repeated, keep_best
from meritrix.schemas import JOBS_UNIFIED, OEWS_MEASURES

POSTING_KEYS = ["source", "job_id"]
QCEW_KEY = ["area_fips", "industry_code", "own_code", "year", "qtr"]
QCEW_MEASURES = ["qtrly_estabs", "avg_monthly_emplvl", "total_qtrly_wages", "avg_wkly_wage"]


def adzuna_to_posting(bronze: DataFrame) -> DataFrame:
    """Private payloads (``job_id, raw_data, ingestion_timestamp``) -> postings."""
    def at(path, to="string"):
        return D.json_path("payload", path, to)

    fields = D.with_payload(bronze).select(
        "job_id",
        "ingestion_timestamp",
        at("$.title").alias("job_title"),
        at("$.company.display_name").alias("company_or_agency"),
        at("$.description").alias("job_description"),
        at("$.location.area[2]").alias("location_city"),
        at("$.location.area[1]").alias("location_state"),
        at("$.location.area[0]").alias("location_country"),
        at("$.latitude", "double").alias("latitude"),
        at("$.longitude", "double").alias("longitude"),
        at("$.salary_min", "double").alias("salary_min"),
        at("$.salary_max", "double").alias("salary_max"),
        at("$.salary_is_predicted").alias("predicted"),
        at("$.category.label").alias("job_category"),
        at("$.contract_time").alias("contract"),
        D.iso_date(at("$.created")).alias("posted_date"),
        at("$.redirect_url").alias("apply_url"),
    )
    rows = fields.withColumns({
        "job_id": F.concat(F.lit("adzuna_"), F.col("job_id")),
        "source": F.lit("adzuna"),
        "sector": F.lit("private"),
        "job_title_normalized": D.norm_a("job_title"),
        "salary_is_predicted": D.is_predicted("predicted"),
        "experience_level": D.level_private("job_title"),
        "is_entry_level": D.is_entry("job_title", "private"),
        "employment_type": D.employment_type("contract", "job_title", "full_time", "part_time"),
        "remote_type": D.remote_private("job_description"),
        "close_date": F.lit(None).cast("date"),
    })
    return rows.select(*JOBS_UNIFIED.fieldNames())


def usajobs_to_posting(bronze: DataFrame) -> DataFrame:
    """Federal payloads (``control_number, raw_data, ingestion_timestamp``) -> postings."""
    def at(path, to="string"):
        return D.json_path("payload", f"$.MatchedObjectDescriptor.{path}", to)

    pay, place = "PositionRemuneration[0]", "PositionLocation[0]"
    rate = at(f"{pay}.RateIntervalCode")
    fields = D.with_payload(bronze).select(
        "control_number",
        "ingestion_timestamp",
        at("PositionTitle").alias("job_title"),
        at("OrganizationName").alias("company_or_agency"),
        D.description_or_summary(
            at("PositionFormattedDescription[0].Content"), at("QualificationSummary")
        ).alias("job_description"),
        D.city_part(at(f"{place}.CityName")).alias("location_city"),
        at(f"{place}.CountrySubDivisionCode").alias("location_state"),
        at(f"{place}.CountryCode").alias("location_country"),
        at(f"{place}.Latitude", "double").alias("latitude"),
        at(f"{place}.Longitude", "double").alias("longitude"),
        D.annualise(at(f"{pay}.MinimumRange"), rate).alias("salary_min"),
        D.annualise(at(f"{pay}.MaximumRange"), rate).alias("salary_max"),
        at("JobCategory[0].Name").alias("job_category"),
        at("JobGrade[0].Code").alias("grade"),
        at("PositionSchedule[0].Code").alias("schedule"),
        at("RemoteIndicator", "boolean").alias("remote_flag"),
        D.iso_date(at("PublicationStartDate")).alias("posted_date"),
        D.iso_date(at("ApplicationCloseDate")).alias("close_date"),
        at("ApplyURI[0]").alias("apply_url"),
    )
    rows = fields.withColumns({
        "job_id": F.concat(F.lit("usajobs_"), F.col("control_number")),
        "source": F.lit("usajobs_current"),
        "sector": F.lit("federal"),
        "job_title_normalized": D.norm_a("job_title"),
        "salary_is_predicted": F.lit(False),
        "experience_level": D.level_federal("grade", "job_title", "salary_min"),
        "is_entry_level": D.is_entry("job_title", "federal"),
        "employment_type": D.employment_type("schedule", "job_title", "1", "2"),
        "remote_type": D.remote_federal("remote_flag", "job_description"),
    })
    return rows.select(*JOBS_UNIFIED.fieldNames())


def latest_payloads(bronze: DataFrame, key: str) -> DataFrame:
    """One payload per key, the freshest; done before parsing, on three columns. Payloads
    of keys that were landed once, most of them, are not shuffled."""
    rows = bronze.select(key, "raw_data", "ingestion_timestamp").dropna(subset=[key])
    return best_of_repeated(rows, [key], [F.desc_nulls_last("ingestion_timestamp"), F.asc("raw_data")])


def transform_adzuna(bronze: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = adzuna_to_posting(latest_payloads(bronze, "job_id"))
    return rows if target is None else upsert(target, rows, POSTING_KEYS, unique=True)


def transform_usajobs(bronze: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = usajobs_to_posting(latest_payloads(bronze, "control_number"))
    return rows if target is None else upsert(target, rows, POSTING_KEYS, unique=True)


def qcew_rows(bronze: DataFrame, ranges=None) -> DataFrame:
    """One row per area, industry, ownership and quarter.

    Where a key occurs at several aggregation levels, the smallest level wins;
    its measures are column-wise maxima over repeated loads. Maxima per key and level
    come first: their buffers are numbers, so that they are hashed and combined
    before the shuffle, and a key loaded very often costs no more than others. Of these
    few rows the maximum of (minus the level, measure) is taken, where a NULL level or
    measure is the smallest; the text key is built last.
    """
    measures = ["qtrly_estabs", "month1_emplvl", "month2_emplvl", "month3_emplvl",
                "total_qtrly_wages", "avg_wkly_wage", "ingestion_timestamp"]
    level = (-F.col("agglvl_code")).alias("level")
    best = (
        disclosed(bronze).dropna(subset=QCEW_KEY).groupBy(*QCEW_KEY, "agglvl_code")
        .agg(*(F.max(m).alias(m) for m in measures))
        .groupBy(*QCEW_KEY).agg(F.max(-F.col("agglvl_code")).alias("level"), *(F.max(F.struct(level, m)).alias(m) for m in measures))
        .select(*QCEW_KEY, (-F.col("level")).alias("agglvl_code"), *(F.col(m)[m].alias(m) for m in measures))
    )
    return best.select(
        D.qcew_key().alias("qcew_key"),
        "area_fips",
        D.area_type("agglvl_code", ranges).alias("area_type"),
        D.state_fips("area_fips").alias("state_fips"),
        "industry_code",
        D.industry_level("industry_code").alias("industry_level"),
        "own_code",
        D.own_label("own_code").alias("own_label"),
        "year",
        "qtr",
        "qtrly_estabs",
        mean_of_months("month1_emplvl", "month2_emplvl", "month3_emplvl").alias("avg_monthly_emplvl"),
        "total_qtrly_wages",
        "avg_wkly_wage",
        "ingestion_timestamp",
    )


def transform_qcew(bronze: DataFrame, target: DataFrame | None = None, ranges=None) -> DataFrame:
    rows = qcew_rows(bronze, ranges)
    return rows if target is None else upsert_if_newer(
        target, rows, ["qcew_key"], "ingestion_timestamp", QCEW_MEASURES, unique=True
    )


def qcew_collapse_counts(bronze: DataFrame) -> DataFrame:
    """One row: records read, kept, and folded into another record's key."""
    per_key = disclosed(bronze).dropna(subset=QCEW_KEY).groupBy(*QCEW_KEY).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").alias("records"), F.count("*").alias("keys"),
        (F.sum("n") - F.count("*")).alias("collapsed"),
    )


def flatten_oews(bronze: DataFrame) -> DataFrame:
    """Wage records held as JSON (``record, survey_year``) -> typed columns.
    Values that are not numbers (suppression marks, '1,234') become NULL."""
    def at(key):
        return D.json_path("payload", f"$.{key.upper()}")

    return has_occupation(D.with_payload(bronze, "record").select(
        "survey_year",
        at("area").alias("area"),
        at("area_title").alias("area_title"),
        at("area_type").try_cast("int").alias("area_type"),
        at("occ_code").alias("occ_code"),
        at("occ_title").alias("occ_title"),
        D.occupation_group(at("o_group")).alias("o_group"),
        *[at(m).try_cast("double").alias(m) for m in OEWS_MEASURES],
        "ingestion_timestamp",
    ))


def oews_rows(bronze: DataFrame) -> DataFrame:
    """One row per survey year, area and occupation: latest load, then the
    largest employment, then the remaining columns so that ties are decided."""
    flat = flatten_oews(bronze)
    order = [F.desc("ingestion_timestamp"), F.desc_nulls_last("tot_emp"), any_row(flat)]
    best = keep_best(flat.withColumn("area_k", F.coalesce("area", F.lit(""))),
                     ["survey_year", "area_k", "occ_code"], order)
    return best.select(D.oews_key().alias("oews_key"), *flat.columns)


def transform_oews(bronze: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = oews_rows(bronze)
    return rows if target is None else upsert_if_newer(
        target, rows, ["oews_key"], "ingestion_timestamp", OEWS_MEASURES, unique=True
    )
