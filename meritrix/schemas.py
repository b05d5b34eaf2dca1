"""Table schemas of the three layers."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema from 'name type, ...'; unlike fromDDL it needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_ADZUNA = _struct(
    "job_id string, raw_data string, search_query string, search_country string, "
    "api_pull_date date, ingestion_timestamp timestamp"
)
RAW_USAJOBS = _struct(
    "control_number string, raw_data string, api_pull_date date, ingestion_timestamp timestamp"
)
QCEW_CSV = _struct(
    "area_fips string, own_code int, industry_code string, agglvl_code int, size_code int, "
    "year int, qtr int, disclosure_code string, qtrly_estabs int, month1_emplvl int, "
    "month2_emplvl int, month3_emplvl int, total_qtrly_wages double, taxable_qtrly_wages double, "
    "qtrly_contributions double, avg_wkly_wage double"
)
JOLTS = _struct(
    "series_id string, year int, period string, period_name string, value double, footnotes string"
)
OEWS_MEASURES = [
    "tot_emp", "a_mean", "a_pct10", "a_pct25", "a_median", "a_pct75", "a_pct90", "h_mean", "h_median",
]
JOBS_UNIFIED = _struct(
    "job_id string, source string, sector string, job_title string, job_title_normalized string, "
    "company_or_agency string, job_description string, location_city string, location_state string, "
    "location_country string, latitude double, longitude double, salary_min double, salary_max double, "
    "salary_is_predicted boolean, job_category string, experience_level string, employment_type string, "
    "remote_type string, is_entry_level boolean, posted_date date, close_date date, "
    "ingestion_timestamp timestamp, apply_url string"
)
QCEW_QUARTERLY = _struct(
    "qcew_key string, area_fips string, area_type string, state_fips string, industry_code string, "
    "industry_level int, own_code int, own_label string, year int, qtr int, qtrly_estabs int, "
    "avg_monthly_emplvl double, total_qtrly_wages double, avg_wkly_wage double, ingestion_timestamp timestamp"
)
OEWS_ANNUAL = _struct(
    "oews_key string, survey_year int, area string, area_title string, area_type int, occ_code string, "
    "occ_title string, o_group string, " + ", ".join(f"{m} double" for m in OEWS_MEASURES)
    + ", ingestion_timestamp timestamp"
)
FACT_JOB_POSTINGS = _struct(
    "posting_key string, date_key int, location_key bigint, company_key bigint, category_key bigint, "
    "source string, sector string, experience_level string, is_entry_level boolean, employment_type string, "
    "remote_type string, salary_min double, salary_max double, salary_midpoint double, posted_date date, "
    "close_date date, apply_url string, occupation_key bigint"
)
FACT_QCEW = _struct(
    "qcew_key string, date_key int, location_key bigint, area_fips string, area_type string, "
    "industry_code string, industry_level int, own_code int, own_label string, qtrly_estabs int, "
    "avg_monthly_emplvl double, total_qtrly_wages double, avg_wkly_wage double, year int, qtr int"
)
FACT_OEWS_WAGES = _struct(
    "oews_key string, date_key int, occupation_key bigint, location_key bigint, survey_year int, area string, "
    "area_title string, area_type int, occ_code string, occ_title string, "
    + ", ".join(f"{m} double" for m in OEWS_MEASURES)
)
USER_PREFERENCES = _struct("user_email string, pref_type string, pref_value string")

# Physical layout: low-cardinality partition columns, then the sort inside a
# file that gives Parquet row groups useful min/max ranges.
LAYOUT = {
    "jobs_unified": (["sector"], ["posted_date"]),
    "raw_bls_qcew": (["year", "qtr"], ["area_fips"]),
    "raw_bls_oews": (["survey_year"], []),
    "bls_qcew_quarterly": (["year", "qtr"], ["state_fips"]),
    "bls_oews_annual": (["survey_year"], ["occ_code"]),
    "fact_qcew": (["year"], ["qtr", "area_fips"]),
    "fact_oews_wages": (["survey_year"], ["occ_code"]),
    "fact_job_postings": (["sector"], ["posted_date"]),
    "dim_occupation_soc": ([], ["title_normalized"]),
}

#: Keys by whose hash the large keyed tables are laid out as well, and the rows of a
#: bucket: a batch then meets only the buckets that its keys fall into.
BUCKET_KEYS = {
    "raw_adzuna": ["job_id"],
    "raw_usajobs_current": ["control_number"],
    "jobs_unified": ["source", "job_id"],
    "fact_job_postings": ["posting_key"],
}
ROWS_PER_BUCKET = 1_000_000
