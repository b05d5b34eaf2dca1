"""Every checked query: its Spark call over the test tables and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as O
from checks.adapters import adapter, cte, load
from meritrix.operators import joins as J
from meritrix.operators import windows as W
from meritrix.functions import lookups as L
from meritrix.operators.filters import salary_in_range
from meritrix.operators.resolver import fips_names, resolve_soc, soc_patterns, soc_seed, soc_stats
from meritrix.plans import gold, quality, reads, silver, views
from meritrix.session import stored

AS_OF = "2001-08-01"  # newest posting date of the test tables
DAY = f"DATE '{AS_OF}'"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# -- inputs ----------------------------------------------------------------

def postings(spark, sf) -> DataFrame:
    return adapter(spark, sf, "postings")


def clean(spark, sf) -> DataFrame:
    return quality.jobs_clean(postings(spark, sf))


def categories(spark, sf) -> DataFrame:
    return gold.category_labels(postings(spark, sf))


def occupations(spark, sf):
    resolved = resolve_soc(postings(spark, sf))
    return resolved, gold.dim_occupation(resolved)


def posting_fact(spark, sf, *columns):
    """The posting fact with occupations (without the other dimension keys) and
    the occupation dimension. Both, and the resolver output, are stored tables
    as they are in the warehouse; of the fact only the needed columns."""
    p = postings(spark, sf)
    resolved = stored(resolve_soc(p))
    dim = stored(gold.dim_occupation(resolved))
    fact = gold.update_postings_soc(gold.fact_job_postings(p, {}), p, resolved, dim)
    return (stored(fact.select(*columns)) if columns else fact), dim


PAY = ("occupation_key", "sector", "salary_midpoint")


def qcew(spark, sf) -> DataFrame:
    return silver.transform_qcew(adapter(spark, sf, "qcew_raw"))


def oews_bronze(spark, sf) -> DataFrame:
    raw = adapter(spark, sf, "oews_raw")
    fields = [F.col(c).alias(c.upper()) for c in raw.columns if c != "survey_year"]
    return raw.select("survey_year", F.to_json(F.struct(*fields)).alias("record"),
                      F.lit("2024-01-01").cast("timestamp").alias("ingestion_timestamp"))


def ids(df: DataFrame, *arrays: str) -> DataFrame:
    """Array columns as text, so that both engines print them alike."""
    return df.withColumns({a: F.array_join(a, ",") for a in arrays})


# -- views -----------------------------------------------------------------

@check("salary_by_sector", f"""WITH {O.CLEAN}
SELECT sector, source, experience_level, count(*) AS job_count,
 count(coalesce(salary_min, salary_max)) AS jobs_with_salary,
 round(avg(coalesce(salary_min, salary_max)), 0) AS avg_salary_low,
 round(avg(coalesce(salary_max, salary_min)), 0) AS avg_salary_high,
 round(avg({O.MID}), 0) AS avg_salary_mid,
 round(median(salary_min), 0) AS median_salary_min, round(median(salary_max), 0) AS median_salary_max,
 round(quantile_cont(salary_min, 0.25), 0) AS p25_salary, round(quantile_cont(salary_max, 0.75), 0) AS p75_salary
FROM clean GROUP BY ALL""")
def _(spark, sf):
    return views.salary_by_sector(clean(spark, sf))


SHARE = "round(CAST(job_count AS DOUBLE) * 100.0 / CAST(sum(job_count) OVER (PARTITION BY sector, source) AS DOUBLE), 2) AS pct_of_source"


@check("experience_by_sector", f"""WITH {O.CLEAN}, c AS (SELECT sector, source, experience_level, employment_type,
 category_group, count(*) AS job_count FROM grouped GROUP BY ALL) SELECT *, {SHARE} FROM c""")
def _(spark, sf):
    return views.experience_by_sector(clean(spark, sf), categories(spark, sf))


@check("geo_distribution", f"""WITH {O.CLEAN} SELECT location_state, location_city, location_country, sector, source,
 experience_level, count(*) AS job_count, count(*) FILTER (is_entry_level) AS entry_level_count,
 round(avg(coalesce(salary_min, salary_max)), 0) AS avg_salary FROM clean WHERE location_state IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    return views.geo_distribution(clean(spark, sf))


@check("remote_by_sector", f"""WITH {O.CLEAN}, c AS (SELECT sector, source, remote_type, experience_level,
 count(*) AS job_count FROM clean GROUP BY ALL) SELECT *, {SHARE} FROM c""")
def _(spark, sf):
    return views.remote_by_sector(clean(spark, sf))


@check("category_by_sector", f"""WITH {O.CLEAN}, c AS (SELECT sector, source, job_category, category_group,
 experience_level, count(*) AS job_count FROM grouped GROUP BY ALL) SELECT *, {SHARE} FROM c""")
def _(spark, sf):
    return views.category_by_sector(clean(spark, sf), categories(spark, sf))


@check("top_employers", f"""WITH {O.CLEAN}, parents AS (SELECT company_or_agency AS name, min(sector) AS s FROM postings
 WHERE company_or_agency IS NOT NULL GROUP BY 1)
SELECT sector, source, company_or_agency, coalesce({O.agency_parent('name', 's')}, company_or_agency) AS employer_label,
 experience_level, count(*) AS job_count, count(*) FILTER (is_entry_level) AS entry_level_count,
 round(avg(salary_min), 0) AS avg_salary_min FROM clean JOIN parents ON name = company_or_agency GROUP BY ALL""")
def _(spark, sf):
    return views.top_employers(clean(spark, sf), gold.company_labels(postings(spark, sf)))


@check("posting_trends", f"""WITH {O.CLEAN} SELECT CAST(date_trunc('week', posted_date) AS DATE) AS week_start, sector, source,
 experience_level, count(*) AS job_count, count(*) FILTER (is_entry_level) AS entry_level_count,
 round(avg(salary_min), 0) AS avg_salary_min FROM clean WHERE posted_date >= {DAY} - INTERVAL 6 MONTH GROUP BY ALL""")
def _(spark, sf):
    return views.posting_trends(clean(spark, sf), AS_OF)


@check("entry_salary_gap", f"""WITH {O.CLEAN}, g AS (SELECT category_group, sector, count(*) AS job_count, avg(salary_min) AS lo,
 avg(salary_max) AS hi, median({O.MID}) AS mid FROM grouped
 WHERE is_entry_level AND coalesce(salary_min, salary_max) IS NOT NULL GROUP BY ALL)
SELECT category_group, sector, job_count, round(lo, 0) AS avg_salary_min, round(hi, 0) AS avg_salary_max,
 round(mid, 0) AS median_salary_mid,
 round(lo - lag(lo) OVER (PARTITION BY category_group ORDER BY sector), 0) AS salary_gap_vs_prev_sector FROM g""")
def _(spark, sf):
    return views.entry_salary_gap(clean(spark, sf), categories(spark, sf))


GAP = O.FACT + """,
med AS (SELECT soc_code, soc_title, soc_major_title, sector, median(salary_midpoint) AS m, count(*) AS n FROM fact
 WHERE salary_midpoint BETWEEN 15000 AND 500000 AND soc_code <> '99-9999' GROUP BY ALL),
gap AS (SELECT f.soc_code, f.soc_title, f.soc_major_title, f.m AS federal_median, f.n AS federal_postings,
 p.m AS private_median, p.n AS private_postings, f.m - p.m AS sector_gap_dollars,
 CASE WHEN p.m > 0 THEN (f.m - p.m) / p.m END AS sector_gap_pct
 FROM med f JOIN med p ON f.soc_code = p.soc_code AND f.sector = 'federal' AND p.sector = 'private')"""


@check("salary_gap_federal_vs_private", f"WITH {GAP} SELECT * FROM gap")
def _(spark, sf):
    return views.salary_gap(*posting_fact(spark, sf, *PAY))


@check("salary_gap_approx", f"WITH {GAP} SELECT soc_code, federal_postings, private_postings, true AS federal_ok, true AS private_ok FROM gap")
def _(spark, sf):
    """Which values come out is open; their ranks lie within the accuracy."""
    fact, dim = posting_fact(spark, sf, *PAY)
    gap = views.salary_gap(fact, dim, exact=False)
    rows = salary_in_range(fact).join(F.broadcast(dim.select("occupation_key", "soc_code")), "occupation_key")
    ranks = rows.join(gap.select("soc_code", "federal_median", "private_median"), "soc_code")

    def within(sector):
        mine, value = F.col("sector") == sector, F.col("salary_midpoint") - F.col(f"{sector}_median")
        n = F.count_if(mine)
        slack = n / 10_000 + 1
        return ((F.count_if(mine & (value < 0)) <= n / 2 + slack) & (F.count_if(mine & (value <= 0)) >= n / 2 - slack)).alias(f"{sector}_ok")

    checked = ranks.groupBy("soc_code").agg(within("federal"), within("private"))
    return gap.select("soc_code", "federal_postings", "private_postings").join(checked, "soc_code")


@check("postings_vs_oews", f"""WITH {O.FACT}, {O.OEWS}, nat AS (SELECT occ_code, a_median, survey_year FROM wages WHERE area_type = 1
 QUALIFY row_number() OVER (PARTITION BY occ_code ORDER BY survey_year DESC, tot_emp DESC NULLS LAST, area DESC) = 1)
SELECT posting_key, sector, posted_date, soc_code, soc_title, soc_major_title, salary_midpoint AS advertised_salary,
 a_median AS national_a_median, CAST(NULL AS DOUBLE) AS national_a_pct25, CAST(NULL AS DOUBLE) AS national_a_pct75,
 survey_year AS oews_reference_year, CASE WHEN a_median > 0 THEN (salary_midpoint - a_median) / a_median END AS gap_vs_national_median
FROM fact LEFT JOIN nat ON occ_code = soc_code
WHERE salary_midpoint BETWEEN 15000 AND 500000 AND soc_code <> '99-9999'""")
def _(spark, sf):
    fact, dim = posting_fact(spark, sf)
    wages = gold.fact_oews_wages(silver.transform_oews(oews_bronze(spark, sf)), dim)
    return views.postings_vs_oews(fact, dim, wages)


TREND = O.QCEW + """,
trend AS (SELECT state_fips, own_label, year, qtr, make_date(year, (qtr - 1) * 3 + 1, 1) AS quarter_start_date,
 sum(avg_monthly_emplvl) AS state_employment, sum(total_qtrly_wages) AS state_qtrly_wages,
 avg(avg_wkly_wage) AS state_avg_wkly_wage FROM qcew WHERE area_type = 'state' AND industry_code = '10' GROUP BY ALL)"""


@check("qcew_employment_trend", f"WITH {TREND} SELECT * FROM trend")
def _(spark, sf):
    return views.qcew_employment_trend(gold.fact_qcew(qcew(spark, sf)))


# -- quality ---------------------------------------------------------------

@check("pk_violations", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    return quality.pk_violations(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


NEAR_KEYS = f"""k AS (SELECT {O.NORM_A.format('job_title')} AS title_norm, lower(trim(company_or_agency)) AS company_norm,
 location_state, posted_date, source, job_id FROM postings
 WHERE job_title IS NOT NULL AND company_or_agency IS NOT NULL AND posted_date IS NOT NULL)"""


@check("near_duplicates", f"""WITH {O.POSTINGS}, {NEAR_KEYS}
SELECT title_norm, company_norm, location_state, posted_date, count(*) AS n_rows,
 string_agg(DISTINCT source, ',' ORDER BY source) AS sources
FROM k GROUP BY title_norm, company_norm, location_state, posted_date HAVING count(*) > 1""")
def _(spark, sf):
    return ids(quality.near_duplicates(postings(spark, sf)), "sources")


@check("near_duplicate_members", f"""WITH {O.POSTINGS}, {NEAR_KEYS}
SELECT DISTINCT * FROM (FROM k QUALIFY count(*) OVER (PARTITION BY title_norm, company_norm, location_state, posted_date) > 1)""")
def _(spark, sf):
    p = postings(spark, sf)
    return quality.near_duplicate_members(p, quality.near_duplicates(p))


@check("near_duplicates_split", f"""WITH {O.POSTINGS}, n AS (SELECT location_state, source, job_id,
 count(*) OVER (PARTITION BY location_state) AS n_rows FROM postings WHERE posted_date IS NOT NULL)
SELECT DISTINCT * FROM n WHERE n_rows > 1""")
def _(spark, sf):
    # one title, company and day: every state is one large group
    p = postings(spark, sf).filter(F.col("posted_date").isNotNull()).withColumns({
        "job_title": F.lit("Clerk"), "company_or_agency": F.lit("Acme"), "posted_date": F.lit(AS_OF).cast("date")})
    groups = quality.near_duplicates(p)
    members = quality.near_duplicate_members(p, groups)
    sizes = groups.select(F.col("location_state").alias("state"), "n_rows")
    return members.join(sizes, F.col("location_state").eqNullSafe(F.col("state"))).select(
        "location_state", "source", "job_id", "n_rows")


@check("jobs_clean", f"WITH {O.CLEAN} SELECT * FROM clean")
def _(spark, sf):
    return clean(spark, sf)


@check("jobs_deduped", f"""WITH {O.CLEAN} SELECT * FROM clean WHERE company_or_agency IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {O.NORM_A.format('job_title')}, lower(trim(company_or_agency)), location_state, posted_date
 ORDER BY CASE WHEN source LIKE 'usajobs%' THEN 0 ELSE 1 END, ingestion_timestamp DESC, job_id) = 1""")
def _(spark, sf):
    return quality.jobs_deduped(clean(spark, sf))


@check("quality_summary", f"""WITH {O.POSTINGS} SELECT source, count(*) AS total_rows, count(*) - count(job_title) AS null_title,
 count(*) - count(salary_min) AS null_salary_min, count(*) - count(salary_max) AS null_salary_max,
 count(*) - count(location_state) AS null_state, count(*) - count(location_city) AS null_city,
 count(*) - count(posted_date) AS null_posted_date, count(*) FILTER (remote_type = 'unknown') AS unknown_remote,
 count(*) FILTER (experience_level NOT IN ('entry', 'mid', 'senior')) AS bad_exp_level,
 round(CAST(count(salary_min) AS DOUBLE) * 100.0 / count(*), 1) AS pct_has_salary FROM postings GROUP BY source""")
def _(spark, sf):
    return quality.quality_summary(postings(spark, sf))


@check("quality_null_rates", f"""WITH {O.POSTINGS} SELECT source,
 round(CAST(count(*) - count(salary_min) AS DOUBLE) * 100.0 / count(*), 1) AS pct_null_salary,
 round(CAST(count(*) - count(location_state) AS DOUBLE) * 100.0 / count(*), 1) AS pct_null_state,
 round(CAST(count(*) FILTER (remote_type = 'unknown') AS DOUBLE) * 100.0 / count(*), 1) AS pct_unknown_remote
FROM postings GROUP BY source""")
def _(spark, sf):
    return quality.null_rates(postings(spark, sf))


@check("silver_row_counts", f"WITH {O.POSTINGS} SELECT source, count(*) AS n FROM postings GROUP BY source")
def _(spark, sf):
    return quality.silver_row_counts(postings(spark, sf))


@check("quality_report", f"""WITH {O.POSTINGS}, k AS (SELECT count(*) AS n FROM postings
  WHERE job_title IS NOT NULL AND company_or_agency IS NOT NULL AND posted_date IS NOT NULL
  GROUP BY {O.NORM_A.format('job_title')}, lower(trim(company_or_agency)), location_state, posted_date HAVING count(*) > 1)
SELECT 'row_counts' AS check_name, count(DISTINCT source) AS findings FROM postings
UNION ALL SELECT 'pk_violations', count(*) FROM (SELECT 1 FROM postings GROUP BY source, job_id HAVING count(*) > 1)
UNION ALL SELECT 'near_duplicates', least(count(*), 50) FROM k
UNION ALL SELECT 'quality_summary', count(DISTINCT source) FROM postings""")
def _(spark, sf):
    report = quality.quality_report(postings(spark, sf))
    return W.union_all([
        df.agg(F.lit(name).alias("check_name"), F.count("*").alias("findings")) for name, df in report.items()
    ])


# -- silver ----------------------------------------------------------------

@check("transform_adzuna", f"""WITH {cte('payloads')}, j AS (SELECT *, CAST(raw_data AS JSON) AS r FROM payloads),
f AS (SELECT job_id, r->>'$.title' AS title, r->>'$.company.display_name' AS company, r->>'$.location.area[0]' AS country,
 r->>'$.location.area[1]' AS state, r->>'$.location.area[2]' AS city, CAST(r->>'$.salary_min' AS DOUBLE) AS lo,
 CAST(left(r->>'$.created', 10) AS DATE) AS posted FROM j)
SELECT 'adzuna_' || job_id AS job_id, 'adzuna' AS source, 'private' AS sector, title AS job_title,
 {O.NORM_A.format('title')} AS job_title_normalized, company AS company_or_agency, city AS location_city,
 state AS location_state, country AS location_country, lo AS salary_min, CAST(NULL AS DOUBLE) AS salary_max,
 false AS salary_is_predicted, 'senior' AS experience_level, 'unknown' AS employment_type, 'unknown' AS remote_type,
 false AS is_entry_level, posted AS posted_date FROM f""")
def _(spark, sf):
    bronze = adapter(spark, sf, "payloads").withColumn("ingestion_timestamp", F.lit("2024-02-01").cast("timestamp"))
    out = silver.transform_adzuna(bronze)
    return out.drop("job_description", "latitude", "longitude", "job_category", "close_date", "apply_url", "ingestion_timestamp")


FEDERAL = cte("payloads_federal") + f""",
d AS (SELECT control_number, CAST(raw_data AS JSON)->'$.MatchedObjectDescriptor' AS r, ingestion_timestamp FROM payloads_federal),
f AS (SELECT *, r->>'$.PositionTitle' AS title, lower(r->>'$.PositionTitle') AS tl,
 coalesce(r->>'$.PositionFormattedDescription[0].Content', r->>'$.QualificationSummary') AS descr,
 CASE r->>'$.PositionRemuneration[0].RateIntervalCode' WHEN 'PH' THEN 2080 WHEN 'PB' THEN 26 ELSE 1 END AS rate FROM d),
g AS (SELECT *, CAST(r->>'$.PositionRemuneration[0].MinimumRange' AS DOUBLE) * rate AS lo,
 CAST(r->>'$.PositionRemuneration[0].MaximumRange' AS DOUBLE) * rate AS hi,
 regexp_matches(tl, '{L.ENTRY_WORDS_FEDERAL}') AS entry FROM f),
federal AS (SELECT 'usajobs_' || control_number AS job_id, 'usajobs_current' AS source, 'federal' AS sector, title AS job_title,
 {O.NORM_A.format('title')} AS job_title_normalized, r->>'$.OrganizationName' AS company_or_agency, descr AS job_description,
 split_part(r->>'$.PositionLocation[0].CityName', ',', 1) AS location_city,
 r->>'$.PositionLocation[0].CountrySubDivisionCode' AS location_state, r->>'$.PositionLocation[0].CountryCode' AS location_country,
 CAST(r->>'$.PositionLocation[0].Latitude' AS DOUBLE) AS latitude, CAST(r->>'$.PositionLocation[0].Longitude' AS DOUBLE) AS longitude,
 lo AS salary_min, hi AS salary_max, false AS salary_is_predicted, r->>'$.JobCategory[0].Name' AS job_category,
 CASE WHEN r->>'$.JobGrade[0].Code' = 'SES' THEN 'senior' WHEN entry THEN 'entry'
  WHEN regexp_matches(tl, 'senior|sr.|principal|staff|lead|director|chief|executive') THEN 'senior'
  WHEN lo < 55000 THEN 'entry' WHEN lo >= 100000 THEN 'senior' ELSE 'mid' END AS experience_level,
 CASE r->>'$.PositionSchedule[0].Code' WHEN '1' THEN 'full_time' WHEN '2' THEN 'part_time'
  ELSE CASE WHEN contains(tl, 'intern') THEN 'intern' ELSE 'unknown' END END AS employment_type,
 CASE WHEN r->>'$.RemoteIndicator' = 'true' THEN 'remote' WHEN regexp_matches(lower(descr), '\\bhybrid\\b') THEN 'hybrid' ELSE 'onsite' END AS remote_type,
 entry AS is_entry_level, CAST(left(r->>'$.PublicationStartDate', 10) AS DATE) AS posted_date,
 CAST(left(r->>'$.ApplicationCloseDate', 10) AS DATE) AS close_date, ingestion_timestamp, r->>'$.ApplyURI[0]' AS apply_url FROM g)"""


@check("transform_usajobs", f"WITH {FEDERAL} SELECT * FROM federal")
def _(spark, sf):
    return silver.transform_usajobs(adapter(spark, sf, "payloads_federal"))


@check("transform_qcew", f"WITH {O.QCEW} SELECT * FROM qcew")
def _(spark, sf):
    return qcew(spark, sf)


@check("qcew_collapse_counts", """WITH """ + cte("qcew_raw") + """ SELECT CAST(sum(n) AS BIGINT) AS records, count(*) AS keys,
 CAST(sum(n) - count(*) AS BIGINT) AS collapsed FROM (SELECT count(*) AS n FROM qcew_raw WHERE coalesce(disclosure_code, '') = ''
 GROUP BY area_fips, industry_code, own_code, year, qtr)""")
def _(spark, sf):
    return silver.qcew_collapse_counts(adapter(spark, sf, "qcew_raw"))


@check("transform_oews", f"WITH {O.OEWS} SELECT * FROM wages")
def _(spark, sf):
    out = silver.transform_oews(oews_bronze(spark, sf))
    return out.drop("a_mean", "a_pct10", "a_pct25", "a_pct75", "a_pct90", "h_mean", "h_median", "ingestion_timestamp")


@check("resolve_soc", f"WITH {O.POSTINGS} {O.RESOLVED} SELECT * FROM resolved")
def _(spark, sf):
    return resolve_soc(postings(spark, sf))


# documents are free text: their sentences make a large, varied set of titles
@check("resolve_soc_free_text", "WITH postings AS (SELECT unnest(string_split(text, '.')) AS job_title FROM documents) "
       + O.RESOLVED + " SELECT * FROM resolved")
def _(spark, sf):
    return resolve_soc(load(spark, sf, "documents").select(F.explode(F.split("text", r"\.")).alias("job_title")))


# the same with lookups that are frames and may be large: equi joins
@check("resolve_soc_joins", f"WITH {O.POSTINGS} {O.RESOLVED} SELECT * FROM resolved")
def _(spark, sf):
    return resolve_soc(postings(spark, sf), seed=soc_seed(spark), patterns=soc_patterns(spark))


@check("resolve_free_text_joins", SQL["resolve_soc_free_text"])
def _(spark, sf):
    titles = load(spark, sf, "documents").select(F.explode(F.split("text", r"\.")).alias("job_title"))
    return resolve_soc(titles, seed=soc_seed(spark), patterns=soc_patterns(spark))


PART_SQL = """SELECT p_name || ' ' || lower(p_type) || ' no ' || CAST(p_partkey AS VARCHAR) AS name, p_partkey FROM @part"""
GARBLED = """SELECT CASE p_partkey % 5 WHEN 0 THEN name WHEN 1 THEN substr(name, 2) WHEN 2 THEN 'xy' || name
 WHEN 3 THEN replace(name, ' no ', ' nr ') || 's' ELSE 'an entirely other ' || name END AS job_title FROM names"""


# every part's name is a seed, the end of it a pattern; titles are garbled names
@check("resolve_part_names", f"WITH names AS ({PART_SQL.replace('@', '')}), postings AS ({GARBLED}) " + O.RESOLVED.replace(
    f"(VALUES {O.values(L.SOC_TITLE_SEED)})", "(SELECT name, '15-0000', name FROM names)").replace(
    f"(VALUES {O.values(L.SOC_TITLE_PATTERNS)})", "(SELECT 'no ' || CAST(p_partkey AS VARCHAR), '17-0000', name FROM names)")
    + " SELECT * FROM resolved")
def _(spark, sf):
    load(spark, sf, "part").createOrReplaceTempView("given_part")
    names = stored(spark.sql(PART_SQL.replace("@", "given_").replace("VARCHAR", "STRING")))
    names.createOrReplaceTempView("names")
    seed = names.select(F.col("name").alias("title_norm"), F.lit("15-0000").alias("soc_code"), F.col("name").alias("soc_title"))
    patterns = names.select(F.concat(F.lit("no "), F.col("p_partkey").cast("string")).alias("pattern"),
                            F.lit("17-0000").alias("soc_code"), F.col("name").alias("soc_title"))
    return resolve_soc(spark.sql(GARBLED), seed=seed, patterns=patterns)


@check("soc_stats", f"""WITH {O.POSTINGS} {O.RESOLVED} SELECT match_method, count(*) AS title_count,
 CAST(sum(posting_count) AS BIGINT) AS total_postings FROM resolved GROUP BY 1""")
def _(spark, sf):
    return soc_stats(resolve_soc(postings(spark, sf)))


# -- gold ------------------------------------------------------------------

@check("dim_date", """WITH b AS (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
 strftime(d, '%b') AS month_name, day(d) AS day_of_month, dayofweek(d) AS day_of_week, strftime(d, '%a') AS day_name,
 dayofweek(d) IN (0, 6) AS is_weekend FROM d""")
def _(spark, sf):
    ship = load(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    return gold.dim_date(spark, ship.agg(F.min("d")), ship.agg(F.max("d")))


LOCATIONS = f"""loc0 AS (SELECT location_city AS city, location_state AS state, location_country AS country,
 avg(latitude) AS latitude, avg(longitude) AS longitude FROM postings
 WHERE location_city IS NOT NULL AND location_state IS NOT NULL AND location_country IS NOT NULL GROUP BY ALL),
loc AS (SELECT {O.numbered('city, state, country', 'city, state, country')} AS location_key, city, state, country,
 {O.census_region('state')} AS region, latitude, longitude FROM loc0)"""
COMPANIES = f"""com0 AS (SELECT company_or_agency AS company_name, min(sector) AS sector FROM postings
 WHERE company_or_agency IS NOT NULL GROUP BY 1),
com AS (SELECT {O.numbered('company_name', 'company_name')} AS company_key, company_name, sector,
 {O.agency_parent('company_name', 'sector')} AS agency_parent FROM com0)"""
CATEGORIES = f"""cat0 AS (SELECT DISTINCT job_category AS category_name FROM postings WHERE job_category IS NOT NULL),
cat AS (SELECT {O.numbered('category_name', 'category_name')} AS category_key, category_name,
 {O.category_group('category_name')} AS category_group FROM cat0)"""


@check("dim_location", f"WITH {O.POSTINGS}, {LOCATIONS} SELECT * FROM loc")
def _(spark, sf):
    return gold.dim_location(postings(spark, sf))


@check("dim_company", f"WITH {O.POSTINGS}, {COMPANIES} SELECT * FROM com")
def _(spark, sf):
    return gold.dim_company(postings(spark, sf))


@check("dim_category", f"WITH {O.POSTINGS}, {CATEGORIES} SELECT * FROM cat")
def _(spark, sf):
    return gold.dim_category(postings(spark, sf))


@check("dim_occupation", f"WITH {O.POSTINGS} {O.RESOLVED} {O.OCCUPATIONS} SELECT * FROM occ")
def _(spark, sf):
    return occupations(spark, sf)[1]


FACT_COLUMNS = f"""source || '::' || job_id AS posting_key, CAST(strftime(posted_date, '%Y%m%d') AS INT) AS date_key, location_key, company_key, category_key, source,
 postings.sector, experience_level, is_entry_level, employment_type, remote_type, salary_min, salary_max, {O.MID} AS salary_midpoint,
 posted_date"""


@check("fact_job_postings", f"""WITH {O.POSTINGS}, {LOCATIONS}, {COMPANIES}, {CATEGORIES} SELECT {FACT_COLUMNS} FROM postings
 LEFT JOIN loc ON city = location_city AND state = location_state AND country = location_country
 LEFT JOIN com ON company_name = company_or_agency LEFT JOIN cat ON category_name = job_category""")
def _(spark, sf):
    p = postings(spark, sf)
    dims = {n: stored(f(p)) for n, f in (
        ("location", gold.dim_location), ("company", gold.dim_company), ("category", gold.dim_category))}
    return gold.fact_job_postings(p, dims).drop("close_date", "apply_url", "occupation_key")


@check("salted_company_join", f"""WITH {O.POSTINGS}, {COMPANIES} SELECT source, job_id, company_or_agency, company_key
 FROM postings LEFT JOIN com ON company_name = company_or_agency""")
def _(spark, sf):
    # the path taken when the dimension is too large to broadcast
    p = postings(spark, sf).select("source", "job_id", "company_or_agency")
    dim = gold.dim_company(postings(spark, sf)).select("company_key", F.col("company_name").alias("company_or_agency"))
    on = ["company_or_agency"]
    return J.salted_join(p, dim, on, ["source", "job_id"], J.hot_keys(p, on))


@check("fact_qcew", f"""WITH {O.QCEW} SELECT qcew_key, CAST(strftime(make_date(year, (qtr - 1) * 3 + 1, 1), '%Y%m%d') AS INT) AS date_key,
 area_fips, area_type, industry_code, industry_level, own_code, own_label, qtrly_estabs, avg_monthly_emplvl, total_qtrly_wages,
 avg_wkly_wage, year, qtr FROM qcew""")
def _(spark, sf):
    return gold.fact_qcew(qcew(spark, sf)).drop("location_key")


@check("fact_oews_wages", f"""WITH {O.POSTINGS} {O.RESOLVED} {O.OCCUPATIONS}, {O.OEWS} SELECT oews_key, survey_year * 10000 + 501 AS date_key,
 occupation_key, survey_year, area, area_type, occ_code, occ_title, tot_emp, a_median FROM wages LEFT JOIN occ ON soc_code = occ_code""")
def _(spark, sf):
    wages = gold.fact_oews_wages(silver.transform_oews(oews_bronze(spark, sf)), occupations(spark, sf)[1])
    return wages.select("oews_key", "date_key", "occupation_key", "survey_year", "area", "area_type", "occ_code",
                        "occ_title", "tot_emp", "a_median")


@check("update_postings_soc", f"WITH {O.FACT} SELECT posting_key, sector, salary_midpoint, occupation_key FROM fact")
def _(spark, sf):
    return posting_fact(spark, sf)[0].select("posting_key", "sector", "salary_midpoint", "occupation_key")


# -- reads -----------------------------------------------------------------

@check("federal_vs_private_gap", f"""WITH {GAP} SELECT *, CASE WHEN sector_gap_dollars > 0 THEN 'Federal pays more'
 ELSE 'Private pays more' END AS gap_direction FROM gap WHERE federal_postings >= 5 AND private_postings >= 5
 ORDER BY abs(sector_gap_dollars) DESC NULLS LAST, soc_code LIMIT 30""")
def _(spark, sf):
    return reads.federal_vs_private_gap(views.salary_gap(*posting_fact(spark, sf, *PAY)), min_postings=5)


@check("soc_major_distribution", f"""WITH {O.FACT} SELECT soc_major_title, sector, count(*) AS posting_count FROM fact
 WHERE soc_code <> '99-9999' GROUP BY ALL""")
def _(spark, sf):
    return reads.soc_major_distribution(*posting_fact(spark, sf))


@check("salary_by_occupation_top", f"""WITH {O.FACT}, ok AS (SELECT * FROM fact WHERE salary_midpoint BETWEEN 15000 AND 500000
 AND soc_code <> '99-9999'), top AS (SELECT soc_code FROM ok GROUP BY 1 ORDER BY count(*) DESC, soc_code LIMIT 5)
SELECT soc_code, soc_title, sector, salary_midpoint FROM ok WHERE soc_code IN (FROM top)""")
def _(spark, sf):
    return reads.salary_by_occupation_top(*posting_fact(spark, sf, *PAY), n=5)


@check("qcew_trend", f"""WITH {TREND} SELECT year, qtr, quarter_start_date AS quarter_date, state_employment, state_avg_wkly_wage
 FROM trend WHERE state_fips = '06' AND own_label = 'Private'""")
def _(spark, sf):
    return reads.qcew_trend(gold.fact_qcew(qcew(spark, sf)))


@check("qcew_state_options", f"""WITH {O.QCEW}, n(state_fips, state_name) AS (VALUES {O.values(O.L.STATE_FIPS_NAMES)})
SELECT * FROM n WHERE state_fips IN (SELECT state_fips FROM qcew WHERE area_type = 'state')""")
def _(spark, sf):
    return reads.qcew_state_options(gold.fact_qcew(qcew(spark, sf)), fips_names(spark))


@check("headline_counters", f"""WITH {O.FACT}, {O.QCEW} SELECT (SELECT count(*) FROM fact) AS total_postings,
 (SELECT count(*) FROM qcew) AS qcew_rows, (SELECT count(*) FROM occ WHERE soc_code <> '99-9999') AS soc_codes_mapped,
 (SELECT max(year) FROM qcew) AS latest_qcew_year, (SELECT min(year) FROM qcew) AS earliest_qcew_year""")
def _(spark, sf):
    p = postings(spark, sf)
    return reads.headline_counters(gold.fact_job_postings(p, {}), stored(gold.fact_qcew(qcew(spark, sf))), occupations(spark, sf)[1])


@check("filter_options", f"""WITH {O.CLEAN} SELECT DISTINCT 'state' AS kind, location_state AS value FROM clean WHERE location_state IS NOT NULL
UNION ALL SELECT DISTINCT 'category', job_category FROM clean WHERE job_category IS NOT NULL""")
def _(spark, sf):
    o = reads.filter_options(clean(spark, sf))
    return W.union_all([
        o["states"].select(F.lit("state").alias("kind"), F.col("location_state").alias("value")),
        o["categories"].select(F.lit("category").alias("kind"), F.col("job_category").alias("value")),
    ])


@check("cities_for_states", f"""WITH {O.CLEAN} SELECT DISTINCT location_city FROM clean
 WHERE location_state IN ('Texas', 'Ohio') AND location_city IS NOT NULL""")
def _(spark, sf):
    return reads.cities_for_states(clean(spark, sf), ["Texas", "Ohio"])


@check("summary_stats", f"""WITH {O.CLEAN} SELECT count(*) AS total_jobs, count(*) FILTER (sector = 'federal') AS federal_jobs,
 count(*) FILTER (sector = 'private') AS private_jobs, count(*) FILTER (is_entry_level) AS entry_level_jobs,
 count(*) FILTER (posted_date >= {DAY} - 7) AS jobs_last_7d, count(DISTINCT location_state) AS states_covered FROM clean""")
def _(spark, sf):
    return reads.summary_stats(clean(spark, sf), AS_OF)


@check("posting_trend", f"""WITH {O.CLEAN} SELECT posted_date AS day, sector, count(*) AS job_count FROM clean
 WHERE posted_date >= {DAY} - 30 GROUP BY ALL""")
def _(spark, sf):
    return reads.posting_trend(clean(spark, sf), AS_OF)


JOBS = """job_id, source, sector, job_title, company_or_agency, location_city, location_state, salary_min, salary_max,
 experience_level, employment_type, remote_type, posted_date, CAST(NULL AS VARCHAR) AS apply_url, job_category"""


@check("latest_jobs", f"""WITH {O.CLEAN} SELECT {JOBS}, category_group FROM grouped WHERE posted_date >= {DAY} - 60
 AND experience_level IN ('entry', 'senior') AND sector IN ('federal')
 ORDER BY posted_date DESC, ingestion_timestamp DESC, source, job_id LIMIT 30""")
def _(spark, sf):
    wanted = {"experience_level": ["entry", "senior"], "sector": ["federal"], "location_state": []}
    return reads.latest_jobs(clean(spark, sf), categories(spark, sf), wanted, AS_OF, days=60)


@check("search_jobs", f"""WITH {O.CLEAN} SELECT {JOBS}, CAST(NULL AS DATE) AS close_date, category_group FROM grouped
 WHERE location_state IN ('Texas', 'California') AND remote_type IN ('remote')
 AND posted_date >= DATE '1996-01-01' AND posted_date <= DATE '2000-06-30' ORDER BY posted_date DESC, source, job_id LIMIT 200""")
def _(spark, sf):
    wanted = {"location_state": ["Texas", "California"], "remote_type": ["remote"], "job_category": []}
    return reads.search_jobs(clean(spark, sf), categories(spark, sf), wanted, "1996-01-01", "2000-06-30", sort="salary_desc")


@check("job_cards", f"""WITH {O.CLEAN}, t AS (SELECT *, format('{{:,}}', CAST(salary_min AS BIGINT)) AS lo, format('{{:,}}', CAST(salary_max AS BIGINT)) AS hi FROM clean)
SELECT job_id, source, CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN '$' || lo || ' – $' || hi
 WHEN lo IS NOT NULL THEN '$' || lo || '+' WHEN hi IS NOT NULL THEN 'up to $' || hi ELSE 'Salary not listed' END AS salary,
 coalesce(nullif(concat_ws(', ', location_city, location_state), ''), 'Unknown location') AS place FROM t""")
def _(spark, sf):
    return reads.job_cards(clean(spark, sf))


def preferences(spark, sf) -> DataFrame:
    """Preference rows per customer: some types only for some users, and a
    second state for a third of them."""
    c = load(spark, sf, "customer")
    email = F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.org"))
    k, n = F.col("c_custkey"), F.col("c_nationkey")

    def pick(x, *labels):
        return F.element_at(F.array(*map(F.lit, labels)), (x % len(labels)).cast("int") + 1)

    def row(when, kind, value):
        return F.when(when, F.struct(F.lit(kind).alias("pref_type"), value.alias("pref_value")))

    rows = F.array(
        row(k % 4 != 0, "experience_level", pick(k, "entry", "mid", "senior")),
        row(k % 5 != 0, "sector", pick(n, "federal", "private")),
        row(k % 3 != 0, "location_state", pick(n, "California", "Texas", "New York", "Ohio", "Nowhere")),
        row(k % 3 == 1, "location_state", F.lit("Ontario")),
        row(k % 2 == 0, "remote_type", pick(k / 2, "remote", "hybrid", "onsite")),
    )
    return c.select(email.alias("user_email"), F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select(
        "user_email", "r.*")


PREF_SQL = """c0 AS (SELECT 'user' || c_custkey || '@example.org' AS user_email, c_custkey AS k, c_nationkey AS n FROM customer),
prefs AS (
 SELECT user_email, 'experience_level' AS pref_type, (['entry', 'mid', 'senior'])[k % 3 + 1] AS pref_value FROM c0 WHERE k % 4 <> 0
 UNION ALL SELECT user_email, 'sector', (['federal', 'private'])[n % 2 + 1] FROM c0 WHERE k % 5 <> 0
 UNION ALL SELECT user_email, 'location_state', (['California', 'Texas', 'New York', 'Ohio', 'Nowhere'])[n % 5 + 1] FROM c0 WHERE k % 3 <> 0
 UNION ALL SELECT user_email, 'location_state', 'Ontario' FROM c0 WHERE k % 3 = 1
 UNION ALL SELECT user_email, 'remote_type', (['remote', 'hybrid', 'onsite'])[(k // 2) % 3 + 1] FROM c0 WHERE k % 2 = 0)"""


def feed_sql(days, k, types) -> str:
    lists = ", ".join(f"list(pref_value) FILTER (pref_type = '{t}') AS w_{t}" for t in types)
    match = " AND ".join(f"(w_{t} IS NULL OR list_contains(w_{t}, {t}))" for t in types)
    some = ", ".join(f"'{t}'" for t in types)
    return f"""WITH {O.CLEAN}, {PREF_SQL}, u AS (SELECT user_email, {lists} FROM prefs WHERE pref_type IN ({some}) GROUP BY 1)
SELECT user_email, job_id, source, sector, job_title, company_or_agency, location_city, location_state, salary_min, salary_max,
 experience_level, employment_type, remote_type, posted_date, job_category
FROM u JOIN (SELECT * FROM clean WHERE posted_date >= {DAY} - {days}) p ON {match}
QUALIFY row_number() OVER (PARTITION BY user_email ORDER BY posted_date DESC, ingestion_timestamp DESC, source, job_id) <= {k}"""


@check("personal_feed", feed_sql(7, 8, reads.PREFERENCE_TYPES))
def _(spark, sf):
    return reads.personal_feed(preferences(spark, sf), clean(spark, sf), AS_OF)


@check("personal_feed_everybody", feed_sql(7, 8, reads.PREFERENCE_TYPES).replace(
    "GROUP BY 1)", "GROUP BY 1 UNION ALL SELECT 's' || s_suppkey, NULL, NULL, NULL, NULL FROM supplier)", 1))
def _(spark, sf):
    """Suppliers stand for users without any preference row."""
    new = load(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("user_email"))
    known = preferences(spark, sf)
    return reads.personal_feed(known, clean(spark, sf), AS_OF, users=new.union(known.select("user_email")))


@check("recommended_jobs", feed_sql(14, 6, reads.PREFERENCE_TYPES[:3]))
def _(spark, sf):
    return reads.recommended_jobs(preferences(spark, sf), clean(spark, sf), AS_OF)


@check("peak_to_trough", f"""WITH {TREND} SELECT max(state_employment) AS peak, min(state_employment) AS trough,
 1 - min(state_employment) / max(state_employment) AS drop_share FROM trend
 WHERE state_fips = '06' AND own_label = 'Private' AND year BETWEEN 1996 AND 1999""")
def _(spark, sf):
    return reads.peak_to_trough(reads.qcew_trend(gold.fact_qcew(qcew(spark, sf))), 1996, 1999)
