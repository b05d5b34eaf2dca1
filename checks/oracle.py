"""Building blocks of the DuckDB reference SQL.

The reference SQL is written from the semantics, not generated from the Spark
plans: theta joins where Spark works row by row, plain windows where Spark
salts, built-in quantiles where Spark selects ranks.
"""

from __future__ import annotations

from checks.adapters import cte
from meritrix.functions import lookups as L


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(_q(x) for x in r) + ")" for r in rows)


def cases(rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {_q(v)}" for c, v in rules) + f" ELSE {default} END"


def category_group(col: str) -> str:
    return cases(
        [(" OR ".join(f"contains(lower({col}), {_q(w)})" for w in words), g) for g, words in L.CATEGORY_GROUPS], "'Other'"
    )


def agency_parent(name: str, sector: str) -> str:
    inner = cases([(f"contains(lower({name}), {_q(p)})", code) for p, code in L.AGENCY_PARENTS], "NULL")
    return f"CASE WHEN {sector} = 'federal' THEN {inner} END"


def census_region(col: str) -> str:
    return cases([(f"{col} IN ({', '.join(map(_q, s))})", r) for r, s in L.CENSUS_REGIONS.items()], "'Other'")


def major_title(col: str) -> str:
    return cases([(f"{col} = {_q(k)}", v) for k, v in L.SOC_MAJOR_TITLES], "'Unmapped'")


def area_type(col: str) -> str:
    return cases([(f"{col} BETWEEN {a} AND {b}", t) for a, b, t in L.AREA_TYPE_RANGES], "'other'")


def own_label(col: str) -> str:
    return cases([(f"{col} = {k}", v) for k, v in L.OWNERSHIP_LABELS.items()], "'Other'")


def numbered(natural: str, source: str) -> str:
    """Key per row: position by (first hex digits of the md5, natural key)."""
    return f"row_number() OVER (ORDER BY substr(md5(concat_ws(chr(31), {natural})), 1, 3), {source})"


NORM_A = "trim(regexp_replace(lower({}), '[^a-zA-Z0-9]+', ' ', 'g'))"
NORM_B = "trim(regexp_replace(lower({}), '[^a-z0-9 ]+', ' ', 'g'))"

POSTINGS = cte("postings")
CLEAN = POSTINGS + """,
clean AS (SELECT * FROM postings
  WHERE job_title IS NOT NULL AND source IS NOT NULL AND sector IS NOT NULL
    AND coalesce(salary_min BETWEEN 10000 AND 500000, true)
    AND coalesce(salary_max BETWEEN 10000 AND 500000, true)
    AND coalesce(salary_min <= salary_max, true)),
grouped AS (SELECT *, CASE WHEN job_category IS NULL THEN 'Other' ELSE """ + category_group("job_category") + """ END AS category_group FROM clean)"""

MID = "CASE WHEN salary_min IS NULL THEN salary_max WHEN salary_max IS NULL THEN salary_min ELSE (salary_min + salary_max) / 2.0 END"

RESOLVED = f""",
seed(s, code, label) AS (VALUES {values(L.SOC_TITLE_SEED)}),
pats(p, code, label) AS (VALUES {values(L.SOC_TITLE_PATTERNS)}),
titles AS (SELECT {NORM_B.format('job_title')} AS t, min(job_title) AS raw, count(*) AS n
  FROM postings WHERE job_title IS NOT NULL GROUP BY 1),
ex AS (SELECT t, code, label FROM titles JOIN seed ON t = s),
near AS (SELECT t, code, label, levenshtein(t, s) AS d FROM titles, seed
  WHERE length(t) BETWEEN 4 AND 60 AND t NOT IN (SELECT t FROM ex)
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY levenshtein(t, s), s) = 1),
fz AS (SELECT * FROM near WHERE d <= greatest(2, round(length(t) * 0.15))),
kw AS (SELECT t, code, label, p FROM titles JOIN pats ON contains(t, p)
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY length(p) DESC, p) = 1),
resolved AS (SELECT coalesce(ex.code, fz.code, kw.code, '99-9999') AS soc_code,
   coalesce(ex.label, fz.label, kw.label, 'Unmapped') AS soc_title,
   left(coalesce(ex.code, fz.code, kw.code, '99-9999'), 2) || '-0000' AS soc_major_group,
   t AS title_normalized, raw AS title_raw,
   CASE WHEN ex.t IS NOT NULL THEN 'exact' WHEN fz.t IS NOT NULL THEN 'fuzzy'
        WHEN kw.t IS NOT NULL THEN 'keyword' ELSE 'unmapped' END AS match_method,
   CASE WHEN ex.t IS NOT NULL THEN CAST(1.0 AS DOUBLE)
        WHEN fz.t IS NOT NULL THEN CAST(1.0 AS DOUBLE) - CAST(d AS DOUBLE) / CAST(length(t) AS DOUBLE)
        WHEN kw.t IS NOT NULL THEN least(CAST(1.0 AS DOUBLE), CAST(length(p) AS DOUBLE) / CAST(length(t) AS DOUBLE))
        ELSE CAST(0.0 AS DOUBLE) END AS match_confidence, n AS posting_count
  FROM titles LEFT JOIN ex USING (t) LEFT JOIN fz USING (t) LEFT JOIN kw USING (t))"""

OCCUPATIONS = f""",
occ0 AS (SELECT soc_code, min(soc_title) AS soc_title, soc_major_group FROM resolved GROUP BY soc_code, soc_major_group),
occ AS (SELECT {numbered('soc_code', 'soc_code')} AS occupation_key, soc_code, soc_title, soc_major_group,
  {major_title('soc_major_group')} AS soc_major_title FROM occ0)"""

FACT = POSTINGS + RESOLVED + OCCUPATIONS + f""",
fact AS (SELECT source || '::' || job_id AS posting_key, sector, posted_date, {MID} AS salary_midpoint,
   occ.soc_code, occ.soc_title, occ.soc_major_title, occ.occupation_key
  FROM postings LEFT JOIN resolved ON {NORM_B.format('job_title')} = title_normalized
  LEFT JOIN occ ON occ.soc_code = resolved.soc_code)"""

QCEW = cte("qcew_raw") + f""",
per_level AS (SELECT area_fips, industry_code, own_code, year, qtr, agglvl_code, max(qtrly_estabs) AS qtrly_estabs,
   (coalesce(max(month1_emplvl), 0) + coalesce(max(month2_emplvl), 0) + coalesce(max(month3_emplvl), 0)) / CAST(3.0 AS DOUBLE) AS avg_monthly_emplvl,
   max(total_qtrly_wages) AS total_qtrly_wages, max(avg_wkly_wage) AS avg_wkly_wage,
   max(ingestion_timestamp) AS ingestion_timestamp
  FROM qcew_raw WHERE coalesce(disclosure_code, '') = '' GROUP BY ALL),
qcew AS (SELECT area_fips || '|' || industry_code || '|' || own_code || '|' || year || '|' || qtr AS qcew_key, area_fips,
   {area_type('agglvl_code')} AS area_type, left(area_fips, 2) AS state_fips, industry_code,
   CASE WHEN regexp_matches(industry_code, '^[0-9]{{2,6}}$') THEN length(industry_code) ELSE 0 END AS industry_level,
   own_code, {own_label('own_code')} AS own_label, year, qtr, qtrly_estabs, avg_monthly_emplvl, total_qtrly_wages,
   avg_wkly_wage, ingestion_timestamp
  FROM per_level QUALIFY row_number() OVER (PARTITION BY area_fips, industry_code, own_code, year, qtr ORDER BY agglvl_code) = 1)"""

OEWS = cte("oews_raw") + """,
wages AS (SELECT survey_year || '|' || coalesce(area, '') || '|' || occ_code AS oews_key, survey_year, area,
   CAST(NULL AS VARCHAR) AS area_title, TRY_CAST(area_type AS INT) AS area_type, occ_code, occ_title,
   CASE WHEN contains(lower(o_group), 'major') THEN 'major' WHEN contains(lower(o_group), 'detailed') THEN 'detailed' END AS o_group,
   TRY_CAST(tot_emp AS DOUBLE) AS tot_emp, TRY_CAST(a_median AS DOUBLE) AS a_median
  FROM oews_raw WHERE occ_code NOT LIKE '00-%'
  QUALIFY row_number() OVER (PARTITION BY survey_year, area, occ_code ORDER BY TRY_CAST(tot_emp AS DOUBLE) DESC NULLS LAST) = 1)"""
