"""The posting, payload, employment and wage tables expressed over the given
test tables. The text is plain SQL that Spark and DuckDB read alike, so the
checked queries and their reference SQL start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# adapter -> (tables it reads, SELECT)
ADAPTERS = {
    "postings": (['orders', 'customer'], r"""
SELECT CASE WHEN o_orderstatus='F' THEN 'usajobs_' ELSE 'adzuna_' END || CAST(o_orderkey AS STRING) AS job_id,
 CASE WHEN o_orderstatus='F' THEN 'usajobs_current' ELSE 'adzuna' END AS source,
 CASE WHEN o_orderstatus='F' THEN 'federal' ELSE 'private' END AS sector,
 CASE o_orderkey % 15 WHEN 0 THEN 'Software Engineer' WHEN 1 THEN 'Data Analyst' WHEN 2 THEN 'Registered Nurse' WHEN 3 THEN 'Sofware Enginer' WHEN 4 THEN 'Accountnt' WHEN 5 THEN 'Senior Data Analyst - Remote' WHEN 6 THEN 'Supervisory Management & Program Analyst' WHEN 7 THEN 'Health System Specialist' WHEN 8 THEN 'Aerospace Engineer, GS-13' WHEN 9 THEN 'Junior Developer Intern' WHEN 10 THEN 'Chief Nurse' WHEN 11 THEN 'Zamboni Wrangler' WHEN 12 THEN 'Front - End Lead' WHEN 13 THEN 'Sr. Attorney' END AS job_title,
 CASE WHEN o_orderstatus='F' AND o_custkey % 3 = 0 THEN 'Department of Veterans Affairs' WHEN o_orderstatus='F' AND o_custkey % 3 = 1 THEN 'Department of the Navy' ELSE c_name END AS company_or_agency,
 'City ' || CAST(c_nationkey % 7 AS STRING) AS location_city,
 CASE WHEN c_nationkey % 6 = 0 THEN NULL WHEN c_nationkey % 6 = 1 THEN 'California' WHEN c_nationkey % 6 = 2 THEN 'Texas' WHEN c_nationkey % 6 = 3 THEN 'New York' WHEN c_nationkey % 6 = 4 THEN 'Ohio' ELSE 'Ontario' END AS location_state,
 'US' AS location_country,
 CAST(c_nationkey AS DOUBLE) AS latitude, CAST(-c_nationkey AS DOUBLE) AS longitude,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 4) AS DOUBLE) END AS salary_min,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN CAST(floor(o_totalprice / 5) AS DOUBLE) ELSE CAST(floor(o_totalprice / 3) AS DOUBLE) END AS salary_max,
 CASE o_custkey % 9 WHEN 0 THEN 'IT Jobs Information Technology' WHEN 1 THEN 'Healthcare & Nursing' WHEN 2 THEN 'Accounting & Finance' WHEN 3 THEN 'Legal Jobs' WHEN 4 THEN 'HR human resources' WHEN 5 THEN 'Logistics & Warehouse' WHEN 6 THEN 'Admin Jobs' WHEN 7 THEN 'Teaching' END AS job_category,
 CASE o_orderkey % 3 WHEN 0 THEN 'entry' WHEN 1 THEN 'mid' ELSE 'senior' END AS experience_level,
 (o_orderkey % 3 = 0) AS is_entry_level,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'full_time' WHEN '2-HIGH' THEN 'part_time' WHEN '3-MEDIUM' THEN 'intern' ELSE 'unknown' END AS employment_type,
 CASE o_orderkey % 4 WHEN 0 THEN 'remote' WHEN 1 THEN 'hybrid' WHEN 2 THEN 'onsite' ELSE 'unknown' END AS remote_type,
 CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS posted_date,
 o_orderdate AS ingestion_timestamp
FROM @orders JOIN @customer ON c_custkey = o_custkey
"""),
    "payloads": (['orders', 'customer'], r"""
SELECT CAST(o_orderkey AS STRING) AS job_id,
 '{"id":"' || CAST(o_orderkey AS STRING) || '","title":"Sr Engineer ' || CAST(o_orderkey % 5 AS STRING) || '","company":{"display_name":"' || c_name || '"},"location":{"area":["US"' || CASE WHEN o_orderkey % 2 = 0 THEN ',"Texas","Austin"' ELSE '' END || ']},"salary_min":' || CAST(o_orderkey % 1000 AS STRING) || ',"created":"2024-01-0' || CAST(1 + o_orderkey % 9 AS STRING) || 'T10:00:00Z"}' AS raw_data
FROM @orders JOIN @customer ON c_custkey = o_custkey
"""),
    "payloads_federal": (['orders', 'customer'], r"""
SELECT CAST(o_orderkey AS STRING) AS control_number,
 '{"MatchedObjectId":"' || CAST(o_orderkey AS STRING) || '","MatchedObjectDescriptor":{"PositionTitle":"'
 || CASE o_orderkey % 5 WHEN 0 THEN 'Program Analyst' WHEN 1 THEN 'IT Specialist (INFOSEC)' WHEN 2 THEN 'Sr. Attorney' WHEN 3 THEN 'Student Trainee' ELSE 'Chief Engineer' END
 || '","OrganizationName":"' || CASE o_custkey % 2 WHEN 0 THEN 'Department of the Navy' ELSE c_name END
 || '","QualificationSummary":"' || CASE o_orderkey % 4 WHEN 0 THEN 'A Hybrid schedule is offered' ELSE 'On site duty' END || '"'
 || CASE WHEN o_orderkey % 6 = 0 THEN ',"PositionFormattedDescription":[{"Content":"Formatted text"}]' ELSE '' END
 || CASE WHEN o_orderkey % 7 = 0 THEN ',"PositionLocation":[]' ELSE ',"PositionLocation":[{"CityName":"Washington, District of Columbia","CountrySubDivisionCode":"Virginia","CountryCode":"United States","Latitude":38.5,"Longitude":-77.25}]' END
 || CASE o_orderkey % 4 WHEN 0 THEN ',"PositionRemuneration":[{"MinimumRange":"30.5","MaximumRange":"40","RateIntervalCode":"PH"}]' WHEN 1 THEN ',"PositionRemuneration":[{"MinimumRange":"2000","MaximumRange":"3000","RateIntervalCode":"PB"}]' WHEN 2 THEN ',"PositionRemuneration":[{"MinimumRange":"54999","MaximumRange":"99000","RateIntervalCode":"PA"}]' ELSE ',"PositionRemuneration":[{"MinimumRange":"100000"}]' END
 || ',"JobCategory":[{"Name":"' || c_mktsegment || '"}],"JobGrade":[{"Code":"' || CASE WHEN o_orderkey % 9 = 0 THEN 'SES' ELSE 'GS' END
 || '"}],"PositionSchedule":[{"Code":"' || CAST(1 + o_orderkey % 3 AS STRING) || '"}]'
 || CASE o_orderkey % 3 WHEN 0 THEN ',"RemoteIndicator":true' WHEN 1 THEN ',"RemoteIndicator":false' ELSE '' END
 || ',"PublicationStartDate":"2024-02-0' || CAST(1 + o_orderkey % 9 AS STRING) || 'T00:00:00.0000","ApplicationCloseDate":"2024-03-15T23:59:59.9970","ApplyURI":["https://example.org/' || CAST(o_orderkey AS STRING) || '"]}}' AS raw_data,
 o_orderdate AS ingestion_timestamp
FROM @orders JOIN @customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F'
"""),
    "qcew_raw": (['lineitem', 'supplier'], r"""
SELECT CASE WHEN s_nationkey < 10 THEN '0' ELSE '' END || CAST(s_nationkey AS STRING) || '000' AS area_fips,
 CAST(CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 5 WHEN 6 THEN 8 ELSE 9 END AS INT) AS own_code,
 CASE l_partkey % 4 WHEN 0 THEN '10' WHEN 1 THEN '1025' WHEN 2 THEN '541511' ELSE '31-33' END AS industry_code,
 CAST(CASE s_suppkey % 4 WHEN 0 THEN 10 WHEN 1 THEN 50 WHEN 2 THEN 70 ELSE 30 END AS INT) AS agglvl_code,
 CAST(extract(year FROM l_shipdate) AS INT) AS year, CAST(extract(quarter FROM l_shipdate) AS INT) AS qtr,
 CASE WHEN l_returnflag='R' THEN 'N' WHEN l_returnflag='A' THEN '' ELSE NULL END AS disclosure_code,
 CAST(l_quantity AS INT) AS qtrly_estabs,
 CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE CAST(l_quantity AS INT) * 3 END AS month1_emplvl,
 CAST(l_quantity AS INT) * 6 AS month2_emplvl, CAST(l_quantity AS INT) * 9 AS month3_emplvl,
 CAST(floor(l_extendedprice) AS DOUBLE) AS total_qtrly_wages, CAST(floor(l_extendedprice / 13) AS DOUBLE) AS avg_wkly_wage,
 l_shipdate AS ingestion_timestamp
FROM @lineitem JOIN @supplier ON s_suppkey = l_suppkey
"""),
    "oews_raw": (['part'], r"""
SELECT CAST(2019 + p_size % 6 AS INT) AS survey_year, CASE p_partkey % 3 WHEN 0 THEN '99' ELSE '06' END AS area,
 CASE p_partkey % 3 WHEN 0 THEN '1' ELSE '2' END AS area_type,
 CASE p_partkey % 8 WHEN 0 THEN '15-1252' WHEN 1 THEN '15-2041' WHEN 2 THEN '29-1141' WHEN 3 THEN '13-2011' WHEN 4 THEN '17-2011' WHEN 5 THEN '00-0000' WHEN 6 THEN NULL ELSE '13-1111' END AS occ_code,
 p_name AS occ_title, CASE p_partkey % 2 WHEN 0 THEN 'Detailed' ELSE 'major group' END AS o_group,
 CASE WHEN p_partkey % 10 = 0 THEN '*' WHEN p_partkey % 10 = 1 THEN '#' WHEN p_partkey % 10 = 2 THEN '1,234' ELSE CAST(CAST(floor(p_retailprice * 50) AS INT) AS STRING) END AS a_median,
 CAST(p_partkey AS STRING) AS tot_emp
FROM @part
"""),
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, select = ADAPTERS[name]
    for t in tables:
        load(spark, sf_dir, t).createOrReplaceTempView(f"given_{t}")
    return spark.sql(bound(select, "given_"))


def bound(select: str, prefix: str = "") -> str:
    """Adapter text with its ``@table`` marks replaced by table names."""
    return select.replace("@", prefix)


def cte(*names: str) -> str:
    """``name AS (...)`` list for a WITH clause of the reference SQL."""
    return ",\n".join(f"{n} AS ({bound(ADAPTERS[n][1])})" for n in names)
