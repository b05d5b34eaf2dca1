from datetime import date

import pytest
from pyspark.sql import functions as F

from meritrix.functions import derive as D
from meritrix.functions import lookups as L


@pytest.mark.parametrize("amount, code, want", [
    ("'25.00'", "'PH'", 52000.0), ("'2000'", "'PB'", 52000.0), ("'60000'", "NULL", 60000.0),
    ("'60000'", "'PA'", 60000.0), ("'abc'", "'PH'", None), ("NULL", "'PB'", None),
])
def test_annualise(one, amount, code, want):
    assert one(D.annualise("a", F.col("c").cast("string")), a=amount, c=code) == want


@pytest.mark.parametrize("grade, title, pay, want", [
    ("SES", "Intern Program Chief", 1, "senior"), ("GS", "Clerk", 54999, "entry"), ("GS", "Clerk", 55000, "mid"),
    ("GS", "Clerk", 100000, "senior"), ("GS", "Clerk", None, "mid"), ("GS", "Student Trainee", 200000, "entry"),
])
def test_level_federal(rows, grade, title, pay, want):
    df = rows("g string, t string, p double", (grade, title, None if pay is None else float(pay)))
    assert df.select(D.level_federal("g", "t", "p").alias("r")).first().r == want


@pytest.mark.parametrize("title, level, flag", [
    ("Associate Editor", "entry", False), ("Senior Associate", "entry", False), ("Sr Engineer", "senior", False),
    ("Entry-Level Clerk", "entry", True), ("Painter", "mid", False), (None, "mid", None),
])
def test_level_private(rows, title, level, flag):
    r = rows("t string", (title,)).select(D.level_private("t").alias("l"), D.is_entry("t", "private").alias("e")).first()
    assert (r.l, r.e) == (level, flag)


def test_title_forms(one):
    raw = "'Senior Data Analyst — Remote'"
    assert one(D.norm_a("t"), t=raw) == "senior data analyst remote"
    assert one(D.norm_b("t"), t=raw) == "senior data analyst   remote"


def test_remote_type(one):
    assert one(D.remote_private("d"), d="'x\nREMOTE work'") == "remote"
    assert one(D.remote_private("d"), d="'remotely'") == "unknown"
    assert one(D.remote_private("d"), d="CAST(NULL AS STRING)") == "unknown"
    assert one(D.remote_federal("f", "d"), f="CAST(NULL AS BOOLEAN)", d="CAST(NULL AS STRING)") == "onsite"
    assert one(D.remote_federal("f", "d"), f="false", d="'Hybrid desk'") == "hybrid"


def test_json_paths(spark):
    text = '{"a":{"b":[{"c":"x"}]},"n":"12.5","arr":["US"],"flag":true}'
    df = D.with_payload(spark.createDataFrame([(text,), ("not json",)], "raw_data string"))
    got = df.select(
        D.json_path("payload", "$.a.b[0].c").alias("c"), D.json_path("payload", "$.arr[2]").alias("missing"),
        D.json_path("payload", "$.n", "double").alias("n"), D.json_path("payload", "$.flag", "boolean").alias("f"),
    ).collect()
    assert tuple(got[0]) == ("x", None, 12.5, True)
    assert tuple(got[1]) == (None, None, None, None)


def test_dates_and_keys(one):
    assert one(D.iso_date("d"), d="'2024-02-03T10:00:00Z'") == date(2024, 2, 3)
    assert one(D.iso_date("d"), d="'soon'") is None
    assert one(D.quarter_date_key("y", "q"), y="2024", q="3") == 20240701
    assert one(D.survey_date_key("y"), y="2023") == 20230501
    assert one(D.qcew_key(), area_fips="'06000'", industry_code="'10'", own_code="5", year="2024", qtr="1") == "06000|10|5|2024|1"
    assert one(D.qcew_key(), area_fips="CAST(NULL AS STRING)", industry_code="'10'", own_code="5", year="2024", qtr="1") is None
    assert one(D.oews_key(), survey_year="2023", area="CAST(NULL AS STRING)", occ_code="'15-1252'") == "2023||15-1252"


def test_calendar(spark):
    from meritrix.plans.gold import dim_date

    days = dim_date(spark, "2020-01-01", "2030-12-31")
    assert days.count() == 4018
    r = days.filter("date_key = 20200105").first()
    assert (r.month_name, r.day_name, r.day_of_week, r.is_weekend, r.quarter) == ("Jan", "Sun", 0, True, 1)


def test_labels(one):
    assert one(D.census_region("s"), s="'District of Columbia'") == "South"
    assert one(D.census_region("s"), s="'Ontario'") == "Other"
    assert one(D.agency_parent("n", "s"), n="'US Department of the Navy'", s="'federal'") == "USN"
    assert one(D.agency_parent("n", "s"), n="'Department of the Navy'", s="'private'") is None
    assert one(D.category_group("c"), c="'IT Jobs'") == "Other"
    assert one(D.category_group("c"), c="'Healthcare engineer'") == "Tech"
    assert [one(D.area_type("a"), a=str(a)) for a in (10, 55, 70, 30, 99, 20)] == [
        "national", "state", "msa", "county", "csa", "other"]
    assert [one(D.industry_level("c"), c=f"'{c}'") for c in ("10", "1025", "541511", "31-33", "1")] == [2, 4, 6, 0, 0]
    assert one(D.own_label("c"), c="8") == "Total Private+Gov"
    assert one(D.soc_major_title("g"), g="'99-0000'") == "Unmapped"
    assert one(D.gap_direction("g"), g="0") == "Private pays more"


def test_display(one):
    null = "CAST(NULL AS DOUBLE)"
    assert one(D.salary_text("a", "b"), a="52000D", b="61000.4D") == "$52,000 – $61,000"
    assert one(D.salary_text("a", "b"), a="52000D", b=null) == "$52,000+"
    assert one(D.salary_text("a", "b"), a="0D", b="9D") == "up to $9"
    assert one(D.salary_text("a", "b"), a=null, b=null) == "Salary not listed"
    assert one(D.location_text("a", "b"), a="' '", b="'Ohio'") == "Ohio"
    assert one(D.location_text("a", "b"), a="'nan'", b="CAST(NULL AS STRING)") == "Unknown location"
    assert one(D.salary_midpoint("a", "b"), a="10D", b=null) == 10.0


def test_tables_are_complete():
    assert len(L.SOC_TITLE_SEED) == len({t for t, _, _ in L.SOC_TITLE_SEED}) == 85
    assert len(L.SOC_TITLE_PATTERNS) == len({t for t, _, _ in L.SOC_TITLE_PATTERNS}) == 203
    assert len(L.SOC_MAJOR_TITLES) == 23 and len(L.STATE_FIPS_NAMES) == 51 and len(L.AGENCY_PARENTS) == 18
    assert [len(s) for s in L.CENSUS_REGIONS.values()] == [9, 12, 17, 13]


def test_normalising_lists_its_characters(rows):
    """Ranges in a class that is negated take several times as long."""
    frame = rows("t string", ("Ünter-Chef, IT  (m/w)",), ("A1 b2\u212a\u0130",), (None,))
    out = frame.select(D.norm_a("t").alias("a"), D.norm_b("t").alias("b"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "a-z" not in plan
    want = frame.selectExpr("trim(regexp_replace(lower(t), '[^a-zA-Z0-9]+', ' ')) a", "trim(regexp_replace(lower(t), '[^a-z0-9 ]+', ' ')) b")
    assert out.collect() == want.collect()
