import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meritrix.plans import reads

AS_OF = date(2024, 6, 30)
SCHEMA = ("job_id string, source string, sector string, job_title string, company_or_agency string, location_city string, "
          "location_state string, salary_min double, salary_max double, experience_level string, employment_type string, "
          "remote_type string, posted_date date, job_category string, ingestion_timestamp timestamp")


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(11)
    jobs = []
    for i in range(400):
        day = AS_OF - timedelta(days=rng.randint(0, 20))
        hot = i % 3 == 0  # a third of the postings in one combination
        jobs.append((
            f"j{i}", "adzuna", "private" if hot else rng.choice(["federal", "private"]), "t", "c", "x",
            "Texas" if hot else rng.choice(["Texas", "Ohio", None, "*"]), None, None,
            "entry" if hot else rng.choice(["entry", "mid", "senior"]), "full_time",
            "remote" if hot else rng.choice(["remote", "hybrid", "onsite", "unknown"]), day, "k",
            datetime(2024, 7, 1, rng.randint(0, 23)),
        ))
    prefs = []
    for u in range(60):
        for kind, values in (("experience_level", ["entry", "mid", "senior"]), ("sector", ["federal", "private"]),
                             ("location_state", ["Texas", "Ohio", "Mars", "*"]), ("remote_type", ["remote", "hybrid"])):
            for v in rng.sample(values, rng.choice([0, 0, 1, 2])):
                prefs.append((f"u{u}", kind, v))
    return jobs, prefs


def brute(jobs, prefs, days, k, types, require_any):
    users = {}
    for u, kind, v in prefs:
        users.setdefault(u, {}).setdefault(kind, set()).add(v)
    col = {"experience_level": 9, "sector": 2, "location_state": 6, "remote_type": 11}
    out = {}
    for u, wish in users.items():
        wish = {t: wish[t] for t in types if t in wish}
        if require_any and not wish:
            continue
        ok = [j for j in jobs if j[12] >= AS_OF - timedelta(days=days) and all(j[col[t]] in v for t, v in wish.items())]
        ok.sort(key=lambda j: (-j[12].toordinal(), -j[14].timestamp(), j[1], j[0]))
        if ok:
            out[u] = {j[0] for j in ok[:k]}
    return out


@pytest.mark.parametrize("recommend", [False, True])
def test_feed_against_brute_force(spark, world, recommend):
    jobs, prefs = world
    clean, p = spark.createDataFrame(jobs, SCHEMA), spark.createDataFrame(prefs, "user_email string, pref_type string, pref_value string")
    if recommend:
        got, want = reads.recommended_jobs(p, clean, AS_OF), brute(jobs, prefs, 14, 6, reads.PREFERENCE_TYPES[:3], True)
    else:
        got, want = reads.personal_feed(p, clean, AS_OF), brute(jobs, prefs, 7, 8, reads.PREFERENCE_TYPES, False)
    feed = {}
    for r in got.collect():
        feed.setdefault(r.user_email, []).append(r.job_id)
    assert {u: set(v) for u, v in feed.items()} == want
    assert all(len(v) == len(set(v)) for v in feed.values())


def test_search_order_and_sort_modes(spark, world):
    clean = spark.createDataFrame(world[0], SCHEMA).withColumn("salary_max", F.col("job_id").substr(2, 9).cast("double"))
    dim = spark.createDataFrame([("k", "Tech")], "category_name string, category_group string")
    top = reads.search_jobs(clean, dim, {"sector": ["private"]}, limit=10).collect()
    assert [r.posted_date for r in top] == sorted([r.posted_date for r in top], reverse=True) and top[0].category_group == "Tech"
    by_pay = reads.search_jobs(clean, dim, {"sector": ["private"]}, limit=10, sort="salary_desc").collect()
    assert {r.job_id for r in by_pay} == {r.job_id for r in top}
    assert [r.salary_max for r in by_pay] == sorted((r.salary_max for r in by_pay), reverse=True)
    latest = reads.latest_jobs(clean, dim, {"remote_type": ["remote"]}, AS_OF, limit=4).collect()
    assert len(latest) == 4 and {r.remote_type for r in latest} == {"remote"}
    assert reads.cities_for_states(clean, []).count() == 0
    assert [r.location_city for r in reads.cities_for_states(clean, ["Ohio"]).collect()] == ["x"]


def test_gap_formula(rows):
    from meritrix.plans.views import salary_gap

    published = [("13-2011", 117778, 34960, 2.369), ("15-1252", 172035, 82388, 1.088), ("13-1111", 117980, 59343, 0.988),
                 ("15-2051", 165503, 99154, 0.669), ("17-2199", 116288, 154221, -0.246)]
    fact, dim = [], []
    for i, (code, f, p, _) in enumerate(published):
        dim.append((i, code, code, "x"))
        fact += [(i, "federal", float(f)), (i, "private", float(p)), (i, "private", 14999.0)]
    fact.append((None, "federal", 50000.0))
    out = salary_gap(rows("occupation_key int, sector string, salary_midpoint double", *fact),
                     rows("occupation_key int, soc_code string, soc_title string, soc_major_title string", *dim)).collect()
    assert {r.soc_code: round(r.sector_gap_pct, 3) for r in out} == {c: g for c, *_, g in published}
    gaps = [abs(r.sector_gap_dollars) for r in out]
    assert gaps == sorted(gaps, reverse=True)
