import json

from pyspark.sql import functions as F

from meritrix.plans import gold
from meritrix.schemas import FACT_JOB_POSTINGS
from meritrix.sources.readers import select_files
from meritrix.sources.store import SnapshotStore, read_table
from meritrix.streaming.ingest import load_year, pending_files, refresh_years, stream_ingest
from meritrix.streaming.refresh import refresh, refresh_batch


def payload(i, title="Data Analyst", **more):
    return json.dumps({"id": i, "title": title, "company": {"display_name": f"c{i % 3}"}, "salary_min": 50000 + i,
                       "location": {"area": ["US", "Texas", "Austin"]}, "category": {"label": "IT Jobs"},
                       "created": "2024-05-06T01:02:03Z", **more})


def test_two_runs_equal_one(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    target, marks = str(tmp_path / "raw"), str(tmp_path / "marks")

    def run():
        stream_ingest(spark, str(landing), target, marks).awaitTermination()
        return {r.job_id: r.raw_data for r in read_table(spark, target).collect()}

    assert run() == {}
    (landing / "1.json").write_text("\n".join(payload(i) for i in (1, 2, 2)))
    assert set(run()) == {"1", "2"}
    (landing / "2.json").write_text("\n".join(payload(i, "changed") for i in (2, 3)))
    got = run()
    assert set(got) == {"1", "2", "3"} and "Data Analyst" in got["2"] and "changed" in got["3"]
    assert read_table(spark, target).count() == 3
    assert run() == got


def test_pending_files(spark, tmp_path):
    for name in ("oesm1.x", "oesm2.x"):
        (tmp_path / name).write_text("a")
    listing = select_files(spark, str(tmp_path))
    manifest = listing.filter(F.col("path").endswith("oesm1.x"))
    assert [r.path[-7:] for r in pending_files(manifest, listing).collect()] == ["oesm2.x"]
    assert pending_files(manifest, listing, force=True).count() == 2


def test_years_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "qcew")
    year = lambda y, v: spark.range(3).select("id", F.lit(y).alias("year"), F.lit(v).alias("v"))
    for y in (2022, 2023, 2024):
        load_year(year(y, "first"), path, y)
    load_year(year(2023, "again"), path, 2023)
    both = year(2023, "new").union(year(2024, "new")).union(year(2022, "ignored"))
    refresh_years(both, path, [2023, 2024])
    got = {(r.year, r.v, r.n) for r in read_table(spark, path).groupBy("year", "v").agg(F.count("*").alias("n")).collect()}
    assert got == {(2022, "first", 3), (2023, "new", 3), (2024, "new", 3)}


def bronze(spark, *payloads, ts="2024-06-01"):
    rows = [(str(json.loads(p)["id"]), p) for p in payloads]
    return spark.createDataFrame(rows, "job_id string, raw_data string").withColumn(
        "ingestion_timestamp", F.lit(ts).cast("timestamp"))


def test_refresh_is_idempotent_and_keeps_keys(spark, tmp_path):
    tables = SnapshotStore(spark, str(tmp_path / "wh"))
    tables.write("raw_adzuna", bronze(spark, payload(1), payload(2, "Zzzz"), payload(3)))
    first = refresh(tables, ["raw_adzuna"], calendar=("2024-01-01", "2024-12-31"))
    assert first["jobs_unified"] == {"rows": 3, "inserted": 3}
    assert list(first).index("dim_company") < list(first).index("fact_job_postings")

    def fact():
        return sorted(tuple(r) for r in tables.read("fact_job_postings").collect())

    before = fact()
    again = refresh(tables, ["raw_adzuna"])
    assert fact() == before and all(v["inserted"] == 0 for v in again.values())

    tables.write("raw_adzuna", bronze(spark, payload(1), payload(2, "Nurse"), payload(3), payload(4), ts="2024-06-02"))
    refresh(tables, ["raw_adzuna"])
    after = {r.posting_key: r for r in tables.read("fact_job_postings").collect()}
    assert len(after) == 4
    old = {r[0]: r for r in before}
    for key in ("adzuna::adzuna_1", "adzuna::adzuna_3"):
        assert tuple(after[key]) == old[key]
    codes = {r.occupation_key: r.soc_code for r in tables.read("dim_occupation").collect()}
    assert codes[after["adzuna::adzuna_2"].occupation_key] == "29-1141"
    assert refresh(tables, ["unrelated"]) == {}


def federal(spark, *numbers, title="Nurse"):
    rows = [(str(i), json.dumps({"MatchedObjectDescriptor": {"PositionTitle": title, "OrganizationName": f"a{i}"}})) for i in numbers]
    return spark.createDataFrame(rows, "control_number string, raw_data string").withColumn(
        "ingestion_timestamp", F.lit("2024-06-01").cast("timestamp"))


def test_refresh_of_one_source_leaves_the_files_of_the_other(spark, tmp_path):
    tables = SnapshotStore(spark, str(tmp_path / "wh"))
    tables.write("raw_adzuna", bronze(spark, payload(1), payload(2, "Zzzz"), payload(3)))
    tables.write("raw_usajobs_current", federal(spark, 1, 2))
    refresh(tables, ["raw_adzuna"], calendar=("2024-01-01", "2024-12-31"))
    before = tables.table("jobs_unified").pointer.parts
    for numbers, inserted in ((2, 2), (3, 1)):  # new keys, then some that are there
        tables.write("raw_usajobs_current", federal(spark, *range(numbers)))
        assert refresh(tables, ["raw_usajobs_current"])["jobs_unified"] == {"rows": 3 + numbers, "inserted": inserted}
        after = tables.table("jobs_unified").pointer.parts
        assert after["sector=private"] == before["sector=private"] and len(after["sector=federal"]) == 1
    assert {r.posting_key for r in tables.read("fact_job_postings").collect()} == {
        *(f"adzuna::adzuna_{i}" for i in (1, 2, 3)), *(f"usajobs_current::usajobs_{i}" for i in (0, 1, 2))}


def test_first_refresh_lays_postings_out_and_later_ones_grow_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("meritrix.streaming.refresh.ROWS_PER_BUCKET", 2)
    monkeypatch.setattr("meritrix.sources.store.ROWS_PER_BUCKET", 2)
    tables = SnapshotStore(spark, str(tmp_path / "wh"))
    tables.write("raw_adzuna", bronze(spark, *map(payload, range(4))), buckets=0)
    refresh(tables, ["raw_adzuna"], calendar=("2024-01-01", "2024-12-31"))
    assert tables.table("jobs_unified").pointer.buckets == 2
    tables.write("raw_adzuna", bronze(spark, *map(payload, range(9))), buckets=0)
    refresh(tables, ["raw_adzuna"])
    tables.write("raw_adzuna", bronze(spark, *map(payload, range(1, 10))), buckets=0)
    refresh(tables, ["raw_adzuna"])
    assert tables.table("jobs_unified").pointer.buckets == 4 and tables.read("jobs_unified").count() == 10
    assert tables.read("fact_job_postings").count() == 10


def test_fact_of_jobs_is_the_fact_with_its_back_fill(spark, tmp_path):
    tables = SnapshotStore(spark, str(tmp_path / "wh"))
    tables.write("raw_adzuna", bronze(spark, *(payload(i, t) for i, t in enumerate(["Nurse", "Zzzz", None, "", "Data Analyst", None]))))
    refresh(tables, ["raw_adzuna"], calendar=("2024-01-01", "2024-12-31"))
    jobs, old = tables.read("jobs_unified"), tables.read("fact_job_postings")
    dims = {n: tables.read(f"dim_{n}") for n in ("location", "company", "category")}
    titles = tables.read("dim_occupation_soc"), tables.read("dim_occupation")

    def plain(postings, existing):
        return gold.update_postings_soc(gold.fact_job_postings(postings, dims, existing), postings, *titles)

    def content(df):
        return sorted(map(str, df.select(*FACT_JOB_POSTINGS.fieldNames()).collect()))

    assert content(old) == content(plain(jobs, None)) and old.filter("occupation_key IS NULL").count() == 2
    held = old.withColumns({"occupation_key": F.lit(77).cast("bigint"), "company_key": F.lit(5).cast("bigint")})
    for existing in (old, held, old.limit(0)):
        for postings in (jobs, jobs.filter("job_id <> 'adzuna_0'"), jobs.filter("job_title IS NOT NULL"), jobs.union(jobs), jobs.limit(0)):
            assert content(gold.fact_of_jobs(postings, dims, titles, existing)) == content(plain(postings, existing))


def test_a_batch_touches_its_own_partitions_and_labels(spark, tmp_path):
    tables = SnapshotStore(spark, str(tmp_path / "wh"))
    tables.write("raw_adzuna", bronze(spark, payload(1), payload(2, "Zzzz"), payload(3)))
    refresh(tables, ["raw_adzuna"], calendar=("2024-01-01", "2024-12-31"))
    report = refresh_batch(tables, "raw_adzuna", bronze(spark, payload(2, "Nurse"), payload(4), ts="2024-06-02"))
    assert report["jobs_unified"] == report["fact_job_postings"] == {"inserted": 1, "updated": 1, "unchanged": 2}
    assert report["dim_company"]["inserted"] == 0
    fact = {r.posting_key: r for r in tables.read("fact_job_postings").collect()}
    codes = {r.occupation_key: r.soc_code for r in tables.read("dim_occupation").collect()}
    assert len(fact) == 4 and codes[fact["adzuna::adzuna_2"].occupation_key] == "29-1141"
    again = refresh_batch(tables, "raw_adzuna", bronze(spark, payload(4), ts="2024-06-02"))
    assert again["jobs_unified"]["inserted"] == 0 and sum(again["dim_company"].values()) == again["dim_company"]["unchanged"]
    assert {r.posting_key: tuple(r) for r in tables.read("fact_job_postings").collect()} == {k: tuple(r) for k, r in fact.items()}


def test_refresh_of_employment_and_wages(spark, tmp_path, rows):
    tables = SnapshotStore(spark, str(tmp_path / "wh"))
    tables.write("raw_bls_qcew", rows(
        "area_fips string, own_code int, industry_code string, agglvl_code int, year int, qtr int, disclosure_code string, "
        "qtrly_estabs int, month1_emplvl int, month2_emplvl int, month3_emplvl int, total_qtrly_wages double, avg_wkly_wage double",
        ("06000", 5, "10", 55, 2023, 2, None, 1, 3, 6, None, 10.0, 2.0), ("06000", 5, "10", 50, 2023, 2, "", 2, 30, 60, 90, 20.0, 4.0),
        ("06000", 5, "10", 50, 2023, 2, "N", 9, 99, 99, 99, 99.0, 9.0), (None, 5, "10", 50, 2023, 2, "", 2, 30, 60, 90, 20.0, 4.0),
    ).withColumn("ingestion_timestamp", F.lit("2024-01-01").cast("timestamp")))
    tables.write("raw_bls_oews", rows("record string, survey_year int", (
        '{"AREA":"99","AREA_TYPE":"1","OCC_CODE":"15-2041","A_MEDIAN":"100"}', 2023),
    ).withColumn("ingestion_timestamp", F.lit("2024-01-01").cast("timestamp")))
    tables.write("raw_adzuna", bronze(spark, payload(1)))
    report = refresh(tables, ["raw_bls_qcew", "raw_bls_oews", "raw_adzuna"], calendar=("2023-01-01", "2023-12-31"))
    q = tables.read("fact_qcew").collect()
    assert len(q) == 1 and (q[0].avg_monthly_emplvl, q[0].qtrly_estabs, q[0].date_key) == (60.0, 2, 20230401)
    w = tables.read("fact_oews_wages").first()
    assert w.occupation_key is not None and w.date_key == 20230501
    assert report["fact_oews_wages"]["rows"] == 1
