"""Views kept up by signed changes, and the batch path of employment and wages."""

import pytest
from pyspark.sql import functions as F

from meritrix.schemas import FACT_QCEW, JOBS_UNIFIED
from meritrix.sources.store import SnapshotStore, StoredTable
from meritrix.streaming import delta
from meritrix.streaming.refresh import refresh, refresh_batch


def jobs(spark, *given):
    base = {"sector": "private", "source": "adzuna", "job_title": "x", "salary_min": 20000.0, "salary_max": 30000.0,
            "experience_level": "mid", "is_entry_level": False, "location_state": "Ohio"}
    rows = [tuple({**base, "job_id": k, **more}.get(f) for f in JOBS_UNIFIED.fieldNames()) for k, more in given]
    return spark.createDataFrame(rows, JOBS_UNIFIED)


GEO = next(v for v in delta.VIEWS if v.name == "agg_geo")


def states(tables):
    return {r.location_state: (r.job_count, r.entry_level_count, r.avg_salary) for r in delta.geo_distribution(tables).collect()}


def test_changes_are_added_and_taken_away(spark, tmp_path):
    tables = SnapshotStore(spark, str(tmp_path))
    tables.write("jobs_unified", jobs(spark, ("a", {}), ("b", {"salary_min": 40000.0, "salary_max": None}), ("c", {"location_state": "Utah"})))
    assert delta.maintain(tables, GEO) == {"changed": 2, "rebuilt": 1}
    assert states(tables) == {"Ohio": (2, 0, 30000.0), "Utah": (1, 0, 20000.0)}
    assert delta.maintain(tables, GEO) == {"changed": 0, "rebuilt": 0}

    tables.merge("jobs_unified", jobs(spark, ("a", {"salary_min": None, "salary_max": None, "is_entry_level": True}), ("d", {}),
                                      ("c", {"salary_min": 5.0})), ["source", "job_id"])  # c is not clean any more
    assert delta.maintain(tables, GEO)["rebuilt"] == 0
    assert states(tables) == {"Ohio": (3, 1, 30000.0)}
    before = {n for n in tables.table("agg_geo")._pointers()}
    assert delta.maintain(tables, GEO) == {"changed": 0, "rebuilt": 0} and before == set(tables.table("agg_geo")._pointers())

    tables.table("jobs_unified").delete(F.col("job_id") == "b")
    tables.merge("jobs_unified", jobs(spark, ("a", {"salary_min": None, "salary_max": None})), ["source", "job_id"])
    delta.maintain(tables, GEO)  # two versions of the source at once
    assert states(tables) == {"Ohio": (2, 0, 20000.0)}


def test_a_run_that_dies_is_made_up_for(spark, tmp_path, monkeypatch):
    tables = SnapshotStore(spark, str(tmp_path))
    tables.write("jobs_unified", jobs(spark, ("a", {})))
    delta.maintain(tables, GEO)
    tables.merge("jobs_unified", jobs(spark, ("b", {})), ["source", "job_id"])
    with monkeypatch.context() as m:
        m.setattr(StoredTable, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            delta.maintain(tables, GEO)
    assert states(tables) == {"Ohio": (1, 0, 20000.0)}
    delta.maintain(tables, GEO)
    assert states(tables) == {"Ohio": (2, 0, 20000.0)}


def test_a_pruned_version_makes_a_new_build(spark, tmp_path):
    tables = SnapshotStore(spark, str(tmp_path))
    tables.write("jobs_unified", jobs(spark, ("a", {})))
    delta.maintain(tables, GEO)
    for i in range(3):
        tables.merge("jobs_unified", jobs(spark, (f"n{i}", {})), ["source", "job_id"])
    tables.prune("jobs_unified", keep=1)
    assert delta.maintain(tables, GEO)["rebuilt"] == 1
    assert states(tables) == {"Ohio": (4, 0, 20000.0)}


def test_an_emptied_source_empties_the_view(spark, tmp_path):
    tables = SnapshotStore(spark, str(tmp_path))
    tables.write("jobs_unified", jobs(spark, ("a", {}), ("b", {"location_state": None})))
    delta.maintain(tables, GEO)
    tables.table("jobs_unified").delete(F.lit(True))
    delta.maintain(tables, GEO)
    assert states(tables) == {}


def test_only_folders_that_differ_are_read(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    frame = rows("k int, p int, v int", *((i, i % 10, 0) for i in range(100)))
    table = StoredTable.create(spark, path, frame.schema, partition_by=["p"])
    table.append(frame)
    then = table.pointer.number
    table.upsert(rows("k int, p int, v int", (3, 3, 7), (200, 5, 7)), ["k"])
    changed = StoredTable(spark, path).changes_since(then)
    assert {f.split("/p=")[1].split("/")[0] for f in changed.inputFiles()} == {"3", "5"}
    net = changed.groupBy("k", "p", "v").agg(F.sum("sign").alias("n")).where("n != 0").collect()
    assert sorted(map(tuple, net)) == [(3, 3, 0, -1), (3, 3, 7, 1), (200, 5, 7, 1)]


def test_sums_are_exact_over_many_changes(spark, tmp_path):
    """0.1 added and taken away a hundred times leaves nothing behind."""
    employment = next(v for v in delta.VIEWS if v.name == "agg_employment")
    tables = SnapshotStore(spark, str(tmp_path))

    def fact(*values):
        names = FACT_QCEW.fieldNames()
        base = {"area_fips": "06000", "area_type": "state", "industry_code": "10", "own_label": "Private", "year": 2020, "qtr": 1}
        return spark.createDataFrame([tuple({**base, "qcew_key": str(i), "total_qtrly_wages": v, "avg_monthly_emplvl": 100 / 3}.get(c)
                                            for c in names) for i, v in enumerate(values)], FACT_QCEW)

    tables.write("fact_qcew", fact(*[0.1] * 50))
    delta.maintain(tables, employment)
    tables.merge("fact_qcew", fact(*[0.2] * 49, 0.3), ["qcew_key"])
    delta.maintain(tables, employment)
    r = delta.qcew_employment_trend(tables).first()
    assert (r.state_qtrly_wages, r.state_employment, r.state_avg_wkly_wage) == (10.1, 5000 / 3, None)


def test_a_batch_of_statistics_keeps_other_partitions(spark, rows, tmp_path):
    tables = SnapshotStore(spark, str(tmp_path))
    schema = ("area_fips string, own_code int, industry_code string, agglvl_code int, year int, qtr int, disclosure_code string, "
              "qtrly_estabs int, month1_emplvl int, month2_emplvl int, month3_emplvl int, total_qtrly_wages double, avg_wkly_wage double")
    raw = lambda *given: rows(schema, *((f"{a:05}", 5, "10", 50, y, 1, None, n, n, n, n, 1.0 * n, 1.0) for a, y, n in given)).withColumn(
        "ingestion_timestamp", F.lit("2024-01-01").cast("timestamp"))
    tables.write("raw_bls_qcew", raw((1000, 2020, 5), (2000, 2021, 5), (3000, 2021, 5)))
    refresh(tables, ["raw_bls_qcew"], calendar=("2020-01-01", "2021-12-31"))
    kept = {f for f in tables.read("fact_qcew").inputFiles() if "year=2020" in f}
    report = refresh_batch(tables, "raw_bls_qcew", raw((2000, 2021, 9), (3000, 2021, 2), (4000, 2021, 1)))
    assert report["fact_qcew"] == {"inserted": 1, "updated": 2, "unchanged": 0}
    got = {r.area_fips: r.total_qtrly_wages for r in tables.read("fact_qcew").collect()}
    assert got == {"01000": 5.0, "02000": 9.0, "03000": 5.0, "04000": 1.0}  # the largest of a key's loads
    assert kept <= set(tables.read("fact_qcew").inputFiles()) and kept
    whole = SnapshotStore(spark, str(tmp_path / "whole"))
    whole.write("raw_bls_qcew", tables.read("raw_bls_qcew"))
    refresh(whole, ["raw_bls_qcew"], calendar=("2020-01-01", "2021-12-31"))
    order = ["qcew_key"]
    assert whole.read("fact_qcew").orderBy(*order).collect() == tables.read("fact_qcew").orderBy(*order).collect()
