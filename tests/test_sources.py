import json
import os

import pytest
from pyspark.sql import functions as F

from meritrix.plans import silver
from meritrix.schemas import QCEW_CSV
from meritrix.sources import readers
from meritrix.session import scratch, stored
from meritrix.sources.store import (
    SnapshotStore, StoredTable, append_new, delete_partitions, partition_columns, read_table, replace_partitions, upsert_stored,
    write_layout,
)

HEAD = ",".join(QCEW_CSV.fieldNames())
ROW = "01000,5,10,50,0,2024,1,,12,100,110,120,5000.5,, NULL ,900"


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_qcew_csv(spark, tmp_path):
    names = QCEW_CSV.fieldNames()
    write(tmp_path / "a" / "2024.csv", HEAD + ",oty_extra", ROW + ",1", ROW.replace("12,100", "x, 1 ").replace("01000", '"02000"') + ",2")
    out = readers.read_qcew_csv(spark, str(tmp_path / "a"))
    assert [f.dataType for f in out.schema.fields[:16]] == [f.dataType for f in QCEW_CSV.fields]
    a, b = out.orderBy("area_fips").collect()
    assert (a.own_code, a.disclosure_code, a.qtrly_estabs, a.total_qtrly_wages, a.qtrly_contributions) == (5, None, 12, 5000.5, None)
    assert (b.area_fips, b.qtrly_estabs, b.month1_emplvl) == ("02000", None, 1)
    assert a.source_file == "2024.csv" and json.loads(a.raw_record)["area_fips"] == "01000"
    assert set(json.loads(a.raw_record)) <= set(names)


def test_qcew_csv_stops_on_a_bad_key(spark, tmp_path):
    write(tmp_path / "b.csv", HEAD, ROW.replace(",2024,", ",year?,"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        readers.read_qcew_csv(spark, str(tmp_path / "b.csv")).collect()


def test_qcew_csv_stops_on_a_reordered_file(spark, tmp_path):
    write(tmp_path / "c" / "1.csv", HEAD, ROW)
    names = QCEW_CSV.fieldNames()
    write(tmp_path / "c" / "2.csv", ",".join([names[1], names[0], *names[2:]]), ROW)
    with pytest.raises(Exception, match="header"):
        readers.read_qcew_csv(spark, str(tmp_path / "c")).collect()


def test_oews_records(spark, tmp_path):
    good = {"AREA": "99", "AREA_TYPE": "1", "OCC_CODE": "15-1252", "OCC_TITLE": "Dev", "O_GROUP": "Detailed", "A_MEDIAN": "*", "TOT_EMP": "1,234"}
    path = write(tmp_path / "oesm23nat.ndjson", json.dumps(good), "{broken", json.dumps({**good, "OCC_CODE": "00-0000"}),
                 json.dumps({**good, "OCC_CODE": None}))
    rows = readers.read_oews_ndjson(spark, path, 2023)
    assert rows.count() == 3 and rows.first().source_file == "oesm23nat.ndjson"
    bad = readers.oews_bad_rows(spark, path).first()
    assert (bad.rows_read, bad.rows_skipped) == (4, 1)
    r = silver.transform_oews(rows).collect()
    assert len(r) == 1 and (r[0].oews_key, r[0].a_median, r[0].tot_emp, r[0].o_group) == ("2023|99|15-1252", None, None, "detailed")


def test_oews_keeps_one_row_per_key(spark, rows):
    rec = '{"AREA":"99","AREA_TYPE":"1","OCC_CODE":"15-1252","TOT_EMP":"%s"}'
    bronze = rows("record string, survey_year int", (rec % 5, 2023), (rec % 50, 2023), (rec.replace('"99"', "null") % 7, 2023))
    out = silver.transform_oews(bronze.withColumn("ingestion_timestamp", F.lit("2024-01-01").cast("timestamp")))
    assert {r.oews_key: r.tot_emp for r in out.collect()} == {"2023|99|15-1252": 50.0, "2023||15-1252": 7.0}


def test_oews_csv_binds_by_name_in_any_case(spark, tmp_path):
    path = write(tmp_path / "x.csv", "occ_code,Area,A_MEDIAN", "15-1252, 99 ,#", "15-2041,06,88000")
    recs = [json.loads(r.record) for r in readers.read_oews_csv(spark, path, 2022).orderBy("record").collect()]
    assert sorted(recs, key=lambda r: r["OCC_CODE"]) == [
        {"OCC_CODE": "15-1252", "AREA": "99"}, {"OCC_CODE": "15-2041", "AREA": "06", "A_MEDIAN": "88000"}]


def test_payload_landing(spark, tmp_path):
    path = write(tmp_path / "p.json", '{"id": 7, "title": "x"}', '{"title": "no id"}')
    a = readers.read_adzuna(spark, path, "data engineer", "us").orderBy(F.desc_nulls_last("job_id")).collect()
    assert (a[0].job_id, a[0].search_query, a[0].raw_data) == ("7", "data engineer", '{"id": 7, "title": "x"}')
    assert a[1].job_id is None
    kept = silver.transform_adzuna(readers.read_adzuna(spark, path)).collect()
    assert [r.job_id for r in kept] == ["adzuna_7"]


def test_file_selection(spark, tmp_path):
    for name in ("oesm19st.ndjson", "~oesm19st.ndjson", "all_data_M_2024.ndjson", "readme.txt", "MSA_M2019_dl.ndjson"):
        write(tmp_path / name, "{}")
    got = {r.path.rsplit("/", 1)[1] for r in readers.select_files(spark, str(tmp_path)).collect()}
    assert got == {"oesm19st.ndjson", "all_data_M_2024.ndjson", "MSA_M2019_dl.ndjson"}


def test_jolts(spark, tmp_path):
    path = write(tmp_path / "j.json", '{"series_id":"JTS1","year":2024,"period":"M01","value":5.5,"footnotes":"p"}')
    r = readers.read_jolts(spark, path).first()
    assert (r.series_id, r.year, r.period, r.value, r.footnotes) == ("JTS1", 2024, "M01", 5.5, "p")


def test_snapshots(spark, rows, tmp_path):
    tables = SnapshotStore(spark, str(tmp_path / "t"))
    assert tables.read_or_none("dim_x") is None
    tables.write("dim_x", rows("k int", (1,)))
    tables.write("dim_x", tables.read("dim_x").union(rows("k int", (2,))))  # derived from itself
    assert tables.read("dim_x").count() == 2
    (tmp_path / "t" / "dim_x" / "snapshot=000003").mkdir()  # a job that died: no _SUCCESS
    assert tables.read("dim_x").count() == 2
    tables.write("dim_x", rows("k int", (9,)))
    assert [r.k for r in tables.read("dim_x").collect()] == [9]
    tables.prune("dim_x")
    assert sorted(f.name for f in (tmp_path / "t" / "dim_x").iterdir()) == [
        "_pointers", "snapshot=000002", "snapshot=000003", "snapshot=000004"]


def test_partition_replacement_and_layout(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = spark.range(400).select(F.col("id").alias("v"), (F.col("id") % 4 + 2020).cast("int").alias("year"),
                                 F.lit(1).alias("qtr"), F.lit("06000").alias("area_fips"))
    write_layout(df, path, "fact_qcew")
    table = read_table(spark, path)
    assert "PartitionFilters: [isnotnull(year" in table.filter("year = 2021")._jdf.queryExecution().executedPlan().toString()
    replace_partitions(table.filter("year = 2021").withColumn("v", F.lit(-1).cast("bigint")), path, ["year"])
    after = read_table(spark, path)
    assert after.count() == 400 and after.filter("v = -1").select("year").distinct().first().year == 2021
    new = stored(after.filter("v <> -1").limit(5).withColumn("v", F.col("v") + 1000000))
    assert append_new(spark, path, new, ["v"]) == {"inserted": 5, "skipped": 0, "rejected": 0}
    assert append_new(spark, path, new, ["v"]) == {"inserted": 0, "skipped": 5, "rejected": 0}
    assert read_table(spark, path).count() == 405
    files = {f for f in read_table(spark, path).inputFiles() if "year=2021" not in f}
    delete_partitions(spark, path, F.col("v") == -1)
    table = read_table(spark, path)
    assert table.filter("v = -1").count() == 0 and table.count() == 305
    assert partition_columns(spark, path) == ["year"]
    assert files == set(table.inputFiles())  # other partitions keep their files


def test_delete_without_partitions(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(10).write.parquet(path)
    before = read_table(spark, path)
    assert delete_partitions(spark, path, F.col("id") > 3) == {"deleted": 6, "rewritten": 1}
    assert read_table(spark, path).count() == 4 and [f.name for f in tmp_path.iterdir()] == ["plain"]
    assert before.count() == 10  # opened before, and still whole


def test_rows_without_a_key_are_kept_or_refused(spark, rows, tmp_path):
    path, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    schema = "k int, v string, at timestamp"
    rows(schema).write.parquet(path)
    batch = rows("k int, v string", (1, "a"), (None, "b"), (None, "b"), (None, "c")).withColumn("at", F.current_timestamp())
    with pytest.raises(ValueError, match="without a key"):
        append_new(spark, path, batch, ["k"])
    for _ in range(2):  # a retry has other load times
        assert append_new(spark, path, batch, ["k"], rejects=rejects, load_columns=["at"])["rejected"] == 3
    assert sorted((r.v, r.copies) for r in read_table(spark, rejects).collect()) == [("b", 2), ("c", 1)]
    assert read_table(spark, path).count() == 1


def test_upsert_of_a_stored_table_touches_few_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows("k int, v string, p string", *((i, "old", f"p {i % 4}") for i in range(40))).write.partitionBy("p").parquet(path)
    before = {f for f in (tmp_path / "t").rglob("*.parquet") if "p%200" not in str(f) and "p 0" not in str(f) and "new" not in str(f)}
    moved = rows("k int, v string, p string", (0, "new", "p 0"), (100, "new", "p new"))
    assert upsert_stored(spark, path, moved, ["k"]) == {"inserted": 1, "updated": 1, "unchanged": 9}
    assert before <= set((tmp_path / "t").rglob("*.parquet"))
    everything = rows("k int, v string, p string", *((i, "gone", "p 1") for i in range(0, 40, 4)))
    upsert_stored(spark, path, everything, ["k"])  # partition "p 0" is left empty
    table = read_table(spark, path)
    assert table.count() == 41 and table.filter("p = 'p 0'").count() == 0 and table.filter("v = 'gone'").count() == 10


def test_scratch_folders_go(spark, rows):
    with scratch(spark) as keep:
        frame = keep(rows("k int", (1,)))
        path = frame.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
