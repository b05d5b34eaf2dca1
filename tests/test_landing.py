"""Landing of wage files: one read, quarantined lines, counts."""

import json

import pytest

from meritrix.sources import readers
from meritrix.sources.landing import land_wages
from meritrix.sources.store import exists, read_table


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{line}\n" for line in lines))
    return str(path)


def test_ndjson_lines_go_where_they_belong(spark, tmp_path):
    record = json.dumps({"AREA": "99", "OCC_CODE": "15-1252"})
    write(tmp_path / "in" / "a.ndjson", record, "{broken", record, "", record)
    write(tmp_path / "in" / "b.ndjson", "{broken", record)
    target, bad = str(tmp_path / "raw"), str(tmp_path / "bad")
    for _ in range(2):  # a second try lands again, but a bad line once
        assert land_wages(spark, str(tmp_path / "in"), 2023, target, bad) == {"read": 7, "skipped": 3, "landed": 4}
    assert read_table(spark, target).count() == 8
    found = sorted((r.source_file, r.row_no, r.line, r.reason) for r in read_table(spark, bad).collect())
    assert found == [("a.ndjson", 2, "{broken", "not JSON"), ("a.ndjson", 4, "", "not JSON"), ("b.ndjson", 1, "{broken", "not JSON")]


def test_rows_are_numbered_across_the_blocks_of_a_file(spark, tmp_path):
    lines = [json.dumps({"i": i}) if i % 97 else f"bad {i}" for i in range(1, 3_000)]
    path = write(tmp_path / "in" / "a.ndjson", *lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        counts = land_wages(spark, path, 2023, str(tmp_path / "raw"), str(tmp_path / "bad"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert counts == {"read": 2_999, "skipped": 30, "landed": 2_969}
    assert {r.row_no: r.line for r in read_table(spark, str(tmp_path / "bad")).collect()} == {i: f"bad {i}" for i in range(97, 3_000, 97)}


def test_csv_files_with_other_headers(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "occ_code,Area,A_MEDIAN", "15-1252, 99 ,#", "15-2041,06,88000,extra", "15-2042,07,1")
    write(tmp_path / "in" / "b.csv", "AREA,OCC_CODE", "36,11-1011", "37", "38,11-1012")
    target, bad = str(tmp_path / "raw"), str(tmp_path / "bad")
    assert land_wages(spark, str(tmp_path / "in"), 2022, target, bad, kind="csv") == {"read": 6, "skipped": 2, "landed": 4}
    records = [json.loads(r.record) for r in read_table(spark, target).collect()]
    assert sorted(r["OCC_CODE"] for r in records) == ["11-1011", "11-1012", "15-1252", "15-2042"]
    found = sorted((r.source_file, r.row_no, r.line) for r in read_table(spark, bad).collect())
    assert found == [("a.csv", 2, "15-2041,06,88000,extra"), ("b.csv", 2, "37")]


def test_a_drop_without_bad_lines_needs_no_quarantine(spark, tmp_path):
    path = write(tmp_path / "a.ndjson", "{}")
    assert land_wages(spark, path, 2023, str(tmp_path / "raw"), str(tmp_path / "bad"))["skipped"] == 0
    assert not exists(spark, str(tmp_path / "bad"))


@pytest.mark.parametrize("kind", ["ndjson", "csv"])
def test_the_files_are_scanned_once(spark, tmp_path, kind):
    path = write(tmp_path / "in" / f"a.{kind}", *(["{}", "x"] if kind == "ndjson" else ["a,b", "1,2", "3"]))
    plan = readers.oews_records(spark, path, kind)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
