from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meritrix.operators import merge as M
from meritrix.operators.keys import assign_keys, number_rows
from meritrix.schemas import JOBS_UNIFIED, _struct


def got(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def test_insert_new_never_refreshes(rows):
    target = rows("k int, v string", (1, "old"))
    src = rows("k int, v string", (1, "new"), (2, "b"), (2, "a"), (None, "x"))
    out = M.insert_new(target, src, ["k"], [F.asc("v")])
    assert got(out) == [(1, "old"), (2, "a")]
    assert got(M.insert_new(out, src, ["k"], [F.asc("v")])) == got(out)
    assert got(M.null_key_rows(src, ["k"])) == [(None, "x")]


def test_upsert_replaces_and_keeps_uncarried_columns(rows):
    target = rows("k int, v string, extra int", (1, "old", 7), (3, "c", 9))
    src = rows("k int, v string", (1, "new"), (2, "b"))
    out = M.upsert(target, src, ["k"])
    assert sorted(out.collect(), key=lambda r: r.k) == [(1, "new", 7), (2, "b", None), (3, "c", 9)]
    assert got(M.upsert(out, src, ["k"]), "k", "v") == got(out, "k", "v")


def test_upsert_if_newer(rows):
    t1, t2, t0 = datetime(2024, 1, 2), datetime(2024, 1, 3), datetime(2024, 1, 1)
    schema = "k int, label string, m double, ts timestamp"
    target = rows(schema, (1, "a", 1.0, t1), (2, "b", 2.0, t1), (3, "c", 3.0, t1))
    src = rows(schema, (1, "A", 10.0, t1), (2, "B", 20.0, t2), (3, "C", 30.0, t0), (4, "D", 40.0, t0))
    out = M.upsert_if_newer(target, src, ["k"], "ts", ["m"])
    assert got(out) == [(1, "a", 1.0, t1), (2, "b", 20.0, t2), (3, "c", 3.0, t1), (4, "D", 40.0, t0)]
    assert got(M.upsert_if_newer(out, src, ["k"], "ts", ["m"])) == got(out)


def test_update_from_keeps_unmatched(rows):
    fact = rows("k string, occ bigint", ("a", 1), ("b", 2), ("c", None))
    out = M.update_from(fact, rows("k string, occ bigint", ("a", 9), ("c", 3)), ["k"], "occ")
    assert got(out) == [("a", 9), ("b", 2), ("c", 3)]


def test_merge_counts(rows):
    target, src = rows("k int", (1,), (2,)), rows("k int", (2,), (3,), (3,), (4,))
    r = M.merge_counts(target, src, ["k"]).first()
    assert (r.inserted, r.updated, r.unchanged) == (2, 1, 1)


def test_retention_and_truncate(rows):
    df = rows("k int, ingestion_timestamp timestamp", (1, datetime(2026, 4, 22)), (2, datetime(2026, 4, 23)), (3, None))
    assert got(M.delete_before(df, "2026-04-23 00:00:00"), "k") == [(2,), (3,)]
    out = M.truncate({"fact": df, "dim_date": df})
    assert out["fact"].count() == 0 and out["dim_date"].count() == 3 and out["fact"].schema == df.schema


def test_ensure_columns(rows):
    out = M.ensure_columns(rows("job_id string, other int", ("a", 1)), JOBS_UNIFIED)
    assert "other" in out.columns and out.schema["posted_date"].dataType == JOBS_UNIFIED["posted_date"].dataType
    assert M.ensure_columns(out, JOBS_UNIFIED).columns == out.columns


def test_keys_are_dense_and_stable(spark, rows):
    names = spark.range(5000).select(F.concat(F.lit("company "), F.col("id").cast("string")).alias("name"))
    first = number_rows(names.filter("name < 'company 3'"), ["name"], "key")
    n = first.count()
    assert {r.key for r in first.select("key").collect()} == set(range(1, n + 1))
    full = assign_keys(names, ["name"], "key", first)
    assert {r.key for r in full.collect()} == set(range(1, 5001))
    assert full.join(first.withColumnRenamed("key", "k1"), "name").filter("key <> k1").count() == 0
    again = assign_keys(names.repartition(13), ["name"], "key", full)
    assert again.exceptAll(full.select(*again.columns)).count() == 0


def test_schema_text():
    assert _struct("a int, b string").simpleString() == "struct<a:int,b:string>"
