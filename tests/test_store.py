"""Stored tables: kinds of partitions, versions, crashes, key buckets."""

import datetime
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meritrix.operators.merge import upsert_if_newer
from meritrix.sources import store
from meritrix.sources.store import NULL_PARTITION, SnapshotStore, StoredTable, append_new, exists, read_table, upsert_stored
from meritrix.streaming.ingest import load_year

DAY = datetime.date(2024, 2, 29)
VALUES = {
    "string": ["06", "36", "6", "", None, "~", "~~", NULL_PARTITION, "a/b %20=c", "é x", "2024-02-29", "true"],
    "int": [6, -1, 0, None], "bigint": [2**40, None], "boolean": [True, False, None], "date": [DAY, None],
}


def content(table):
    return sorted((tuple(r) for r in table.collect()), key=str)


@pytest.mark.parametrize("kind", list(VALUES))
def test_every_kind_of_partition_value(spark, rows, tmp_path, kind):
    path, values = str(tmp_path / "t"), VALUES[kind]
    given = [(i * 10 + j, f"v{j}", p) for i, p in enumerate(values) for j in range(3)]
    frame = rows(f"k int, v string, p {kind}", *given)
    table = StoredTable.create(spark, path, frame.schema, partition_by=["p"], sort_by=["k"])
    assert read_table(spark, path).schema == frame.schema and read_table(spark, path).count() == 0
    table.append(frame)
    assert content(read_table(spark, path)) == sorted(given, key=str)
    assert sorted((r.p for r in StoredTable(spark, path).partitions().collect()), key=str) == sorted(values, key=str)

    new = [(10, "new", values[0])]  # a key of the second value moves to the first
    assert upsert_stored(spark, path, rows(f"k int, v string, p {kind}", *new), ["k"]) == {"inserted": 0, "updated": 1, "unchanged": 2}
    given = [r for r in given if r[0] != 10] + new
    assert content(read_table(spark, path)) == sorted(given, key=str)

    for at, value in enumerate(values):
        gone = F.col("p").eqNullSafe(F.lit(value).cast(kind))
        n = sum(1 for r in given if r[2] == value and type(r[2]) is type(value))
        assert store.delete_partitions(spark, path, gone & (F.col("v") != "v1")) == {"deleted": n - ("v1" in [r[1] for r in given if r[2] == value]), "rewritten": 1}
        store.delete_partitions(spark, path, gone)
        given = [r for r in given if not (r[2] == value and type(r[2]) is type(value))]
        assert content(read_table(spark, path)) == sorted(given, key=str)
    assert read_table(spark, path).schema == frame.schema and read_table(spark, path).count() == 0
    table = StoredTable(spark, path)
    table.append(frame)
    assert read_table(spark, path).count() == 3 * len(values)


def test_a_filter_on_a_partition_column_prunes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    frame = rows("k int, p string", *((i, f"{i % 5:02}") for i in range(50)))
    StoredTable.create(spark, path, frame.schema, partition_by=["p"]).append(frame)
    found = read_table(spark, path).filter("p = '03'")
    assert len(found.collect()) == 10
    assert read_files(found) * 4 < len(found.inputFiles()) + 4  # one partition of five


def read_files(frame):
    """Files that the frame's own scan has read."""
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numFiles").get().value()


def test_adopted_folders_keep_leading_zeros(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows("k string, p string, q int", ("k1", "06", 1), ("k2", "06", 2), ("k3", "36", 1), ("k4", "36", 2)).write.partitionBy("p", "q").parquet(path)
    assert [f.dataType for f in read_table(spark, path).schema.fields] == [T.StringType(), T.StringType(), T.IntegerType()]
    assert store.delete_partitions(spark, path, F.col("k") == "k2") == {"deleted": 1, "rewritten": 1}
    assert content(read_table(spark, path)) == [("k1", "06", 1), ("k3", "36", 1), ("k4", "36", 2)]
    assert upsert_stored(spark, path, rows("k string, p string, q int", ("k1", "6", 1)), ["k"])["updated"] == 1
    assert content(read_table(spark, path)) == [("k1", "6", 1), ("k3", "36", 1), ("k4", "36", 2)]
    assert store.delete_partitions(spark, path, F.col("p") == "6")["deleted"] == 1
    assert append_new(spark, path, rows("k string, p string, q int", ("k3", "x", 9), ("k5", "", 9)), ["k"])["inserted"] == 1
    assert content(read_table(spark, path)) == [("k3", "36", 1), ("k4", "36", 2), ("k5", "", 9)]


def test_an_opened_reader_keeps_its_version(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    frame = rows("k int, v string, p string", *((i, "old", f"{i % 3}") for i in range(30)))
    StoredTable.create(spark, path, frame.schema, partition_by=["p"]).append(frame)
    opened = [read_table(spark, path)]
    upsert_stored(spark, path, rows("k int, v string, p string", (0, "new", "2"), (99, "new", "9")), ["k"])
    opened.append(read_table(spark, path))
    store.delete_partitions(spark, path, F.col("p") == "1")
    opened.append(read_table(spark, path))
    assert [f.count() for f in opened] == [30, 31, 21]
    assert [f.filter("v = 'new'").count() for f in opened] == [0, 2, 2]
    StoredTable(spark, path).prune(keep=2)
    assert [f.count() for f in opened[1:]] == [31, 21]
    StoredTable(spark, path).prune(keep=1)
    assert read_table(spark, path).count() == 21
    left = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(left) == len(opened[2].inputFiles())


def test_a_job_that_dies_changes_nothing(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    frame = rows("k int, v string, p string", *((i, "old", f"{i % 3}") for i in range(30)))
    StoredTable.create(spark, path, frame.schema, partition_by=["p"]).append(frame)
    batch = rows("k int, v string, p string", (0, "new", "2"), (99, "new", "9"))
    steps = [lambda: upsert_stored(spark, path, batch, ["k"]), lambda: append_new(spark, path, batch, ["k"]),
             lambda: store.delete_partitions(spark, path, F.col("k") > 5), lambda: StoredTable(spark, path).compact(["p=0"])]

    def die(*_):
        raise KeyboardInterrupt

    for step in steps:
        for place in ("_commit", "_write"):
            with monkeypatch.context() as m:
                m.setattr(StoredTable, place, die)
                with pytest.raises(KeyboardInterrupt):
                    step()
            assert content(read_table(spark, path)) == content(frame)
    assert upsert_stored(spark, path, batch, ["k"]) == {"inserted": 1, "updated": 1, "unchanged": 9}
    assert read_table(spark, path).count() == 31


def test_a_second_writer_is_refused(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    frame = rows("k int", (1,))
    StoredTable.create(spark, path, frame.schema)
    one, other = StoredTable(spark, path), StoredTable(spark, path)
    one.append(frame)
    with pytest.raises(RuntimeError, match="another writer"):
        other.append(frame)
    assert read_table(spark, path).count() == 1


def test_types_do_not_drift(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    table = StoredTable.create(spark, path, rows("k bigint, v double, s string").schema)
    table.append(rows("v float, k int", (1.5, 1)))  # wider types hold them; a missing column is NULL
    for schema in ("k string, v double", "k bigint, v double, more int", "k double"):
        with pytest.raises(ValueError):
            table.append(rows(schema))
    assert content(read_table(spark, path)) == [(1, 1.5, None)]
    assert table.add_columns(rows("k bigint, day date, s string").schema) == ["day"]
    with pytest.raises(ValueError):
        table.add_columns(rows("s int").schema)
    table.append(rows("k int, day date", (2, DAY)))
    assert content(read_table(spark, path)) == [(1, 1.5, None, None), (2, None, None, DAY)]
    with pytest.raises(ValueError):
        StoredTable.create(spark, str(tmp_path / "u"), rows("snapshot int").schema)


def test_an_empty_first_year_makes_a_readable_table(spark, tmp_path):
    path, year = str(tmp_path / "t"), spark.range(4).select("id", (F.col("id") % 2 + 2020).cast("int").alias("year"))
    assert load_year(year, path, 1999) == {"written": 0, "replaced": 0}
    assert read_table(spark, path).count() == 0 and read_table(spark, path).columns == ["id", "year"]
    assert load_year(year, path, 2020) == {"written": 2, "replaced": 0}
    assert load_year(year.limit(0), path, 2020) == {"written": 0, "replaced": 2}
    assert read_table(spark, path).count() == 0
    assert load_year(year, path, 2021) == {"written": 2, "replaced": 0}


def test_a_dead_first_write_is_no_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows("k int", (1,)).write.parquet(f"{path}/snapshot=000001")
    assert not exists(spark, path)
    with pytest.raises(LookupError):
        read_table(spark, path)
    tables = SnapshotStore(spark, str(tmp_path))
    assert not tables.exists("t")
    assert content(tables.write("t", rows("k int", (2,)))) == [(2,)]


def test_many_small_appends_are_compacted(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MOST_FOLDERS", 3)
    path = str(tmp_path / "t")
    table = StoredTable.create(spark, path, rows("k int, p string").schema, partition_by=["p"])
    for i in range(5):
        table.append(rows("k int, p string", (i, "a"), *([(i + 100, "b")] if i == 2 else [])))
    assert content(read_table(spark, path)) == [(0, "a"), (1, "a"), (102, "b"), (2, "a"), (3, "a"), (4, "a")]
    assert len(table.pointer.parts["p=a"]) == 2 and len(table.pointer.parts["p=b"]) == 1


def test_merge_functions_reach_stored_tables(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, v string, ingestion_timestamp timestamp"
    at = datetime.datetime(2024, 1, 1)
    table = StoredTable.create(spark, path, rows(schema).schema, bucket_by=["k"], buckets=4)
    table.append(rows(schema, (1, "a", at), (2, "b", at)))
    newer = at + datetime.timedelta(days=1)
    batch = rows(schema, (1, "x", at), (2, "y", newer), (3, "z", at))
    table.upsert(batch, ["k"], merge=lambda t, s, keys, unique: upsert_if_newer(t, s, keys, update_cols=["v"], unique=unique))
    assert content(read_table(spark, path).drop("ingestion_timestamp")) == [(1, "a"), (2, "y"), (3, "z")]


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """100,000 keys in 2,048 buckets."""
    path = str(tmp_path_factory.mktemp("large") / "t")
    frame = spark.range(100_000).select(F.concat(F.lit("key-"), "id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    StoredTable.create(spark, path, frame.schema, bucket_by=["k"], buckets=2048).append(frame)
    return path


def size_of(frame):
    return sum(os.path.getsize(f.removeprefix("file://")) for f in frame.inputFiles())


def test_a_small_batch_reads_its_buckets_only(spark, rows, large):
    batch = rows("k string, v string", *((f"key-{i * 1_997}", "new") for i in range(50)), *((f"other-{i}", "new") for i in range(50)))
    table = StoredTable(spark, large)
    found, parts = table.candidates(batch, ["k"])
    assert len(parts) <= 100 and size_of(found) < 0.06 * size_of(table.read())
    assert "PushedFilters: [Or(" in found.select("k")._jdf.queryExecution().executedPlan().toString()
    assert found.join(batch, "k", "left_semi").count() == 50
    before = set(table.read().inputFiles())
    assert append_new(spark, large, batch, ["k"]) == {"inserted": 50, "skipped": 50, "rejected": 0}
    assert before < set(read_table(spark, large).inputFiles())
    assert append_new(spark, large, batch, ["k"])["inserted"] == 0


def test_a_small_merge_rewrites_few_files(spark, rows, large):
    batch = rows("k string, v string", *((f"key-{i * 971}", "merged") for i in range(100)))
    before = set(read_table(spark, large).inputFiles())
    counts = upsert_stored(spark, large, batch, ["k"])
    after = set(read_table(spark, large).inputFiles())
    assert counts["updated"] == 100 and len(before - after) < 0.06 * len(before)
    assert read_table(spark, large).filter("v = 'merged'").count() == 100


def test_buckets_follow_the_tables_types(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    table = StoredTable.create(spark, path, rows("k bigint, v int").schema, bucket_by=["k"], buckets=64)
    table.append(rows("k bigint, v int", *((i, 0) for i in range(200))))
    assert append_new(spark, path, rows("k int, v int", *((i, 1) for i in range(190, 210))), ["k"]) == {
        "inserted": 10, "skipped": 10, "rejected": 0}
    assert upsert_stored(spark, path, rows("k int, v int", (5, 7), (500, 7)), ["k"])["updated"] == 1
    assert read_table(spark, path).filter("k = 5").collect() == [(5, 7)]


def test_named_tables_grow_into_buckets(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "ROWS_PER_BUCKET", 10)
    tables = SnapshotStore(spark, str(tmp_path))
    frame = spark.range(50).select(F.col("id").cast("string").alias("job_id"), F.lit("x").alias("raw_data"))
    tables.write("raw_adzuna", frame)
    assert tables.table("raw_adzuna").pointer.buckets == 0
    tables.write("raw_adzuna", frame)
    assert tables.table("raw_adzuna").pointer.buckets == 5 and tables.read("raw_adzuna").count() == 50
    assert tables.merge("raw_adzuna", frame.limit(3).withColumn("raw_data", F.lit("y")), ["job_id"])["updated"] == 3
    assert tables.read("raw_adzuna").filter("raw_data = 'y'").count() == 3


def test_rejects_differ_by_their_dates(spark, rows, tmp_path):
    path, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    schema = "k int, day date, ingestion_timestamp timestamp"
    StoredTable.create(spark, path, rows(schema).schema)
    at = datetime.datetime(2024, 1, 1)
    batch = rows(schema, (None, DAY, at), (None, None, at), (None, DAY, at), (1, DAY, at))
    assert append_new(spark, path, batch, ["k"], rejects=rejects) == {"inserted": 1, "skipped": 0, "rejected": 3}
    more = rows(schema, (None, DAY, at + datetime.timedelta(days=1)))
    append_new(spark, path, more, ["k"], rejects=rejects)
    assert {r.day: r.copies for r in read_table(spark, rejects).collect()} == {DAY: 2, None: 1}


def test_only_repeated_keys_are_ranked(spark, tmp_path, monkeypatch):
    """A batch without repeated keys is not sorted as whole rows; of one with some, only these rows are."""
    table = StoredTable.create(spark, str(tmp_path / "t"), T.StructType.fromDDL("k bigint, v string, p string"), partition_by=["p"])
    ranked = []
    whole = store.one_per_key
    monkeypatch.setattr(store, "one_per_key", lambda rows, *given: ranked.append(rows.count()) or whole(rows, *given))
    first = spark.sql("SELECT id AS k, 'a' AS v, IF(id < 50, 'x', 'y') AS p FROM range(100)")
    assert table.append_new(first, ["k"]) == {"inserted": 100, "skipped": 0, "rejected": 0}
    more = spark.sql("SELECT id AS k, 'b' AS v, 'x' AS p FROM range(90, 110)")
    assert table.append_new(more, ["k"], lasting=True) == {"inserted": 10, "skipped": 10, "rejected": 0}
    assert table.upsert(more.where("k < 100"), ["k"], lasting=True) == {"inserted": 0, "updated": 10, "unchanged": 40}
    assert ranked == []
    twice = more.unionByName(spark.sql("SELECT 109 AS k, 'c' AS v, 'x' AS p UNION ALL SELECT NULL, 'd', 'x' UNION ALL SELECT 110, 'e', 'x' UNION ALL SELECT 110, 'f', 'x'"))
    assert table.upsert(twice, ["k"], [F.desc("v")]) == {"inserted": 1, "updated": 20, "unchanged": 50}
    late = spark.sql("SELECT 200 AS k, 'g' AS v, 'y' AS p UNION ALL SELECT 200, 'h', 'y' UNION ALL SELECT 109, 'i', 'y' UNION ALL SELECT 109, 'i', 'y'")
    assert table.append_new(late, ["k"], [F.asc("v")]) == {"inserted": 1, "skipped": 1, "rejected": 0}
    assert ranked == [4, 2]
    found = {r.k: r.v for r in table.read().where("k >= 90").collect()}
    assert found == {**{k: "b" for k in range(90, 109)}, 109: "c", 110: "f", 200: "g"}
    assert table.read().count() == 112
