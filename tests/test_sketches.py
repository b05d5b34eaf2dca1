"""Mergeable summaries and Z order."""

import random

from pyspark.sql import functions as F

from meritrix.operators import sketches as S
from meritrix.operators.clustering import z_value
from meritrix.sources.store import StoredTable, read_table


def sample(spark, n=20_000):
    return spark.range(n).select(
        (F.col("id") % 30).alias("day"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
            (F.col("id") % 5).cast("string")).alias("g"),
        F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double")).alias("v"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64(F.col("id") * 3), F.lit(3000))).alias("who"))


def test_merged_days_answer_like_the_rows(spark):
    rows = sample(spark)
    days = S.summarised(rows, ["day", "g"], ("v",), ("who",))
    assert days.groupBy("day", "g").count().where("count > 1").isEmpty()
    months = S.merged(days, ["g"]).select(
        "g", "n", "n_v", S.quantile_of("kll_v", 0.5).alias("median"), S.distinct_of("hll_who").alias("people"))
    truth = {r.g: r for r in rows.groupBy("g").agg(
        F.count("*").alias("n"), F.count("v").alias("n_v"), F.count_distinct("who").alias("people")).collect()}
    got = {r.g: r for r in months.collect()}
    assert set(got) == set(truth) and None in got
    for g, r in got.items():
        assert (r.n, r.n_v) == (truth[g].n, truth[g].n_v)
        assert abs(r.people - truth[g].people) <= S.distinct_error() * truth[g].people + 1
    for r in S.ranks_of(rows, months, ["g"], "v", "median").collect():
        assert r.low - 0.5 <= S.rank_error() and 0.5 - r.high <= S.rank_error()
    exact = {r.g: r.n_distinct for r in S.exact_distinct(rows, ["g"], "who").collect()}
    assert exact == {g: r.people for g, r in truth.items()}


def test_groups_without_values(spark, rows):
    given = rows("g string, v double, who string", ("a", None, None), ("b", 1.0, "x"), ("b", 3.0, None))
    days = S.summarised(given, ["g"], ("v",), ("who",))
    out = {r.g: tuple(r)[1:] for r in S.merged(days, ["g"]).select(
        "g", "n", S.quantile_of("kll_v", 0.5).alias("m"), S.distinct_of("hll_who").alias("d")).collect()}
    assert out["a"] == (1, None, 0) and out["b"][0] == 2 and out["b"][1] in (1.0, 3.0) and out["b"][2] == 1
    assert S.merged(S.summarised(given.limit(0), ["g"], ("v",), ("who",)), ["g"]).count() == 0


def test_changed_days_replace_their_summaries(spark, tmp_path):
    path, rows = str(tmp_path / "days"), sample(spark, 3_000)
    days = S.summarised(rows, ["day"], ("v",), ("who",))
    table = StoredTable.create(spark, path, days.schema, partition_by=["day"])
    table.append(days)
    kept = set(table.read().inputFiles())
    more = rows.where("day = 3").union(sample(spark, 6_000).where("day = 3 AND who IS NOT NULL"))
    table.upsert(S.summarised(more, ["day"], ("v",), ("who",)), ["day"])
    assert len(kept - set(read_table(spark, path).inputFiles())) == 1
    assert read_table(spark, path).where("day = 3").first().n == more.count()


def test_z_value_interleaves_bits(spark, rows):
    draw = random.Random(1)
    pairs = [(draw.randrange(64), draw.randrange(64), draw.randrange(64)) for _ in range(200)]
    out = rows("a int, b int, c int", *pairs).select("a", "b", "c", z_value([F.col("a"), F.col("b"), F.col("c")], 6).alias("z")).collect()
    for a, b, c, z in out:
        assert z == int("".join(x + y + w for x, y, w in zip(f"{a:06b}", f"{b:06b}", f"{c:06b}")), 2)


def scanned(frame):
    """Rows that the scan handed on after skipping row groups and pages."""
    frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_a_filter_on_the_second_column_reads_little(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40_000).select(
        F.concat(F.lit("occ-"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(900)).cast("string"), 3, "0")).alias("code"),
        F.when(F.col("id") % 97 > 0, F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64(F.col("id") + 1), F.lit(1000)).cast("int"))).alias("day"),
        F.col("id").alias("v"))
    table = StoredTable.create(spark, path, rows.schema, sort_by=["code"])
    table.append(rows.repartitionByRange(32, "code"))
    before = read_table(spark, path)
    table.cluster(["code", "day"], 64)
    after = read_table(spark, path)
    assert sorted(r.v for r in after.select("v").collect()) == list(range(40_000)) and len(after.inputFiles()) >= 48
    by_day, by_code = "day = date'2021-05-05'", "code = 'occ-123'"
    assert scanned(after.where(by_day)) < 0.35 * scanned(before.where(by_day))
    assert scanned(after.where(by_code)) < 0.35 * 40_000
    assert after.where(by_day).count() == before.where(by_day).count() > 0
