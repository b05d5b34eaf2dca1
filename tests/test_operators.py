from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from meritrix.functions import aggregates as A
from meritrix.operators import filters as FL
from meritrix.operators import joins as J
from meritrix.operators import windows as W
from meritrix.operators.quantiles import group_quantiles
from meritrix.plans import quality, silver


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [True, False])
def test_quantiles_match_numpy(spark, few):
    rng = np.random.default_rng(3)
    data = [("hot", float(x)) for x in rng.integers(10000, 10200, 3000)]       # one crowded bucket
    data += [("wide", float(x)) for x in rng.uniform(-5000, 900000, 501)]      # outside the histogram
    data += [("one", 42.0), ("none", None), (None, 7.0), (None, 9.0)]
    df = spark.createDataFrame(data, "g string, x double")
    ps = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    out = group_quantiles(df, ["g"], {a: ("x", p) for a, p in ps.items()}, 10000, 500000, buckets=64, few_groups=few)
    got = {r.g: r for r in out.collect()}
    assert set(got) == {"hot", "wide", "one", None}
    for g in got:
        xs = np.array([x for k, x in data if k == g and x is not None])
        for a, p in ps.items():
            assert got[g][a] == pytest.approx(np.quantile(xs, p), rel=1e-12), (g, a)


def test_weighted_quantiles_of_two_measures(rows):
    df = rows("g int, a double, b double, n bigint", (1, 1.0, 10.0, 3), (1, 5.0, None, 1), (1, 9.0, 30.0, 1))
    r = group_quantiles(df, ["g"], {"a": ("a", 0.5), "b": ("b", 0.5)}, 0, 100, weight="n").first()
    assert (r.a, r.b) == (1.0, 10.0)


def skewed(spark):
    """A third of the rows on one key, a sixth without a key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 6 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    return spark.range(20000).select("id", key.alias("k"))


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_quantiles_of_values_in_one_bucket(spark, rounds):
    """All values lie within a billionth of the range; later rounds cut their bucket."""
    df = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise(F.when(F.col("id") % 3 == 1, "b")).alias("g"),
        (1.0 + F.col("id") * F.col("id") / 1e12).alias("x"), (F.col("id") % 4).alias("w"))
    ps = {"low": 0.0, "q1": 0.25, "mid": 0.5, "p99": 0.99, "top": 1.0}
    out = group_quantiles(df, ["g"], {k: ("x", p) for k, p in ps.items()}, 0, 1e6, buckets=16, weight="w", rounds=rounds)
    got = {r.g: r for r in out.collect()}
    values = {}
    for r in df.collect():
        values.setdefault(r.g, []).extend([r.x] * r.w)
    assert set(got) == set(values)
    for g, xs in values.items():
        xs.sort()
        for k, p in ps.items():
            at = p * (len(xs) - 1)
            low = int(at)
            want = xs[low] + (xs[min(low + 1, len(xs) - 1)] - xs[low]) * (at - low)
            assert abs(got[g][k] - want) < 1e-15


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.range(450).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (F.col("id") * 2).alias("v"))
    right = right.union(spark.createDataFrame([("hot", -1)], "k string, v bigint"))
    hot = J.hot_keys(left, ["k"], 0.05)
    assert [r.k for r in hot.collect()] == ["hot"]
    got = J.salted_join(left, right, ["k"], ["id"], hot, how, salts=8)
    want = left.join(right, "k", how)
    assert got.count() == want.count()
    assert got.select("id", "k", "v").exceptAll(want.select("id", "k", "v")).count() == 0
    assert want.select("id", "k", "v").exceptAll(got.select("id", "k", "v")).count() == 0


def test_salt_spreads_the_hot_key_and_the_missing_key(spark):
    left = skewed(spark)
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = J.salted_join(left, right, ["k"], ["id"], J.hot_keys(left, ["k"]), salts=64)
        sizes = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sizes < 20000 / 3  # the hot key alone would be larger


def test_salts_follow_the_counted_rows(spark):
    left = skewed(spark)
    hot = J.hot_key_salts(left, ["k"], 0.05, task_rows=80)
    assert [(r.k, r._salts) for r in hot.collect()] == [("hot", 84)]
    right = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    got = J.salted_join(left, right, ["k"], ["id"], hot)
    assert got.count() == 20000 and got.exceptAll(left.join(right, "k", "left").select(*got.columns)).count() == 0


def test_lookup_join_beyond_the_bound(spark):
    left = skewed(spark)
    right = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = J.lookup_join(left, right, ["k"], ["id"], most=10)
        assert "_salt" in plan(big)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    small = J.lookup_join(left, right, ["k"], ["id"])
    assert "_salt" not in plan(small)
    assert big.exceptAll(small.select(*big.columns)).count() == 0


def test_best_row_is_limited_before_the_shuffle(spark):
    df = skewed(spark)
    best = W.top_k_per_group(df, ["k"], [F.desc("id")], 2)
    assert plan(best).count("WindowGroupLimit") == 2
    many = W.top_k_per_group(df, ["k"], [F.desc("id")], 5000)
    assert many.filter("k = 'hot'").count() == 5000 and many.filter("k = 'k1'").count() < 200
    assert "_part" in plan(many)
    assert {r.id for r in best.filter("k = 'hot'").collect()} == {19998, 19995}
    assert "TakeOrderedAndProject" in plan(W.top_k(df, [F.desc("id")], 3))


def test_share_of_sums_to_hundred(rows):
    df = rows("s string, c string, job_count bigint", ("a", "x", 1), ("a", "y", 2), (None, "x", 5), (None, None, 5))
    out = A.share_of(df, ["s"]).collect()
    assert len(out) == 4
    assert sorted(r.pct_of_source for r in out) == [33.33, 50.0, 50.0, 66.67]


def test_near_duplicate_lists_stay_whole(spark):
    p = spark.range(1000).select(
        F.lit("Clerk ").alias("job_title"), F.lit("Acme").alias("company_or_agency"), F.lit(None).cast("string").alias("location_state"),
        F.lit("2024-01-01").cast("date").alias("posted_date"), F.lit("adzuna").alias("source"), F.col("id").cast("string").alias("job_id"))
    groups = quality.near_duplicates(p)
    (group,) = groups.collect()
    assert group.n_rows == 1000 and group.sources == ["adzuna"]
    listed = [r.job_id for r in quality.near_duplicate_members(p, groups).collect()]
    assert len(listed) == 1000 == len(set(listed))
    assert quality.near_duplicates(p, limit=1).count() == 1


def test_assert_unique(rows):
    good = rows("source string, job_id string", ("a", "1"), ("b", "1"))
    quality.assert_unique(good)
    with pytest.raises(RuntimeError):
        quality.assert_unique(good.union(good))


def test_filters(rows):
    jobs = rows("job_title string, source string, sector string, salary_min double, salary_max double",
                ("a", "s", "x", 10000.0, 500000.0), ("b", "s", "x", None, None), ("c", "s", "x", 9999.0, None),
                ("d", "s", "x", 60000.0, 50000.0), (None, "s", "x", None, None), ("e", "s", "x", None, 500001.0))
    assert [r.job_title for r in FL.clean(jobs).collect()] == ["a", "b"]
    q = rows("disclosure_code string", ("N",), ("",), (None,))
    assert FL.disclosed(q).count() == 2
    o = rows("occ_code string", ("00-0000",), (None,), ("15-1252",))
    assert FL.has_occupation(o).count() == 1


def test_recency(spark):
    df = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-12-31')) AS posted_date")
    assert FL.since(df, "2024-12-31", days=7).count() == 8
    assert FL.since(df, "2024-08-31", months=6).agg(F.min("posted_date")).first()[0].isoformat() == "2024-02-29"
    assert FL.date_between(df, "2024-03-01", "2024-03-02").count() == 2
    assert FL.date_between(df).count() == 366


def test_only_repeated_keys_are_ranked(spark, rows):
    schema = "k string, j int, v int"
    data = [("a", 1, 5), ("a", 1, 7), ("a", 2, 1), (None, 1, 3), (None, 1, 2), ("", None, 4), ("b", 1, None), ("b", 1, 0)]
    order = [F.desc_nulls_last("v")]
    for some in (data, data[2:4], []):
        df = spark.createDataFrame(some, schema)
        got = sorted(map(str, W.best_of_repeated(df, ["k", "j"], order).collect()))
        assert got == sorted(map(str, W.keep_best(df, ["k", "j"], order).collect()))


def test_payloads_of_single_keys_are_not_shuffled(spark, rows):
    schema = "job_id string, raw_data string, ingestion_timestamp timestamp"
    once = rows(schema, ("1", "{}", None), ("2", "{}", None), (None, "{}", None))
    best = silver.latest_payloads(once, "job_id")
    assert "Exchange" not in best._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.job_id for r in best.collect()) == ["1", "2"]
    twice = silver.latest_payloads(once.union(rows(schema, ("2", '{"a":1}', datetime(2024, 1, 1)))), "job_id")
    assert sorted((r.job_id, r.raw_data) for r in twice.collect()) == [("1", "{}"), ("2", '{"a":1}')]
