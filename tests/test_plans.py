"""Plan shapes that matter at scale."""

import os

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from checks import catalog as C
from meritrix.operators import merge as M
from meritrix.operators.resolver import resolve_soc
from meritrix.plans import gold, silver, views

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["salary_by_sector", "entry_salary_gap", "near_duplicates", "fact_job_postings", "transform_qcew",
                                  "resolve_soc", "personal_feed", "upsert", "top_employers", "postings_vs_oews", "transform_usajobs"])
def test_no_pairing_and_no_python(spark, name):
    text = physical(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert bad not in text, bad


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "postings")
    C.postings(spark, SF).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = physical(views.posting_trends(C.quality.jobs_clean(spark.read.parquet(path)), C.AS_OF))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(posted_date" in plan and "IsNotNull(job_title)" in plan
    schema = plan[plan.index("ReadSchema"):]
    assert "company_or_agency" not in schema and "location_city" not in schema


def test_resolving_stays_above_the_title_aggregation(spark):
    df = resolve_soc(C.postings(spark, SF)).filter("soc_code <> '99-9999'")
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = next(i for i, line in enumerate(lines) if "Aggregate [" in line)
    assert any("levenshtein" in line for line in lines[:first])
    assert not any("levenshtein" in line for line in lines[first:])


def test_one_row_per_group_before_the_shuffle(spark):
    assert physical(C.QUERIES["jobs_deduped"](spark, SF)).count("WindowGroupLimit") == 2


def test_back_fill_joins_the_fact_without_another_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = C.postings(spark, SF)
        resolved = C.stored(resolve_soc(p))
        dim = C.stored(gold.dim_occupation(resolved))
        fact = gold.update_postings_soc(gold.fact_job_postings(p, {}), p, resolved, dim)
        top = physical(fact).split("SortMergeJoin [posting_key", 1)[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = top.split("WindowGroupLimit", 1)[0]
    assert "Exchange" not in left


def test_payload_is_parsed_once(spark):
    bronze = C.adapter(spark, SF, "payloads").withColumn("ingestion_timestamp", F.current_timestamp())
    text = silver.adzuna_to_posting(bronze)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("parseJson") == 1


@pytest.mark.parametrize("merge", ["upsert", "upsert_if_newer", "merge_counts", "new_rows"])
def test_a_small_batch_leaves_a_large_target_in_place(spark, tmp_path, merge):
    """The target is only met by broadcast joins with the batch's keys."""
    spark.range(500_000).select("id", F.col("id").alias("v"), F.lit("x" * 50).alias("kept"),
                                F.lit("2024-01-01").cast("timestamp").alias("ts")).write.parquet(str(tmp_path / "t"))
    spark.range(100).select((F.col("id") * 7).alias("id"), F.lit(1).cast("bigint").alias("v"),
                            F.lit("2024-02-01").cast("timestamp").alias("ts")).write.parquet(str(tmp_path / "b"))
    target, batch = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        args = {"upsert_if_newer": {"ts": "ts", "update_cols": ["v"]}, "merge_counts": {"ts": "ts"}}.get(merge, {})
        frame = getattr(M, merge)(target, batch, ["id"], **args)
        frame.collect()
        text = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for part in text.split("Exchange hashpartitioning")[1:]:  # what each shuffle is fed from
        first_scan = part[part.index("FileScan"):]
        assert "/b]" in first_scan[:first_scan.index("]", first_scan.index("Location")) + 1] or "BroadcastHashJoin" in part[:part.index("FileScan")]


def test_employment_records_are_hashed_not_sorted(spark):
    """The aggregation over all records hashes them; NULL levels and measures are the smallest."""
    lowest = [line for line in physical(silver.qcew_rows(C.adapter(spark, SF, "qcew_raw"))).splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in lowest
    given = spark.sql("""SELECT '06000' AS area_fips, 5 AS own_code, k AS industry_code, level AS agglvl_code, 2020 AS year, 1 AS qtr,
 '' AS disclosure_code, n AS qtrly_estabs, 3 AS month1_emplvl, 3 AS month2_emplvl, 3 AS month3_emplvl, w AS total_qtrly_wages,
 1.0D AS avg_wkly_wage, TIMESTAMP '2024-01-01' AS ingestion_timestamp FROM VALUES ('a', 50, 1, 9.0D), ('a', 50, 7, NULL), ('a', 70, 9, 99.0D),
 ('a', NULL, 10, 100.0D), ('b', NULL, 2, 5.0D), ('b', NULL, NULL, 6.0D), ('c', 30, NULL, 1.0D), ('c', 50, 4, 2.0D) AS t (k, level, n, w)""")
    got = {r.industry_code: (r.qtrly_estabs, r.total_qtrly_wages) for r in silver.qcew_rows(given).collect()}
    assert got == {"a": (7, 9.0), "b": (2, 6.0), "c": (None, 1.0)}
