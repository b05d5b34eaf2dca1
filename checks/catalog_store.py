"""Checked queries over stored tables: kinds of partitions, versions, key buckets,
views kept up by signed changes, sketches and Z order."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import catalog
from checks import oracle as O
from checks.adapters import adapter, load
from checks.catalog import SQL, check
from meritrix.operators import sketches
from meritrix.operators import windows as W
from meritrix.plans import gold
from meritrix.session import scratch_path, stored
from meritrix.sources import store
from meritrix.streaming import delta, ingest
from meritrix.streaming.refresh import refresh, refresh_batch

#: Orders with partition values of every kind: codes with leading zeros, an empty and a missing
#: string, a string that looks like a folder name's mark, flags and days, some of them missing.
KINDS_SQL = """SELECT o_orderkey AS k, o_totalprice AS v,
 CASE o_custkey % 6 WHEN 0 THEN '06' WHEN 1 THEN '36' WHEN 2 THEN '' WHEN 3 THEN '~' WHEN 4 THEN 'a/b %20=c' END AS state,
 CASE WHEN o_custkey % 7 > 0 THEN o_custkey % 2 = 0 END AS flag,
 CASE WHEN o_custkey % 5 > 0 THEN CAST('2024-02-0' || CAST(o_custkey % 5 AS VARCHAR) AS DATE) END AS day FROM @orders"""
KINDS = f"WITH t AS ({KINDS_SQL.replace('@', '')})"


def kinds(spark, sf):
    load(spark, sf, "orders").createOrReplaceTempView("given_orders")
    return stored(spark.sql(KINDS_SQL.replace("@", "given_").replace("VARCHAR", "STRING")))


def kept_by_kind(spark, sf, name):
    rows, path = kinds(spark, sf), scratch_path(spark, name)
    table = store.StoredTable.create(spark, path, rows.schema, partition_by=["state", "flag", "day"], sort_by=["k"])
    table.append(rows)
    return rows, path


@check("stored_partition_kinds", f"{KINDS} SELECT * FROM t")
def _(spark, sf):
    return store.read_table(spark, kept_by_kind(spark, sf, "kinds")[1])


@check("stored_upsert_kinds", f"""{KINDS} SELECT k, CASE WHEN k % 3 = 0 THEN -v ELSE v END AS v,
 CASE WHEN k % 3 = 0 THEN CASE state WHEN '06' THEN '6' ELSE state END ELSE state END AS state,
 CASE WHEN k % 3 = 0 THEN NOT flag ELSE flag END AS flag, day FROM t UNION ALL
 SELECT -k, v, '', NULL, NULL FROM t WHERE k % 5 = 0 AND k > 0""")
def _(spark, sf):
    """A batch moves a third of the rows to other partitions and brings new ones."""
    rows, path = kept_by_kind(spark, sf, "kinds")
    moved = rows.filter("k % 3 = 0").withColumns({
        "v": -F.col("v"), "state": F.when(F.col("state") == "06", "6").otherwise(F.col("state")), "flag": ~F.col("flag")})
    new = rows.filter("k % 5 = 0 AND k > 0").select((-F.col("k")).alias("k"), "v", F.lit("").alias("state"),
                                          F.lit(None).cast("boolean").alias("flag"), F.lit(None).cast("date").alias("day"))
    store.upsert_stored(spark, path, moved.unionByName(new), ["k"])
    return store.read_table(spark, path)


@check("stored_delete_kinds", f"""{KINDS} SELECT * FROM t
 WHERE NOT coalesce(state = '06' OR state = '' OR (state IS NULL AND flag) OR day = DATE '2024-02-03' AND v < 100000, false)""")
def _(spark, sf):
    """Whole partitions go, and single rows of others."""
    path = kept_by_kind(spark, sf, "kinds")[1]
    store.delete_partitions(spark, path, F.expr(
        "state = '06' OR state = '' OR (state IS NULL AND flag) OR day = DATE '2024-02-03' AND v < 100000"))
    return store.read_table(spark, path)


@check("stored_table_adopted", """SELECT l_orderkey, l_linenumber, l_quantity, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS code
 FROM lineitem WHERE l_linenumber <> 3 AND NOT (l_linenumber = 4 AND l_quantity < 10)""")
def _(spark, sf):
    """Folders ``code=01`` .. that Spark wrote: rows of one code go, and some of another."""
    path = scratch_path(spark, "lines")
    load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.lpad(
        F.col("l_linenumber").cast("string"), 2, "0").alias("code")).write.partitionBy("code").parquet(path)
    store.delete_partitions(spark, path, F.expr("code = '03' OR code = '04' AND l_quantity < 10"))
    return store.read_table(spark, path)


@check("stored_table_emptied", """SELECT 'first' AS step, 0 AS written, 0 AS replaced, 0 AS n UNION ALL
 SELECT 'loaded', count(*), 0, count(*) FROM orders WHERE year(o_orderdate) = 1996 UNION ALL
 SELECT 'emptied', 0, count(*), 0 FROM orders WHERE year(o_orderdate) = 1996 UNION ALL
 SELECT 'again', count(*), 0, count(*) FROM orders WHERE year(o_orderdate) = 1996 UNION ALL
 SELECT 'deleted', 0, count(*), 0 FROM orders WHERE year(o_orderdate) = 1996""")
def _(spark, sf):
    """A year reload whose first year has no rows, down to the empty table and back."""
    rows = stored(load(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year")))
    path, steps = scratch_path(spark, "years"), []
    for step, given in (("first", rows.limit(0)), ("loaded", rows), ("emptied", rows.limit(0)), ("again", rows)):
        done = ingest.load_year(given, path, 1996)
        steps.append((step, done["written"], done["replaced"], store.read_table(spark, path).count()))
    gone = store.delete_partitions(spark, path, F.lit(True))["deleted"]
    steps.append(("deleted", 0, gone, store.read_table(spark, path).count()))
    return spark.createDataFrame(steps, "step string, written bigint, replaced bigint, n bigint")


@check("stored_versions", f"""{KINDS} SELECT 'opened before' AS seen, k, v FROM t UNION ALL
 SELECT 'opened after', k, CASE WHEN k % 2 = 0 THEN 0 ELSE v END FROM t WHERE k % 7 > 0""")
def _(spark, sf):
    """A frame that was opened before a merge and a deletion still has the old rows."""
    rows, path = kept_by_kind(spark, sf, "kinds")
    before = store.read_table(spark, path)
    store.upsert_stored(spark, path, rows.filter("k % 2 = 0").withColumn("v", F.lit(0).cast(rows.schema["v"].dataType)), ["k"])
    store.delete_partitions(spark, path, F.expr("k % 7 = 0"))
    after = store.read_table(spark, path)
    return W.union_all([df.select(F.lit(seen).alias("seen"), "k", "v") for seen, df in (
        ("opened before", before), ("opened after", after))])


@check("stored_new_columns", """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus FROM orders""")
def _(spark, sf):
    """Half of the rows come before the table gets a column, half after."""
    rows, path = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), scratch_path(spark, "orders")
    table = store.StoredTable.create(spark, path, rows.drop("o_orderstatus").schema)
    table.append(rows.filter("o_orderkey % 2 = 0").drop("o_orderstatus"))
    table.add_columns(rows.schema)
    table.append(rows.filter("o_orderkey % 2 = 1"))
    return store.read_table(spark, path)


@check("bucketed_landing", """SELECT o_orderkey, o_totalprice, 'first' AS batch FROM orders WHERE o_orderkey % 4 > 0 UNION ALL
 SELECT o_orderkey, o_totalprice, 'second' FROM orders WHERE o_orderkey % 4 = 0""")
def _(spark, sf):
    """Insert-if-absent into key buckets: the second batch repeats half of the first."""
    rows, path = load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), scratch_path(spark, "landed")
    store.StoredTable.create(spark, path, rows.withColumn("batch", F.lit("")).schema, bucket_by=["o_orderkey"], buckets=16)
    store.append_new(spark, path, rows.filter("o_orderkey % 4 > 0").withColumn("batch", F.lit("first")), ["o_orderkey"])
    store.append_new(spark, path, rows.filter("o_orderkey % 4 <> 1").withColumn("batch", F.lit("second")), ["o_orderkey"])
    return store.read_table(spark, path)


@check("bucketed_upsert", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders""")
def _(spark, sf):
    """A merge into partitions with key buckets."""
    rows, path = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), scratch_path(spark, "orders")
    table = store.StoredTable.create(spark, path, rows.schema, partition_by=["o_orderstatus"], bucket_by=["o_orderkey"], buckets=8)
    table.append(rows)
    zero = F.lit(0).cast(rows.schema["o_totalprice"].dataType)
    store.upsert_stored(spark, path, rows.filter("o_orderkey % 5 = 0").withColumn("o_totalprice", zero), ["o_orderkey"])
    return store.read_table(spark, path)


@check("rejects_by_content", """SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS day, count(*) AS copies FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL""")
def _(spark, sf):
    """Rows without a key, landed twice: each content once, dates included, with its copies."""
    rows = load(spark, sf, "orders").filter("o_orderkey % 3 = 0").select(
        F.lit(None).cast("bigint").alias("key"), "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"))
    path, rejects = scratch_path(spark, "landed"), scratch_path(spark, "rejects")
    store.StoredTable.create(spark, path, rows.withColumn("loaded_at", F.current_timestamp()).schema)
    for _ in range(2):
        store.append_new(spark, path, rows.withColumn("loaded_at", F.current_timestamp()), ["key"], rejects=rejects)
    return store.read_table(spark, rejects).select("o_orderstatus", "day", "copies")


# -- signed changes --------------------------------------------------------

def postings_by_batches(spark, sf, view):
    """The test postings in a stored table, reached by a first load with wrong and with
    false rows, a view over it, and then corrections: updates, inserts and deletions."""
    tables, true = store.SnapshotStore(spark, scratch_path(spark, "tables")), stored(catalog.postings(spark, sf))
    labels = {"agg_experience": ["dim_category"], "agg_category": ["dim_category"], "agg_employers": ["dim_company"]}.get(view, [])
    view = next(v for v in delta.VIEWS if v.name == view)
    number = F.regexp_extract("job_id", "([0-9]+)$", 1).cast("bigint")
    wrong = number % 3 == 0
    first = true.where(number % 5 > 0).withColumns({
        "salary_min": F.when(wrong, F.col("salary_min") / 2).otherwise(F.col("salary_min")),
        "experience_level": F.when(wrong, "mid").otherwise(F.col("experience_level")),
        "location_state": F.when(wrong, "Ohio").otherwise(F.col("location_state")),
        "posted_date": F.when(wrong, F.date_add("posted_date", 3)).otherwise(F.col("posted_date"))})
    false_rows = true.where(number % 11 == 0).withColumn("job_id", F.concat(F.lit("false_"), "job_id"))
    tables.write("jobs_unified", first.unionByName(false_rows))
    for name, build in (("dim_category", gold.category_labels), ("dim_company", gold.company_labels)):
        if name in labels:
            tables.write(name, build(true))
    delta.maintain(tables, view)
    tables.merge("jobs_unified", true.where(wrong), ["source", "job_id"], lasting=True)
    delta.maintain(tables, view)
    jobs = tables.table("jobs_unified")
    jobs.append_new(true, ["source", "job_id"], lasting=True)
    jobs.delete(F.col("job_id").startswith("false_"))
    report = delta.maintain(tables, view)
    if report["rebuilt"] or not report["changed"] or delta.maintain(tables, view)["changed"]:
        raise AssertionError(report)
    return tables


def _kept(name, view, build):
    @check(f"{name}_by_changes", SQL[name])
    def _(spark, sf):
        return build(postings_by_batches(spark, sf, view))


_kept("experience_by_sector", "agg_experience", delta.experience_by_sector)
_kept("geo_distribution", "agg_geo", delta.geo_distribution)
_kept("remote_by_sector", "agg_remote", delta.remote_by_sector)
_kept("category_by_sector", "agg_category", delta.category_by_sector)
_kept("top_employers", "agg_employers", delta.top_employers)
_kept("posting_trends", "agg_trends", lambda tables: delta.posting_trends(tables, catalog.AS_OF))


@check("soc_major_distribution_by_changes", SQL["soc_major_distribution"])
def _(spark, sf):
    fact, occupations = catalog.posting_fact(spark, sf)
    tables = store.SnapshotStore(spark, scratch_path(spark, "tables"))
    tables.write("dim_occupation", occupations)
    tables.write("fact_job_postings", fact.withColumn("occupation_key", F.when(F.xxhash64("posting_key") % 3 != 0, F.col("occupation_key"))))
    delta.maintain_all(tables)
    tables.merge("fact_job_postings", fact.where(F.xxhash64("posting_key") % 3 == 0), ["posting_key"])
    delta.maintain_all(tables)
    return delta.soc_major_distribution(tables)


def statistics_by_batches(spark, sf):
    """Employment and wage records: most by a whole refresh, the rest, and revisions of
    what is there, as batches."""
    tables = store.SnapshotStore(spark, scratch_path(spark, "tables"))
    qcew, oews = adapter(spark, sf, "qcew_raw"), catalog.oews_bronze(spark, sf)
    later = F.xxhash64("area_fips", "industry_code", "own_code", "year", "qtr") % 4 == 0
    again = F.xxhash64("area_fips", "industry_code", "own_code", "year", "qtr") % 10 == 1
    tables.write("raw_bls_qcew", qcew.where(~later).withColumn(
        "total_qtrly_wages", F.when(again, F.col("total_qtrly_wages") / 2).otherwise(F.col("total_qtrly_wages"))))
    late_record = F.xxhash64("record") % 3 == 0
    tables.write("raw_bls_oews", oews.where(~late_record))
    tables.write("dim_occupation", catalog.occupations(spark, sf)[1])
    refresh(tables, ["raw_bls_qcew", "raw_bls_oews"])
    delta.maintain_all(tables)
    refresh_batch(tables, "raw_bls_qcew", qcew.where(again & (F.col("year") < 1996)))
    refresh_batch(tables, "raw_bls_qcew", qcew.where(later | again & (F.col("year") >= 1996)))
    refresh_batch(tables, "raw_bls_oews", oews.where(late_record))
    delta.maintain_all(tables)
    return tables


@check("fact_qcew_by_batches", SQL["fact_qcew"])
def _(spark, sf):
    return statistics_by_batches(spark, sf).read("fact_qcew").drop("location_key")


@check("fact_oews_wages_by_batches", SQL["fact_oews_wages"])
def _(spark, sf):
    wages = statistics_by_batches(spark, sf).read("fact_oews_wages")
    return wages.select("oews_key", "date_key", "occupation_key", "survey_year", "area", "area_type", "occ_code",
                        "occ_title", "tot_emp", "a_median")


@check("qcew_employment_trend_by_changes", f"""SELECT state_fips, own_label, year, qtr, round(state_employment, 3) AS state_employment,
 round(state_qtrly_wages, 3) AS state_qtrly_wages, round(state_avg_wkly_wage, 3) AS state_avg_wkly_wage, quarter_start_date FROM ({SQL['qcew_employment_trend']})""")
def _(spark, sf):
    return delta.qcew_employment_trend(statistics_by_batches(spark, sf)).withColumns(
        {c: F.round(c, 3) for c in ("state_employment", "state_qtrly_wages", "state_avg_wkly_wage")})


# -- mergeable summaries ---------------------------------------------------

def summaries_by_day(spark, sf):
    """Sketches per day, sector and level in a stored table."""
    rows, path = stored(catalog.clean(spark, sf)), scratch_path(spark, "days")
    days = sketches.summarised(rows, ["posted_date", "sector", "experience_level"], ("salary_min",), ("company_or_agency",))
    store.StoredTable.create(spark, path, days.schema, partition_by=["sector"], sort_by=["posted_date"], commit=False).append(days)
    return rows, store.read_table(spark, path)


@check("median_from_sketches", f"""WITH {O.CLEAN} SELECT sector, experience_level, count(*) AS n, count(salary_min) AS n_salary, true AS within
 FROM clean GROUP BY ALL""")
def _(spark, sf):
    """The rank of each median, merged from days, against all rows."""
    rows, days = summaries_by_day(spark, sf)
    by = ["sector", "experience_level"]
    months = stored(sketches.merged(days, by).withColumn("median", sketches.quantile_of("kll_salary_min", 0.5)))
    ranks = sketches.ranks_of(rows, months, by, "salary_min", "median").drop("n")
    error = F.lit(sketches.rank_error())
    return months.join(ranks, by, "left").select(
        *by, "n", F.col("n_salary_min").alias("n_salary"),
        ((F.col("low") - 0.5 <= error) & (0.5 - F.col("high") <= error)).alias("within"))


@check("distinct_from_sketches", f"""WITH {O.CLEAN} SELECT sector, count(DISTINCT company_or_agency) AS employers, true AS close FROM clean GROUP BY ALL""")
def _(spark, sf):
    """The merged sketches' estimate against the exact two-level count."""
    rows, days = summaries_by_day(spark, sf)
    estimate = sketches.merged(days, ["sector"]).select("sector", sketches.distinct_of("hll_company_or_agency").alias("estimate"))
    exact = sketches.exact_distinct(rows, ["sector"], "company_or_agency", "employers")
    far = F.abs(F.col("estimate") - F.col("employers")) / F.col("employers")
    return exact.join(estimate, "sector").select("sector", "employers", (far <= sketches.distinct_error()).alias("close"))


@check("exact_distinct", """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    return sketches.exact_distinct(load(spark, sf, "lineitem"), ["l_returnflag"], "l_partkey", "parts")


@check("clustered_table", "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey FROM lineitem")
def _(spark, sf):
    """A table in Z order of date and part."""
    rows, path = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"), scratch_path(spark, "lines")
    table = store.StoredTable.create(spark, path, rows.schema, sort_by=["l_shipdate"])
    table.append(rows)
    table.cluster(["l_shipdate", "l_partkey"], 16)
    return store.read_table(spark, path)
