"""Checked queries over richer inputs: every payload field, all wage measures,
orders, file guards, reloads and the federal stream."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import oracle as O
from checks.adapters import adapter, cte, load
from checks.catalog import categories, check, clean, qcew
from meritrix.functions import lookups as L
from meritrix.operators import merge as M
from meritrix.operators import windows as W
from meritrix.plans import gold, reads, silver
from meritrix.schemas import JOBS_UNIFIED, OEWS_MEASURES, RAW_USAJOBS
from meritrix.session import scratch_path, stored
from meritrix.sources import readers, store
from meritrix.streaming import ingest

# -- private payloads with every field -------------------------------------

#: One payload per order; each optional field is missing from some.
RICH_SQL = r"""SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS loaded,
 CASE o_orderkey % 7 WHEN 0 THEN 'Senior Data Scientist' WHEN 1 THEN 'Junior Developer' WHEN 2 THEN 'Marketing Intern'
  WHEN 3 THEN 'Head of Sales' WHEN 4 THEN 'Associate Clerk' WHEN 5 THEN 'Cook & Baker' END AS title,
 c_name AS company, CASE o_orderkey % 4 WHEN 0 THEN 'Fully Remote position' WHEN 1 THEN 'A HYBRID week' WHEN 2 THEN 'remotely on site' END AS descr,
 CASE WHEN o_orderkey % 3 > 0 THEN 'Texas' END AS state, CASE WHEN o_orderkey % 3 = 2 THEN 'Austin' END AS city,
 CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_custkey % 90 AS DOUBLE) END AS lat, CASE WHEN o_orderkey % 5 > 0 THEN CAST(-o_custkey % 180 AS DOUBLE) END AS lon,
 CASE WHEN o_orderkey % 6 > 0 THEN CAST(20000 + o_orderkey % 1000 AS DOUBLE) END AS lo,
 CASE WHEN o_orderkey % 6 > 1 THEN CAST(40000 + o_orderkey % 1000 AS DOUBLE) END AS hi,
 CASE o_orderkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' END AS predicted, c_mktsegment AS category,
 CASE o_orderkey % 4 WHEN 0 THEN 'full_time' WHEN 1 THEN 'part_time' WHEN 2 THEN 'contract' END AS contract,
 CASE WHEN o_orderkey % 8 > 0 THEN '2024-03-0' || CAST(1 + o_orderkey % 9 AS VARCHAR) || 'T08:00:00Z' END AS created,
 'https://example.org/' || CAST(o_orderkey AS VARCHAR) AS url
FROM @orders JOIN @customer ON c_custkey = o_custkey"""


def rich_bronze(spark, sf):
    for t in ("orders", "customer"):
        load(spark, sf, t).createOrReplaceTempView(f"given_{t}")
    r = spark.sql(RICH_SQL.replace("@", "given_").replace("VARCHAR", "STRING"))
    area = F.filter(F.array(F.lit("US"), "state", "city"), lambda x: x.isNotNull())
    payload = F.to_json(F.struct(
        "id", "title", F.struct(F.col("company").alias("display_name")).alias("company"), F.col("descr").alias("description"),
        F.struct(area.alias("area")).alias("location"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.col("lo").alias("salary_min"), F.col("hi").alias("salary_max"), F.col("predicted").alias("salary_is_predicted"),
        F.struct(F.col("category").alias("label")).alias("category"), F.col("contract").alias("contract_time"), "created",
        F.col("url").alias("redirect_url")))
    return r.select(F.col("id").alias("job_id"), payload.alias("raw_data"), F.col("loaded").cast("timestamp").alias("ingestion_timestamp"))


ENTRY, SENIOR, FLAG = L.ENTRY_WORDS_PRIVATE, L.SENIOR_WORDS_PRIVATE, L.ENTRY_FLAG_WORDS_PRIVATE
RICH = f"""WITH r AS ({RICH_SQL.replace('@', '')})
SELECT 'adzuna_' || id AS job_id, 'adzuna' AS source, 'private' AS sector, title AS job_title,
 {O.NORM_A.format('title')} AS job_title_normalized, company AS company_or_agency, descr AS job_description, city AS location_city,
 state AS location_state, 'US' AS location_country, lat AS latitude, lon AS longitude, lo AS salary_min, hi AS salary_max,
 coalesce(predicted = '1', false) AS salary_is_predicted, category AS job_category,
 CASE WHEN regexp_matches(lower(title), '{ENTRY}') THEN 'entry' WHEN regexp_matches(lower(title), '{SENIOR}') THEN 'senior' ELSE 'mid' END AS experience_level,
 CASE WHEN contract IN ('full_time', 'part_time') THEN contract WHEN contains(lower(title), 'intern') THEN 'intern' ELSE 'unknown' END AS employment_type,
 CASE WHEN regexp_matches(lower(descr), '\\bremote\\b') THEN 'remote' WHEN regexp_matches(lower(descr), '\\bhybrid\\b') THEN 'hybrid' ELSE 'unknown' END AS remote_type,
 regexp_matches(lower(title), '{FLAG}') AS is_entry_level, CAST(left(created, 10) AS DATE) AS posted_date,
 CAST(NULL AS DATE) AS close_date, loaded AS ingestion_timestamp, url AS apply_url FROM r"""


@check("transform_adzuna_all_fields", RICH)
def _(spark, sf):
    out = silver.transform_adzuna(rich_bronze(spark, sf))
    if out.columns != JOBS_UNIFIED.fieldNames():
        raise AssertionError(out.columns)
    return out.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


@check("transform_adzuna_onto_a_table", f"""{RICH.replace("url AS apply_url FROM r", "url AS apply_url, CAST(id AS BIGINT) AS n FROM r")}""".replace(
    "WITH r", "SELECT source, job_id, CASE WHEN n % 3 = 0 THEN 'old' ELSE job_title END AS job_title, salary_min FROM (WITH r") + ")")
def _(spark, sf):
    """A stored table holds two thirds of the postings; a batch brings one third of
    these again and the rest new."""
    first = rich_bronze(spark, sf).filter("CAST(job_id AS BIGINT) % 3 < 2")
    target = stored(silver.transform_adzuna(first).withColumn("job_title", F.lit("old")))
    batch = rich_bronze(spark, sf).filter("CAST(job_id AS BIGINT) % 3 > 0")
    return silver.transform_adzuna(batch, target).select("source", "job_id", "job_title", "salary_min")


# -- wages -----------------------------------------------------------------

@check("transform_oews_measures", f"""WITH {cte('oews_raw')}
SELECT survey_year, area, occ_code, {', '.join(f"CASE WHEN try_cast(tot_emp AS INT) % {i + 3} > 0 THEN CAST(try_cast(tot_emp AS INT) * {i + 1} AS DOUBLE) END AS {m}" for i, m in enumerate(OEWS_MEASURES[1:]))},
 TRY_CAST(tot_emp AS DOUBLE) AS tot_emp FROM oews_raw WHERE occ_code NOT LIKE '00-%'
 QUALIFY row_number() OVER (PARTITION BY survey_year, area, occ_code ORDER BY TRY_CAST(tot_emp AS DOUBLE) DESC NULLS LAST) = 1""")
def _(spark, sf):
    raw, n = adapter(spark, sf, "oews_raw"), F.col("tot_emp").cast("int")
    marks = {m: F.when(n % (i + 3) > 0, (n * (i + 1)).cast("string")).otherwise(F.lit("#")) for i, m in enumerate(OEWS_MEASURES[1:])}
    raw = raw.withColumns(marks)
    record = F.to_json(F.struct(*[F.col(c).alias(c.upper()) for c in raw.columns if c != "survey_year"]))
    bronze = raw.select("survey_year", record.alias("record"), F.lit("2024-01-01").cast("timestamp").alias("ingestion_timestamp"))
    return silver.transform_oews(bronze).select("survey_year", "area", "occ_code", *OEWS_MEASURES)


@check("transform_qcew_onto_a_table", f"""WITH {O.QCEW} SELECT qcew_key, year,
 CASE WHEN year < 1997 THEN total_qtrly_wages ELSE total_qtrly_wages + 1 END AS total_qtrly_wages FROM qcew""")
def _(spark, sf):
    """The batch repeats all years at their own times; older values stand only
    where the table's rows are as new."""
    rows = stored(silver.transform_qcew(adapter(spark, sf, "qcew_raw")))
    late = F.col("ingestion_timestamp") + F.expr("INTERVAL 1 DAY")
    target = stored(rows.withColumn("ingestion_timestamp", F.when(F.col("year") < 1997, late).otherwise(
        F.col("ingestion_timestamp"))))
    newer = adapter(spark, sf, "qcew_raw").withColumns({
        "ingestion_timestamp": F.col("ingestion_timestamp").cast("timestamp") + F.expr("INTERVAL 12 HOURS"),
        "total_qtrly_wages": F.col("total_qtrly_wages") + 1})
    return silver.transform_qcew(newer, target).select("qcew_key", "year", "total_qtrly_wages")


@check("fact_qcew_onto_a_table", f"""WITH {O.QCEW} SELECT qcew_key, year,
 CASE WHEN year < 1997 THEN 0.0 ELSE total_qtrly_wages END AS total_qtrly_wages FROM qcew""")
def _(spark, sf):
    rows = stored(qcew(spark, sf))
    existing = stored(gold.fact_qcew(rows).withColumn("total_qtrly_wages", F.lit(0.0)))
    return gold.fact_qcew(rows.filter("year >= 1997"), existing).select("qcew_key", "year", "total_qtrly_wages")


# -- orders ----------------------------------------------------------------

def _position_sql(mode: str, order: str, rows: str = "clean") -> str:
    return f"SELECT '{mode}' AS mode, row_number() OVER (ORDER BY {order}, source, job_id) AS position, source, job_id FROM {rows}"


OTHER_SORTS = (("oldest", "posted_date ASC NULLS LAST"), ("salary_desc", "salary_max DESC NULLS LAST"),
               ("salary_asc", "salary_min ASC NULLS LAST"))


@check("sort_modes", f"""WITH {O.CLEAN}, best AS (SELECT * FROM clean ORDER BY posted_date DESC NULLS FIRST, source, job_id LIMIT 200)
 """ + " UNION ALL ".join(_position_sql(m, o, "best") for m, o in (("newest", "posted_date DESC NULLS FIRST"), *OTHER_SORTS)))
def _(spark, sf):
    """The newest 200 postings, as a search shows them, in each of its orders."""
    rows, labels = stored(clean(spark, sf)), stored(categories(spark, sf))

    def shown(mode):
        found = reads.search_jobs(rows, labels, sort=mode).withColumn("at", F.monotonically_increasing_id())
        return found.select(F.lit(mode).alias("mode"), F.row_number().over(Window.orderBy("at")).alias("position"), "source", "job_id")

    return W.union_all([shown(m) for m in ("newest", "oldest", "salary_desc", "salary_asc")])


@check("sort_positions", f"WITH {O.CLEAN} " + " UNION ALL ".join(
    _position_sql(m, o) for m, o in (("newest", "posted_date DESC NULLS LAST"), *OTHER_SORTS)))
def _(spark, sf):
    """The position of every row, for each way to sort: rows in earlier range
    partitions plus the place in its own."""
    rows = stored(clean(spark, sf).select("source", "job_id", "posted_date", "salary_min", "salary_max"))

    def every(mode):
        placed = stored(W.resort(rows, mode).select("source", "job_id", F.monotonically_increasing_id().alias("at")))
        part = F.shiftright("at", 33)
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
        offsets = placed.groupBy(part.alias("part")).count().select(
            "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
        inside = F.col("at") - F.shiftleft(part, 33) + 1
        return placed.withColumn("part", part).join(F.broadcast(offsets), "part").select(
            F.lit(mode).alias("mode"), (F.col("before") + inside).alias("position"), "source", "job_id")

    return W.union_all([every(m) for m in ("newest", "oldest", "salary_desc", "salary_asc")])


# -- incremental loads -----------------------------------------------------

@check("load_history", """SELECT DISTINCT year(l_shipdate) AS year, year(l_shipdate) % 2 = 0 AS pending_first, false AS pending_later FROM lineitem""")
def _(spark, sf):
    """Files of odd years are loaded and remembered first, then the others."""
    folder, manifest = scratch_path(spark, "drop"), scratch_path(spark, "manifest")
    rows = load(spark, sf, "lineitem").select("l_orderkey", F.year("l_shipdate").alias("year"))
    rows.repartition("year").write.partitionBy("year").json(folder)
    files = stored(readers.select_files(spark, f"{folder}/year=*", [""]))
    year = F.regexp_extract("path", "year=([0-9]+)", 1).cast("int")
    ingest.mark_loaded(spark, manifest, files.filter(year % 2 == 1))
    first = stored(ingest.pending_files(store.read_table(spark, manifest), files).select(year.alias("year")).distinct())
    ingest.mark_loaded(spark, manifest, files)
    later = ingest.pending_files(store.read_table(spark, manifest), files).select(year.alias("year")).distinct()
    marks = files.select(year.alias("year")).distinct()
    return marks.join(first.withColumn("f", F.lit(True)), "year", "left").join(later.withColumn("l", F.lit(True)), "year", "left").select(
        "year", F.coalesce("f", F.lit(False)).alias("pending_first"), F.coalesce("l", F.lit(False)).alias("pending_later"))


@check("load_year", f"""WITH {O.QCEW} SELECT qcew_key, year,
 CASE WHEN year >= 1998 THEN -1.0 ELSE total_qtrly_wages END AS total_qtrly_wages FROM qcew""")
def _(spark, sf):
    """All years are loaded, then the later ones again with other values, the newest first."""
    rows, path = stored(qcew(spark, sf).select("qcew_key", "year", "total_qtrly_wages")), scratch_path(spark, "years")
    years = sorted(r.year for r in rows.select("year").distinct().collect())
    for year in years:
        ingest.load_year(rows, path, year)
    for year in reversed([y for y in years if y >= 1998]):
        ingest.load_year(rows.withColumn("total_qtrly_wages", F.lit(-1.0)), path, year)
    return store.read_table(spark, path)


@check("load_every_year", f"""WITH {O.QCEW} SELECT qcew_key, year,
 CASE WHEN year = 1995 THEN -1.0 ELSE total_qtrly_wages END AS total_qtrly_wages FROM qcew""")
def _(spark, sf):
    """Every year of the table is loaded, one of them again with other values."""
    rows, path = stored(qcew(spark, sf).select("qcew_key", "year", "total_qtrly_wages")), scratch_path(spark, "years")
    for row in rows.select("year").distinct().orderBy("year").collect():
        ingest.load_year(rows, path, row.year)
    ingest.load_year(rows.withColumn("total_qtrly_wages", F.lit(-1.0)), path, 1995)
    return store.read_table(spark, path)


@check("stream_ingest_federal", f"""WITH {cte('payloads_federal')} SELECT 'landed' AS place, control_number, raw_data FROM payloads_federal
 UNION ALL SELECT 'rejects', NULL, replace(raw_data, '"MatchedObjectId"', '"Other"') FROM payloads_federal WHERE CAST(control_number AS BIGINT) % 5 = 0""")
def _(spark, sf):
    """Federal payloads by stream; copies that lack the id are kept as rejects."""
    rows = adapter(spark, sf, "payloads_federal").select("control_number", "raw_data")
    odd = rows.filter("CAST(control_number AS BIGINT) % 5 = 0").select(F.replace("raw_data", F.lit('"MatchedObjectId"'), F.lit('"Other"')).alias("value"))
    landing, target, marks = (scratch_path(spark, n) for n in ("landing", "raw_usajobs", "checkpoint"))
    for part in (rows.select(F.col("raw_data").alias("value")), odd):
        part.write.mode("append").text(landing)
        ingest.stream_ingest(spark, landing, target, marks, readers.usajobs_rows, ("control_number",), RAW_USAJOBS).awaitTermination()
    landed, refused = (store.read_table(spark, p).select("control_number", "raw_data") for p in (target, f"{target}_rejects"))
    return landed.select(F.lit("landed").alias("place"), "*").union(refused.select(F.lit("rejects"), "*"))


@check("truncate", "SELECT 'customer' AS name, 0 AS n UNION ALL SELECT 'dim_date', count(*) FROM supplier")
def _(spark, sf):
    """Suppliers stand for the calendar, which is kept."""
    tables = {"customer": load(spark, sf, "customer"), "dim_date": load(spark, sf, "supplier")}
    return W.union_all([df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in M.truncate(tables).items()])
