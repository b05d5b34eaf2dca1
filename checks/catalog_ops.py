"""Checked queries for single operators: sources, writes, joins, aggregates,
windows and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import oracle as O
from checks.adapters import adapter, cte, load
from checks.catalog import (
    COMPANIES, FEDERAL, SQL, check, ids, oews_bronze, postings, qcew,
)
from meritrix.functions import aggregates as A
from meritrix.functions import derive as D
from meritrix.functions import lookups as L
from meritrix.operators import filters as FL
from meritrix.operators import joins as J
from meritrix.operators import keys as K
from meritrix.operators import merge as M
from meritrix.operators import windows as W
from meritrix.plans import gold
from meritrix.session import scratch_path, stored
from meritrix.sources import landing, readers, store
from meritrix.streaming import ingest
from meritrix.streaming.refresh import refresh, refresh_batch

INGESTED = "2024-02-01"

# -- sources: the test tables are written in the landing format and read back


def text_drop(df, column: str, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.select(F.col(column).alias("value")).write.text(path)
    return path


@check("read_adzuna", f"WITH {cte('payloads')} SELECT job_id, raw_data, 'data' AS search_query, 'us' AS search_country FROM payloads")
def _(spark, sf):
    path = text_drop(adapter(spark, sf, "payloads"), "raw_data", "adzuna")
    return readers.read_adzuna(spark, path, "data", "us").drop("api_pull_date", "ingestion_timestamp")


@check("read_usajobs", f"WITH {cte('payloads_federal')} SELECT control_number, raw_data FROM payloads_federal")
def _(spark, sf):
    path = text_drop(adapter(spark, sf, "payloads_federal"), "raw_data", "usajobs")
    return readers.read_usajobs(spark, path).select("control_number", "raw_data")


@check("read_usajobs_historical", """SELECT CAST(o_orderkey AS VARCHAR) AS control_number, 2019 AS source_year,
 o_orderpriority AS priority, o_custkey AS customer FROM orders""")
def _(spark, sf):
    out = readers.read_usajobs_historical(spark, f"{sf}/orders.parquet", 2019, key="o_orderkey")
    return D.with_payload(out).select(
        "control_number", "source_year", D.json_path("payload", "$.o_orderpriority").alias("priority"),
        D.json_path("payload", "$.o_custkey", "bigint").alias("customer"))


@check("read_qcew_csv", f"""WITH {cte('qcew_raw')} SELECT area_fips, own_code, industry_code, agglvl_code, 0 AS size_code, year, qtr,
 nullif(disclosure_code, '') AS disclosure_code, qtrly_estabs, month1_emplvl, month2_emplvl, month3_emplvl, total_qtrly_wages,
 CAST(NULL AS DOUBLE) AS taxable_qtrly_wages, CAST(NULL AS DOUBLE) AS qtrly_contributions, avg_wkly_wage, true AS named FROM qcew_raw""")
def _(spark, sf):
    raw = adapter(spark, sf, "qcew_raw").withColumns({
        "size_code": F.lit(0), "taxable_qtrly_wages": F.lit("n/a"), "qtrly_contributions": F.lit(" NULL "),
        "oty_note": F.lit("not kept")})
    path = scratch_path(spark, "qcew")
    # other column order than the table's: binding is by header name
    raw.select(*sorted(c for c in raw.columns if c != "ingestion_timestamp")).write.option("header", True).csv(path)
    out = readers.read_qcew_csv(spark, path)
    return out.withColumn("named", F.col("source_file").endswith(".csv")).drop("raw_record", "source_file", "ingestion_timestamp")


OEWS_KEPT = "survey_year, area, area_type, occ_code, occ_title, o_group, tot_emp"


@check("read_oews_ndjson", f"""WITH {cte('oews_raw')} SELECT {OEWS_KEPT.replace('survey_year', '2023 AS survey_year')}, a_median
 FROM oews_raw WHERE tot_emp NOT LIKE '%7'""")
def _(spark, sf):
    rows = oews_bronze(spark, sf)
    broken = F.get_json_object("record", "$.TOT_EMP").endswith("7")
    path = text_drop(rows.withColumn("record", F.when(broken, F.lit('{"AREA": ')).otherwise(F.col("record"))), "record", "oews")
    out = D.with_payload(readers.read_oews_ndjson(spark, path, 2023), "record")
    return out.select("survey_year", *[D.json_path("payload", f"$.{c.upper()}").alias(c)
                                       for c in (*OEWS_KEPT.split(", ")[1:], "a_median")])


@check("oews_bad_rows", f"""WITH {cte('oews_raw')} SELECT count(*) AS rows_read,
 count(*) FILTER (tot_emp LIKE '%7') AS rows_skipped FROM oews_raw""")
def _(spark, sf):
    rows = oews_bronze(spark, sf)
    broken = F.get_json_object("record", "$.TOT_EMP").endswith("7")
    path = text_drop(rows.withColumn("record", F.when(broken, F.lit('{"AREA": ')).otherwise(F.col("record"))), "record", "oews")
    return readers.oews_bad_rows(spark, path).agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_skipped").alias("rows_skipped"))


@check("read_oews_csv", f"""WITH {cte('oews_raw')} SELECT {OEWS_KEPT.replace('survey_year', '2023 AS survey_year')},
 CASE WHEN a_median NOT IN ('*', '**', '#') THEN a_median END AS a_median FROM oews_raw""")
def _(spark, sf):
    raw = adapter(spark, sf, "oews_raw").drop("survey_year")
    path = scratch_path(spark, "oews")
    raw.select(*[F.col(c).alias(c.capitalize()) for c in reversed(raw.columns)]).write.option("header", True).csv(path)
    out = D.with_payload(readers.read_oews_csv(spark, path, 2023), "record")
    return out.select("survey_year", *[D.json_path("payload", f"$.{c.upper()}").alias(c)
                                       for c in (*OEWS_KEPT.split(", ")[1:], "a_median")])


def two_headers(spark, sf):
    """A drop of two files with other column orders; one cell too many in some rows."""
    raw = adapter(spark, sf, "oews_raw").drop("survey_year")
    path = scratch_path(spark, "oews")
    for odd, names in ((0, raw.columns), (1, [c.capitalize() for c in reversed(raw.columns)])):
        half = raw.filter(F.pmod(F.xxhash64("occ_title", "area", "tot_emp"), F.lit(2)) == odd)
        text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
        cells = F.concat_ws(",", *[F.when(t.contains(","), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(t) for t in text])
        extra = F.when(F.col("tot_emp").endswith("7"), F.lit(",x,y")).otherwise(F.lit(""))
        head = spark.createDataFrame([(",".join(names),)], "value string")
        head.union(half.select(F.concat(cells, extra))).coalesce(1).write.text(f"{path}/part={odd}")
    return path


@check("read_oews_csv_two_headers", f"""WITH {cte('oews_raw')} SELECT {OEWS_KEPT.replace('survey_year', '2023 AS survey_year')}
 FROM oews_raw WHERE tot_emp NOT LIKE '%7'""")
def _(spark, sf):
    out = D.with_payload(readers.read_oews_csv(spark, two_headers(spark, sf), 2023), "record")
    return out.select("survey_year", *[D.json_path("payload", f"$.{c.upper()}").alias(c) for c in OEWS_KEPT.split(", ")[1:]])


@check("oews_csv_bad_rows", f"""WITH {cte('oews_raw')} SELECT count(*) AS rows_read,
 count(*) FILTER (tot_emp LIKE '%7') AS rows_skipped, 2 AS files FROM oews_raw""")
def _(spark, sf):
    return readers.oews_csv_bad_rows(spark, two_headers(spark, sf)).agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_skipped").alias("rows_skipped"), F.count("*").cast("int").alias("files"))


def landed_and_refused(spark, path, kind):
    """A wage drop through ``land_wages``: rows by table, and the counts it reports."""
    target, bad = scratch_path(spark, "raw_oews"), scratch_path(spark, "quarantine")
    counts = landing.land_wages(spark, path, 2023, target, bad, kind=kind)
    landed, refused = store.read_table(spark, target), store.read_table(spark, bad)
    return landed.agg(
        F.lit("landed").alias("place"), F.count("record").alias("n"), F.max(F.lit(counts["read"])).cast("bigint").alias("rows_read")
    ).union(refused.agg(F.lit("refused"), F.count_if(F.expr("line IS NOT NULL AND row_no > 0 AND reason IS NOT NULL")),
                        F.max(F.lit(counts["skipped"])).cast("bigint")))


LANDED = f"""WITH {cte('oews_raw')} SELECT 'landed' AS place, count(*) FILTER (tot_emp NOT LIKE '%7') AS n, count(*) AS rows_read FROM oews_raw
 UNION ALL SELECT 'refused', count(*) FILTER (tot_emp LIKE '%7'), count(*) FILTER (tot_emp LIKE '%7') FROM oews_raw"""


@check("land_wages_ndjson", LANDED)
def _(spark, sf):
    rows = oews_bronze(spark, sf)
    broken = F.get_json_object("record", "$.TOT_EMP").endswith("7")
    path = text_drop(rows.withColumn("record", F.when(broken, F.lit('{"AREA": ')).otherwise(F.col("record"))), "record", "oews")
    return landed_and_refused(spark, path, "ndjson")


@check("land_wages_csv", LANDED)
def _(spark, sf):
    return landed_and_refused(spark, two_headers(spark, sf), "csv")


@check("read_jolts", """SELECT event_type AS series_id, year(ts) AS year, 'M' || lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS period, value FROM events""")
def _(spark, sf):
    e = load(spark, sf, "events")
    line = F.to_json(F.struct(F.col("event_type").alias("series_id"), F.year("ts").alias("year"),
                              F.date_format("ts", "'M'MM").alias("period"), "value"))
    path = text_drop(e.select(line.alias("line")), "line", "jolts")
    return readers.read_jolts(spark, path).select("series_id", "year", "period", "value")


# -- keyed writes ----------------------------------------------------------

KEY = ["l_orderkey", "l_linenumber"]
REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ONE_PER_KEY = f"QUALIFY row_number() OVER (PARTITION BY {', '.join(KEY)} ORDER BY {', '.join(REST)}) = 1"
SIDES = f"""t AS (SELECT * FROM lineitem WHERE l_partkey % 2 = 0 {ONE_PER_KEY}),
s AS (SELECT * FROM lineitem WHERE l_partkey % 2 = 1 {ONE_PER_KEY})"""
SAME = "t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber"


def sides(spark, sf):
    """Table and batch: lines of even and of odd parts; many keys are in both,
    and the batch repeats keys."""
    rows = load(spark, sf, "lineitem")
    return M.one_per_key(rows.filter("l_partkey % 2 = 0"), KEY, REST), rows.filter("l_partkey % 2 = 1")


@check("insert_new", f"WITH {SIDES} SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (FROM t WHERE {SAME})")
def _(spark, sf):
    return M.insert_new(*sides(spark, sf), KEY, REST)


@check("upsert", f"WITH {SIDES} SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS (FROM s WHERE {SAME})")
def _(spark, sf):
    return M.upsert(*sides(spark, sf), KEY, REST)


@check("upsert_partial_columns", f"""WITH {SIDES} SELECT l_orderkey, l_linenumber, coalesce(s.l_quantity, t.l_quantity) AS l_quantity,
 t.l_returnflag FROM t FULL JOIN s USING (l_orderkey, l_linenumber)""")
def _(spark, sf):
    target, batch = sides(spark, sf)
    kept = target.select(*KEY, "l_quantity", "l_returnflag")
    return M.upsert(kept, M.one_per_key(batch, KEY, REST).select(*KEY, "l_quantity"), KEY)


@check("upsert_if_newer", f"""WITH t AS (SELECT * FROM lineitem WHERE l_partkey % 2 = 0 {ONE_PER_KEY}),
s AS (SELECT * FROM lineitem WHERE l_partkey % 2 = 1 {ONE_PER_KEY.replace('ORDER BY ', 'ORDER BY l_shipdate DESC, ')})
SELECT l_orderkey, l_linenumber, CASE WHEN t.l_shipdate IS NULL OR s.l_shipdate > t.l_shipdate THEN s.l_quantity ELSE t.l_quantity END AS l_quantity,
 coalesce(t.l_returnflag, s.l_returnflag) AS l_returnflag,
 CASE WHEN t.l_shipdate IS NULL OR s.l_shipdate > t.l_shipdate THEN s.l_shipdate ELSE t.l_shipdate END AS l_shipdate
FROM t FULL JOIN s USING (l_orderkey, l_linenumber)""")
def _(spark, sf):
    target, batch = sides(spark, sf)
    cols = [*KEY, "l_quantity", "l_returnflag", "l_shipdate"]
    newest = [F.desc("l_shipdate"), *REST]
    return M.upsert_if_newer(target.select(*cols), M.one_per_key(batch, KEY, newest).select(*cols), KEY, "l_shipdate", ["l_quantity"])


@check("update_from", f"""WITH {SIDES} SELECT t.l_orderkey, t.l_linenumber, coalesce(s.l_suppkey, t.l_suppkey) AS l_suppkey
 FROM t LEFT JOIN s ON {SAME}""")
def _(spark, sf):
    target, batch = sides(spark, sf)
    return M.update_from(target.select(*KEY, "l_suppkey"), M.one_per_key(batch, KEY, REST), KEY, "l_suppkey")


@check("merge_counts", f"""WITH {SIDES} SELECT count(*) FILTER (t.l_orderkey IS NULL) AS inserted,
 count(*) FILTER (t.l_orderkey IS NOT NULL AND s.l_orderkey IS NOT NULL) AS updated,
 count(*) FILTER (s.l_orderkey IS NULL) AS unchanged FROM t FULL JOIN s ON {SAME}""")
def _(spark, sf):
    return M.merge_counts(*sides(spark, sf), KEY)


@check("assign_keys", f"""WITH {O.POSTINGS}, {COMPANIES},
f AS (SELECT company_name FROM com WHERE sector = 'federal'),
e AS (SELECT company_name, {O.numbered('company_name', 'company_name')} AS company_key FROM f),
n AS (SELECT company_name, {O.numbered('company_name', 'company_name')} + (SELECT max(company_key) FROM e) AS company_key
 FROM com WHERE company_name NOT IN (FROM f))
SELECT * FROM e UNION ALL SELECT * FROM n""")
def _(spark, sf):
    names = stored(gold.company_labels(postings(spark, sf)).select("company_name", "sector"))
    first = stored(K.number_rows(names.filter("sector = 'federal'").select("company_name"), ["company_name"], "company_key"))
    return K.assign_keys(names.select("company_name"), ["company_name"], "company_key", first)


@check("refresh_years", f"""WITH {O.QCEW} SELECT qcew_key, year,
 total_qtrly_wages + CASE WHEN year IN (1999, 2000) THEN 1 ELSE 0 END AS total_qtrly_wages FROM qcew""")
def _(spark, sf):
    rows = stored(qcew(spark, sf).select("qcew_key", "year", "qtr", "area_fips", "total_qtrly_wages"))
    path = scratch_path(spark, "fact_qcew")
    store.write_layout(rows, path, "fact_qcew")
    revised = store.read_table(spark, path).withColumn("total_qtrly_wages", F.col("total_qtrly_wages") + 1)
    ingest.refresh_years(revised, path, [1999, 2000])
    return store.read_table(spark, path).select("qcew_key", "year", "total_qtrly_wages")


@check("refresh_years_emptied", f"""WITH {O.QCEW} SELECT qcew_key, year,
 total_qtrly_wages + CASE WHEN year = 1999 THEN 1 ELSE 0 END AS total_qtrly_wages FROM qcew WHERE year <> 2000""")
def _(spark, sf):
    """The revision of 1999 and 2000 has no rows of 2000 any more."""
    rows = stored(qcew(spark, sf).select("qcew_key", "year", "qtr", "area_fips", "total_qtrly_wages"))
    path = scratch_path(spark, "fact_qcew")
    store.write_layout(rows, path, "fact_qcew")
    revised = store.read_table(spark, path).filter("year <> 2000").withColumn("total_qtrly_wages", F.col("total_qtrly_wages") + 1)
    ingest.refresh_years(revised, path, [1999, 2000])
    return store.read_table(spark, path).select("qcew_key", "year", "total_qtrly_wages")


def lines_by_status(spark, sf):
    """A stored table of lines in partition folders, and a batch for it."""
    target, batch = sides(spark, sf)
    path = scratch_path(spark, "lines")
    target.write.partitionBy("l_linestatus").parquet(path)
    return path, batch


@check("append_partitioned", f"WITH {SIDES} SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (FROM t WHERE {SAME})")
def _(spark, sf):
    path, batch = lines_by_status(spark, sf)
    store.append_new(spark, path, batch, KEY, REST)
    return store.read_table(spark, path)


@check("upsert_stored", f"WITH {SIDES} SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS (FROM s WHERE {SAME})")
def _(spark, sf):
    """Rows may move to another partition; its folder must not keep them."""
    path, batch = lines_by_status(spark, sf)
    store.upsert_stored(spark, path, batch, KEY, REST)
    return store.read_table(spark, path)


@check("delete_partitions", """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
 WHERE NOT (l_returnflag = 'R' OR l_returnflag = 'A' AND l_quantity < 10)""")
def _(spark, sf):
    path = scratch_path(spark, "lines")
    load(spark, sf, "lineitem").select(*KEY, "l_quantity", "l_returnflag").write.partitionBy("l_returnflag").parquet(path)
    store.delete_partitions(spark, path, F.expr("l_returnflag = 'R' OR l_returnflag = 'A' AND l_quantity < 10"))
    if store.partition_columns(spark, path) != ["l_returnflag"]:
        raise AssertionError("the layout is gone")
    return store.read_table(spark, path).select(*KEY, "l_returnflag")


@check("landing_rejects", f"""WITH {cte('payloads')} SELECT 'landed' AS place, job_id, raw_data FROM payloads WHERE CAST(job_id AS BIGINT) % 5 > 0
 UNION ALL SELECT 'rejects', NULL, raw_data FROM payloads WHERE CAST(job_id AS BIGINT) % 5 = 0""")
def _(spark, sf):
    """Payloads without an id are kept, once, although they are landed twice."""
    rows = adapter(spark, sf, "payloads").select("job_id", "raw_data")
    rows = rows.withColumn("job_id", F.when(F.col("job_id").cast("bigint") % 5 > 0, F.col("job_id")))
    path, rejects = scratch_path(spark, "landed"), scratch_path(spark, "rejects")
    rows.limit(0).write.parquet(path)
    for _ in range(2):
        store.append_new(spark, path, rows, ["job_id"], [F.asc("raw_data")], rejects=rejects)
    landed, refused = (store.read_table(spark, p).select("job_id", "raw_data") for p in (path, rejects))
    return landed.select(F.lit("landed").alias("place"), "*").union(refused.select(F.lit("rejects"), "*"))


@check("delete_before", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-06-01'")
def _(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return M.delete_before(rows, "1999-06-01 00:00:00", "o_orderdate")


@check("ensure_columns", f"WITH {O.POSTINGS} SELECT job_id, source, CAST(NULL AS VARCHAR) AS apply_url, CAST(NULL AS DATE) AS close_date FROM postings")
def _(spark, sf):
    from meritrix.schemas import JOBS_UNIFIED

    return M.ensure_columns(postings(spark, sf), JOBS_UNIFIED).select("job_id", "source", "apply_url", "close_date")


@check("null_key_rows", f"WITH {O.POSTINGS} SELECT source, job_id FROM postings WHERE job_title IS NULL OR posted_date IS NULL")
def _(spark, sf):
    return M.null_key_rows(postings(spark, sf), ["job_title", "posted_date"]).select("source", "job_id")


# -- derivations and filters on their own ----------------------------------

@check("title_forms", f"""WITH t AS (SELECT doc_id, unnest(string_split(text, '.')) AS title FROM documents)
SELECT doc_id, {O.NORM_A.format('title')} AS form_a, {O.NORM_B.format('title')} AS form_b,
 CASE WHEN regexp_matches(lower(title), '{L.ENTRY_WORDS_PRIVATE}') THEN 'entry'
  WHEN regexp_matches(lower(title), '{L.SENIOR_WORDS_PRIVATE}') THEN 'senior' ELSE 'mid' END AS level,
 regexp_matches(lower(title), '{L.ENTRY_FLAG_WORDS_PRIVATE}') AS entry FROM t""")
def _(spark, sf):
    t = load(spark, sf, "documents").select("doc_id", F.explode(F.split("text", r"\.")).alias("title"))
    return t.select("doc_id", D.norm_a("title").alias("form_a"), D.norm_b("title").alias("form_b"),
                    D.level_private("title").alias("level"), D.is_entry("title", "private").alias("entry"))


@check("description_flags", """SELECT doc_id, CASE WHEN regexp_matches(lower(text), '\\bremote\\b') THEN 'remote'
 WHEN regexp_matches(lower(text), '\\bhybrid\\b') THEN 'hybrid' ELSE 'unknown' END AS private_type,
 CASE WHEN doc_id % 10 = 0 THEN 'remote' WHEN regexp_matches(lower(text), '\\bhybrid\\b') THEN 'hybrid' ELSE 'onsite' END AS federal_type
FROM documents""")
def _(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", D.remote_private("text").alias("private_type"),
                    D.remote_federal(F.col("doc_id") % 10 == 0, "text").alias("federal_type"))


@check("annualise", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_totalprice * 2080 WHEN 1 THEN o_totalprice * 26
 ELSE o_totalprice END AS yearly FROM orders""")
def _(spark, sf):
    o = load(spark, sf, "orders")
    code = F.get(F.array(F.lit("PH"), F.lit("PB"), F.lit("PA"), F.lit(None)), (F.col("o_orderkey") % 4).cast("int"))
    return o.select("o_orderkey", D.annualise("o_totalprice", code).alias("yearly"))


@check("labels", f"""SELECT p_partkey, {O.category_group('p_type')} AS category_group, {O.area_type('p_size * 2')} AS area_type,
 {O.own_label('p_size')} AS own_label, left(CAST(p_partkey AS VARCHAR), 2) || '-0000' AS major_group,
 {O.major_title("left(CAST(p_partkey AS VARCHAR), 2) || '-0000'")} AS major_title FROM part""")
def _(spark, sf):
    group = D.soc_major_group(F.col("p_partkey").cast("string"))
    return load(spark, sf, "part").select(
        "p_partkey", D.category_group("p_type").alias("category_group"), D.area_type(F.col("p_size") * 2).alias("area_type"),
        D.own_label("p_size").alias("own_label"), group.alias("major_group"), D.soc_major_title(group).alias("major_title"))


@check("salary_in_range", f"WITH {O.FACT} SELECT posting_key, salary_midpoint FROM fact WHERE salary_midpoint BETWEEN 15000 AND 500000")
def _(spark, sf):
    return FL.salary_in_range(gold.posting_measures(postings(spark, sf))).select("posting_key", "salary_midpoint")


@check("disclosed", f"""WITH {cte('qcew_raw')} SELECT area_fips, year, qtr, count(*) AS n FROM qcew_raw
 WHERE disclosure_code IS NULL OR disclosure_code = '' GROUP BY ALL""")
def _(spark, sf):
    return A.count_by(FL.disclosed(adapter(spark, sf, "qcew_raw")), ["area_fips", "year", "qtr"])


@check("has_occupation", f"WITH {cte('oews_raw')} SELECT occ_code, count(*) AS n FROM oews_raw WHERE occ_code NOT LIKE '00-%' GROUP BY 1")
def _(spark, sf):
    return A.count_by(FL.has_occupation(adapter(spark, sf, "oews_raw")), ["occ_code"])


@check("in_any_and_between", f"""WITH {O.POSTINGS} SELECT source, job_id FROM postings WHERE sector IN ('federal')
 AND remote_type IN ('remote', 'hybrid') AND posted_date BETWEEN DATE '1996-02-01' AND DATE '1998-03-01'""")
def _(spark, sf):
    rows = FL.in_any(postings(spark, sf), {"sector": ["federal"], "remote_type": ["remote", "hybrid"], "location_city": []})
    return FL.date_between(rows, "1996-02-01", "1998-03-01").select("source", "job_id")


@check("drop_columns", "SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem")
def _(spark, sf):
    return D.drop_columns(load(spark, sf, "lineitem"), ["l_tax", "l_discount"])


# -- joins -----------------------------------------------------------------

@check("without", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, sf):
    keys = load(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return J.without(load(spark, sf, "customer"), keys, ["c_custkey"]).select("c_custkey")


@check("having_match", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, sf):
    keys = load(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return J.having_match(load(spark, sf, "customer"), keys, ["c_custkey"]).select("c_custkey")


@check("merge_join", f"""WITH {SIDES} SELECT l_orderkey, l_linenumber, t.l_quantity AS old_quantity, s.l_quantity AS new_quantity
 FROM t FULL JOIN s USING (l_orderkey, l_linenumber)""")
def _(spark, sf):
    target, batch = sides(spark, sf)
    both = J.merge_join(target, M.one_per_key(batch, KEY, REST), KEY)
    return both.select(*KEY, F.col("t.l_quantity").alias("old_quantity"), F.col("s.l_quantity").alias("new_quantity"))


@check("hot_keys", """WITH c AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_returnflag FROM c WHERE n > 0.2 * (SELECT sum(n) FROM c)""")
def _(spark, sf):
    return J.hot_keys(load(spark, sf, "lineitem"), ["l_returnflag"], 0.2)


@check("salted_line_join", """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, s_name FROM lineitem
 LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 0""")
def _(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey")
    names = load(spark, sf, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    out = J.salted_join(lines, names, ["l_suppkey"], ["l_orderkey", "l_linenumber"], J.hot_keys(lines, ["l_suppkey"]))
    return out.drop("l_suppkey")


# -- aggregates ------------------------------------------------------------

@check("collapse_max", """SELECT l_orderkey, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return A.collapse_max(load(spark, sf, "lineitem"), ["l_orderkey"], ["l_quantity", "l_extendedprice"])


@check("group_quantiles", """SELECT l_returnflag, quantile_cont(l_quantity, 0.1) AS q10, median(l_quantity) AS q50,
 quantile_cont(l_quantity, 0.99) AS q99, median(floor(l_extendedprice)) AS price FROM lineitem GROUP BY 1""")
def _(spark, sf):
    from meritrix.operators.quantiles import group_quantiles

    rows = load(spark, sf, "lineitem").withColumn("price", F.floor("l_extendedprice"))
    return group_quantiles(rows, ["l_returnflag"], {
        "q10": ("l_quantity", 0.1), "q50": ("l_quantity", 0.5), "q99": ("l_quantity", 0.99), "price": ("price", 0.5)},
        0, 60000)


@check("aggregate_functions", """SELECT c_mktsegment, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS in_debt,
 count(DISTINCT c_nationkey) AS nations, round(median(floor(c_acctbal)), 2) AS mid, quantile_cont(floor(c_acctbal), 0.25) AS low,
 arg_max(c_custkey, c_custkey) AS latest, min(c_name) AS some_name,
 string_agg(DISTINCT CAST(c_nationkey % 5 AS VARCHAR), ',' ORDER BY CAST(c_nationkey % 5 AS VARCHAR)) AS fifths
FROM customer GROUP BY 1""")
def _(spark, sf):
    c = load(spark, sf, "customer")
    out = c.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), A.count_if(F.col("c_acctbal") < 0).alias("in_debt"),
        A.count_distinct("c_nationkey").alias("nations"),
        A.rounded(A.median(F.floor("c_acctbal")), 2).alias("mid"), A.percentile_cont(F.floor("c_acctbal"), 0.25).alias("low"),
        A.latest_by("c_custkey", "c_custkey").alias("latest"), A.representative("c_name").alias("some_name"),
        A.distinct_list((F.col("c_nationkey") % 5).cast("string")).alias("fifths"))
    return ids(out, "fifths")


@check("pivot_sector", f"""WITH {O.POSTINGS} SELECT experience_level, max(salary_min) FILTER (sector = 'federal') AS federal_salary_min,
 max(salary_min) FILTER (sector = 'private') AS private_salary_min FROM postings GROUP BY 1""")
def _(spark, sf):
    return A.pivot_sector(postings(spark, sf), ["experience_level"], ["salary_min"])


@check("counters", """SELECT (SELECT count(*) FROM orders) AS orders, (SELECT max(l_shipdate) FROM lineitem) AS last_shipped""")
def _(spark, sf):
    return A.counters(spark, orders=load(spark, sf, "orders").agg(F.count("*")),
                      last_shipped=load(spark, sf, "lineitem").agg(F.max("l_shipdate")))


# -- windows, order, sets --------------------------------------------------

@check("keep_best", """SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def _(spark, sf):
    return W.keep_best(load(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")])


@check("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def _(spark, sf):
    return W.top_k(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 50)


@check("rows_of_top_groups", """SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN
 (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 12)""")
def _(spark, sf):
    return W.rows_of_top_groups(load(spark, sf, "orders").select("o_custkey", "o_orderkey"), "o_custkey", 12)


@check("diff_prev", """WITH m AS (SELECT o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY ALL)
SELECT *, n - lag(n) OVER (PARTITION BY o_orderstatus ORDER BY month) AS change FROM m""")
def _(spark, sf):
    m = load(spark, sf, "orders").groupBy("o_orderstatus", F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"))
    return m.withColumn("change", W.diff_prev(m, ["o_orderstatus"], ["month"], F.col("n")))


@check("union_all", "SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier")
def _(spark, sf):
    return W.union_all([load(spark, sf, "customer").select(F.col("c_name").alias("name")),
                        load(spark, sf, "supplier").select(F.col("s_name").alias("name"))])


# -- incremental -----------------------------------------------------------

@check("stream_ingest", f"WITH {cte('payloads')} SELECT job_id, raw_data FROM payloads")
def _(spark, sf):
    """Two drops that overlap, two runs of the stream: each payload lands once."""
    rows = adapter(spark, sf, "payloads")
    landing, target, marks = (scratch_path(spark, n) for n in ("landing", "raw_adzuna", "checkpoint"))
    for part in (rows.filter("CAST(job_id AS BIGINT) % 3 = 0"), rows):
        part.select(F.col("raw_data").alias("value")).write.mode("append").text(landing)
        ingest.stream_ingest(spark, landing, target, marks).awaitTermination()
    return spark.read.parquet(target).select("job_id", "raw_data")


@check("stream_dedup", "SELECT DISTINCT event_id, event_type FROM events")
def _(spark, sf):
    """Every event arrives twice; the watermark bounds what is remembered."""
    events = load(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp"))
    landing, out, marks = (scratch_path(spark, n) for n in ("events", "unique", "checkpoint"))
    events.union(events).write.parquet(landing)
    stream = spark.readStream.schema(events.schema).parquet(landing)
    unique = ingest.stream_dedup(stream, ["event_id"], "ts", "1 day")
    unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("event_id", "event_type")


def _bronze(spark, sf, name, adapted, key):
    return adapter(spark, sf, adapted).select(key, "raw_data", F.lit(INGESTED).cast("timestamp").alias("ingestion_timestamp"))


@check("refresh", f"""WITH {FEDERAL}, p AS (SELECT job_id, 'adzuna' AS source, 'private' AS sector, r->>'$.title' AS job_title,
 r->>'$.company.display_name' AS company_or_agency, CAST(NULL AS VARCHAR) AS job_category, CAST(r->>'$.salary_min' AS DOUBLE) AS mid
 FROM (SELECT 'adzuna_' || job_id AS job_id, CAST(raw_data AS JSON) AS r FROM ({cte('payloads').split(' AS (', 1)[1][:-1]}))),
postings AS (FROM p UNION ALL SELECT job_id, source, sector, job_title, company_or_agency, job_category, {O.MID} FROM federal)
{O.RESOLVED} {O.OCCUPATIONS}
SELECT source || '::' || job_id AS posting_key, sector, company_or_agency AS company_name, {O.category_group('job_category')} AS category_group,
 occ.soc_code, mid AS salary_midpoint FROM postings LEFT JOIN resolved ON {O.NORM_B.format('job_title')} = title_normalized
 LEFT JOIN occ ON occ.soc_code = resolved.soc_code""")
def _(spark, sf):
    """Bronze to Gold through stored tables, one source after the other."""
    tables = store.SnapshotStore(spark, scratch_path(spark, "tables"))
    tables.write("raw_adzuna", _bronze(spark, sf, "raw_adzuna", "payloads", "job_id"))
    tables.write("raw_usajobs_current", _bronze(spark, sf, "raw_usajobs_current", "payloads_federal", "control_number"))
    refresh(tables, ["raw_adzuna"])
    refresh(tables, ["raw_usajobs_current"])
    return gold_view(tables)


@check("refresh_batch", SQL["refresh"])
def _(spark, sf):
    """Most payloads by a whole refresh, the rest and some of the others again as
    batches: the same content."""
    tables = store.SnapshotStore(spark, scratch_path(spark, "tables"))
    private = _bronze(spark, sf, "raw_adzuna", "payloads", "job_id")
    federal = _bronze(spark, sf, "raw_usajobs_current", "payloads_federal", "control_number")
    tables.write("raw_adzuna", private.filter("CAST(job_id AS BIGINT) % 7 > 0"))
    tables.write("raw_usajobs_current", federal.filter("CAST(control_number AS BIGINT) % 3 > 0"))
    refresh(tables, ["raw_adzuna", "raw_usajobs_current"])
    refresh_batch(tables, "raw_usajobs_current", federal.filter("CAST(control_number AS BIGINT) % 3 < 2"))
    refresh_batch(tables, "raw_adzuna", private.filter("CAST(job_id AS BIGINT) % 7 < 2"))
    return gold_view(tables)


def gold_view(tables):
    fact = tables.read("fact_job_postings")
    companies, cats, occ = (tables.read(f"dim_{n}") for n in ("company", "category", "occupation"))
    return (
        fact.join(companies.select("company_key", "company_name"), "company_key", "left")
        .join(cats.select("category_key", "category_group"), "category_key", "left")
        .join(F.broadcast(occ.select("occupation_key", "soc_code")), "occupation_key", "left")
        .select("posting_key", "sector", "company_name", F.coalesce("category_group", F.lit("Other")).alias("category_group"),
                "soc_code", "salary_midpoint")
    )
