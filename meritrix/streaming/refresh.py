"""Dependency-ordered refresh of Silver and Gold: whole, or by what a batch touches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from meritrix.functions import derive as D
from meritrix.operators.merge import merge_counts, upsert
from meritrix.operators.resolver import resolve_soc
from meritrix.plans import gold, silver
from meritrix.schemas import ROWS_PER_BUCKET
from meritrix.session import scratch
from meritrix.sources.store import SnapshotStore

POSTING_SOURCES = {"raw_adzuna": silver.transform_adzuna, "raw_usajobs_current": silver.transform_usajobs}


def _jobs(tables: SnapshotStore, old: DataFrame | None, changed: set[str]) -> None:
    """Merges each changed source, so that partitions without its keys keep their
    files. A table that has outgrown its key buckets is written whole."""
    name, keys = "jobs_unified", silver.POSTING_KEYS
    for bronze, transform in POSTING_SOURCES.items():
        if bronze not in changed:
            continue
        raw = tables.table(bronze)
        rows = transform(raw.read())
        if not tables.exists(name):
            tables.write(name, rows, buckets=raw.rows_in() // ROWS_PER_BUCKET)
            continue
        table = tables.table(name)
        if table.rows_in() // ROWS_PER_BUCKET >= 2 * max(table.pointer.buckets, 1):
            tables.write(name, upsert(table.read(), rows, keys, unique=True))
        else:
            table.upsert(rows, keys, lasting=True)


def _posting_fact(tables: SnapshotStore, old: DataFrame | None) -> DataFrame:
    """Build and occupation back-fill in one go, so the fact is written once."""
    dims = {n: tables.read(f"dim_{n}") for n in ("location", "company", "category")}
    titles = tables.read("dim_occupation_soc"), tables.read("dim_occupation")
    return gold.fact_of_jobs(tables.read("jobs_unified"), dims, titles, old)


def _from(name: str, build):
    """Step that derives its table from one other table."""
    return lambda tables, old, changed: build(tables.read(name), old)


# (table, tables whose change triggers it, build); dimensions before facts. A build
# returns the new content, or None where it has written it.
STEPS = [
    ("jobs_unified", tuple(POSTING_SOURCES), _jobs),
    ("bls_qcew_quarterly", ("raw_bls_qcew",), _from("raw_bls_qcew", silver.transform_qcew)),
    ("bls_oews_annual", ("raw_bls_oews",), _from("raw_bls_oews", silver.transform_oews)),
    ("dim_location", ("jobs_unified",), _from("jobs_unified", gold.dim_location)),
    ("dim_company", ("jobs_unified",), _from("jobs_unified", gold.dim_company)),
    ("dim_category", ("jobs_unified",), _from("jobs_unified", gold.dim_category)),
    ("dim_occupation_soc", ("jobs_unified",), _from("jobs_unified", lambda jobs, old: resolve_soc(jobs, existing=old))),
    ("dim_occupation", ("dim_occupation_soc",), _from("dim_occupation_soc", gold.dim_occupation)),
    ("fact_job_postings", ("jobs_unified",), lambda tables, old, changed: _posting_fact(tables, old)),
    ("fact_qcew", ("bls_qcew_quarterly",), _from("bls_qcew_quarterly", gold.fact_qcew)),
    ("fact_oews_wages", ("bls_oews_annual", "dim_occupation"),
     lambda tables, old, changed: gold.fact_oews_wages(
         tables.read("bls_oews_annual"), tables.read("dim_occupation"), old)),
]


def refresh(tables: SnapshotStore, changed, calendar=("1990-01-01", "2030-12-31")) -> dict[str, dict[str, int]]:
    """Rebuild every table downstream of the ``changed`` ones, in order.

    Returns ``{table: {rows, inserted}}`` from the file footers. Each step
    reads stored snapshots and writes a new one, so lineage ends at every
    table. A step whose other inputs do not exist yet is left for later.
    """
    changed, report = set(changed), {}
    if not tables.exists("dim_date"):
        tables.write("dim_date", gold.dim_date(tables.spark, *calendar))
    for name, triggers, build in STEPS:
        if not changed.intersection(triggers):
            continue
        if name == "fact_oews_wages" and not all(map(tables.exists, triggers)):
            continue
        old = tables.read_or_none(name)
        before = 0 if old is None else old.count()
        content = build(tables, old, changed)
        rows = (tables.read(name) if content is None else tables.write(name, content)).count()
        report[name] = {"rows": rows, "inserted": rows - before}
        changed.add(name)
    return report


#: Dimension, the posting columns that name its rows, its natural key, its build.
DIMENSIONS = [
    ("dim_location", ["location_city", "location_state", "location_country"], ["city", "state", "country"], gold.dim_location),
    ("dim_company", ["company_or_agency"], ["company_name"], gold.dim_company),
    ("dim_category", ["job_category"], ["category_name"], gold.dim_category),
]


def refresh_batch(tables: SnapshotStore, bronze: str, batch: DataFrame) -> dict[str, dict[str, int]]:
    """Carry new payloads of one source through Silver and Gold.

    Employment and wage records are landed, too (see ``_statistics``). Postings and facts are partitioned tables of which only the partitions that
    the batch touches are rewritten. Dimensions are rebuilt for the labels that the
    batch brings or takes away, from all postings that carry these; the large
    tables are scanned for that, but not shuffled for a small batch. All tables
    must exist (``refresh`` makes them). Returns inserted, updated and unchanged
    rows per table; unchanged ones count within the rewritten partitions.
    """
    spark, report = tables.spark, {}
    if bronze in STATISTICS:
        return _statistics(tables, bronze, batch)
    with scratch(spark) as keep:
        jobs = keep(POSTING_SOURCES[bronze](batch))
        keys = silver.POSTING_KEYS
        before = tables.read("jobs_unified").join(jobs.select(*keys), keys, "left_semi")
        changed = keep(jobs.unionByName(before))  # the labels of now and of before
        report["jobs_unified"] = tables.merge("jobs_unified", jobs, keys, lasting=True)
        postings = tables.read("jobs_unified")
        for name, columns, natural, build in DIMENSIONS:
            carried = postings.join(changed.select(*columns).dropna().distinct(), columns, "left_semi")
            report[name] = _renew(tables, keep, name, natural, build, carried)
        title = D.norm_b("job_title").alias("_title")
        titled = postings.filter("job_title IS NOT NULL").withColumn("_title", title)
        names = changed.filter("job_title IS NOT NULL").select(title).distinct()
        carried = titled.join(names, "_title", "left_semi").drop("_title")
        report["dim_occupation_soc"] = _renew(
            tables, keep, "dim_occupation_soc", ["title_normalized"], lambda rows, old: resolve_soc(rows, existing=old), carried)
        resolved = tables.read("dim_occupation_soc")
        report["dim_occupation"] = _renew(tables, keep, "dim_occupation", ["soc_code"], gold.dim_occupation, resolved)

        dims = {n: tables.read(f"dim_{n}") for n in ("location", "company", "category")}
        rows = keep(gold.fact_job_postings(jobs, dims).drop("occupation_key"))
        held = tables.read("fact_job_postings").join(rows.select("posting_key"), "posting_key", "left_semi")
        rows = rows.join(held.select("posting_key", "occupation_key"), "posting_key", "left")
        fact = gold.update_postings_soc(rows, jobs, resolved, tables.read("dim_occupation"))
        report["fact_job_postings"] = tables.merge("fact_job_postings", fact, ["posting_key"])
    return report


#: Raw table: the columns that its partitions are found by, its Silver build and table,
#: the natural key of that, and the fact with its build.
STATISTICS = {
    "raw_bls_qcew": (["year", "qtr"], silver.qcew_rows, "bls_qcew_quarterly", "qcew_key", "fact_qcew",
                     lambda tables, rows: gold.fact_qcew(rows)),
    "raw_bls_oews": (["survey_year"], silver.oews_rows, "bls_oews_annual", "oews_key", "fact_oews_wages",
                     lambda tables, rows: gold.fact_oews_wages(rows, tables.read("dim_occupation"))),
}


def _statistics(tables: SnapshotStore, bronze: str, batch: DataFrame) -> dict[str, dict[str, int]]:
    """Land employment or wage records and rewrite what they touch.

    A key's row is made from all its records, earlier loads included, so the records
    of the batch's keys are read again, from the raw partitions of the batch's periods
    only. Silver and the fact rewrite the partitions of these keys. The result
    is what a whole refresh gives.
    """
    periods, build, silver_name, key, fact_name, build_fact = STATISTICS[bronze]
    with scratch(tables.spark) as keep:
        batch = keep(batch)
        raw = tables.table(bronze)
        raw.append(batch)
        named = keep(build(batch).select(key).distinct())
        touched = raw.read(raw.parts_of(batch.select(*periods).dropna()))
        rows = keep(build(touched).join(named, key, "left_semi"))
        report = {silver_name: tables.merge(silver_name, rows, [key], lasting=True)}
        if tables.exists(fact_name):
            report[fact_name] = tables.merge(fact_name, build_fact(tables, rows), [key], lasting=True)
    return report


def _renew(tables: SnapshotStore, keep, name: str, natural: list[str], build, rows: DataFrame) -> dict[str, int]:
    """A new snapshot of a dimension in which the rows built from ``rows`` replace
    those of the same natural key; surrogate keys stay."""
    old = tables.read(name)
    new = keep(build(rows, old))  # the old rows, and those built
    counts = merge_counts(old, new.subtract(old), natural).first().asDict()
    tables.write(name, new)
    return counts
