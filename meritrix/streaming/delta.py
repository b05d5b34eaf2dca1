"""Aggregates kept up by signed changes.

A view of counts and sums is stored with the version of its source that it reflects.
To bring it up to date, only the folders by which that version and the current one
differ are read: rows that went count -1, rows that came +1, and their sums are
added to the stored groups. Sums are decimals, so that adding and taking away
is exact. A run that is repeated finds the view at the current version and changes
nothing; a view whose version has been pruned is built anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meritrix.operators.filters import clean, not_null, since, state_totals
from meritrix.functions import derive as D
from meritrix.functions.aggregates import share_of
from meritrix.operators.joins import label_category
from meritrix.plans import reads, views
from meritrix.sources.store import SnapshotStore, StoredTable

#: Sums keep six places after the point.
EXACT = "decimal(24,6)"


@dataclass(frozen=True)
class Additive:
    """A view of ``source``: ``rows`` picks the rows that count, one by one, and keeps
    the column ``sign``; ``keys`` name the groups; ``sums`` and the number of
    their values are kept for each (as ``<name>`` and ``n_<name>``), and all rows as ``n``."""

    name: str
    source: str
    rows: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    sums: dict[str, str] = field(default_factory=dict)  # name to SQL expression
    derived: dict[str, str] = field(default_factory=dict)  # keys that are expressions

    def counted(self, signed: DataFrame) -> DataFrame:
        """Signed rows to one row per group that changed, with its ``group_id``."""
        rows = self.rows(signed)
        sign = F.col("sign")
        parts = [F.sum(sign).cast("bigint").alias("n")]
        for name, value in self.sums.items():
            value = F.expr(value).cast(EXACT)
            parts.append(F.sum(value * sign.cast("decimal(1,0)")).cast("decimal(38,6)").alias(name))
            parts.append(F.sum(F.when(value.isNotNull(), sign).otherwise(0)).cast("bigint").alias(f"n_{name}"))
        grouped = rows.withColumns({k: F.expr(v) for k, v in self.derived.items()}).groupBy(*self.keys).agg(*parts)
        text = F.to_json(F.struct(*self.keys), {"ignoreNullFields": "false"})
        changed = [F.col("n") != 0] + [c for x in self.sums for c in (F.coalesce(x, F.lit(0)) != 0, F.col(f"n_{x}") != 0)]
        hit = changed[0]
        for c in changed[1:]:
            hit |= c
        return grouped.where(hit).withColumn("group_id", F.sha2(text, 256)).withColumns(
            {x: F.coalesce(x, F.lit(0).cast("decimal(38,6)")) for x in self.sums})

    def added(self, target: DataFrame, source: DataFrame, keys, unique: bool) -> DataFrame:
        """Merge function: changes are added to their groups; groups without rows go."""
        named = source.select("group_id")
        hit = target.join(named, "group_id", "left_semi").unionByName(source)
        amounts = ["n", *(x for s in self.sums for x in (s, f"n_{s}"))]
        new = hit.groupBy("group_id").agg(
            *(F.first(k).alias(k) for k in self.keys),
            *(F.sum(x).cast(hit.schema[x].dataType).alias(x) for x in amounts))
        kept = target.join(named, "group_id", "left_anti")
        return kept.unionByName(new.where("n != 0"))


def _mean(name: str) -> Column:
    """Rounded mean of a kept sum; NULL without values."""
    return F.round(F.col(name).cast("double") / F.nullif(F.col(f"n_{name}"), F.lit(0)), 0)


_ANY_PAY = "coalesce(salary_min, salary_max)"
_ENTRY = "cast(is_entry_level AS int)"

VIEWS = [
    Additive("agg_experience", "jobs_unified", clean,
             ("sector", "source", "experience_level", "employment_type", "job_category")),
    Additive("agg_geo", "jobs_unified", lambda rows: not_null(clean(rows), ["location_state"]),
             ("location_state", "location_city", "location_country", "sector", "source", "experience_level"),
             {"entry": _ENTRY, "pay": _ANY_PAY}),
    Additive("agg_remote", "jobs_unified", clean, ("sector", "source", "remote_type", "experience_level")),
    Additive("agg_category", "jobs_unified", clean, ("sector", "source", "job_category", "experience_level")),
    Additive("agg_employers", "jobs_unified", lambda rows: not_null(clean(rows), ["company_or_agency"]),
             ("sector", "source", "company_or_agency", "experience_level"), {"entry": _ENTRY, "pay": "salary_min"}),
    # by day, as the months that the view covers start on any day of a week
    Additive("agg_trends", "jobs_unified", lambda rows: not_null(clean(rows), ["posted_date"]),
             ("posted_date", "sector", "source", "experience_level"), {"entry": _ENTRY, "pay": "salary_min"}),
    Additive("agg_majors", "fact_job_postings", lambda rows: not_null(rows, ["occupation_key"]), ("occupation_key", "sector")),
    # three times the mean of three whole numbers is whole, so its sums are exact
    Additive("agg_employment", "fact_qcew", state_totals, ("state_fips", "own_label", "year", "qtr"),
             {"months": "round(avg_monthly_emplvl * 3, 6)", "wages": "total_qtrly_wages", "weekly": "avg_wkly_wage"},
             {"state_fips": "left(area_fips, 2)"}),
]


def maintain(tables: SnapshotStore, view: Additive) -> dict[str, int]:
    """Bring a view up to the current version of its source. Returns the groups that
    changed, and whether it was built anew."""
    source = tables.table(view.source)
    now = {view.source: source.pointer.number}
    table = tables.table(view.name) if tables.exists(view.name) else None
    then = table.pointer.derived.get(view.source) if table else None
    if then == now[view.source]:
        return {"changed": 0, "rebuilt": 0}
    if then is None or not source.has_version(then):
        whole = view.counted(source.read().withColumn("sign", F.lit(1)))
        if table is None:
            table = StoredTable.create(tables.spark, f"{tables.root}/{view.name}", whole.schema,
                                       bucket_by=["group_id"], commit=False)
        table.overwrite(whole, now)
        return {"changed": table.rows_in(), "rebuilt": 1}
    counts = table.upsert(view.counted(source.changes_since(then)), ["group_id"], merge=view.added, derived=now)
    return {"changed": counts["inserted"] + counts["updated"], "rebuilt": 0}


def maintain_all(tables: SnapshotStore) -> dict[str, dict[str, int]]:
    """All views whose source exists."""
    return {v.name: maintain(tables, v) for v in VIEWS if tables.exists(v.source)}


# -- the views of plans.views and plans.reads, from their kept counts --------------

def experience_by_sector(tables: SnapshotStore) -> DataFrame:
    return views.experience_shares(tables.read("agg_experience").drop("group_id"), tables.read("dim_category"))


def geo_distribution(tables: SnapshotStore) -> DataFrame:
    return tables.read("agg_geo").select(
        "location_state", "location_city", "location_country", "sector", "source", "experience_level",
        F.col("n").alias("job_count"), F.col("entry").cast("bigint").alias("entry_level_count"), _mean("pay").alias("avg_salary"))


def remote_by_sector(tables: SnapshotStore) -> DataFrame:
    counts = tables.read("agg_remote").select("sector", "source", "remote_type", "experience_level", F.col("n").alias("job_count"))
    return share_of(counts, ["sector", "source"])


def category_by_sector(tables: SnapshotStore) -> DataFrame:
    counts = tables.read("agg_category").select("sector", "source", "job_category", "experience_level", F.col("n").alias("job_count"))
    return share_of(label_category(counts, tables.read("dim_category")), ["sector", "source"])


def top_employers(tables: SnapshotStore) -> DataFrame:
    per_name = tables.read("agg_employers").select(
        "sector", "source", "company_or_agency", "experience_level", F.col("n").alias("job_count"),
        F.col("entry").cast("bigint").alias("entry_level_count"), _mean("pay").alias("avg_salary_min"))
    return views.employers_labelled(per_name, tables.read("dim_company"))


def posting_trends(tables: SnapshotStore, as_of, months: int = 6) -> DataFrame:
    days = since(tables.read("agg_trends"), as_of, months=months)
    weeks = days.groupBy(F.date_trunc("week", "posted_date").cast("date").alias("week_start"), "sector", "source", "experience_level").agg(
        F.sum("n").alias("job_count"), F.sum("entry").cast("bigint").alias("entry_level_count"),
        F.sum("pay").alias("pay"), F.sum("n_pay").alias("n_pay"))
    return weeks.select("week_start", "sector", "source", "experience_level", "job_count", "entry_level_count",
                        _mean("pay").alias("avg_salary_min")).orderBy("week_start", "sector")


def soc_major_distribution(tables: SnapshotStore) -> DataFrame:
    return reads.majors_labelled(tables.read("agg_majors").drop("group_id"), tables.read("dim_occupation"))


def qcew_employment_trend(tables: SnapshotStore) -> DataFrame:
    def total(name, part: float = 1.0):
        return F.when(F.col(f"n_{name}") > 0, F.col(name).cast("double") / part)

    return tables.read("agg_employment").select(
        "state_fips", "own_label", "year", "qtr", total("months", 3.0).alias("state_employment"),
        total("wages").alias("state_qtrly_wages"),
        (F.col("weekly").cast("double") / F.nullif("n_weekly", F.lit(0))).alias("state_avg_wkly_wage"),
        D.quarter_start("year", "qtr").alias("quarter_start_date")).orderBy("state_fips", "own_label", "year", "qtr")
