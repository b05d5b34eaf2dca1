"""Keyed writes as pure functions: (target, source) -> new content.

Plain Parquet has no MERGE, so each operator returns the table's next content
and the sinks write it. ``target`` is unique on its keys; sources are reduced
to one row per key first (``order`` says which). Rows with a NULL key cannot
be identified again and are kept out here; ``append_new`` stores them as rejects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meritrix.operators.joins import merge_join
from meritrix.operators.windows import any_row, keep_best


def null_key_rows(df: DataFrame, keys) -> DataFrame:
    """Rejects: rows of which some key part is NULL."""
    return df.filter(reduce(Column.__or__, [F.col(k).isNull() for k in keys]))


def one_per_key(src: DataFrame, keys, order=None) -> DataFrame:
    """The first row per non-null key; without ``order``, one fixed row."""
    rows = src.dropna(subset=list(keys))
    return keep_best(rows, keys, order or [any_row(src)])


def new_rows(target: DataFrame, src: DataFrame, keys, order=None, unique: bool = False) -> DataFrame:
    """Source rows whose key the target lacks: what an append has to write.

    The target is first cut down to the keys of the batch. With a small batch
    that is a broadcast join, and the large target is scanned for its key
    columns but never shuffled.
    """
    keys = list(keys)
    batch = src.dropna(subset=keys) if unique else one_per_key(src, keys, order)
    seen = target.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return batch.join(seen, keys, "left_anti")


def insert_new(target: DataFrame, src: DataFrame, keys, order=None) -> DataFrame:
    """Insert-if-absent: rows already present are never refreshed."""
    return target.unionByName(new_rows(target, src, keys, order), allowMissingColumns=True)


def upsert(target: DataFrame, src: DataFrame, keys, order=None, unique: bool = False) -> DataFrame:
    """Replace matched rows, keep the rest, insert new ones.

    Columns that the source does not carry keep the target's value: the target
    is first cut to the batch's keys, and only what is left meets the batch. So
    only key columns of the source reach the target, a small batch is broadcast
    and the target is not shuffled. ``unique`` tells that the source has one row
    per key already.
    """
    keys = list(keys)
    batch = src.dropna(subset=keys) if unique else one_per_key(src, keys, order)
    untouched = [c for c in target.columns if c not in src.columns]
    named = batch.select(*keys)
    if untouched:
        held = target.join(named, keys, "left_semi").select(*keys, *untouched)
        batch = batch.join(held, keys, "left")
    kept = target.join(named, keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True).select(*target.columns)


def upsert_if_newer(target: DataFrame, src: DataFrame, keys, ts: str = "ingestion_timestamp",
                    update_cols=(), order=None, unique: bool = False) -> DataFrame:
    """Insert new keys; on a match take ``update_cols`` and the timestamp only
    when the source is strictly newer. Other columns stay as first loaded.

    Target rows that the batch does not name pass through an anti join with its
    keys; only the matched ones meet the batch as whole rows.
    """
    keys = list(keys)
    batch = src.dropna(subset=keys) if unique else one_per_key(src, keys, order or [F.desc(ts), any_row(src)])
    named = batch.select(*keys)
    both = merge_join(target.join(named, keys, "left_semi"), batch, keys)
    newer = F.col("t").isNull() | (F.col(f"s.{ts}") > F.col(f"t.{ts}"))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c not in src.columns:
            out.append(F.col(f"t.{c}").alias(c))
        elif c == ts or c in update_cols:
            out.append(F.when(newer, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("t").isNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return target.join(named, keys, "left_anti").select(*target.columns).unionByName(both.select(*out))


def update_from(target: DataFrame, lookup: DataFrame, on, col: str) -> DataFrame:
    """UPDATE .. FROM: take ``col`` from the lookup, keep it where unmatched."""
    on = list(on)
    new = lookup.select(*on, F.col(col).alias("_new"))
    return (
        target.join(new, on, "left")
        .withColumn(col, F.coalesce("_new", F.col(col)))
        .select(*target.columns)
    )


def merge_counts(target: DataFrame, src: DataFrame, keys, ts: str | None = None) -> DataFrame:
    """One row: how many source keys a merge inserts, updates or leaves. The
    target is counted and cut to the batch's keys, never shuffled for a small batch."""
    keys = list(keys)
    cols = [*keys, ts] if ts else keys
    batch = src.dropna(subset=keys).select(*cols).groupBy(*keys).agg(
        *([F.max(ts).alias(ts)] if ts else [F.count("*").alias("_n")]))
    hit = target.select(*cols).join(batch.select(*keys), keys, "left_semi")
    both = merge_join(hit, batch, keys)
    update = F.col("t").isNotNull() & (F.col(f"s.{ts}") > F.col(f"t.{ts}") if ts else F.lit(True))
    changes = both.select(F.when(F.col("t").isNull(), 1).otherwise(0).alias("inserted"),
                          F.when(update, 1).otherwise(0).alias("updated"), F.lit(0).alias("held"))
    held = target.select(F.lit(0).alias("inserted"), F.lit(0).alias("updated"), F.lit(1).alias("held"))
    total = changes.union(held).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("inserted", "updated", "held")))
    return total.select("inserted", "updated", (F.col("held") - F.col("updated")).alias("unchanged"))


def delete_before(df: DataFrame, cutoff, ts: str = "ingestion_timestamp") -> DataFrame:
    """Retention: what is left after deleting rows ingested before ``cutoff``.
    A row without a timestamp is not 'before' anything and stays."""
    t = F.col(ts)
    return df.filter(t.isNull() | (t >= F.lit(cutoff).cast(df.schema[ts].dataType)))


def truncate(tables: dict[str, DataFrame], keep=("dim_date",)) -> dict[str, DataFrame]:
    """Empty every table except the calendar, keeping schemas."""
    return {name: df if name in keep else df.limit(0) for name, df in tables.items()}


def ensure_columns(df: DataFrame, schema) -> DataFrame:
    """Add missing columns of ``schema`` as typed NULLs; never drops any."""
    have = set(df.columns)
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have})
