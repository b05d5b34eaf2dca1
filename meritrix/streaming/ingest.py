"""Streaming ingest of landed payload files, and load-once file guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meritrix.operators.joins import without
from meritrix.schemas import RAW_ADZUNA
from meritrix.sources.readers import adzuna_rows
from meritrix.sources.store import StoredTable, append_new, exists


def stream_ingest(spark: SparkSession, landing: str, target: str, checkpoint: str, rows=adzuna_rows,
                  keys=("job_id",), schema=RAW_ADZUNA, trigger: dict | None = None, buckets: int = 0):
    """Land new payload files, each key once.

    The file source's checkpoint remembers the files already read. Known keys
    live in the target table itself, not in streaming state, so nothing grows
    with the stream, and a batch that is retried after a failure inserts
    only what is still missing. Payloads without a key are kept in the table
    ``<target>_rejects``. Returns the started query; the default trigger drains
    what is there and stops. A new target is laid out in ``buckets`` of its key, if
    any are asked for: a micro-batch then reads those that its keys fall into.
    """
    if not exists(spark, target):
        StoredTable.create(spark, target, schema, bucket_by=keys if buckets else (), buckets=buckets)

    def land(batch: DataFrame, _epoch: int) -> None:
        append_new(batch.sparkSession, target, batch, list(keys), [F.asc("raw_data")], rejects=f"{target}_rejects")

    return (
        rows(spark.readStream.text(landing)).writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def stream_dedup(events: DataFrame, keys, event_time: str, delay: str) -> DataFrame:
    """Duplicate-free stream with bounded state: keys are forgotten once they
    are ``delay`` behind the watermark."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def pending_files(manifest: DataFrame, listing: DataFrame, force: bool = False) -> DataFrame:
    """Files of a listing that the manifest does not have yet."""
    return listing if force else without(listing, manifest, ["path"])


def mark_loaded(spark: SparkSession, manifest: str, files: DataFrame) -> dict[str, int]:
    """Remember loaded files (column ``path``) in the manifest table; a path that
    it has already stays as it is. Run after the load itself: a crash between the
    two repeats a load, which replaces its own rows, and loses none."""
    rows = files.select("path", F.current_timestamp().alias("loaded_at"))
    if not exists(spark, manifest):
        StoredTable.create(spark, manifest, rows.schema)
    return append_new(spark, manifest, rows, ["path"])


def refresh_years(df: DataFrame, path: str, years, partition_by=("year",)) -> dict[str, int]:
    """Replace the given years (current and previous, as revisions arrive) and
    leave the other partitions untouched. A given year without rows in ``df`` has
    none in the table afterwards. Partition columns besides the year are replaced
    with it. Returns the rows written and those they replace."""
    table, years = StoredTable(df.sparkSession, path), [int(y) for y in years]
    if list(partition_by) != list(table.pointer.partition_by):
        raise ValueError(f"{path} is partitioned by {table.pointer.partition_by}")
    wanted = F.col("year").isin(years)
    touched = [r.part for r in table.partitions().filter(wanted).select("part").collect()]  # one row per folder
    return table.replace(df.filter(wanted), touched)


def load_year(df: DataFrame, path: str, year: int) -> dict[str, int]:
    """One restartable unit of a back-fill: running a year again replaces it. The
    first one, which may have no rows, makes the table."""
    spark = df.sparkSession
    if not exists(spark, path):
        StoredTable.create(spark, path, df.schema, partition_by=["year"])
    return refresh_years(df, path, [year])
