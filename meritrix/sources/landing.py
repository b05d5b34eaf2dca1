"""Landing of wage files in one pass over them: good rows go to the raw table, bad
lines with their place and reason to a quarantine table, and the counts come from the
same write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meritrix.schemas import LAYOUT
from meritrix.session import scratch
from meritrix.sources.readers import FILE_COLUMN, oews_records
from meritrix.sources.store import StoredTable, append_new, exists

RAW_OEWS = T.StructType([
    T.StructField("record", T.StringType()), T.StructField("survey_year", T.IntegerType()),
    T.StructField(FILE_COLUMN, T.StringType()), T.StructField("ingestion_timestamp", T.TimestampType())])
QUARANTINE = T.StructType([
    T.StructField("bad_row_id", T.StringType()), T.StructField(FILE_COLUMN, T.StringType()), T.StructField("row_no", T.LongType()),
    T.StructField("line", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("loaded_at", T.TimestampType())])


def land_wages(spark: SparkSession, path: str, survey_year: int, target: str, quarantine: str, *,
               kind: str = "ndjson", glob: str | None = None) -> dict[str, int]:
    """Append the good rows of a drop to ``target`` and keep its bad lines in
    ``quarantine``; both tables are made at need. Returns the rows read, skipped and landed.

    The files are read once. What comes out of that is stored, counted while it is
    written, and both tables are filled from there. The quarantine comes first
    and takes a line once, however often a load is tried again; the raw table is
    the caller's to guard (``mark_loaded``), as its rows have no key.
    """
    seen = Observation()
    with scratch(spark) as keep:
        rows = keep(oews_records(spark, path, kind, glob).observe(
            seen, F.count(F.lit(1)).alias("read"), F.count("reason").alias("skipped")))
        counts = seen.get
        if counts["skipped"]:
            if not exists(spark, quarantine):
                StoredTable.create(spark, quarantine, QUARANTINE)
            append_new(spark, quarantine, bad_lines(rows), ["bad_row_id"])
        if not exists(spark, target):
            partition_by, sort_by = LAYOUT["raw_bls_oews"]
            StoredTable.create(spark, target, RAW_OEWS, partition_by=partition_by, sort_by=sort_by)
        good = rows.where("reason IS NULL").select(
            "record", F.lit(survey_year).alias("survey_year"), FILE_COLUMN, F.current_timestamp().alias("ingestion_timestamp"))
        StoredTable(spark, target).append(good)
    return {"read": counts["read"], "skipped": counts["skipped"], "landed": counts["read"] - counts["skipped"]}


def bad_lines(rows: DataFrame) -> DataFrame:
    """Bad rows with their number in the file (from 1; header and blank lines are
    not counted). A file may be read in blocks by several tasks: a row's number is its
    place in its block, after the rows of the blocks before."""
    blocks = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # blocks of a file
    before = blocks.select("file", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    numbered = rows.where("reason IS NOT NULL").join(before, ["file", "block"]).withColumn("row_no", F.col("at") + F.col("shift"))
    named = F.sha2(F.concat_ws("\n", "file", F.col("row_no").cast("string"), F.coalesce("line", F.lit(""))), 256)
    return numbered.select(named.alias("bad_row_id"), FILE_COLUMN, "row_no", "line", "reason", F.current_timestamp().alias("loaded_at"))
