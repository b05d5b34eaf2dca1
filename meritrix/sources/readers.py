"""Landing readers: JSON lines, CSV, NDJSON and Parquet drops."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meritrix.functions import lookups as L
from meritrix.schemas import JOLTS, QCEW_CSV

FILE_COLUMN = "source_file"
HEADER_THREADS = 32


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the name of the file each row came from (before other columns are
    derived: file metadata belongs to the scan)."""
    return df.withColumn(FILE_COLUMN, F.col("_metadata.file_name"))


def nullify(df: DataFrame, tokens) -> DataFrame:
    """Trim all columns and turn the given cells into NULL."""
    def cell(c):
        text = F.trim(F.col(c))
        return F.when(~text.isin(list(tokens)), text).alias(c)

    return df.select(*[cell(c) if t == "string" and c != FILE_COLUMN else F.col(c) for c, t in df.dtypes])


def name_glob(prefixes=None, suffix: str = "") -> str:
    """``pathGlobFilter`` for files that start with one of the prefixes. Lock
    files ('~...') match no prefix and are left out with everything else."""
    return "{" + ",".join(f"{p}*{suffix}" for p in prefixes or L.OEWS_FILE_PREFIXES) + "}"


def select_files(spark: SparkSession, folder: str, prefixes=None) -> DataFrame:
    """Listing of the files of a drop that belong to the load; contents are
    not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", name_glob(prefixes)).load(folder)
        .select("path", "modificationTime", "length")
    )


def _landed(lines: DataFrame) -> DataFrame:
    return lines.withColumns({
        "api_pull_date": F.current_date(), "ingestion_timestamp": F.current_timestamp(),
    })


def adzuna_rows(lines: DataFrame, search_query: str | None = None, search_country: str | None = None) -> DataFrame:
    """Landing rows from a frame with one payload per ``value``; also used on
    a stream."""
    return _landed(lines).select(
        F.get_json_object("value", "$.id").alias("job_id"),
        F.col("value").alias("raw_data"),
        F.lit(search_query).cast("string").alias("search_query"),
        F.lit(search_country).cast("string").alias("search_country"),
        "api_pull_date",
        "ingestion_timestamp",
    )


def usajobs_rows(lines: DataFrame) -> DataFrame:
    return _landed(lines).select(
        F.get_json_object("value", "$.MatchedObjectId").alias("control_number"),
        F.col("value").alias("raw_data"),
        "api_pull_date",
        "ingestion_timestamp",
    )


def read_adzuna(spark: SparkSession, path: str, search_query=None, search_country=None) -> DataFrame:
    return adzuna_rows(spark.read.text(path), search_query, search_country)


def read_usajobs(spark: SparkSession, path: str) -> DataFrame:
    return usajobs_rows(spark.read.text(path))


def read_usajobs_historical(spark: SparkSession, path: str, year: int, key: str = "control_number") -> DataFrame:
    """Parquet drop -> one JSON payload per row, whatever its columns."""
    df = spark.read.parquet(path)
    return df.select(
        F.col(key).cast("string").alias("control_number"),
        F.to_json(F.struct(*df.columns)).alias("raw_data"),
        F.lit(year).alias("source_year"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def read_qcew_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Quarterly employment files, bound by header name.

    The first eight columns must cast or the load fails; measures that do not
    cast become NULL. ``enforceSchema=false`` makes Spark check every file's
    header, so a reordered file stops the load instead of shifting columns.
    """
    raw = (
        spark.read.option("header", True).option("mode", mode).option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    )
    names = QCEW_CSV.fieldNames()
    text = nullify(with_source_file(raw.select("*", "_metadata")).select(*names, FILE_COLUMN), L.QCEW_NULL_TOKENS)
    typed = [
        (F.col(f.name).cast(f.dataType) if i < 8 else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        for i, f in enumerate(QCEW_CSV.fields)
    ]
    return text.select(
        *typed,
        F.to_json(F.struct(*names)).alias("raw_record"),
        FILE_COLUMN,
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def read_oews_ndjson(spark: SparkSession, path: str, survey_year: int, glob: str | None = None) -> DataFrame:
    """Wage records kept whole; lines that are not JSON are skipped
    (``oews_bad_rows`` counts them)."""
    return _oews_lines(spark, path, glob).filter(F.try_parse_json("value").isNotNull()).select(
        F.col("value").alias("record"),
        F.lit(survey_year).alias("survey_year"),
        FILE_COLUMN,
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def oews_bad_rows(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    return _oews_lines(spark, path, glob).groupBy(FILE_COLUMN).agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.try_parse_json("value").isNull()).alias("rows_skipped"),
    )


def _oews_lines(spark, path, glob):
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return with_source_file(reader.text(path).select("value", "_metadata"))


def _placed(df: DataFrame) -> DataFrame:
    """Where rows stand: their file, the block of it that one task reads, and an order
    inside the block."""
    return df.withColumns({"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start"),
                           "at": F.monotonically_increasing_id()})


def oews_records(spark: SparkSession, path: str, kind: str, glob: str | None = None) -> DataFrame:
    """All rows of a wage drop, ``ndjson`` or ``csv``, with what is wrong with them:
    (record, source_file, line, reason, file, block, at). ``record`` is the JSON of a good
    row; a bad one has its ``line`` and the ``reason`` instead."""
    if kind == "csv":
        rows = _oews_csv(spark, path, placed=True)
        bad, line, record, reason = F.col("bad"), F.col("line"), F.col("record"), "cells do not fit the header"
    else:
        reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
        rows = _placed(with_source_file(reader.text(path).select("value", "_metadata")).select("*", "_metadata"))
        bad, line, record, reason = F.try_parse_json("value").isNull(), F.col("value"), F.col("value"), "not JSON"
    return rows.select(F.when(~bad, record).alias("record"), FILE_COLUMN, F.when(bad, line).alias("line"),
                       F.when(bad, reason).alias("reason"), "file", "block", "at")


def read_oews_csv(spark: SparkSession, path: str, survey_year: int) -> DataFrame:
    """Wage CSV bound by header name, in any case and column order, file by file;
    one JSON record per row with upper-case keys and suppressed cells left out.
    Rows that do not fit their header are skipped; ``oews_csv_bad_rows`` counts them."""
    return _oews_csv(spark, path).filter(~F.col("bad")).select(
        "record", F.lit(survey_year).alias("survey_year"), FILE_COLUMN,
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def oews_csv_bad_rows(spark: SparkSession, path: str) -> DataFrame:
    return _oews_csv(spark, path).groupBy(FILE_COLUMN).agg(
        F.count("record").alias("rows_read"), F.count_if("bad").alias("rows_skipped"))


def _oews_csv(spark: SparkSession, path: str, placed: bool = False) -> DataFrame:
    """All rows of a drop: its files are grouped by their header line, each group
    is one scan, and the scans are put together. Header lines are read by many
    threads, as an object store answers each of them slowly."""
    files = [row.path for row in spark.read.format("binaryFile").load(path).select("path").collect()]  # names only
    by_header: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for header, file in zip(pool.map(lambda p: _first_line(spark, p), files), files):
            by_header.setdefault(header, []).append(file)
    options = {"header": True, "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    frames = []
    for _, paths in sorted(by_header.items()):
        names = spark.read.options(**options).csv(paths[0]).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "_bad")])
        raw = spark.read.options(**options, columnNameOfCorruptRecord="_bad").schema(schema).csv(paths)
        raw = with_source_file(raw.select("*", "_metadata"))
        where = ["file", "block", "at"] if placed else []
        raw = _placed(raw.select("*", "_metadata")) if placed else raw
        cells = nullify(raw.select(*names, FILE_COLUMN, "_bad", *where), L.OEWS_NULL_TOKENS)
        frames.append(cells.select(
            F.to_json(F.struct(*[F.col(n).alias(n.upper()) for n in names])).alias("record"),
            FILE_COLUMN, F.col("_bad").isNotNull().alias("bad"), *([F.col("_bad").alias("line")] if placed else []), *where))
    if not frames:
        more = ", line string, file string, block bigint, at bigint" if placed else ""
        return spark.createDataFrame([], f"record string, {FILE_COLUMN} string, bad boolean{more}")
    return reduce(DataFrame.unionByName, frames)


def _first_line(spark: SparkSession, path: str) -> str:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def read_jolts(spark: SparkSession, path: str) -> DataFrame:
    """Labour-turnover series; landed with the raw line next to the fields."""
    return spark.read.text(path).select(
        F.from_json("value", JOLTS).alias("r"), F.col("value").alias("raw_record")
    ).select("r.*", "raw_record", F.current_timestamp().alias("ingestion_timestamp"))
