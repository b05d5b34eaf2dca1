"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "meritrix") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        # long CASE projections exceed the JIT's default method size; on a
        # cluster the same flag goes into spark.executor.extraJavaOptions
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites cost a round trip per Column
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only in local mode (tests, a
    laptop) a temporary folder takes its place where that is unset; on a cluster
    each machine would have its own, so there it is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        current = tempfile.mkdtemp(prefix="meritrix-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate files in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a frame that several steps read to the shared folder and read it
    back: it survives lost executors, and later plans start from a scan. Results
    are lazy, so the folder goes when the application ends; a frame that only the
    caller reads belongs into ``scratch``."""
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """``stored`` for frames that only the caller's own writes read: the folders
    go when the block ends, whether it ends well or not."""
    paths: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "scratch"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
