"""Parquet tables, checkpoints and sessions."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def session(master: str = "local[*]", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session with the settings the operators expect (UTC, AQE, Arrow)."""
    spark = (
        SparkSession.builder.master(master)
        .appName("rainloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of a folder of Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names for all executors; one of this machine only in local mode where that is unset.

    RuntimeError on a cluster without that setting, since executors can't read each other's disks.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


_staged: set[str] = set()


def staged(df: DataFrame) -> DataFrame:
    """`df` written once as a table in the shared folder and read again; cuts the lineage and outlives lost executors.

    The table stays until `clear_staged`, or until the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    if not _staged:
        atexit.register(clear_staged, spark)
    _staged.add(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Removes the tables that `staged` has written; results that still read them can't be evaluated any more."""
    if spark.sparkContext._jsc is None:  # the session has ended before
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _staged:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(conf).delete(path, True)


def broadcast_if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """`df` marked for broadcast if it has at most `rows` rows (counted), unmarked otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def write_partitioned(df: DataFrame, path: str, keys: list[str]) -> None:
    """Writes `df` as zstd Parquet partitioned by `keys`, gathered by key; adaptive execution splits keys with too many rows among tasks."""
    df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).option("compression", "zstd").parquet(path)


def file_census(spark: SparkSession, folder: str, pattern: str = "*.png") -> int:
    """How many files of a folder and those below match `pattern`; their content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return files.load(folder).select("path").count()
