"""Reading input tables, and the folder for tables a run writes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS_PER_CORE = 2
# How tables of a run are stored: texts take about half the space of the default.
STORED_AS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "7",
    "parquet.page.size": str(4 << 20),
}


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Give every core work where a scan has fewer splits than there are cores.

    A table of one row group is read by one task, and everything narrow that
    follows stays in it. Scans with enough splits, which is any large table, are
    returned as they are: no row moves. ``keys`` name a row, so that none is hot.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores * PARTITIONS_PER_CORE, *keys)


def read_table(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    return spread(spark.read.parquet(path), *keys)


def fetched(pages: DataFrame, url: str | None = None) -> DataFrame:
    """Pages that were fetched, or the one with this address."""
    present = pages.where(F.col("html").isNotNull())
    return present if url is None else present.where(F.col("url") == url)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored there, on whatever storage Spark reads."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end there, by the mark that Spark's writers leave."""
    return exists(spark, f"{path}/_SUCCESS")


def run_folder(spark: SparkSession) -> str:
    """A new folder on the storage all executors share.

    The cluster names that storage in spark.checkpoint.dir. Only on one machine may it
    be unset; a temporary folder then takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp()
    return f"{base.rstrip('/')}/reviewloom-{uuid.uuid4().hex}"
