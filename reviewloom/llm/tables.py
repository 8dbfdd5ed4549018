"""Reading the given tables and keeping intermediate ones on shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.sources.tables import run_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Workspace:
    """A new folder on the storage that spark.checkpoint.dir names.

    ``keep`` writes a table and reads it back: what follows starts from files that
    outlive any executor, and nothing above is computed twice.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = run_folder(spark)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(self.path(name))
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def put_file(self, name: str, content: bytes) -> str:
        """A plain file in the folder, sent to every executor; returns its name there,
        which no other file of the session has."""
        spark = self.spark
        name = f"{uuid.uuid4().hex}-{name}"
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        stream.write(content)
        stream.close()
        spark.sparkContext.addFile(self.path(name))
        return name


def hash_sample(frame: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows, chosen by the hash of their keys; all, if there are fewer."""
    total = frame.count()
    if total <= rows:
        return frame
    share = (1 << 20) * rows // total
    return frame.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 20)) < share)
