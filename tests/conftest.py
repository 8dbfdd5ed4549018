import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__  # noqa: E402, F401  (registers the packages for the executors)
from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(4)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Applies a Column function to Python values and returns Python values."""
    from pyspark.sql import functions as F

    def run(function, values, kind="string"):
        rows = [(i, value) for i, value in enumerate(values)]
        frame = spark.createDataFrame(rows, f"i int, x {kind}")
        found = frame.select("i", function(F.col("x")).alias("y")).collect()
        return [row.y for row in sorted(found, key=lambda row: row.i)]

    return run
