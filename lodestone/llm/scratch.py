"""Written tables between the jobs of one operator, and names that clash with nothing."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lodestone.session import shared_folder


class Scratch:
    """Tables below the folder all executors share. A written table cuts the lineage: when an executor is lost, later
    jobs read the table again and recompute nothing before it. The folder may go once the operator's result is used."""

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        ship(spark)
        self._spark = spark
        self.folder = shared_folder(spark, purpose)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that no later job reads."""
        jvm = self._spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name the frame doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers import it; once an application. Spark hands the archive out
    itself: executors see no folder of the driver."""
    context = spark.sparkContext
    if getattr(context, "_lodestone_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._lodestone_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
