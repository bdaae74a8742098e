"""The driver tables, tables in the shared folder, and the package for Python workers."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python workers, once a session's context."""
    context = spark.sparkContext
    if not getattr(context, "_vistaframe_shipped", False):
        folder = tempfile.mkdtemp(prefix="spark-ship-")
        context.addPyFile(shutil.make_archive(f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name))
        context._vistaframe_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset a local master gets a new local one; a cluster raises."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, **options: str) -> DataFrame:
    """df as a Parquet table in the shared folder, with options of its writer: lineage ends here and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder that a computation needs until its result is written."""

    def __init__(self) -> None:
        self.held: list[tuple[SparkSession, str]] = []

    def written(self, df: DataFrame) -> DataFrame:
        table = written(df)
        self.held += [(df.sparkSession, path) for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}]
        return table

    def drop(self) -> None:
        """Deletes the tables through the file system that Spark wrote them to."""
        for spark, path in self.held:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        self.held = []
