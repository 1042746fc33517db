"""Intermediate tables: what several steps read is written once, which also cuts the lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where one process runs all, the warehouse will do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` in the shared folder, so that what they were read from may go."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


class Stage:
    """Writes tables of one run below a shared folder and reads them back by column.

    As a context manager it removes them at the end of the run; nothing that still reads them may be used then.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.root = f"{(folder or shared_folder(spark)).rstrip('/')}/sheaf-{uuid.uuid4()}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.root)


def unstaged(df: DataFrame, name: str) -> DataFrame:
    """Keep everything in one lazy plan; for small inputs and for looking at plans."""
    return df
