"""Tables of one job in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder of our own where that is unset and all runs in one process, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: driver and executors need a folder that they share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


class Scratch:
    """A folder for one job's tables. A lost executor is recovered from them, and they cut the lineage."""

    #: Folders of this process that were not freed.
    made: ClassVar[list[str]] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}"
        self.made.append(self.root)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        """Frees a table that no later read needs."""
        _delete(self.spark, f"{self.root}/{name}")


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Frees the scratch folders that are made inside, at its end, failed or not: what is read later has to be written elsewhere by then."""
    before = len(Scratch.made)
    try:
        yield
    finally:
        for root in Scratch.made[before:]:
            _delete(spark, root)
        del Scratch.made[before:]


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
