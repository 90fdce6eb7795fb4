"""Readers of landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tidemark.sources.files import read_files


def read_attempts(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Acquisition attempts as they landed, read-only and with the schema that is expected of them."""
    return spark.read.schema(schema).parquet(path)


def scan_corpus(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``(path, content, length)`` of a manifest table; rows without a path are dropped.

    Of a directory, scan_files gives the same: Spark's own file sources never list names that begin with a dot or an underscore.
    """
    return df.where(F.col(path).isNotNull() & (F.col(path) != "")).select(F.col(path).alias("path"), F.col(content).cast("binary").alias("content")).withColumn("length", F.octet_length("content").cast("long"))


def scan_files(spark: SparkSession, root: str, max_bytes: int = 2_000_000) -> DataFrame:
    """``(path, content, length)`` of the files below a folder. Contents over ``max_bytes``, which no scan looks into, are not read."""
    return read_files(spark, root, max_bytes)


def write_split(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of coerce_or_reject, written in one pass as two folders of one table; each is then read by itself."""
    spark = checked.sparkSession
    checked.withColumn("rejected", F.size("problems") > 0).write.partitionBy("rejected").mode("errorifexists").parquet(path)
    kept = spark.read.schema(StructType([*checked.schema.fields, StructField("rejected", BooleanType())])).parquet(path)
    return kept.where(~F.col("rejected")).drop("problems", "rejected"), kept.where("rejected").drop("rejected")
