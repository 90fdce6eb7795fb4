"""Shared pieces of the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.sources.workspace import Scratch as Scratch

PACKAGE = Path(__file__).resolve().parents[1]
#: Rows and bytes that go to a Python worker at once, where the session does not say: texts are long, and workers small.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": (str(2**31 - 1), str(16 * 2**20))}


def ship(spark: SparkSession) -> None:
    """Readies a session for functions that run on its executors: sends them the package's modules, once a Spark context, and bounds batches."""
    for name, (default, ours) in BATCH.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, ours)
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    at = Path(tempfile.mkdtemp(prefix="tidemark-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(at, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f"{PACKAGE.name}/{f.relative_to(PACKAGE)}")
    context.addPyFile(str(at))
    context._tidemark_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_bound(n: int, most: int) -> int:
    """The 64-bit hash at or below which about twice ``most`` of n rows lie; all, where n is small."""
    return 2**63 - 1 if n <= 2 * most + 64 else -(2**63) + (2 * most + 64) * 2**64 // n


def drawn(df: DataFrame, by: str, totals: dict, most: int, *keys: str) -> DataFrame:
    """At most ``most`` rows of each class, the first by a hash of ``keys``; ``totals`` has each class's rows in the table.

    A bound on the whole 64-bit hash, at twice the share that is wanted, leaves few rows, however large the table; of those the
    first are exactly what an ordering of all rows would give. Rows of classes beyond ``totals`` are left out.
    """
    if not totals:
        return df.limit(0)
    lot = F.xxhash64(*keys, F.lit("sample"))
    bounds = F.create_map(*[x for name, n in totals.items() for x in (F.lit(name), F.lit(hash_bound(n, most)).cast("long"))])
    first = W.partitionBy(by).orderBy("_lot", *keys)
    near = df.withColumn("_lot", lot).where(F.col("_lot") <= bounds[F.col(by)])
    return near.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= most).drop("_lot", "_at")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often body's lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)
