"""Publication of snapshots as immutable versions, made current by an entry of the publication log."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import digests
from tidemark.operators.contracts import FAIL, PASS, contract_row, fingerprint, require, same_rows
from tidemark.sources import buckets as B
from tidemark.sources import commits
from tidemark.sources.commits import ConcurrentPublication, current_version, exists, head, publication_log, rollback

__all__ = ["ConcurrentPublication", "current_version", "head", "publication_log", "rollback"]

#: What previous_version needs of a log.
LOG_SCHEMA = "run_id string, version string, published_at timestamp, status string"


def _at(root: str, version: str) -> str:
    return f"{root}/versions/{version}"


def _bucketed(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/_manifest.json")


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    """A version; one in buckets comes with these known to the planner."""
    path = _at(root, version)
    return B.read_bucketed(spark, path) if _bucketed(spark, path) else spark.read.parquet(path)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The published table: what the log, replayed, leaves current."""
    version = current_version(spark, root)
    if version is None:
        raise LookupError(f"nothing is published under {root}")
    return read_version(spark, root, version)


def publish(df: DataFrame, root: str, version: str, buckets: int | None = None, id: str = "id", placed: bool = False) -> None:
    """Writes a version that no reader sees yet; an existing version is never overwritten.

    With ``buckets`` it lies in so many buckets by id, with a hash tree over them, and a later merge into it shuffles the run only;
    ``placed`` says that ``df`` is such a merge, whose rows already lie by bucket.
    """
    if buckets is None:
        df.write.mode("errorifexists").parquet(_at(root, version))
        return
    B.write_bucketed(df, _at(root, version), buckets, id, placed)
    B.write_manifest(df.sparkSession, _at(root, version), df.schema, buckets, id)


def readback(spark: SparkSession, root: str, version: str, schema: StructType | None = None) -> DataFrame:
    """What was written, read afresh; a schema that is expected spares a look into the files."""
    return read_version(spark, root, version) if schema is None else spark.read.schema(schema).parquet(_at(root, version))


def readback_contract(expected: DataFrame, root: str, version: str, afresh: bool = True) -> DataFrame:
    """READBACK: what was written reads as it should. Of a version in buckets digests are compared, and rows only where these differ.

    Right after publication, whose manifest is digested from the written files, these need not be read ``afresh``.
    """
    spark, path = expected.sparkSession, _at(root, version)
    if not _bucketed(spark, path):
        return same_rows(expected, readback(spark, root, version))
    m = B.read_manifest(spark, path)
    there = digests.tree_of(B.read_bucketed(spark, path), m["buckets"], m["id"]) if afresh else m["tree"]
    bad = digests.differing(there, digests.tree_of(expected, m["buckets"], m["id"]))
    if not bad:
        return contract_row("READBACK", spark.range(1), F.lit(0))
    return same_rows(digests.in_buckets(expected, bad, m["buckets"], m["id"]), B.read_buckets(spark, path, bad).select(*expected.columns))


def backup(spark: SparkSession, root: str) -> dict | None:
    """The current version is the backup of the next: its name and what proves it unchanged. None if nothing is published."""
    version = current_version(spark, root)
    if version is None:
        return None
    if _bucketed(spark, _at(root, version)):
        m = B.read_manifest(spark, _at(root, version))
        return {"version": version, "root": m["root"]}
    return {"version": version, **fingerprint(read_version(spark, root, version)).first().asDict()}


def backup_intact(spark: SparkSession, root: str, kept: dict | None) -> bool:
    """Whether the backup still reads as it did."""
    if kept is None:
        return True
    if "root" in kept:
        path = _at(root, kept["version"])
        return B.read_manifest(spark, path)["root"] == kept["root"] and not B.damaged_buckets(spark, path)
    return fingerprint(read_version(spark, root, kept["version"])).first().asDict() == {k: v for k, v in kept.items() if k != "version"}


def publish_validated(candidate: DataFrame, contracts: DataFrame, root: str, run_id: str, published_at: datetime, base: int | None = None, version: str | None = None, buckets: int | None = None) -> DataFrame:
    """Publishes a candidate whose contracts hold, and makes it current once it reads back as written.

    ``base`` is the log's head when the candidate was begun (now, if not given): if another version has become current since, the candidate was built
    on what is no longer there, and ConcurrentPublication is raised. A failing contract, a damaged backup, a version that reads
    back otherwise and a conflict are logged as FAIL and raised; what was current stays so.
    """
    spark, version = candidate.sparkSession, version or run_id
    base = head(spark, root) if base is None else base
    try:
        require(contracts, "validate candidate")
        kept = backup(spark, root)
        publish(candidate, root, version, buckets)
        require(readback_contract(candidate, root, version, afresh=False), "read back")
        if not backup_intact(spark, root, kept):
            raise RuntimeError("contract failed at backup: the version before has changed")
        commits.commit(spark, root, base, run_id, version, published_at, PASS)
    except Exception:
        commits.commit(spark, root, base, run_id, version, published_at, FAIL)
        raise
    return read_version(spark, root, version)


def publish_onto(spark: SparkSession, root: str, run_id: str, published_at: datetime, build: Callable[[DataFrame | None], tuple[DataFrame, DataFrame]], attempts: int = 3, buckets: int | None = None) -> DataFrame:
    """Builds a candidate and its contracts on what is current, and publishes it; where another writer comes first, builds again on what that one published.

    ``build`` gets the current version, or None, and returns candidate and contracts. Each attempt is a version of its own.
    """
    for k in range(1, attempts + 1):
        base, version = head(spark, root), current_version(spark, root)
        candidate, contracts = build(None if version is None else read_version(spark, root, version))
        try:
            return publish_validated(candidate, contracts, root, run_id, published_at, base, run_id if k == 1 else f"{run_id}.{k}", buckets)
        except ConcurrentPublication:
            if k == attempts:
                raise
    raise ValueError("at least one attempt is needed")


def previous_version(log: DataFrame) -> DataFrame:
    """``log`` with the passed version before each, by time: what a backup or rollback of it means.

    The log has one row a run, so that one ordered window over it is small.
    """
    order = W.partitionBy(F.lit(0)).orderBy("published_at", "run_id").rowsBetween(W.unboundedPreceding, -1)
    return log.withColumn("previous", F.last(F.when(F.col("status") == "PASS", F.col("version")), ignorenulls=True).over(order))


def write_run_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("append").parquet(path)
