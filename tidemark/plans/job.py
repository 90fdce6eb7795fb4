"""A refresh from acquisition to the validated publication, as one job."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import acquire, audit, contracts, merge
from tidemark.operators.contracts import FAIL, PASS
from tidemark.sources import commits, publish
from tidemark.sources.stage_log import StageLog
from tidemark.sources.workspace import Scratch

NOT_RUN = "NOT RUN"
#: Which contracts a field of the summary stands for.
STATUSES = {
    "schema_contract": ("SCHEMA",), "type_contract": ("TYPE",), "backup_contract": ("BACKUP",), "readback": ("READBACK",),
    "semantic_validation": ("SEMANTIC_VALIDATION", "LAST_GOOD", "MISSING_NOT_ZERO", "UNIFORM_STAMP", "ACCOUNTING", "ACQUISITION", "DUPLICATES", "COUNTS"),
    "master_non_shrink": ("MASTER_NON_SHRINK",), "unselected_preservation": ("UNSELECTED_PRESERVATION",),
}


@dataclass(frozen=True)
class Refresh:
    """What one table's refresh is made of."""

    #: The candidate's columns as they must be; ``columns`` of them come from a run or the version before.
    schema: StructType
    columns: Sequence[str]
    #: Those in which a missing value must not become zero.
    measured: Sequence[str]
    #: From attempts to a row an id, with n_attempts and n_success.
    measure: Callable[[DataFrame], DataFrame]
    #: What holds of every row of a candidate.
    rules: Mapping[str, Column]
    id: str = "id"
    stamp: str = "synced_at"
    buckets: int = 16


def _first(df: DataFrame, names: Sequence[str]) -> dict:
    row = df.first()
    return {n: row[n] for n in names}


def refresh(spark: SparkSession, what: Refresh, attempts: DataFrame, root: str, run_id: str, synced_at: datetime, now: Callable[[], datetime] = datetime.now) -> DataFrame:
    """Runs the stages in their order and returns the published version; raises where one fails, and then what was current stays so.

    acquire: the run's measures. materialize: the candidate, merged into the current version, which lies in buckets and is not moved, and written
    once, where it will be published. validate candidate: all contracts; of a failing one the offending ids are sampled to ``traces``. backup: the
    version before still has its digests. read back: the files give the fingerprint with which they were written. publish: an entry of the log makes the version current,
    unless another writer was first. validate published: the current version is this one, and has its counts.

    Every stage is a row of ``stages``, and every run, failed or not, one of ``summaries``. Without a current version all ids are new ones. A run
    without attempts publishes the version before again, under its own stamp.
    """
    scratch, log, started = Scratch(spark), StageLog(spark, run_id, f"{root}/stages"), now()
    base, current = publish.head(spark, root), publish.current_version(spark, root)
    found: dict[str, str] = {}
    counts = dict.fromkeys(("selected_count", "success_count", "failed_count", "http_request_count", "final_rows", "final_unique_ids", "duplicate_ids"))

    def summarize(final: str) -> None:
        one = lambda values: spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()])
        status = lambda names: FAIL if any(found.get(n) == FAIL for n in names) else PASS if all(found.get(n) == PASS for n in names) else NOT_RUN
        head, ids = ({n: v for n, v in counts.items() if (n.endswith("_count")) == side} for side in (True, False))
        publish.write_run_summary(audit.run_summary(run_id, started, now(), one(head), one(ids), one({n: status(c) for n, c in STATUSES.items()} | {"final_status": final})), f"{root}/summaries")

    def checked(rows: DataFrame, stage: str) -> None:
        rows = scratch.table(rows, stage.replace(" ", "_"))
        found.update({r["contract"]: r["status"] for r in rows.collect()})  # a row a contract
        contracts.require(rows, stage)

    try:
        with log.stage("acquire") as s:
            run = scratch.table(s.watch(what.measure(attempts), F.col("n_success") > 0), "run")
            counts |= _first(acquire.run_counts(run), list(counts)[:4])
        with log.stage("materialize") as s:
            none = spark.createDataFrame([], StructType([f for f in what.schema.fields if f.name == what.id or f.name in what.columns]))
            prior = none if current is None else publish.read_version(spark, root, current)
            made = merge.stamp_sync(merge.merge_snapshot(prior, run, what.columns, what.id), synced_at, what.stamp)
            made = made.select(*[F.col(f.name).cast(f.dataType) for f in what.schema.fields])
            made, written = contracts.fingerprinted(s.watch(made), "candidate")
            publish.publish(made, root, run_id, what.buckets, what.id, placed=current is not None)
            candidate = publish.readback(spark, root, run_id)
            counts |= _first(contracts.row_and_id_counts(candidate, what.id), list(counts)[4:])
        with log.stage("validate candidate"):
            kept = contracts.kept_contracts(prior, run, candidate, what.columns, what.measured, what.id)
            every = contracts.all_contracts(
                contracts.run_contracts(acquire.run_counts(run)), contracts.id_contracts(candidate, what.id), contracts.metadata_contracts(candidate, what.schema), kept,
                contracts.row_contracts(candidate, what.rules, what.stamp),
            )
            try:
                checked(every, "validate candidate")
            except RuntimeError:
                bad = contracts.offenders(prior, run, candidate, what.columns, what.measured, what.rules, what.stamp, what.id)
                contracts.samples(scratch.table(bad, "offenders"), id=what.id).withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(f"{root}/traces")
                raise
        with log.stage("backup"):
            found["BACKUP"] = PASS if publish.backup_intact(spark, root, publish.backup(spark, root)) else FAIL
            if found["BACKUP"] == FAIL:
                raise RuntimeError("contract failed at backup: the version before has changed")
        with log.stage("read back"):
            checked(contracts.reads_as_written("READBACK", written, publish.readback(spark, root, run_id)), "read back")
        with log.stage("publish"):
            commits.commit(spark, root, base, run_id, run_id, synced_at, PASS)
        with log.stage("validate published"):
            n = publish.read_version(spark, root, run_id).count()
            if publish.current_version(spark, root) != run_id or n != counts["final_rows"]:
                raise RuntimeError("contract failed at validate published: the current version is not the one that was written")
    except Exception:
        if not any(r["run_id"] == run_id for r in publish.publication_log(spark, root).where(F.col("entry") > base).select("run_id").collect()):
            commits.commit(spark, root, base, run_id, run_id, synced_at, FAIL)
        summarize(FAIL)
        raise
    summarize(PASS)
    return publish.read_version(spark, root, run_id)
