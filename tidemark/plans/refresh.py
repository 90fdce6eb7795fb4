"""The refresh exercised on ``events``: users are ids, events after the cut are this run's attempts, those before made the master."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType, TimestampNTZType

from tidemark.functions.missing import sum_or_missing
from tidemark.operators import acquire, audit, contracts, merge
from tidemark.sources import publish
from tidemark.sources.tables import read_attempts
from tidemark.sources.workspace import Scratch

CUT = datetime(2024, 1, 30, 12)
SYNCED_AT = datetime(2024, 2, 1)
METRICS = ["n_ok", "purchase_value", "last_ok_at", "last_value"]
#: What is expected of the events as they landed.
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
CANDIDATE = (
    StructType().add("id", LongType()).add("n_ok", LongType()).add("purchase_value", DoubleType()).add("last_ok_at", TimestampNTZType())
    .add("last_value", DoubleType()).add("status", StringType()).add("synced_at", TimestampNTZType())
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_attempts(events: DataFrame) -> DataFrame:
    ok = (F.col("event_type") != "error").alias("ok")
    return events.select(F.col("event_id").alias("attempt_id"), F.col("user_id").alias("id"), "ts", ok, "event_type", "value")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_attempts(spark, f"{sf_dir}/events.parquet", EVENTS)


def events_as_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_attempts(_events(spark, sf_dir))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_attempts(_events(spark, sf_dir).where(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz")))


def measured(rows: DataFrame) -> DataFrame:
    """Per id: the run's measures, null where nothing was measured, and the newest success."""
    metrics = {
        "n_ok": F.count_if("ok"),
        "purchase_value": F.round(sum_or_missing(F.col("value"), F.col("ok") & (F.col("event_type") == "purchase")), 2),
        "last_ok_at": F.max(F.when(F.col("ok"), F.col("ts"))),
    }
    return acquire.measure(rows, metrics, last={"last_value": "value"})


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = _as_attempts(_events(spark, sf_dir).where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")))
    return measured(before.where("ok")).select("id", *METRICS)


def reduced_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master(spark, sf_dir).where(F.col("id") % 10 != 3)


def candidate(spark: SparkSession, sf_dir: str, prior: DataFrame | None = None) -> DataFrame:
    """Attempts aggregated once and joined once with the master on id."""
    prior = master(spark, sf_dir) if prior is None else prior
    return stamped(merge.merge_snapshot(prior, measured(attempts(spark, sf_dir)), METRICS))


def stamped(df: DataFrame) -> DataFrame:
    at = merge.stamp_sync(df, SYNCED_AT)
    return at.withColumn("synced_at", F.col("synced_at").cast("timestamp_ntz"))


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquire.run_counts(acquire.attempts_per_id(attempts(spark, sf_dir)))


@dataclass
class Run:
    """The tables of one run, each written once and then read by whatever checks or publishes them."""

    run: DataFrame
    prior: DataFrame
    candidate: DataFrame
    #: Rows by stage, counted as the tables were written.
    stages: dict[str, int]
    #: The first and the last attempt.
    first: datetime | None = None
    last: datetime | None = None
    #: By table, the fingerprint that was taken as it was written.
    written_as: dict[str, Observation] = field(default_factory=dict)

    @classmethod
    def written(cls, spark: SparkSession, sf_dir: str, root: str | None = None) -> Run:
        """Writes the run, the master and the candidate, each once. With ``root``, the last two are written where they are published: as versions
        run-0 and run-1, which no reader sees before the log names them."""
        scratch, seen, prints = Scratch(spark), {}, {}

        def observed(df: DataFrame, stage: str) -> DataFrame:
            df, seen[stage] = audit.observed(df, stage)
            return df

        def version(df: DataFrame, name: str, run_id: str) -> DataFrame:
            if root is None:
                return scratch.table(df, name)
            df, prints[name] = contracts.fingerprinted(df, f"{name} as written")
            publish.publish(df, root, run_id)
            return publish.readback(spark, root, run_id, df.schema)

        span = Observation("span")
        tries = attempts(spark, sf_dir).observe(span, F.min("ts").alias("first"), F.max("ts").alias("last"))
        run = scratch.table(observed(measured(observed(tries, "acquire")), "measure"), "run")
        prior = version(observed(master(spark, sf_dir), "master"), "prior", "run-0")
        candidate = version(observed(stamped(merge.merge_snapshot(prior, run, METRICS)), "materialize"), "candidate", "run-1")
        found = span.get
        return cls(run, prior, candidate, {stage: s.get["n_rows"] for stage, s in seen.items()}, found.get("first"), found.get("last"), prints)

    @staticmethod
    def rules() -> dict[str, Column]:
        """What holds of every row of a candidate."""
        fresh, new = F.col("status").isin(merge.REFRESHED, merge.NEW), F.col("last_ok_at") >= F.lit(CUT).cast("timestamp_ntz")
        return {"has_a_success": F.col("n_ok") > 0, "fresh_is_of_this_run": ~fresh | new, "kept_is_older": fresh | ~new}

    def offenders(self, candidate: DataFrame | None = None) -> DataFrame:
        """The ids that make the contracts of validated() fail."""
        cand = self.candidate if candidate is None else candidate
        return contracts.offenders(self.prior, self.run, cand, METRICS, ["purchase_value", "last_value"], self.rules(), "synced_at")

    def validated(self, candidate: DataFrame | None = None) -> DataFrame:
        """A row a contract over the candidate, or over another one."""
        cand = self.candidate if candidate is None else candidate
        return contracts.all_contracts(
            contracts.run_contracts(acquire.run_counts(self.run)),
            contracts.id_contracts(cand),
            contracts.metadata_contracts(cand, CANDIDATE),
            contracts.kept_contracts(self.prior, self.run, cand, METRICS, ["purchase_value", "last_value"]),
            contracts.row_contracts(cand, self.rules(), "synced_at"),
        )
