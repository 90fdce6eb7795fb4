"""Run summaries, stage logs and what they prove."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: The summary's fields, in order.
SUMMARY_SCHEMA = (
    "run_id string, started_at timestamp_ntz, finished_at timestamp_ntz, wall_seconds double, selected_count bigint, success_count bigint, failed_count bigint, "
    "http_request_count bigint, final_rows bigint, final_unique_ids bigint, duplicate_ids bigint, schema_contract string, type_contract string, "
    "backup_contract string, readback string, semantic_validation string, master_non_shrink string, unselected_preservation string, final_status string"
)
#: Size of a stored sketch: its error in rank falls with it.
SKETCH_K = 200
#: What a log may hold: operational metadata, no payload.
LOG_COLUMNS = ("run_id", "stage", "n_rows", "n_bad", "elapsed_seconds", "status", "error")


def run_summary(run_id: str, started_at: datetime, finished_at: datetime, run_counts: DataFrame, id_counts: DataFrame, statuses: DataFrame) -> DataFrame:
    """The one-row summary of a run, from one-row tables; ``statuses`` has a column a contract."""
    head = run_counts.crossJoin(id_counts).crossJoin(statuses).withColumns({
        "run_id": F.lit(run_id), "started_at": F.lit(started_at).cast("timestamp_ntz"), "finished_at": F.lit(finished_at).cast("timestamp_ntz"),
        "wall_seconds": F.lit((finished_at - started_at).total_seconds()),
    })
    return head.select(*[F.col(part.split()[0]).cast(part.split()[1]).alias(part.split()[0]) for part in SUMMARY_SCHEMA.split(", ")])


def unproven_runs(dispatches: DataFrame, summaries: DataFrame) -> DataFrame:
    """Dispatches without a summary that shows publication and readback: being accepted proves nothing."""
    proven = summaries.where((F.col("readback") == "PASS") & (F.col("final_status") == "PASS")).select("run_id")
    return dispatches.join(proven, "run_id", "left_anti")


def run_trend(summaries: DataFrame) -> DataFrame:
    """Runs, wall time and counts by day."""
    return summaries.groupBy(F.to_date("started_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.max("wall_seconds").alias("max_wall_seconds"),
        F.avg("wall_seconds").alias("avg_wall_seconds"),
        F.sum("selected_count").alias("selected_count"),
        F.sum("failed_count").alias("failed_count"),
        F.count_if(F.col("final_status") != "PASS").alias("n_failed_runs"),
    )


def day_sketches(summaries: DataFrame, measure: str = "wall_seconds", k: int = SKETCH_K) -> DataFrame:
    """By day: runs, failed ones, and a KLL sketch of a measure. Sketches of parts of a day, or of days, merge: what is stored grows with days, not with runs."""
    return summaries.groupBy(F.to_date("started_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_runs"), F.count_if(F.col("final_status") != "PASS").alias("n_failed_runs"), F.kll_sketch_agg_double(F.col(measure), k).alias("sketch"),
    )


def sketched_trend(sketches: DataFrame, period: Column | None = None, ranks: Sequence[float] = (0.5, 0.9, 1.0), k: int = SKETCH_K) -> DataFrame:
    """By period (a day, if none is given): runs, failed ones, and the quantiles of the stored measure, from merged sketches.

    Up to k values in a period quantiles are exact, beyond that off by at most about 1.33 % in rank at k = 200. A period whose values are all null has none.
    """
    merged = sketches.groupBy((F.col("day") if period is None else period).alias("period")).agg(
        F.sum("n_runs").alias("n_runs"), F.sum("n_failed_runs").alias("n_failed_runs"), F.kll_merge_agg_double("sketch", k).alias("_sketch"),
    )
    some = F.kll_sketch_get_n_double("_sketch") > 0
    quantile = lambda r: F.when(some, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(r)))).alias(f"q{round(100 * r)}")
    return merged.select("period", "n_runs", "n_failed_runs", *map(quantile, ranks))


def stage_row(df: DataFrame, stage: str) -> DataFrame:
    """One row: the stage and how many rows it gives."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows")


def observed(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted as it is written, at no second pass; read the count from the observation afterwards."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def allowlist_columns(df: DataFrame, columns: Sequence[str] = LOG_COLUMNS) -> DataFrame:
    """Only the columns that a log may hold, in their order."""
    return df.select(*[c for c in columns if c in df.columns])
