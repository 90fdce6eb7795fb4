"""Merging a run into the last published table, and comparing two snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REFRESHED, NEW, CARRIED, UNSELECTED, FAILED_NEW = "REFRESHED", "NEW", "CARRIED", "UNSELECTED", "FAILED_NEW"


def merge_status(master: DataFrame, run: DataFrame, columns: Sequence[str], id: str = "id", success: str = "n_success") -> DataFrame:
    """``id``, ``columns`` and ``status`` of every id in either table, FAILED_NEW ones too.

    Values are chosen by status, never by which of them is null: a null measured in this run replaces the old value.
    """
    old = master.select(F.col(id), F.lit(True).alias("_old"), F.struct(*columns).alias("_was"))
    new = run.select(F.col(id), F.lit(True).alias("_run"), (F.col(success) > 0).alias("_ok"), F.struct(*columns).alias("_is"))
    fresh, had = F.coalesce("_ok", F.lit(False)), F.col("_old").isNotNull()
    status = (
        F.when(fresh & had, REFRESHED).when(fresh, NEW).when(F.col("_run").isNotNull() & had, CARRIED).when(had, UNSELECTED).otherwise(FAILED_NEW)
    )
    joined = old.join(new, id, "full_outer").withColumn("status", status)
    value = lambda c: F.when(F.col("status").isin(REFRESHED, NEW), F.col(f"_is.{c}")).otherwise(F.col(f"_was.{c}")).alias(c)
    return joined.select(id, *[value(c) for c in columns], "status")


def merge_snapshot(master: DataFrame, run: DataFrame, columns: Sequence[str], id: str = "id", success: str = "n_success") -> DataFrame:
    """The candidate: refreshed, carried, unselected and new rows. A failed id without a prior row has none: no row of zeros stands in."""
    return merge_status(master, run, columns, id, success).where(F.col("status") != FAILED_NEW)


def carry_forward(master: DataFrame, run: DataFrame, id: str = "id", success: str = "n_success") -> DataFrame:
    """Last-good rows of ids whose acquisition failed."""
    return master.join(run.where(F.col(success) == 0).select(id), id, "left_semi")


def preserve_unselected(master: DataFrame, selected: DataFrame, id: str = "id") -> DataFrame:
    """Rows of ids that were not selected."""
    return master.join(selected.select(id), id, "left_anti")


def lost_ids(master: DataFrame, candidate: DataFrame, id: str = "id") -> DataFrame:
    """Ids published before and missing now."""
    return master.select(id).join(candidate.select(id), id, "left_anti")


def new_ids(master: DataFrame, candidate: DataFrame, id: str = "id") -> DataFrame:
    """Ids that appear for the first time."""
    return lost_ids(candidate, master, id)


def same_values(columns: Sequence[str], a: str, b: str) -> Column:
    """Whether two structs agree in these fields; nulls equal nulls."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def snapshot_diff(a: DataFrame, b: DataFrame, columns: Sequence[str], id: str = "id") -> DataFrame:
    """Per id: added, removed, changed or same, from a to b; nulls equal nulls. One full outer join."""
    side = lambda df, name: df.select(id, F.struct(F.lit(True).alias("_here"), *columns).alias(name))
    both = side(a, "_a").join(side(b, "_b"), id, "full_outer")
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(same_values(columns, "_a", "_b"), "same").otherwise("changed")
    return both.select(id, change.alias("change"))


def stamp_sync(df: DataFrame, at: datetime, column: str = "synced_at") -> DataFrame:
    """One sync time on every row. It is passed in, as the clock differs between the writes and retries of one run."""
    return df.withColumn(column, F.lit(at))
