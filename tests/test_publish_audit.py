from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import audit, contracts
from tidemark.sources import publish

T = [datetime(2024, 2, d) for d in range(1, 9)]


def test_publish_read_back_and_refuse(spark, tmp_path):
    root, one = str(tmp_path), spark.createDataFrame([(1, None), (2, 0.0)], "id bigint, v double")
    assert publish.current_version(spark, root) is None and publish.backup(spark, root) is None
    with pytest.raises(LookupError):
        publish.read_current(spark, root)
    publish.publish_validated(one, contracts.no_duplicates(one), root, "run-1", T[0])
    kept = publish.backup(spark, root)
    two = one.unionByName(spark.createDataFrame([(3, 1.0)], "id bigint, v double"))
    assert publish.publish_validated(two, contracts.non_shrink(one, two), root, "run-2", T[1]).count() == 3
    with pytest.raises(RuntimeError, match="MASTER_NON_SHRINK"):
        publish.publish_validated(one, contracts.non_shrink(two, one), root, "run-3", T[2])
    assert publish.current_version(spark, root) == "run-2" and publish.read_current(spark, root).count() == 3
    assert [(r["run_id"], r["status"]) for r in publish.publication_log(spark, root).orderBy("run_id").collect()] == [("run-1", "PASS"), ("run-2", "PASS"), ("run-3", "FAIL")]
    assert publish.backup_intact(spark, root, kept)
    with pytest.raises(AnalysisException):
        publish.publish(one, root, "run-1")  # a version is never overwritten
    assert publish.read_version(spark, root, "run-1").count() == 2


def test_a_damaged_backup_is_seen(spark, tmp_path):
    root, one = str(tmp_path), spark.createDataFrame([(1, None), (2, 0.0)], "id bigint, v double")
    publish.publish_validated(one, contracts.no_duplicates(one), root, "run-1", T[0])
    kept = publish.backup(spark, root)
    one.na.fill(0.0).write.mode("append").parquet(f"{root}/versions/run-1")
    assert not publish.backup_intact(spark, root, kept)


def test_previous_version(spark):
    log = spark.createDataFrame([("a", "a", T[0], "PASS"), ("b", "b", T[1], "FAIL"), ("c", "c", T[2], "PASS"), ("d", "d", T[3], "PASS")], publish.LOG_SCHEMA)
    assert {r["run_id"]: r["previous"] for r in publish.previous_version(log).collect()} == {"a": None, "b": "a", "c": "a", "d": "c"}


def test_unproven_runs_trend_and_log(spark, tmp_path):
    dispatches = spark.createDataFrame([(r, T[0]) for r in ("proven", "failed", "unread", "silent")], "run_id string, dispatched_at timestamp")
    fields = "run_id string, started_at timestamp, wall_seconds double, selected_count bigint, failed_count bigint, readback string, final_status string"
    sums = spark.createDataFrame([("proven", T[0], 10.0, 5, 0, "PASS", "PASS"), ("failed", T[0], 30.0, 5, 2, "PASS", "FAIL"), ("unread", T[1], 5.0, 1, 1, "FAIL", "PASS")], fields)
    assert {r["run_id"] for r in audit.unproven_runs(dispatches, sums).collect()} == {"failed", "unread", "silent"}
    trend = {str(r["day"]): (r["n_runs"], r["max_wall_seconds"], r["avg_wall_seconds"], r["n_failed_runs"]) for r in audit.run_trend(sums).collect()}
    assert trend == {"2024-02-01": (2, 30.0, 20.0, 1), "2024-02-02": (1, 5.0, 5.0, 0)}
    assert audit.allowlist_columns(sums.withColumn("stage", F.lit("x")).withColumn("error", F.lit(""))).columns == ["run_id", "stage", "error"]
    watched, seen = audit.observed(sums, "acquire")
    watched.write.parquet(f"{tmp_path}/x")
    assert seen.get["n_rows"] == 3


def test_run_summary_has_its_fields_in_order(spark, tmp_path):
    one = lambda **k: spark.range(1).select(*[F.lit(v).alias(n) for n, v in k.items()])
    counts = one(selected_count=3, success_count=2, failed_count=1, http_request_count=4)
    ids = one(final_rows=9, final_unique_ids=9, duplicate_ids=0, null_ids=0)
    names = ("schema_contract", "type_contract", "backup_contract", "readback", "semantic_validation", "master_non_shrink", "unselected_preservation", "final_status")
    got = audit.run_summary("r", T[0], T[1], counts, ids, one(**dict.fromkeys(names, "PASS")))
    publish.write_run_summary(got, f"{tmp_path}/s")
    row = spark.read.parquet(f"{tmp_path}/s").first()
    assert len(row) == 19 and row["wall_seconds"] == 86400.0 and list(row.asDict())[0] == "run_id" and row["final_status"] == "PASS"


def test_scratch_folders_are_freed_at_the_end(spark):
    from pathlib import Path

    from tidemark.sources.workspace import Scratch, freed

    kept = Scratch(spark)
    with freed(spark):
        inner = Scratch(spark)
        df = inner.table(spark.range(3), "a")
        out = kept.table(df, "out")
    assert out.count() == 3 and not Path(inner.root.removeprefix("file:")).exists()
    with pytest.raises(ValueError), freed(spark):
        lost = Scratch(spark)
        lost.table(spark.range(3), "a")
        raise ValueError
    assert not Path(lost.root.removeprefix("file:")).exists() and kept.root in Scratch.made and lost.root not in Scratch.made
