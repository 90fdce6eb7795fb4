"""The refresh as one job: what it publishes, logs and leaves behind where it fails."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.plans import refresh as R
from tidemark.plans.job import refresh
from tidemark.plans.operations import events_refresh
from tidemark.sources import commits, publish
from tidemark.sources.stage_log import LOG_SCHEMA

T = [datetime(2024, 3, d) for d in range(1, 9)]
ATTEMPTS = "attempt_id bigint, id bigint, ts timestamp_ntz, ok boolean, event_type string, value double"


@pytest.fixture(scope="module")
def what(spark):
    return replace(events_refresh(), rules={"has_a_success": F.col("n_ok") > 0}, buckets=4)


def attempts(spark, *rows):
    at = datetime(2024, 2, 1)
    return spark.createDataFrame([(i, id, at + timedelta(minutes=i), ok, "purchase", value) for i, (id, ok, value) in enumerate(rows)], ATTEMPTS)


def stages(spark, root, run_id):
    rows = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/stages").where(F.col("run_id") == run_id).collect()
    return {r["stage"]: r["status"] for r in rows}


def summary(spark, root, run_id):
    (row,) = spark.read.schema(audit.SUMMARY_SCHEMA).parquet(f"{root}/summaries").where(F.col("run_id") == run_id).collect()
    return row


def values(df):
    return {r["id"]: (r["purchase_value"], r["status"]) for r in df.collect()}


def test_runs_follow_each_other(spark, tmp_path, what):
    root = str(tmp_path)
    one = refresh(spark, what, attempts(spark, (1, True, 5.0), (2, True, None), (3, False, 1.0), (1, False, 9.0)), root, "r1", T[0])
    assert values(one) == {1: (5.0, "NEW"), 2: (None, "NEW")}
    two = refresh(spark, what, attempts(spark, (1, False, 7.0), (2, True, 2.0), (4, True, 4.0)), root, "r2", T[1])
    assert values(two) == {1: (5.0, "CARRIED"), 2: (2.0, "REFRESHED"), 4: (4.0, "NEW")}
    three = refresh(spark, what, attempts(spark), root, "r3", T[2])
    assert values(three) == {1: (5.0, "UNSELECTED"), 2: (2.0, "UNSELECTED"), 4: (4.0, "UNSELECTED")}
    assert {r["synced_at"] for r in three.collect()} == {T[2]}
    s = summary(spark, root, "r2")
    assert (s["selected_count"], s["success_count"], s["failed_count"], s["http_request_count"], s["final_rows"], s["duplicate_ids"], s["final_status"]) == (3, 2, 1, 3, 3, 0, "PASS")
    assert all(s[n] == "PASS" for n in ("schema_contract", "type_contract", "backup_contract", "readback", "semantic_validation", "master_non_shrink", "unselected_preservation"))
    assert list(stages(spark, root, "r3").values()) == ["PASS"] * 7 and s["wall_seconds"] >= 0
    assert publish.rollback(spark, root, "back", T[3]) == "r2"


def test_a_refused_run_leaves_what_was_current(spark, tmp_path, what):
    root = str(tmp_path)
    refresh(spark, what, attempts(spark, (1, True, 5.0), (2, True, 6.0)), root, "r1", T[0])
    strict = replace(what, rules={"small": F.coalesce(F.col("purchase_value") < 10, F.lit(True))})
    with pytest.raises(RuntimeError, match="validate candidate: SEMANTIC_VALIDATION"):
        refresh(spark, strict, attempts(spark, (2, True, 60.0), (7, True, 70.0)), root, "r2", T[1])
    assert publish.current_version(spark, root) == "r1" and values(publish.read_current(spark, root)) == {1: (5.0, "NEW"), 2: (6.0, "NEW")}
    (trace,) = spark.read.parquet(f"{root}/traces").collect()
    assert (trace["run_id"], trace["contract"], trace["n_ids"], sorted(trace["sample"])) == ("r2", "SEMANTIC_VALIDATION", 2, [2, 7])
    s = summary(spark, root, "r2")
    assert (s["final_status"], s["semantic_validation"], s["schema_contract"], s["readback"], s["final_rows"]) == ("FAIL", "FAIL", "PASS", "NOT RUN", 3)
    assert stages(spark, root, "r2") == {"acquire": "PASS", "materialize": "PASS", "validate candidate": "FAIL"}
    with pytest.raises(RuntimeError, match="ACQUISITION"):
        refresh(spark, what, attempts(spark, (2, False, 1.0)), root, "r3", T[2])
    assert [r["status"] for r in publish.publication_log(spark, root).orderBy("entry").collect()] == ["PASS", "FAIL", "FAIL"]
    # Refused versions are what a sweep takes.
    assert {r["version"]: r["kept"] for r in commits.sweep(spark, root, older_than=0.0).collect()} == {"r1": True, "r2": False, "r3": False}


def test_an_error_in_the_source_is_logged_and_raised(spark, tmp_path, what):
    root = str(tmp_path)
    bad = attempts(spark, (1, True, 5.0)).withColumn("value", F.when(F.col("id") == 1, F.raise_error(F.lit("token=abc payload"))).cast("double"))
    with pytest.raises(Exception, match="payload"):
        refresh(spark, what, bad, root, "r1", T[0])
    s = summary(spark, root, "r1")
    assert (s["final_status"], s["selected_count"], s["semantic_validation"]) == ("FAIL", None, "NOT RUN") and stages(spark, root, "r1") == {"acquire": "FAIL"}
    assert "payload" not in str(spark.read.schema(LOG_SCHEMA).parquet(f"{root}/stages").collect())
    assert publish.current_version(spark, root) is None


def test_a_second_job_that_was_overtaken_is_refused(spark, tmp_path, what):
    root = str(tmp_path)
    refresh(spark, what, attempts(spark, (1, True, 5.0)), root, "r1", T[0])

    def measure(df):
        if not done:
            done.append(1)
            refresh(spark, what, attempts(spark, (1, True, 6.0)), root, "faster", T[1])
        return R.measured(df)

    done = []
    with pytest.raises(publish.ConcurrentPublication):
        refresh(spark, replace(what, measure=measure), attempts(spark, (1, True, 7.0)), root, "slower", T[2])
    assert values(publish.read_current(spark, root)) == {1: (6.0, "REFRESHED")} and summary(spark, root, "slower")["final_status"] == "FAIL"
    assert stages(spark, root, "slower")["publish"] == "FAIL"


def test_a_damaged_backup_stops_the_job(spark, tmp_path, what):
    root = str(tmp_path)
    refresh(spark, what, attempts(spark, *[(i, True, 5.0) for i in range(40)]), root, "r1", T[0])
    files = sorted(f for f in (tmp_path / "versions" / "r1").iterdir() if f.name.endswith(".parquet"))
    files[0].unlink()
    with pytest.raises(RuntimeError, match="backup"):
        refresh(spark, what, attempts(spark, (1, True, 7.0)), root, "r2", T[1])
    assert summary(spark, root, "r2")["backup_contract"] == "FAIL" and publish.current_version(spark, root) == "r1"
