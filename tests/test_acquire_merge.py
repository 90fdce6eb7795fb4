from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tidemark.functions.missing import sum_or_missing
from tidemark.operators import acquire, merge

T = [datetime(2024, 1, 31, h) for h in range(10)]
ATTEMPTS = "attempt_id bigint, id bigint, ts timestamp_ntz, ok boolean, value double"
ROWS = [
    (1, 1, T[1], True, 5.0),  # one success
    (2, 2, T[1], False, None), (3, 2, T[2], True, 7.0),  # an error, then a success
    (4, 3, T[1], True, 8.0), (5, 3, T[2], False, None),  # a success, then an error
    (6, 4, T[1], False, None), (7, 4, T[2], False, None),  # errors only
    (8, 5, T[3], True, 1.0), (9, 5, T[3], True, 2.0),  # a tie in time
    (10, 6, T[1], True, None),  # success with nothing measured
    (11, 7, T[1], True, 0.0),  # a measured zero
    (12, 9, T[1], False, None),  # errors only, and no prior row
]
MASTER = "id bigint, n_ok bigint, purchase_value double, last_value double"
PRIOR = [(1, 3, 5.0, 1.0), (2, 1, None, 2.0), (3, 2, 4.0, 3.0), (4, 9, 9.5, 4.0), (5, 1, 1.0, 5.0), (6, 2, 5.0, 6.0), (7, 1, 3.0, 7.0), (8, 4, None, None)]
METRICS = ["n_ok", "purchase_value", "last_value"]


@pytest.fixture(scope="module")
def attempts(spark):
    return spark.createDataFrame(ROWS, ATTEMPTS)


@pytest.fixture(scope="module")
def master(spark):
    return spark.createDataFrame(PRIOR, MASTER)


@pytest.fixture(scope="module")
def run(attempts):
    return acquire.measure(attempts, {"n_ok": F.count_if("ok"), "purchase_value": sum_or_missing(F.col("value"), F.col("ok"))}, last={"last_value": "value"})


def by_id(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_attempts_per_id_and_counts(attempts):
    per = acquire.attempts_per_id(attempts)
    assert by_id(per, "n_attempts", "n_success", "n_failed")[2] == (2, 1, 1)
    assert acquire.run_counts(per).first().asDict() == {"selected_count": 8, "success_count": 6, "failed_count": 2, "http_request_count": 12}


def test_counts_of_no_attempts(attempts):
    assert tuple(acquire.run_counts(acquire.attempts_per_id(attempts.limit(0))).first()) == (0, 0, 0, 0)


def test_latest_good_takes_the_higher_attempt_of_a_tie(attempts):
    assert by_id(acquire.latest_good(attempts), "attempt_id") == {1: 1, 2: 3, 3: 4, 5: 9, 6: 10, 7: 11}


def test_measure_keeps_missing_apart_from_zero(run):
    assert by_id(run, "purchase_value", "last_value") == {1: (5.0, 5.0), 2: (7.0, 7.0), 3: (8.0, 8.0), 4: (None, None), 5: (3.0, 2.0), 6: (None, None), 7: (0.0, 0.0), 9: (None, None)}


def test_merge_chooses_by_status(master, run):
    got = by_id(merge.merge_snapshot(master, run, METRICS), "status", *METRICS)
    assert got[6] == ("REFRESHED", 1, None, None)  # 5.0 becomes missing, not 5.0
    assert got[7] == ("REFRESHED", 1, 0.0, 0.0)
    assert got[4] == ("CARRIED", 9, 9.5, 4.0)
    assert got[8] == ("UNSELECTED", 4, None, None)
    assert 9 not in got


def test_new_and_failed_new(master, run):
    less = master.where("id <> 1")
    assert by_id(merge.merge_snapshot(less, run, METRICS), "status")[1] == "NEW"
    status = by_id(merge.merge_status(less, run, METRICS), "status")
    assert status[9] == "FAILED_NEW" and status[4] == "CARRIED"


def test_carried_unselected_lost_and_new(attempts, master, run):
    assert by_id(merge.carry_forward(master, run), "n_ok") == {4: 9}
    assert by_id(merge.preserve_unselected(master, acquire.select_ids(attempts)), "n_ok") == {8: 4}
    cand = merge.merge_snapshot(master, run, METRICS)
    assert merge.lost_ids(master, cand).count() == 0
    assert [r["id"] for r in merge.lost_ids(master, cand.where("id <> 2")).collect()] == [2]
    assert [r["id"] for r in merge.new_ids(master.where("id <> 2"), cand).collect()] == [2]


def test_rerun_gives_an_equal_candidate(master, run):
    a, b = (merge.merge_snapshot(master, run, METRICS) for _ in range(2))
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_diff_takes_null_as_equal_to_null(spark, master):
    other = spark.createDataFrame([(2, 1, None, 2.0), (3, 2, 4.5, 3.0), (99, 1, None, None)], MASTER)
    got = by_id(merge.snapshot_diff(master.where("id in (1, 2, 3)"), other, METRICS), "change")
    assert got == {1: "removed", 2: "same", 3: "changed", 99: "added"}


def test_coerced_types_and_unread_values(spark):
    schema = StructType([StructField("id", LongType()), StructField("day", DateType()), StructField("more", LongType())])
    raw = spark.createDataFrame([("1", "05.02.2024"), ("x", "31.02.2001"), (None, None)], "id string, day string")
    rows = acquire.coerce_types(raw, schema, {"day": "dd.MM.yyyy"}).collect()
    assert [(r["id"], str(r["day"]), r["more"]) for r in rows] == [(1, "2024-02-05", None), (None, "None", None), (None, "None", None)]
    assert acquire.unread(raw, schema, {"day": "dd.MM.yyyy"}).first().asDict() == {"id": 1, "day": 1}


def test_stamp_is_one_value(master):
    assert {r["synced_at"] for r in merge.stamp_sync(master, T[0]).collect()} == {T[0]}
