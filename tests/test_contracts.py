from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import contracts as C

SCHEMA = "id bigint, n bigint, v double"


@pytest.fixture(scope="module")
def good(spark):
    return spark.createDataFrame([(1, 1, None), (2, 2, 0.0), (3, 3, 1.5)], SCHEMA)


def row(df):
    r = df.first()
    return r["status"], r["n_bad"]


def test_accounting(spark):
    counts = "selected_count bigint, success_count bigint, failed_count bigint"
    assert row(C.accounting(spark.createDataFrame([(3, 2, 1)], counts))) == ("PASS", 0)
    assert row(C.accounting(spark.createDataFrame([(3, 1, 1)], counts))) == ("FAIL", 1)
    assert row(C.acquired_something(spark.createDataFrame([(3, 1, 2)], counts)))[0] == "PASS"
    assert row(C.acquired_something(spark.createDataFrame([(3, 0, 3)], counts))) == ("FAIL", 3)
    assert row(C.acquired_something(spark.createDataFrame([(0, 0, 0)], counts)))[0] == "PASS"


def test_duplicates_and_counts(spark, good):
    twice = good.unionByName(good.where("id = 1"))
    assert row(C.no_duplicates(good)) == ("PASS", 0) and row(C.no_duplicates(twice)) == ("FAIL", 1)
    assert row(C.counts_agree(good)) == ("PASS", 0) and row(C.counts_agree(twice)) == ("FAIL", 1)
    assert row(C.counts_agree(spark.createDataFrame([(None, 1, 1.0)], SCHEMA)))[0] == "FAIL"
    assert row(C.counts_agree(good.limit(0))) == ("PASS", 0)
    assert [(r["id"], r["n"]) for r in C.duplicate_ids(twice).collect()] == [(1, 2)]


def test_schema_and_types(spark, good):
    assert row(C.schema_contract(good, good.schema)) == ("PASS", 0)
    assert row(C.schema_contract(good.select("n", "id", "v"), good.schema)) == ("FAIL", 2)
    assert row(C.schema_contract(good.drop("v"), good.schema)) == ("FAIL", 1)
    assert row(C.type_contract(good, good.schema)) == ("PASS", 0)
    assert row(C.type_contract(good.withColumn("n", F.col("n").cast("int")), good.schema)) == ("FAIL", 1)
    assert row(C.type_contract(good, good.schema, spark.createDataFrame([(0, 2)], "a bigint, b bigint"))) == ("FAIL", 2)
    assert row(C.type_contract(good, StructType())) == ("PASS", 0)


def test_non_shrink(good):
    assert row(C.non_shrink(good, good)) == ("PASS", 0)
    assert row(C.non_shrink(good, good.where("id <> 1"))) == ("FAIL", 1)
    assert row(C.non_shrink(good.unionByName(good), good)) == ("FAIL", 0)  # no id lost, but rows


def test_preservation(good):
    selected = good.where("id = 1").select("id")
    tampered = good.withColumn("n", F.when(F.col("id") == 2, 9).otherwise(F.col("n")))
    assert row(C.unselected_preserved(good, selected, good, ["n", "v"])) == ("PASS", 0)
    assert row(C.unselected_preserved(good, selected, tampered, ["n", "v"])) == ("FAIL", 1)
    assert row(C.unselected_preserved(good, selected, good.where("id <> 3"), ["n", "v"])) == ("FAIL", 1)
    assert row(C.last_good_carried(good.where("id = 2"), tampered, ["n", "v"])) == ("FAIL", 1)


def test_semantic_and_missing(good):
    assert row(C.semantic(good, {"positive": F.col("n") > 0})) == ("PASS", 0)
    assert row(C.semantic(good, {"positive": F.col("n") > 1, "small": F.col("v") < 9})) == ("FAIL", 2)
    assert row(C.missing_not_zero(good, good, ["v"])) == ("PASS", 0)
    assert row(C.missing_not_zero(good, good.na.fill(0.0, ["v"]), ["v"])) == ("FAIL", 1)


def test_uniform_stamp(good):
    one = good.withColumn("synced_at", F.lit(datetime(2024, 2, 1)))
    late = one.withColumn("synced_at", F.when(F.col("id") == 1, F.lit(datetime(2024, 2, 2))).otherwise(F.col("synced_at")))
    none = one.withColumn("synced_at", F.when(F.col("id") != 1, F.col("synced_at")))
    assert [row(C.uniform_stamp(x))[0] for x in (one, late, none)] == ["PASS", "FAIL", "FAIL"]


def test_same_sets_and_rows(good):
    assert row(C.same_id_set(good, good)) == ("PASS", 0) and row(C.same_id_set(good, good.where("id <> 1"))) == ("FAIL", 1)
    assert row(C.same_rows(good, good.select("v", "n", "id"))) == ("PASS", 0)
    assert row(C.same_rows(good, good.unionByName(good.where("id = 2")))) == ("FAIL", 1)


def test_fingerprint_sees_a_swapped_null_and_no_order(spark, good):
    a, b = (C.fingerprint(spark.createDataFrame([x], "a bigint, b bigint")).first() for x in ((None, 1), (1, None)))
    assert a != b
    assert C.fingerprint(good).first() == C.fingerprint(good.repartition(7)).first()


def test_require_names_stage_and_contract(good):
    twice = good.unionByName(good)
    every = C.all_contracts(C.no_duplicates(twice), C.counts_agree(good))
    with pytest.raises(RuntimeError, match=r"at validate: DUPLICATES \(3\)$"):
        C.require(every, "validate")
    assert C.final_status(every).first()["final_status"] == "FAIL"
    C.require(C.no_duplicates(good), "validate")


def test_kept_contracts_give_the_rows_of_the_single_ones(spark):
    columns, wide = ["n", "v"], f"{SCHEMA}, n_success bigint"
    master = spark.createDataFrame([(1, 1, None), (2, 2, 5.0), (3, 3, 1.5), (4, 4, None)], SCHEMA)
    run = spark.createDataFrame([(1, 7, None, 1), (2, 0, None, 0), (5, 1, None, 2), (6, 0, None, 0)], wide)
    good = spark.createDataFrame([(1, 7, None), (2, 2, 5.0), (3, 3, 1.5), (4, 4, None), (5, 1, None)], SCHEMA)
    bad = spark.createDataFrame([(1, 7, 0.0), (2, 2, 6.0), (3, 9, 1.5), (5, 1, 0.0)], SCHEMA)
    for cand in (good, bad, good.unionByName(good.where("id = 3")), good.limit(0)):
        failed = master.join(run.where("n_success = 0").select("id"), "id", "left_semi")
        one = [
            C.non_shrink(master, cand), C.unselected_preserved(master, run.select("id"), cand, columns), C.last_good_carried(failed, cand, columns),
            C.missing_not_zero(run.where("n_success > 0"), cand, ["v"]),
        ]
        want = sorted(tuple(r.first()) for r in one)
        assert sorted(map(tuple, C.kept_contracts(master, run, cand, columns, ["v"]).collect())) == want
    assert {r["status"] for r in C.kept_contracts(master, run, bad, columns, ["v"]).collect()} == {"FAIL"}
