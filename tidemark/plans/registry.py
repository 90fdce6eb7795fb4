"""Registered queries of the refresh and scan operators, with the SQL that checks each of them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tidemark.functions import paths, text
from tidemark.operators import acquire, audit, contracts, merge, scan
from tidemark.plans import refresh as R
from tidemark.sources import publish, tables
from tidemark.sources.workspace import Scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The fixture of plans.refresh in SQL.
_ATT = "att AS (SELECT event_id AS attempt_id, user_id AS id, ts, event_type <> 'error' AS ok, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00')"
_MEASURES = "count(*) FILTER (ok) AS n_ok, round(sum(value) FILTER (ok AND event_type = 'purchase'), 2) AS purchase_value, max(ts) FILTER (ok) AS last_ok_at, arg_max(value, (ts, attempt_id)) FILTER (ok) AS last_value"
_OLD = "old AS (SELECT event_id AS attempt_id, user_id AS id, ts, event_type <> 'error' AS ok, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-30 12:00:00')"
_PER = f"per AS (SELECT id, count(*) AS n_attempts, count(*) FILTER (ok) AS n_success, count(*) FILTER (NOT ok) AS n_failed, {_MEASURES} FROM att GROUP BY id)"
_MASTER = f"mas AS (SELECT id, {_MEASURES} FROM old WHERE ok GROUP BY id)"
_MERGED = """mer AS (SELECT coalesce(m.id, p.id) AS id,
  CASE WHEN p.n_success > 0 THEN p.n_ok ELSE m.n_ok END AS n_ok, CASE WHEN p.n_success > 0 THEN p.purchase_value ELSE m.purchase_value END AS purchase_value,
  CASE WHEN p.n_success > 0 THEN p.last_ok_at ELSE m.last_ok_at END AS last_ok_at, CASE WHEN p.n_success > 0 THEN p.last_value ELSE m.last_value END AS last_value,
  CASE WHEN p.n_success > 0 AND m.id IS NOT NULL THEN 'REFRESHED' WHEN p.n_success > 0 THEN 'NEW' WHEN p.id IS NOT NULL AND m.id IS NOT NULL THEN 'CARRIED' WHEN m.id IS NOT NULL THEN 'UNSELECTED' ELSE 'FAILED_NEW' END AS status
  FROM {master} m FULL OUTER JOIN per p ON m.id = p.id)"""
_CAND = "cand AS (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS synced_at FROM mer WHERE status <> 'FAILED_NEW')"
_FIX = f"WITH {_ATT}, {_OLD}, {_PER}, {_MASTER}, "
_FULL = _FIX + _MERGED.format(master="mas") + f", {_CAND} "
_REDUCED = _FIX + _MERGED.format(master="(SELECT * FROM mas WHERE id % 10 <> 3)") + f", {_CAND} "


def _register(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return add


@_register("q01_run_counts", f"WITH {_ATT}, {_PER} SELECT count(*) AS selected_count, count(*) FILTER (n_success > 0) AS success_count, count(*) FILTER (n_success = 0) AS failed_count, CAST(sum(n_attempts) AS BIGINT) AS http_request_count FROM per")
def q01(spark, d):
    return R.run_counts(spark, d)


@_register("q02_attempts_per_id", f"WITH {_ATT}, {_PER} SELECT id, n_attempts, n_success, n_failed FROM per")
def q02(spark, d):
    return acquire.attempts_per_id(R.attempts(spark, d))


@_register("q03_latest_good", f"WITH {_ATT}, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, attempt_id DESC) AS n FROM att WHERE ok) SELECT attempt_id, id, ts, ok, event_type, value FROM r WHERE n = 1")
def q03(spark, d):
    return acquire.latest_good(R.attempts(spark, d))


@_register("q04_selected_ids", f"WITH {_ATT} SELECT DISTINCT id FROM att")
def q04(spark, d):
    return acquire.select_ids(R.attempts(spark, d))


@_register("q05_measured_metrics", f"WITH {_ATT}, {_PER} SELECT id, n_attempts, n_success, n_ok, purchase_value, last_ok_at, last_value FROM per")
def q05(spark, d):
    return R.measured(R.attempts(spark, d))


@_register("q06_attempts", f"WITH {_ATT} SELECT attempt_id, id, ts, ok, event_type, value FROM att")
def q06(spark, d):
    """The attempts as they landed, read with the schema that is expected of them."""
    return R.attempts(spark, d)


@_register("q10_candidate", _FULL + "SELECT * FROM cand")
def q10(spark, d):
    return R.candidate(spark, d)


@_register("q11_carried", _FULL + "SELECT id, n_ok, purchase_value, last_ok_at, last_value FROM cand WHERE status = 'CARRIED'")
def q11(spark, d):
    return merge.carry_forward(R.master(spark, d), R.measured(R.attempts(spark, d)))


@_register("q12_unselected", _FULL + "SELECT id, n_ok, purchase_value, last_ok_at, last_value FROM cand WHERE status = 'UNSELECTED'")
def q12(spark, d):
    return merge.preserve_unselected(R.master(spark, d), acquire.select_ids(R.attempts(spark, d)))


@_register("q13_new_ids", _REDUCED + "SELECT id FROM cand WHERE status = 'NEW'")
def q13(spark, d):
    prior = R.reduced_master(spark, d)
    return merge.new_ids(prior, R.candidate(spark, d, prior))


@_register("q13_failed_new", _REDUCED + "SELECT id FROM mer WHERE status = 'FAILED_NEW'")
def q13_failed(spark, d):
    run = R.measured(R.attempts(spark, d))
    return merge.merge_status(R.reduced_master(spark, d), run, R.METRICS).where(F.col("status") == merge.FAILED_NEW).select("id")


@_register("q14_lost_ids", _FULL + "SELECT id FROM mas WHERE id NOT IN (SELECT id FROM cand WHERE id % 10 <> 3)")
def q14(spark, d):
    return merge.lost_ids(R.master(spark, d), R.candidate(spark, d).where(F.col("id") % 10 != 3))


@_register("q15_snapshot_diff", _FULL + """SELECT coalesce(m.id, c.id) AS id, CASE WHEN m.id IS NULL THEN 'added' WHEN c.id IS NULL THEN 'removed'
  WHEN m.n_ok IS NOT DISTINCT FROM c.n_ok AND m.purchase_value IS NOT DISTINCT FROM c.purchase_value AND m.last_ok_at IS NOT DISTINCT FROM c.last_ok_at AND m.last_value IS NOT DISTINCT FROM c.last_value THEN 'same' ELSE 'changed' END AS change
  FROM (SELECT * FROM mas WHERE id % 10 <> 3) m FULL OUTER JOIN (SELECT * FROM cand WHERE id % 10 <> 4) c ON m.id = c.id""")  # fmt: skip
def q15(spark, d):
    return merge.snapshot_diff(R.reduced_master(spark, d), R.candidate(spark, d).where(F.col("id") % 10 != 4), R.METRICS)


_SAME = " AND ".join(f"m.{c} IS NOT DISTINCT FROM c.{c}" for c in R.METRICS)
_ROW = "SELECT '{}' AS contract, CASE WHEN n = 0{} THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS BIGINT) AS n_bad FROM ({})"
_KINDS = " OR ".join(f"typeof({f.name}) <> '{k}'" for f, k in zip(R.CANDIDATE.fields, ("BIGINT", "BIGINT", "DOUBLE", "TIMESTAMP", "DOUBLE", "VARCHAR", "TIMESTAMP"), strict=True))
_CUT = "TIMESTAMP '2024-01-30 12:00:00'"
#: Every contract's number, counted in SQL: what else has to hold, and the query that counts.
_COUNTED = {
    "ACCOUNTING": ("", "SELECT abs(count(*) - count(*) FILTER (n_success > 0) - count(*) FILTER (n_success = 0)) AS n FROM per"),
    "ACQUISITION": ("", "SELECT CASE WHEN count(*) FILTER (n_success > 0) = 0 THEN count(*) ELSE 0 END AS n FROM per"),
    "DUPLICATES": ("", "SELECT count(*) AS n FROM (SELECT id FROM cand WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)"),
    "COUNTS": (" AND nulls = 0", "SELECT count(*) - count(DISTINCT id) AS n, count(*) FILTER (id IS NULL) AS nulls FROM cand"),
    "SCHEMA": ("", f"SELECT count(*) FILTER (a IS DISTINCT FROM b) AS n FROM (SELECT unnest(json_keys(to_json(c))) AS a, unnest({R.CANDIDATE.names}) AS b FROM (SELECT * FROM cand LIMIT 1) c)"),
    "TYPE": ("", f"SELECT count(*) AS n FROM cand WHERE {_KINDS}"),
    "MASTER_NON_SHRINK": (" AND later >= earlier", "SELECT count(*) FILTER (id NOT IN (SELECT id FROM cand)) AS n, count(*) AS earlier, (SELECT count(*) FROM cand) AS later FROM mas"),
    "UNSELECTED_PRESERVATION": ("", f"SELECT count(*) FILTER (c.id IS NULL OR NOT ({_SAME})) AS n FROM mas m LEFT JOIN cand c ON m.id = c.id WHERE m.id NOT IN (SELECT id FROM per)"),
    "LAST_GOOD": ("", f"SELECT count(*) FILTER (c.id IS NULL OR NOT ({_SAME})) AS n FROM mas m LEFT JOIN cand c ON m.id = c.id WHERE m.id IN (SELECT id FROM per WHERE n_success = 0)"),
    "SEMANTIC_VALIDATION": ("", f"SELECT count(*) FILTER (n_ok IS NULL OR n_ok <= 0) + count(*) FILTER (status IN ('REFRESHED', 'NEW') AND NOT coalesce(last_ok_at >= {_CUT}, false)) + count(*) FILTER (status NOT IN ('REFRESHED', 'NEW') AND coalesce(last_ok_at >= {_CUT}, true)) AS n FROM cand"),
    "MISSING_NOT_ZERO": ("", "SELECT count(*) FILTER (p.purchase_value IS NULL AND c.purchase_value = 0) + count(*) FILTER (p.last_value IS NULL AND c.last_value = 0) AS n FROM cand c JOIN per p ON c.id = p.id WHERE p.n_success > 0"),
    "UNIFORM_STAMP": ("", "SELECT count(*) FILTER (synced_at IS NULL) + CAST(min(synced_at) <> max(synced_at) AS BIGINT) AS n FROM cand"),
}


@_register("q20_contracts", _FULL + " UNION ALL ".join(_ROW.format(name, also, sql) for name, (also, sql) in _COUNTED.items()))
def q20(spark, d):
    """All contracts over the candidate."""
    return R.Run.written(spark, d).validated()


#: Candidates that must fail, in each of them what is wrong.
def _broken(cand: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    third = F.col("id") % 10 == 3
    return {
        "shrunken": (cand.where(~third), "MASTER_NON_SHRINK"),
        "duplicated": (cand.unionByName(cand.where(third)), "DUPLICATES"),
        "zero_filled": (cand.withColumn("purchase_value", F.coalesce("purchase_value", F.lit(0.0))), "MISSING_NOT_ZERO"),
        "tampered": (cand.withColumn("n_ok", F.when(F.col("status") == merge.UNSELECTED, F.col("n_ok") + 1).otherwise(F.col("n_ok"))), "UNSELECTED_PRESERVATION"),
        "late_stamp": (cand.withColumn("synced_at", F.when(third, F.col("synced_at") + F.expr("interval 1 second")).otherwise(F.col("synced_at"))), "UNIFORM_STAMP"),
    }


@_register("q20_failing_contracts", _FULL + """SELECT 'shrunken' AS candidate, 'MASTER_NON_SHRINK' AS contract, 'FAIL' AS status, count(*) FILTER (id % 10 = 3) AS n_bad FROM mas
  UNION ALL SELECT 'duplicated', 'DUPLICATES', 'FAIL', count(*) FILTER (id % 10 = 3) FROM cand
  UNION ALL SELECT 'zero_filled', 'MISSING_NOT_ZERO', 'FAIL', count(*) FROM per WHERE n_success > 0 AND purchase_value IS NULL
  UNION ALL SELECT 'tampered', 'UNSELECTED_PRESERVATION', 'FAIL', count(*) FILTER (status = 'UNSELECTED') FROM cand
  UNION ALL SELECT 'late_stamp', 'UNIFORM_STAMP', 'FAIL', 1""")  # fmt: skip
def q20_failing(spark, d):
    run, rows = R.Run.written(spark, d), []
    for name, (df, contract) in _broken(run.candidate).items():
        found = run.validated(df).where(F.col("contract") == contract)
        rows.append(found.select(F.lit(name).alias("candidate"), "contract", "status", "n_bad"))
    return contracts.all_contracts(*rows)


@_register("q20_failing_others", _FULL + """SELECT 'one_failure_more' AS candidate, 'ACCOUNTING' AS contract, 'FAIL' AS status, CAST(1 AS BIGINT) AS n_bad FROM (SELECT count(*) FROM per)
  UNION ALL SELECT 'without_ids', 'COUNTS', 'FAIL', count(*) FILTER (id % 10 = 3) FROM cand
  UNION ALL SELECT 'without_last_value', 'SCHEMA', 'FAIL', 3 FROM (SELECT count(*) FROM cand)
  UNION ALL SELECT 'values_as_text', 'TYPE', 'FAIL', 1 FROM (SELECT count(*) FROM cand)
  UNION ALL SELECT 'nothing_succeeded', 'SEMANTIC_VALIDATION', 'FAIL', count(*) FILTER (id % 10 = 3) FROM cand
  UNION ALL SELECT 'carried_changed', 'LAST_GOOD', 'FAIL', count(*) FILTER (status = 'CARRIED') FROM cand
  UNION ALL SELECT 'read_with_changes', 'READBACK', 'FAIL', count(*) FILTER (id % 10 = 3) + 2 * count(*) FILTER (id % 10 = 4) FROM cand
  UNION ALL SELECT 'added_to_backup', 'BACKUP', 'FAIL', 2 FROM (SELECT count(*) FROM mas)""")  # fmt: skip
def q20_failing_others(spark, d):
    """What each other contract is there to catch: lost accounts and ids, columns and types, rules, carried rows, and rows that read back otherwise."""
    run, scratch = R.Run.written(spark, d), Scratch(spark)
    cand, third = run.candidate, F.col("id") % 10 == 3
    of = lambda name, found, contract: found.where(F.col("contract") == contract).select(F.lit(name).alias("candidate"), "contract", "status", "n_bad")
    counts = acquire.run_counts(run.run).withColumn("failed_count", F.col("failed_count") + 1)
    rows = [
        of("one_failure_more", contracts.accounting(counts), "ACCOUNTING"),
        of("without_ids", contracts.id_contracts(cand.withColumn("id", F.when(~third, F.col("id")))), "COUNTS"),
        of("without_last_value", contracts.schema_contract(cand.drop("last_value"), R.CANDIDATE), "SCHEMA"),
        of("values_as_text", contracts.type_contract(cand.withColumn("purchase_value", F.col("purchase_value").cast("string")), R.CANDIDATE), "TYPE"),
        of("nothing_succeeded", run.validated(cand.withColumn("n_ok", F.when(third, F.lit(0)).otherwise(F.col("n_ok")))), "SEMANTIC_VALIDATION"),
        of("carried_changed", run.validated(cand.withColumn("last_value", F.when(F.col("status") == merge.CARRIED, F.lit(-1.0)).otherwise(F.col("last_value")))), "LAST_GOOD"),
    ]
    publish.publish(cand.where(~third).withColumn("n_ok", F.when(F.col("id") % 10 == 4, F.col("n_ok") + 1).otherwise(F.col("n_ok"))), scratch.root, "run-1")
    rows.append(of("read_with_changes", contracts.same_rows(cand, publish.readback(spark, scratch.root, "run-1")), "READBACK"))
    publish.publish(run.prior, scratch.root, "run-0")
    before = scratch.table(contracts.fingerprint(publish.readback(spark, scratch.root, "run-0")), "before")
    run.prior.where(third).write.mode("append").parquet(f"{scratch.root}/versions/run-0")
    after = contracts.fingerprint(publish.readback(spark, scratch.root, "run-0"))
    rows.append(of("added_to_backup", contracts.same_rows(before, after).withColumn("contract", F.lit("BACKUP")), "BACKUP"))
    return contracts.all_contracts(*rows)


_SUMMARY = _FULL + """SELECT 'run-1' AS run_id, min(ts) AS started_at, max(ts) AS finished_at, CAST(epoch(max(ts)) - epoch(min(ts)) AS DOUBLE) AS wall_seconds,
  (SELECT count(*) FROM per) AS selected_count, (SELECT count(*) FROM per WHERE n_success > 0) AS success_count, (SELECT count(*) FROM per WHERE n_success = 0) AS failed_count, count(*) AS http_request_count,
  (SELECT count(*) FROM cand) AS final_rows, (SELECT count(DISTINCT id) FROM cand) AS final_unique_ids, CAST(0 AS BIGINT) AS duplicate_ids, 'PASS' AS schema_contract, 'PASS' AS type_contract,
  'PASS' AS backup_contract, 'PASS' AS readback, 'PASS' AS semantic_validation, 'PASS' AS master_non_shrink, 'PASS' AS unselected_preservation, 'PASS' AS final_status FROM att"""


@_register("q21_run_summary", _SUMMARY)
def q21(spark, d):
    """The run's summary after publication: started and finished are the first and the last attempt."""
    scratch = Scratch(spark)
    run = R.Run.written(spark, d, scratch.root)
    cand = run.candidate
    kept = contracts.reads_as_written("BACKUP", run.written_as["prior"], publish.readback(spark, scratch.root, "run-0", run.prior.schema))
    read = contracts.reads_as_written("READBACK", run.written_as["candidate"], publish.readback(spark, scratch.root, "run-1", cand.schema))
    every = scratch.table(contracts.all_contracts(run.validated(), read, kept), "statuses")
    status = lambda *names: F.when(F.count_if(F.col("contract").isin(*names) & (F.col("status") != "PASS")) > 0, "FAIL").otherwise("PASS")
    statuses = every.agg(
        status("SCHEMA").alias("schema_contract"), status("TYPE").alias("type_contract"), status("BACKUP").alias("backup_contract"), status("READBACK").alias("readback"),
        status("SEMANTIC_VALIDATION", "LAST_GOOD", "MISSING_NOT_ZERO", "UNIFORM_STAMP").alias("semantic_validation"), status("MASTER_NON_SHRINK").alias("master_non_shrink"),
        status("UNSELECTED_PRESERVATION").alias("unselected_preservation"), F.when(F.count_if(F.col("status") != "PASS") > 0, "FAIL").otherwise("PASS").alias("final_status"),
    )
    return audit.run_summary("run-1", run.first, run.last, acquire.run_counts(run.run), contracts.row_and_id_counts(cand), statuses)


@_register("q21_summary_readback", _SUMMARY)
def q21_readback(spark, d):
    """The summary as it was persisted, read back with the fields that it must have."""
    path = f"{Scratch(spark).root}/summaries"
    publish.write_run_summary(q21(spark, d), path)
    return spark.read.schema(audit.SUMMARY_SCHEMA).parquet(path)


@_register("q22_duplicates", _FULL + "SELECT id, CAST(2 AS BIGINT) AS n FROM cand WHERE id % 10 = 3")
def q22(spark, d):
    cand = R.candidate(spark, d)
    return contracts.duplicate_ids(cand.unionByName(cand.where(F.col("id") % 10 == 3)))


@_register("q22_id_counts", _FULL + "SELECT count(*) + count(*) FILTER (id % 10 = 3) AS final_rows, count(DISTINCT id) AS final_unique_ids, count(*) FILTER (id % 10 = 3) AS duplicate_ids, CAST(0 AS BIGINT) AS null_ids FROM cand")
def q22_counts(spark, d):
    cand = R.candidate(spark, d)
    return contracts.row_and_id_counts(cand.unionByName(cand.where(F.col("id") % 10 == 3)))


@_register("q23_id_set_equal", _FULL + _ROW.format("ID_SET", "", "SELECT (SELECT count(*) FROM (SELECT id FROM mas EXCEPT SELECT id FROM cand)) + (SELECT count(*) FROM (SELECT id FROM cand EXCEPT SELECT id FROM mas)) AS n"))
def q23(spark, d):
    return contracts.same_id_set(R.master(spark, d), R.candidate(spark, d))


@_register("q23_id_set_customers", "SELECT 'ID_SET' AS contract, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS n_bad FROM (SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))")
def q23_customers(spark, d):
    customers = R.table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return contracts.same_id_set(customers, R.table(spark, d, "orders").select(F.col("o_custkey").alias("id")))


_DATED = StructType([StructField("o_orderkey", LongType()), StructField("ordered", DateType())])


def _date_text(spark, d):
    as_text = F.when(F.col("o_orderkey") % 100 == 0, "31.02.2001").otherwise(F.date_format("o_orderdate", "dd.MM.yyyy"))
    return R.table(spark, d, "orders").select("o_orderkey", as_text.alias("ordered"))


@_register("q24_typed_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ordered FROM orders")
def q24(spark, d):
    return acquire.coerce_types(_date_text(spark, d), _DATED, {"ordered": "dd.MM.yyyy"})


@_register("q24_type_contract", "SELECT 'TYPE' AS contract, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS n_bad FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey % 100 = 0)")
def q24_contract(spark, d):
    raw, formats = _date_text(spark, d), {"ordered": "dd.MM.yyyy"}
    return contracts.type_contract(acquire.coerce_types(raw, _DATED, formats), _DATED, acquire.unread(raw, _DATED, formats))


@_register("q25_null_not_zero", _FULL + "SELECT status, count(*) AS n, count(*) FILTER (purchase_value IS NULL) AS n_missing, count(*) FILTER (purchase_value = 0) AS n_zero FROM cand GROUP BY status")
def q25(spark, d):
    missing, zero = F.col("purchase_value").isNull(), F.col("purchase_value") == 0
    return R.candidate(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("n_missing"), F.count_if(zero).alias("n_zero"))


@_register("q26_uniform_stamp", _FULL + _ROW.format("UNIFORM_STAMP", *_COUNTED["UNIFORM_STAMP"]))
def q26(spark, d):
    return contracts.uniform_stamp(R.candidate(spark, d))


def _planted(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("doc_id") % 50
    extra = F.when(kind == 7, ' password = "hunter2222"').when(kind == 9, ' password = "short"').otherwise("")
    return R.table(spark, d, "documents").select("doc_id", F.concat("text", extra).alias("text"))


@_register("q30_scan_table", r"""SELECT doc_id FROM (SELECT doc_id, concat(text, CASE WHEN doc_id % 50 = 7 THEN ' password = "hunter2222"' WHEN doc_id % 50 = 9 THEN ' password = "short"' ELSE '' END) AS text FROM documents)
  WHERE regexp_matches(text, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----') OR regexp_matches(text, '\bgh[pousr]_[A-Za-z0-9_]{30,}\b') OR regexp_matches(text, '\bgithub_pat_[A-Za-z0-9_]{20,}\b') OR regexp_matches(text, '\bAIza[0-9A-Za-z_-]{30,}\b')
  OR regexp_matches(text, '(?i)\b(?:api[_-]?key|access[_-]?token|refresh[_-]?token|password)\s*[=:]\s*[''"][^''"]{8,}[''"]')""")  # fmt: skip
def q30(spark, d):
    return scan.scan_table(_planted(spark, d), "doc_id", "text")


# Each kind of secret, long enough and one short of it.
_SAMPLES = (
    "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN DSA PRIVATE KEY-----", "ghp_" + "a1" * 15, "ghp_" + "a1" * 14, "github_pat_" + "b2" * 10,
    "github_pat_" + "b2" * 9, "AIza" + "c3-_" * 8, "AIza" + "c3" * 14, 'api_key: "12345678"', "api_key: '1234567'",
)


def _cases(column: str, values: tuple[str, ...]) -> Column:
    at = F.col("doc_id") % len(values)
    out = F.lit("")
    for i, v in enumerate(values):
        out = F.when(at == i, v).otherwise(out)
    return out.alias(column)


def _sql_cases(values: tuple[str, ...]) -> str:
    return f"CASE doc_id % {len(values)} " + " ".join(f"WHEN {i} THEN '{v.replace(chr(39), chr(39) * 2)}'" for i, v in enumerate(values)) + " END"


@_register("q30_secret_texts", f"""WITH s AS (SELECT doc_id, concat(text, ' x ', {_sql_cases(_SAMPLES)}, ' y') AS t FROM documents) SELECT doc_id, regexp_matches(t, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----') AS private_key,
  regexp_matches(t, '\\bgh[pousr]_[A-Za-z0-9_]{{30,}}\\b') AS gh_token, regexp_matches(t, '\\bgithub_pat_[A-Za-z0-9_]{{20,}}\\b') AS gh_pat, regexp_matches(t, '\\bAIza[0-9A-Za-z_-]{{30,}}\\b') AS google_key,
  regexp_matches(t, '(?i)\\b(?:api[_-]?key|access[_-]?token|refresh[_-]?token|password)\\s*[=:]\\s*[''"][^''"]{{8,}}[''"]') AS assigned FROM s""")  # fmt: skip
def q30_texts(spark, d):
    """The kinds of secrets in whole texts, each with a sample behind it."""
    s = R.table(spark, d, "documents").select("doc_id", F.concat("text", F.lit(" x "), _cases("t", _SAMPLES), F.lit(" y")).alias("t"))
    return _kinds(s)


@_register("q30_secret_kinds", f"""WITH s AS (SELECT doc_id, concat('x ', {_sql_cases(_SAMPLES)}, ' y') AS t FROM documents) SELECT doc_id, regexp_matches(t, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----') AS private_key,
  regexp_matches(t, '\\bgh[pousr]_[A-Za-z0-9_]{{30,}}\\b') AS gh_token, regexp_matches(t, '\\bgithub_pat_[A-Za-z0-9_]{{20,}}\\b') AS gh_pat, regexp_matches(t, '\\bAIza[0-9A-Za-z_-]{{30,}}\\b') AS google_key,
  regexp_matches(t, '(?i)\\b(?:api[_-]?key|access[_-]?token|refresh[_-]?token|password)\\s*[=:]\\s*[''"][^''"]{{8,}}[''"]') AS assigned FROM s""")  # fmt: skip
def q30_kinds(spark, d):
    return _kinds(R.table(spark, d, "documents").select("doc_id", F.concat(F.lit("x "), _cases("t", _SAMPLES), F.lit(" y")).alias("t")))


def _kinds(s: DataFrame) -> DataFrame:
    t = F.col("t")
    return s.select("doc_id", text.has_private_key(t).alias("private_key"), text.has_gh_token(t).alias("gh_token"), text.has_gh_pat(t).alias("gh_pat"), text.has_google_key(t).alias("google_key"), text.has_assigned_secret(t).alias("assigned"))


# Paths, one a rule and its exceptions.
_PATHS = ("src/m.py", ".env", "a/x.PEM", "logs/y.txt", "Logs/y.txt", "cfg/Credentials.JSON", ".env.example", "logs/k.pem", "a/.env.example", "x.d/.key", "cache/a/b.tar.gz")


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    """A manifest of synthetic paths over planted texts; each path is a file of its own."""
    kind = F.col("doc_id") % 50
    body = F.concat(F.col("text"), F.when(kind == 7, ' password = "hunter2222"').when(kind == 8, ' password = "hunter2222"\0').otherwise(""))
    path = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("/"), _cases("p", _PATHS))
    path = F.when(F.col("doc_id") % len(_PATHS) == 6, ".env.example").otherwise(path)
    return tables.scan_corpus(R.table(spark, d, "documents").select(path.alias("path"), F.encode(body, "UTF-8").alias("content")))


_SQL_CORPUS = f"""c AS (SELECT CASE WHEN doc_id % {len(_PATHS)} = 6 THEN '.env.example' ELSE concat('d', CAST(doc_id AS VARCHAR), '/', {_sql_cases(_PATHS)}) END AS path, doc_id % 50 = 7 AND strlen(text) + 24 <= 2000000 AS secret FROM documents),
  v AS (SELECT 'forbidden filename' AS rule, path FROM c WHERE path <> '.env.example' AND lower(split_part(path, '/', -1)) IN ('.env', 'credentials.json', 'service-account.json', 'service_account.json')
  UNION ALL SELECT 'forbidden artifact type', path FROM c WHERE path <> '.env.example' AND regexp_extract(lower(split_part(path, '/', -1)), '^.+(\\.[^.]+)$', 1) IN ('.pem', '.key', '.p12', '.pfx', '.sqlite', '.sqlite3', '.db', '.xlsx', '.xls', '.parquet', '.ndjson', '.jsonl')
  UNION ALL SELECT 'forbidden runtime-artifact directory', path FROM c WHERE path <> '.env.example' AND len(list_intersect(string_split(path, '/')[:-2], ['artifacts', 'backups', 'snapshots', 'outputs', 'output', 'logs', 'cache'])) > 0
  UNION ALL SELECT 'possible secret pattern', path FROM c WHERE secret)"""


@_register("q31_path_rules", f"""WITH c AS (SELECT doc_id, {_sql_cases(_PATHS)} AS path FROM documents) SELECT doc_id, path, string_split(path, '/')[:-2] AS parts, lower(split_part(path, '/', -1)) AS base, regexp_extract(lower(split_part(path, '/', -1)), '^.+(\\.[^.]+)$', 1) AS suffix, path = '.env.example' AS exempt FROM c""")
def q31(spark, d):
    p = F.col("path")
    rows = R.table(spark, d, "documents").select("doc_id", _cases("path", _PATHS))
    return rows.select("doc_id", "path", paths.path_parts(p).alias("parts"), paths.base_name(p).alias("base"), paths.suffix(p).alias("suffix"), paths.is_exempt(p).alias("exempt"))


@_register("q32_violations", f"WITH {_SQL_CORPUS} SELECT rule, path FROM v")
def q32(spark, d):
    return scan.violations(_corpus(spark, d))


@_register("q32_report", f"WITH {_SQL_CORPUS} SELECT DISTINCT concat(rule, ': ', path) AS message FROM v ORDER BY message")
def q32_report(spark, d):
    return scan.sorted_report(scan.violations(_corpus(spark, d)))


@_register("q33_verdict", f"WITH {_SQL_CORPUS} SELECT CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict, CAST(CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS INTEGER) AS exit_code, count(*) AS n_findings FROM v")
def q33(spark, d):
    return scan.verdict(scan.violations(_corpus(spark, d)))


_SQL_SECRET = r"""regexp_matches({0}, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----') OR regexp_matches({0}, '\bgh[pousr]_[A-Za-z0-9_]{{30,}}\b') OR regexp_matches({0}, '\bgithub_pat_[A-Za-z0-9_]{{20,}}\b')
  OR regexp_matches({0}, '\bAIza[0-9A-Za-z_-]{{30,}}\b') OR regexp_matches({0}, '(?i)\b(?:api[_-]?key|access[_-]?token|refresh[_-]?token|password)\s*[=:]\s*[''"][^''"]{{8,}}[''"]')"""


@_register("q33_clean_verdict", f"SELECT CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict, CAST(n > 0 AS INTEGER) AS exit_code, n AS n_findings FROM (SELECT count(*) AS n FROM documents WHERE {_SQL_SECRET.format('source')})")
def q33_clean(spark, d):
    return scan.verdict(scan.violations(tables.scan_corpus(R.table(spark, d, "documents").select(F.lit("src/a.py").alias("path"), F.encode("source", "UTF-8").alias("content")))))


@_register("q33_skipped", "SELECT CAST(0 AS BIGINT) AS unreadable, count(*) FILTER (strlen(text) + 24 + CAST(doc_id % 50 = 8 AS INTEGER) > 2000000) AS too_large, count(*) FILTER (doc_id % 50 = 8 AND strlen(text) + 25 <= 2000000) AS binary, CAST(0 AS BIGINT) AS not_utf8 FROM documents")
def q33_skipped(spark, d):
    return scan.skipped(_corpus(spark, d))


#: Contents that a gate stops, and ones that just pass it, by what is left of doc_id % 100.
_SECRET = ' password = "hunter2222"'


def _gated(spark: SparkSession, d: str) -> DataFrame:
    """A file a document: every hundredth unreadable, no UTF-8, too long by a byte, of just the length that is scanned, or binary; all of these with a secret."""
    kind, body = F.col("doc_id") % 100, F.encode(F.concat("text", F.lit(_SECRET)), "UTF-8")
    fill = lambda n: F.encode(F.concat(F.repeat(F.lit("x"), n - len(_SECRET)), F.lit(_SECRET)), "UTF-8")
    content = (
        F.when(kind == 11, F.lit(None).cast("binary")).when(kind == 12, F.concat(body, F.lit(b"\xff"))).when(kind == 13, fill(scan.MAX_BYTES + 1)).when(kind == 14, fill(scan.MAX_BYTES))
        .when(kind == 15, F.concat(body, F.lit(b"\0"))).when(kind == 16, body).otherwise(F.encode("source", "UTF-8"))
    )
    return tables.scan_corpus(R.table(spark, d, "documents").select(F.concat(F.lit("src/"), F.col("doc_id").cast("string")).alias("path"), content.alias("content")))


@_register("q33_gates", """SELECT count(*) FILTER (doc_id % 100 = 11) AS unreadable, count(*) FILTER (doc_id % 100 = 13 OR (doc_id % 100 IN (12, 15, 16) AND strlen(text) + 24 + CAST(doc_id % 100 <> 16 AS INTEGER) > 2000000)) AS too_large,
  count(*) FILTER (doc_id % 100 = 15 AND strlen(text) + 25 <= 2000000) AS binary, count(*) FILTER (doc_id % 100 = 12 AND strlen(text) + 25 <= 2000000) AS not_utf8 FROM documents""")  # fmt: skip
def q33_gates(spark, d):
    return scan.skipped(_gated(spark, d))


@_register("q33_gated_findings", "SELECT 'possible secret pattern' AS rule, concat('src/', CAST(doc_id AS VARCHAR)) AS path FROM documents WHERE doc_id % 100 = 14 OR (doc_id % 100 = 16 AND strlen(text) + 24 <= 2000000)")
def q33_gated_findings(spark, d):
    return scan.violations(_gated(spark, d))


@_register("q34_extra_pattern", """SELECT doc_id FROM documents WHERE regexp_matches(text, 'token = "[0-9a-f]{40}"')""")
def q34(spark, d):
    return scan.scan_table(R.table(spark, d, "documents"), "doc_id", "text", (*text.SECRETS, 'token = "[0-9a-f]{40}"'))


@_register("q35_sanitize", "SELECT conv_id, turn, concat('GET https://api.example.com/v1?[removed] failed' || chr(10), 'Authorization: [removed]' || chr(10), 'Cookie: [removed]' || chr(10), 'password=[removed], n=', CAST(length(text) AS VARCHAR)) AS error FROM conversations")
def q35(spark, d):
    key = F.sha2("text", 256)
    error = F.concat(
        F.lit("GET https://api.example.com/v1?key="), key, F.lit(" failed\nAuthorization: Bearer "), key, F.lit("\nCookie: sid="), key, F.lit("\npassword="), key, F.lit(", n="), F.length("text").cast("string"),
    )
    return R.table(spark, d, "conversations").select("conv_id", "turn", text.sanitize(error).alias("error"))


def _sql_sanitized(value: str) -> str:
    """The sanitizers one around the other, with groups as SQL writes them."""
    for pattern, instead in text.SANITIZERS:
        value = f"regexp_replace({value}, '{pattern.replace(chr(39), chr(39) * 2)}', '{instead.replace('$', chr(92))}', 'g')"
    return value


_ERRORS = ("\nGET https://api.example.com/v1?key=", " failed\nAuthorization: Bearer ", "\nSet-Cookie: sid=", "\nbasic ", "\nAPI_KEY: '", "' token=", ";")
_SQL_ERRORS = ", md5(text), ".join(f"'{e.replace(chr(39), chr(39) * 2)}'" for e in _ERRORS)


@_register("q35_sanitized_texts", f"SELECT conv_id, turn, {_sql_sanitized(f'concat(text, {_SQL_ERRORS}, text)')} AS error FROM conversations")
def q35_texts(spark, d):
    """Whole texts with what no log may hold in their midst."""
    parts = [x for e in _ERRORS for x in (F.lit(e), F.md5("text"))][:-1]
    return R.table(spark, d, "conversations").select("conv_id", "turn", text.sanitize(F.concat("text", *parts, "text")).alias("error"))


@_register("q36_links", """SELECT page_id, unnest(regexp_extract_all(concat('see ', url, ' and (', url, ')'), 'https?://[^\\s"''<>)\\]]+')) AS link FROM pages""")
def q36(spark, d):
    pages = R.table(spark, d, "pages").withColumn("body", F.concat(F.lit("see "), "url", F.lit(" and ("), "url", F.lit(")")))
    return pages.select("page_id", F.explode(text.find_links(F.col("body"))).alias("link"))


@_register("q36_page_links", r"""SELECT page_id, unnest(regexp_extract_all(replace(html, 'href="/', 'href="https://pages.example/'), 'https?://[^\s"''<>)\]]+')) AS link FROM pages""")
def q36_pages(spark, d):
    """Links of whole pages; their own are relative, and get a host."""
    body = F.replace("html", F.lit('href="/'), F.lit('href="https://pages.example/'))
    return R.table(spark, d, "pages").select("page_id", F.explode(text.find_links(body)).alias("link"))


@_register("q37_page_resources", r"""SELECT page_id, unnest(list_concat(regexp_extract_all(html, 'href="/[^"]{6,}"'), regexp_extract_all(html, '<h[1-6]>'))) AS resource FROM pages""")
def q37_pages(spark, d):
    """What patterns find in whole pages."""
    return R.table(spark, d, "pages").select("page_id", F.explode(text.find_resource_ids(F.col("html"), ['href="/[^"]{6,}"', "<h[1-6]>"])).alias("resource"))


@_register("q37_resource_ids", "SELECT page_id, unnest(list_concat(regexp_extract_all(concat('/d/', md5(url), '/edit'), '/d/[a-z0-9]{20,}'), regexp_extract_all(url, '/[a-z]{2}/[0-9]+'))) AS resource FROM pages")
def q37(spark, d):
    body = F.concat(F.lit("/d/"), F.md5("url"), F.lit("/edit "), "url")
    found = text.find_resource_ids(body, ["/d/[a-z0-9]{20,}", "/[a-z]{2}/[0-9]+"])
    return R.table(spark, d, "pages").select("page_id", F.explode(found).alias("resource"))


_T0, _T1, _T2 = datetime(2024, 1, 30), datetime(2024, 2, 1), datetime(2024, 2, 2)


def _published(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """The master, then the candidate, published under a folder of this run."""
    root, run = Scratch(spark).root, R.Run.written(spark, d)
    publish.publish_validated(run.prior, contracts.no_duplicates(run.prior), root, "run-0", _T0)
    publish.publish_validated(run.candidate, run.validated(), root, "run-1", _T1)
    return root, run.prior


@_register("q40_publish_readback", _FULL + "SELECT * FROM cand")
def q40(spark, d):
    root, _ = _published(spark, d)
    return publish.read_current(spark, root)


@_register("q41_backup_fingerprint", _FULL + "SELECT count(*) AS n_rows, true AS intact FROM cand")
def q41(spark, d):
    root, _ = _published(spark, d)
    kept = publish.backup(spark, root)
    again = contracts.fingerprint(publish.read_current(spark, root).repartition(5))
    return again.select("n_rows", (F.col("checksum") == F.lit(kept["checksum"])).alias("intact"))


@_register("q42_failing_candidate", _FULL + "SELECT *, 'contract failed at validate candidate: MASTER_NON_SHRINK' AS error FROM cand")
def q42(spark, d):
    """A shrunken candidate is refused, and what was published stays current."""
    root, prior = _published(spark, d)
    bad = publish.read_current(spark, root).where(F.col("id") % 10 != 3)
    try:
        publish.publish_validated(bad, contracts.non_shrink(prior, bad), root, "run-2", _T2)
        error = ""
    except RuntimeError as e:
        error = str(e).split(" (")[0]
    return publish.read_current(spark, root).withColumn("error", F.lit(error))


_DAYS = "days AS (SELECT strftime(ts, '%Y-%m-%d') AS run_id, strftime(ts, '%Y-%m-%d') AS version, max(ts) AS published_at, CASE WHEN count(*) FILTER (event_type = 'error') * 4 > count(*) THEN 'FAIL' ELSE 'PASS' END AS status FROM events GROUP BY 1)"


@_register("q43_previous_version", f"WITH {_DAYS} SELECT *, last_value(CASE WHEN status = 'PASS' THEN version END IGNORE NULLS) OVER (ORDER BY published_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM days")
def q43(spark, d):
    day = F.date_format("ts", "yyyy-MM-dd")
    status = F.when(F.count_if(F.col("event_type") == "error") * 4 > F.count(F.lit(1)), "FAIL").otherwise("PASS")
    log = R.table(spark, d, "events").groupBy(day.alias("run_id")).agg(F.max("ts").alias("published_at"), status.alias("status"))
    return publish.previous_version(log.withColumn("version", F.col("run_id")))


_RUN = "concat(strftime(ts, '%Y-%m-%d'), CASE WHEN hour(ts) < 12 THEN '-04' ELSE '-13' END)"
_SUMMARIES = f"""sums AS (SELECT {_RUN} AS run_id, min(ts) AS started_at, max(ts) AS finished_at, CAST(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS DOUBLE) AS wall_seconds, count(DISTINCT user_id) AS selected_count, count(*) FILTER (event_type = 'error') AS failed_count,
  CASE WHEN count(*) FILTER (event_type = 'purchase') * 6 < count(*) THEN 'FAIL' ELSE 'PASS' END AS readback, CASE WHEN count(*) FILTER (event_type = 'error') * 4 > count(*) THEN 'FAIL' ELSE 'PASS' END AS final_status FROM events WHERE user_id % 7 <> 0 GROUP BY 1)"""


def _run_id() -> Column:
    return F.concat(F.date_format("ts", "yyyy-MM-dd"), F.when(F.hour("ts") < 12, "-04").otherwise("-13")).alias("run_id")


def _summaries(spark: SparkSession, d: str) -> DataFrame:
    """Half-days of events as runs, two a day."""
    kind, n = F.col("event_type"), F.count(F.lit(1))
    seconds = lambda c: F.unix_timestamp(c.cast("timestamp"))
    return R.table(spark, d, "events").where(F.col("user_id") % 7 != 0).groupBy(_run_id()).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"), (seconds(F.max("ts")) - seconds(F.min("ts"))).cast("double").alias("wall_seconds"),
        F.count_distinct("user_id").alias("selected_count"), F.count_if(kind == "error").alias("failed_count"),
        F.when(F.count_if(kind == "purchase") * 6 < n, "FAIL").otherwise("PASS").alias("readback"), F.when(F.count_if(kind == "error") * 4 > n, "FAIL").otherwise("PASS").alias("final_status"),
    )


@_register("q50_unproven_runs", f"WITH {_SUMMARIES}, dis AS (SELECT {_RUN} AS run_id, min(ts) AS dispatched_at FROM events GROUP BY 1) SELECT * FROM dis WHERE run_id NOT IN (SELECT run_id FROM sums WHERE readback = 'PASS' AND final_status = 'PASS')")
def q50(spark, d):
    dispatches = R.table(spark, d, "events").groupBy(_run_id()).agg(F.min("ts").alias("dispatched_at"))
    return audit.unproven_runs(dispatches, _summaries(spark, d))


@_register("q51_run_trend", f"WITH {_SUMMARIES} SELECT CAST(started_at AS DATE) AS day, count(*) AS n_runs, max(wall_seconds) AS max_wall_seconds, avg(wall_seconds) AS avg_wall_seconds, CAST(sum(selected_count) AS BIGINT) AS selected_count, CAST(sum(failed_count) AS BIGINT) AS failed_count, count(*) FILTER (final_status <> 'PASS') AS n_failed_runs FROM sums GROUP BY 1")
def q51(spark, d):
    return audit.run_trend(_summaries(spark, d))


@_register("q52_stage_log", _FULL + "SELECT 'run-1' AS run_id, 'acquire' AS stage, count(*) AS n_rows, 'PASS' AS status FROM att UNION ALL SELECT 'run-1', 'measure', count(*), 'PASS' FROM per UNION ALL SELECT 'run-1', 'materialize', count(*), 'PASS' FROM cand UNION ALL SELECT 'run-1', 'master', count(*), 'PASS' FROM mas")
def q52(spark, d):
    """A row a stage, without payload, though the stages' tables have it."""
    rows = R.attempts(spark, d)
    stages = {"acquire": rows, "measure": R.measured(rows), "materialize": R.candidate(spark, d), "master": R.master(spark, d)}
    log = contracts.all_contracts(*[audit.stage_row(df, name) for name, df in stages.items()])
    return audit.allowlist_columns(log.withColumns({"run_id": F.lit("run-1"), "status": F.lit("PASS"), "payload": F.lit("")}))


@_register("q52_observed_log", _FULL + "SELECT 'run-1' AS run_id, 'acquire' AS stage, count(*) AS n_rows, 'PASS' AS status FROM att UNION ALL SELECT 'run-1', 'measure', count(*), 'PASS' FROM per UNION ALL SELECT 'run-1', 'materialize', count(*), 'PASS' FROM cand UNION ALL SELECT 'run-1', 'master', count(*), 'PASS' FROM mas")
def q52_observed(spark, d):
    """The same log from what was counted as the run's tables were written: no stage is read again."""
    stages = R.Run.written(spark, d).stages
    log = spark.createDataFrame([("run-1", stage, n, "PASS", "") for stage, n in stages.items()], "run_id string, stage string, n_rows bigint, status string, payload string")
    return audit.allowlist_columns(log)
