"""Registered queries of stage logs, files, commits, buckets and digests, with the SQL that checks each of them."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from tidemark.operators import acquire, audit, contracts, digests, merge, scan
from tidemark.plans import refresh as R
from tidemark.plans.job import Refresh, refresh
from tidemark.plans.registry import _FULL, _PATHS, _SQL_CORPUS, _SUMMARIES, _corpus, _broken, _cases, _register, _sql_cases, _summaries
from tidemark.sources import buckets, commits, files, publish, tables
from tidemark.sources.stage_log import StageLog
from tidemark.sources.workspace import Scratch

_T0, _T1, _T2 = datetime(2024, 1, 30), datetime(2024, 2, 1), datetime(2024, 2, 2)


@_register("q52_failing_stages", _FULL + """SELECT 'run-1' AS run_id, stage, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_bad AS BIGINT) AS n_bad, true AS timed, status, error FROM (
  SELECT 'acquire' AS stage, (SELECT count(*) FROM att) AS n_rows, (SELECT count(*) FILTER (NOT ok) FROM att) AS n_bad, 'PASS' AS status, NULL AS error
  UNION ALL SELECT 'master', (SELECT count(*) FROM mas), 0, 'PASS', NULL
  UNION ALL SELECT 'materialize', (SELECT count(*) FROM cand), (SELECT count(*) FILTER (purchase_value IS NULL) FROM cand), 'PASS', NULL
  UNION ALL SELECT 'validate candidate', NULL, NULL, 'FAIL', concat('RuntimeError: contract failed at validate candidate: MASTER_NON_SHRINK (', (SELECT count(*) FILTER (id % 10 = 3) FROM mas), ')')
  UNION ALL SELECT 'publish', NULL, NULL, 'FAIL', 'ArithmeticException [DIVIDE_BY_ZERO]'
  UNION ALL SELECT 'notify', NULL, NULL, 'FAIL', 'ValueError: GET https://api.example.com/v1?[removed] failed, token=[removed]')""")  # fmt: skip
def q52_failing(spark, d):
    """The log of a run whose stages are timed and counted as they write; three of them are made to fail, and theirs are rows too."""
    scratch = Scratch(spark)
    log = StageLog(spark, "run-1", f"{scratch.root}/stages")
    with log.stage("acquire") as s:
        attempts = scratch.table(s.watch(R.attempts(spark, d), F.col("ok")), "attempts")
    with log.stage("master") as s:
        prior = scratch.table(s.watch(R.master(spark, d)), "prior")
    with log.stage("materialize") as s:
        made = R.stamped(merge.merge_snapshot(prior, R.measured(attempts), R.METRICS))
        candidate = scratch.table(s.watch(made, F.col("purchase_value").isNotNull()), "candidate")

    def failing(name: str, act) -> None:
        try:
            with log.stage(name) as s:
                act(s)
        except Exception:  # logged, and what this query shows
            return
        raise AssertionError(f"{name} should have failed")

    failing("validate candidate", lambda s: contracts.require(contracts.non_shrink(prior, candidate.where(F.col("id") % 10 != 3)), "validate candidate"))
    failing("publish", lambda s: publish.publish(s.watch(candidate.withColumn("n_ok", F.expr("n_ok div (id - id)"))), scratch.root, "run-1"))

    def notify(s):
        raise ValueError(f"GET https://api.example.com/v1?key={candidate.count()} failed, token={candidate.count()}\n{candidate.limit(1).collect()}")

    failing("notify", notify)
    return log.read().select("run_id", "stage", "n_rows", "n_bad", (F.col("elapsed_seconds") >= 0).alias("timed"), "status", "error")


def _file_corpus(spark: SparkSession, d: str) -> DataFrame:
    """A file a document, in folders of a hundred: names that begin with a dot and a root that holds one are among them."""
    kind = F.col("doc_id") % 50
    body = F.concat(F.col("text"), F.when(kind == 7, ' password = "hunter2222"').when(kind == 8, ' password = "hunter2222"\0').otherwise(""))
    own = F.concat(F.lit("d"), F.expr("doc_id div 100").cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit("/"), _cases("p", _PATHS))
    path = F.when(F.col("doc_id") == 6, ".env.example").otherwise(own)
    return R.table(spark, d, "documents").select(path.alias("path"), F.encode(body, "UTF-8").alias("content"))


_SQL_FILES = f"""c AS (SELECT CASE WHEN doc_id = 6 THEN '.env.example' ELSE concat('d', CAST(doc_id // 100 AS VARCHAR), '/', CAST(doc_id AS VARCHAR), '/', {_sql_cases(_PATHS)}) END AS path, doc_id % 50 = 7 AND strlen(text) + 24 <= 2000000 AS secret FROM documents),
  v AS (SELECT 'forbidden filename' AS rule, path FROM c WHERE path <> '.env.example' AND lower(split_part(path, '/', -1)) IN ('.env', 'credentials.json', 'service-account.json', 'service_account.json')
  UNION ALL SELECT 'forbidden artifact type', path FROM c WHERE path <> '.env.example' AND regexp_extract(lower(split_part(path, '/', -1)), '^.+(\\.[^.]+)$', 1) IN ('.pem', '.key', '.p12', '.pfx', '.sqlite', '.sqlite3', '.db', '.xlsx', '.xls', '.parquet', '.ndjson', '.jsonl')
  UNION ALL SELECT 'forbidden runtime-artifact directory', path FROM c WHERE path <> '.env.example' AND len(list_intersect(string_split(path, '/')[:-2], ['artifacts', 'backups', 'snapshots', 'outputs', 'output', 'logs', 'cache'])) > 0
  UNION ALL SELECT 'possible secret pattern', path FROM c WHERE secret)"""


@_register("q32_file_violations", f"WITH {_SQL_FILES} SELECT rule, path FROM v")
def q32_files(spark, d):
    """Documents written as files, and the files found and read again by directory: the rows that a manifest of them gives."""
    root = f"{Scratch(spark).root}/files"
    files.write_files(_file_corpus(spark, d), root)
    return scan.violations(tables.scan_files(spark, root))


@_register("q32_exempt_rules", f"""WITH {_SQL_CORPUS.replace("'.jsonl')", "'.jsonl', '.example')")} SELECT rule, path FROM v""")
def q32_exempt(spark, d):
    """Rules by which the exempt path would be forbidden: it stays, while the same name in a folder does not, and its content is scanned like any other."""
    return scan.violations(_corpus(spark, d), scan.Rules(suffixes=(*scan.paths.SUFFIXES, ".example")))


@_register("q10_bucketed_candidate", _FULL + "SELECT * FROM cand")
def q10_buckets(spark, d):
    """The candidate, merged into a version that lies in buckets: the master is read in place and only the run is shuffled."""
    root = Scratch(spark).root
    publish.publish(R.master(spark, d), root, "run-0", BUCKETS)
    return R.candidate(spark, d, publish.read_version(spark, root, "run-0"))


BUCKETS = 16
# Spark's 32-bit hash of a long with seed 42, in SQL: two rounds of mixing over its halves, then an avalanche.
_MASK = 4294967295
_MUL = lambda a, b: f"CAST((CAST({a} AS HUGEINT) * {b}) & {_MASK} AS BIGINT)"
_ROT = lambda a, r: f"((({a} << {r}) & {_MASK}) | ({a} >> {32 - r}))"
_K = lambda half: _MUL(_ROT(f"({_MUL(half, 3432918353)})", 15), 461845907)
_MIX = lambda h, half: f"CAST((CAST({_ROT(f'xor({h}, {half})', 13)} AS HUGEINT) * 5 + 3864292196) & {_MASK} AS BIGINT)"
_SQL_BUCKETS = f"""k AS (SELECT id, {_K(f'(id & {_MASK})')} AS lo, {_K('(id >> 32)')} AS hi FROM mas), m1 AS (SELECT id, hi, {_MIX('42', 'lo')} AS h FROM k), m2 AS (SELECT id, xor({_MIX('h', 'hi')}, 8) AS h FROM m1),
  f1 AS (SELECT id, {_MUL('xor(h, h >> 16)', 2246822507)} AS h FROM m2), f2 AS (SELECT id, {_MUL('xor(h, h >> 13)', 3266489909)} AS h FROM f1),
  b AS (SELECT id, xor(h, h >> 16) % {BUCKETS} AS bucket FROM f2)"""


@_register("q41_tampered_bucket", _FULL + f", {_SQL_BUCKETS}, t AS (SELECT bucket AS tampered FROM b ORDER BY id LIMIT 1) SELECT CAST(bucket AS INTEGER) AS bucket, count(*) AS n_rows, bucket = tampered AS damaged, CASE WHEN bucket = tampered THEN 2 * count(*) ELSE 0 END AS n_bad FROM b, t GROUP BY bucket, tampered")
def q41_tampered(spark, d):
    """A version whose files of one bucket are exchanged: its hash tree names the bucket, and only that bucket's rows are compared, by its own files."""
    root, prior = Scratch(spark).root, R.master(spark, d)
    path = f"{root}/versions/run-0"
    publish.publish(prior, root, "run-0", BUCKETS)
    first = prior.orderBy("id").limit(1).select(digests.bucket_of("id", BUCKETS)).first()[0]
    _tamper(spark, path, prior, first)
    bad = buckets.damaged_buckets(spark, path)
    left = digests.in_buckets(prior, bad, BUCKETS).withColumn("_side", F.lit(1)).unionByName(buckets.read_buckets(spark, path, bad).withColumn("_side", F.lit(-1)))
    n_bad = left.groupBy(*prior.columns).agg(F.sum("_side").alias("_left")).groupBy(digests.bucket_of("id", BUCKETS).alias("bucket")).agg(F.sum(F.abs("_left")).alias("n_bad"))
    sizes = prior.groupBy(digests.bucket_of("id", BUCKETS).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))
    return sizes.join(n_bad, "bucket", "left").select("bucket", "n_rows", F.col("bucket").isin(bad).alias("damaged"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"))


def _tamper(spark: SparkSession, path: str, rows: DataFrame, bucket: int) -> None:
    """Puts other rows into a bucket's files, as if someone had written there by hand."""
    fs, at = commits.hadoop_path(spark, path)
    for f in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(at, f"*_{bucket:05d}.c*")):
        fs.delete(f.getPath(), False)
    side = f"{path}-side"
    buckets.write_bucketed(digests.in_buckets(rows, [bucket], BUCKETS).withColumn("n_ok", F.col("n_ok") + 1), side, BUCKETS)
    for f in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{side}/*_{bucket:05d}.c*")):
        fs.rename(f.getPath(), at)


@_register("q20_bucket_contracts", _FULL + """SELECT 'published' AS candidate, 'UNSELECTED_PRESERVATION' AS contract, 'PASS' AS status, CAST(0 AS BIGINT) AS n_bad FROM (SELECT count(*) FROM cand)
  UNION ALL SELECT 'tampered', 'UNSELECTED_PRESERVATION', 'FAIL', 2 * count(*) FILTER (status = 'UNSELECTED' AND id % 10 = 4) FROM cand
  UNION ALL SELECT 'published', 'READBACK', 'PASS', 0 UNION ALL SELECT 'changed after', 'READBACK', 'FAIL', 2 * count(*) FILTER (id % 10 = 4) FROM cand""")  # fmt: skip
def q20_buckets(spark, d):
    """Preservation and readback by the digests of buckets, of a candidate as it is and of ones with changed rows."""
    scratch = Scratch(spark)
    root, run = scratch.root, scratch.table(R.measured(R.attempts(spark, d)), "run")
    publish.publish(R.master(spark, d), root, "run-0", BUCKETS)
    prior = publish.read_version(spark, root, "run-0")
    publish.publish(R.stamped(merge.merge_snapshot(prior, run, R.METRICS)), root, "run-1", BUCKETS, placed=True)
    cand = publish.read_version(spark, root, "run-1")
    changed = cand.withColumn("n_ok", F.when(F.col("id") % 10 == 4, F.col("n_ok") + 1).otherwise(F.col("n_ok")))
    rows = []
    for name, df in (("published", cand), ("tampered", changed)):
        found, _ = digests.unselected_by_bucket(prior, run.select("id"), df, R.METRICS, BUCKETS)
        rows.append(found.select(F.lit(name).alias("candidate"), "contract", "status", "n_bad"))
    for name, df in (("published", cand), ("changed after", changed)):
        rows.append(publish.readback_contract(df, root, "run-1").select(F.lit(name).alias("candidate"), "contract", "status", "n_bad"))
    return contracts.all_contracts(*rows)


@_register("q40_two_writers", _FULL + "SELECT id, n_ok, purchase_value, last_ok_at, last_value, 'ConcurrentPublication' AS conflict, CAST(2 AS BIGINT) AS n_built, CAST(4 AS BIGINT) AS n_entries FROM cand")
def q40_writers(spark, d):
    """Two writers begin on the master, one with the even ids' attempts, one with the odd ones'. The second to commit is refused, builds again on what the first published, and nothing of either is lost."""
    scratch, built = Scratch(spark), []
    root, run = scratch.root, scratch.table(R.measured(R.attempts(spark, d)), "run")
    prior = scratch.table(R.master(spark, d), "prior")
    publish.publish_validated(prior, contracts.no_duplicates(prior), root, "run-0", _T0)

    def of(rest: int, on: DataFrame, name: str) -> DataFrame:
        made = merge.merge_snapshot(on, run.where(F.pmod("id", F.lit(2)) == rest), R.METRICS)
        return scratch.table(made.select("id", *R.METRICS), name)

    def build(on: DataFrame) -> tuple[DataFrame, DataFrame]:
        built.append(publish.current_version(spark, root))
        if len(built) == 1:  # the other writer, begun on the same version, is faster
            other = of(0, on, "even")
            publish.publish_validated(other, contracts.non_shrink(on, other), root, "run-1", _T1)
        made = of(1, on, f"odd-{len(built)}")
        return made, contracts.non_shrink(on, made)

    publish.publish_onto(spark, root, "run-2", _T2, build)
    log = publish.publication_log(spark, root).orderBy("entry").collect()
    refused = [r for r in log if r["status"] == "FAIL" and r["run_id"] == "run-2"]
    conflict = "ConcurrentPublication" if [r["version"] for r in refused] == ["run-2"] and built == ["run-0", "run-1"] else f"{built} {log}"
    return publish.read_current(spark, root).select("*", F.lit(conflict).alias("conflict"), F.lit(len(built)).cast("long").alias("n_built"), F.lit(len(log)).cast("long").alias("n_entries"))


@_register("q43_rollback", _FULL + "SELECT id, n_ok, purchase_value, last_ok_at, last_value, 0 AS depth, 'run-0' AS version FROM mas")
def q43_rollback(spark, d):
    """Published twice and rolled back: the first version is current again, and the log says how."""
    root, run = Scratch(spark).root, R.Run.written(spark, d)
    publish.publish_validated(run.prior, contracts.no_duplicates(run.prior), root, "run-0", _T0)
    publish.publish_validated(run.candidate, contracts.no_duplicates(run.candidate), root, "run-1", _T1)
    publish.rollback(spark, root, "rollback-1", _T2)
    stands = commits.standing(publish.publication_log(spark, root))
    return publish.read_current(spark, root).crossJoin(F.broadcast(stands))


@_register("q43_sweep", _FULL + "SELECT * FROM (SELECT 'run-0' AS version, true AS kept, count(*) AS n_rows FROM mas UNION ALL SELECT 'run-1', true, count(*) FROM cand UNION ALL SELECT 'run-2', false, 0 UNION ALL SELECT 'lost', false, 0)")
def q43_sweep(spark, d):
    """A failed and a lost publication leave folders that nothing leads to: these go, while the current version and its backup stay."""
    root, run = Scratch(spark).root, R.Run.written(spark, d)
    cand, short = run.candidate, run.candidate.where(F.col("id") % 10 != 3)
    publish.publish_validated(run.prior, contracts.no_duplicates(run.prior), root, "run-0", _T0)
    publish.publish_validated(cand, contracts.no_duplicates(cand), root, "run-1", _T1)
    publish.publish(short, root, "lost")
    publish.publish(short, root, "run-2")
    commits.commit(spark, root, commits.head(spark, root), "run-2", "run-2", _T2, "FAIL")
    swept = commits.sweep(spark, root, older_than=0.0)
    left = {r["version"]: publish.read_version(spark, root, r["version"]).count() for r in swept.where("kept").collect()}
    n = F.coalesce(*[F.when(F.col("version") == v, F.lit(k)) for v, k in left.items()], F.lit(0)).cast("long")
    gone = [r["version"] for r in swept.where("not kept").collect() if commits.exists(spark, f"{root}/versions/{r['version']}")]
    return swept.select("version", (F.col("kept") | F.col("version").isin(gone)).alias("kept"), n.alias("n_rows"))


_SAMPLE = "(SELECT array_to_string(list(id ORDER BY md5(CAST(id AS VARCHAR)), id)[1:5], ',') FROM {0})"
_OFFENDING = {
    "shrunken": ("MASTER_NON_SHRINK", "(SELECT id FROM mas WHERE id % 10 = 3)"), "duplicated": ("DUPLICATES", "(SELECT id FROM cand WHERE id % 10 = 3)"),
    "zero_filled": ("MISSING_NOT_ZERO", "(SELECT id FROM per WHERE n_success > 0 AND purchase_value IS NULL)"), "tampered": ("UNSELECTED_PRESERVATION", "(SELECT id FROM cand WHERE status = 'UNSELECTED')"),
    "late_stamp": ("UNIFORM_STAMP", "(SELECT id FROM cand WHERE id % 10 = 3)"), "no_success": ("SEMANTIC_VALIDATION", "(SELECT id FROM cand WHERE id % 10 = 3)"), "carried_changed": ("LAST_GOOD", "(SELECT id FROM cand WHERE status = 'CARRIED')"),
}


@_register("q20_failing_samples", _FULL + "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{name}' AS candidate, '{contract}' AS contract, (SELECT count(*) FROM {ids}) AS n_ids, {_SAMPLE.format(ids)} AS sample" for name, (contract, ids) in _OFFENDING.items()) + ") WHERE n_ids > 0")
def q20_samples(spark, d):
    """Which ids make each broken candidate fail: how many, and the five with the smallest hash."""
    run, scratch, rows = R.Run.written(spark, d), Scratch(spark), []
    third = F.col("id") % 10 == 3
    broken = {name: df for name, (df, _) in _broken(run.candidate).items()}
    broken["no_success"] = run.candidate.withColumn("n_ok", F.when(third, F.lit(0)).otherwise(F.col("n_ok")))
    broken["carried_changed"] = run.candidate.withColumn("last_value", F.when(F.col("status") == merge.CARRIED, F.lit(-1.0)).otherwise(F.col("last_value")))
    for name, df in broken.items():
        found = contracts.samples(scratch.table(run.offenders(df), name)).where(F.col("contract") == _OFFENDING[name][0])
        rows.append(found.select(F.lit(name).alias("candidate"), "contract", "n_ids", F.array_join(F.col("sample").cast("array<string>"), ",").alias("sample")))
    return contracts.all_contracts(*rows)


_TYPED = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()), StructField("o_orderstatus", StringType(), False), StructField("o_totalprice", DoubleType()), StructField("o_orderdate", DateType()),
])
_KEYS, _FORMATS = ("o_orderkey",), {"o_orderdate": "dd.MM.yyyy"}


def _orders_as_text(spark: SparkSession, d: str) -> DataFrame:
    """Orders as text, with what no column can hold planted in one of twenty."""
    kind, day = F.col("o_orderkey") % 100, F.date_format("o_orderdate", "dd.MM.yyyy")
    return R.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(kind == 3, "99999999999999999999").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(~kind.isin(4, 5), F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(kind.isin(2, 5), "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(kind == 0, "31.02.2001").when(kind == 1, "soon").otherwise(day).alias("o_orderdate"),
    )


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return tables.write_split(acquire.coerce_or_reject(_orders_as_text(spark, d), _TYPED, _KEYS, _FORMATS), f"{Scratch(spark).root}/orders")


_PLANTED = """q AS (SELECT o_orderkey, unnest(CASE o_orderkey % 100 WHEN 0 THEN [{'c': 'o_orderdate', 'r': 'no such date'}] WHEN 1 THEN [{'c': 'o_orderdate', 'r': 'not in the format'}] WHEN 2 THEN [{'c': 'o_totalprice', 'r': 'not a number'}]
  WHEN 3 THEN [{'c': 'o_custkey', 'r': 'out of range'}] WHEN 4 THEN [{'c': 'o_orderstatus', 'r': 'missing'}] WHEN 5 THEN [{'c': 'o_totalprice', 'r': 'not a number'}, {'c': 'o_orderstatus', 'r': 'missing'}] ELSE [] END) AS p FROM orders)"""


@_register("q24_quarantine", f"WITH {_PLANTED} SELECT o_orderkey, p.c AS \"column\", p.r AS reason FROM q")
def q24_quarantine(spark, d):
    """What is wrong with rows that do not have their types, without any value of theirs."""
    return acquire.quarantined(_split(spark, d)[1], _KEYS)


@_register("q24_accepted", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE o_orderkey % 100 NOT BETWEEN 0 AND 5")
def q24_accepted(spark, d):
    return _split(spark, d)[0]


@_register("q24_split_counts", f"WITH {_PLANTED} SELECT (SELECT count(*) FROM orders) AS n_input, (SELECT count(*) FROM orders WHERE o_orderkey % 100 NOT BETWEEN 0 AND 5) AS n_accepted, (SELECT count(DISTINCT o_orderkey) FROM q) AS n_rejected, (SELECT count(*) FROM q) AS n_problems, (SELECT CAST(sum(o_orderkey) AS BIGINT) FROM orders) AS keys")
def q24_counts(spark, d):
    """Accepted and rejected rows are the input, to the row and to the sum of its keys."""
    good, bad = _split(spark, d)
    both = good.select("o_orderkey", F.lit(0).alias("n")).unionByName(bad.select("o_orderkey", F.size("problems").alias("n")))
    n_input = R.table(spark, d, "orders").agg(F.count(F.lit(1)).alias("n_input"))
    counts = both.agg(F.count_if(F.col("n") == 0).alias("n_accepted"), F.count_if(F.col("n") > 0).alias("n_rejected"), F.sum("n").alias("n_problems"), F.sum("o_orderkey").alias("keys"))
    return n_input.crossJoin(F.broadcast(counts))


@_register("q51_sketched_trend", f"WITH {_SUMMARIES} SELECT CAST(date_trunc('week', started_at) AS DATE) AS period, count(*) AS n_runs, count(*) FILTER (final_status <> 'PASS') AS n_failed_runs, quantile_disc(wall_seconds, 0.5) AS q50, quantile_disc(wall_seconds, 0.9) AS q90, max(wall_seconds) AS q100 FROM sums GROUP BY 1")
def q51_sketched(spark, d):
    """Summaries as they were persisted, run by run; their days are sketched and stored, and weeks come from merged sketches."""
    scratch = Scratch(spark)
    wanted = [F.col(part.split()[0]) if part.split()[0] in _summaries(spark, d).columns else F.lit(None).cast(part.split()[1]).alias(part.split()[0]) for part in audit.SUMMARY_SCHEMA.split(", ")]
    for part in range(2):  # two days' worth of writers
        publish.write_run_summary(_summaries(spark, d).where(F.dayofmonth("started_at") % 2 == part).select(*wanted), f"{scratch.root}/summaries")
    persisted = spark.read.schema(audit.SUMMARY_SCHEMA).parquet(f"{scratch.root}/summaries")
    stored = scratch.table(audit.day_sketches(persisted), "days")
    return audit.sketched_trend(stored, F.date_trunc("week", "day").cast("date"))


def events_refresh() -> Refresh:
    return Refresh(R.CANDIDATE, R.METRICS, ["purchase_value", "last_value"], R.measured, R.Run.rules(), buckets=BUCKETS)


def _refreshed(spark: SparkSession, d: str) -> str:
    """Three runs under one root: the first makes the master's rows, the second refreshes them, and the third is refused, as what it calls fresh is old."""
    root, whole = f"{Scratch(spark).root}/published", R.Run.rules()
    before = R.events_as_attempts(spark, d).where(F.col("ts") < F.lit(R.CUT).cast("timestamp_ntz"))
    first = replace(events_refresh(), rules={"has_a_success": whole["has_a_success"]})
    refresh(spark, first, before.where("ok"), root, "run-0", _T0)
    refresh(spark, events_refresh(), R.attempts(spark, d), root, "run-1", _T1)
    try:
        refresh(spark, events_refresh(), before.where(F.col("id") % 10 == 3), root, "run-2", _T2)
    except RuntimeError:  # its summary, stages and traces are what the queries show
        return root
    raise AssertionError("the third run should have been refused")


_THIRD = "third AS (SELECT id, count(*) AS n_attempts, count(*) FILTER (ok) AS n_success FROM old WHERE id % 10 = 3 GROUP BY id), third_rows AS (SELECT id FROM cand UNION SELECT id FROM third WHERE n_success > 0)"


@_register("q60_refresh_summaries", _FULL + f""", {_THIRD} SELECT 'run-0' AS run_id, count(*) AS selected_count, count(*) AS success_count, CAST(0 AS BIGINT) AS failed_count, (SELECT count(*) FROM old WHERE ok) AS http_request_count, count(*) AS final_rows, count(*) AS final_unique_ids,
  'PASS' AS semantic_validation, 'PASS' AS readback, 'PASS' AS backup_contract, 'PASS' AS final_status, false AS current FROM mas
  UNION ALL SELECT 'run-1', count(*), count(*) FILTER (n_success > 0), count(*) FILTER (n_success = 0), (SELECT count(*) FROM att), (SELECT count(*) FROM cand), (SELECT count(*) FROM cand), 'PASS', 'PASS', 'PASS', 'PASS', true FROM per
  UNION ALL SELECT 'run-2', count(*), count(*) FILTER (n_success > 0), count(*) FILTER (n_success = 0), CAST(coalesce(sum(n_attempts), 0) AS BIGINT), (SELECT count(*) FROM third_rows), (SELECT count(*) FROM third_rows), 'FAIL', 'NOT RUN', 'NOT RUN', 'FAIL', false FROM third""")  # fmt: skip
def q60_summaries(spark, d):
    """The persisted summaries of three runs of the whole job, the last of which fails and leaves the second current."""
    root = _refreshed(spark, d)
    rows = spark.read.schema(audit.SUMMARY_SCHEMA).parquet(f"{root}/summaries")
    names = ("selected_count", "success_count", "failed_count", "http_request_count", "final_rows", "final_unique_ids", "semantic_validation", "readback", "backup_contract", "final_status")
    return rows.select("run_id", *names, (F.col("run_id") == publish.current_version(spark, root)).alias("current"))


@_register("q60_refresh_current", _FULL + "SELECT * FROM cand")
def q60_current(spark, d):
    """What the job's readers see after the refused run: the candidate of the one before."""
    return publish.read_current(spark, _refreshed(spark, d))


@_register("q60_refresh_traces", _FULL + f", {_THIRD}, bad AS (SELECT id FROM third WHERE n_success > 0 UNION SELECT id FROM cand WHERE last_ok_at >= TIMESTAMP '2024-01-30 12:00:00') SELECT 'run-2' AS run_id, 'SEMANTIC_VALIDATION' AS contract, (SELECT count(*) FROM bad) AS n_ids, {_SAMPLE.format('bad')} AS sample")
def q60_traces(spark, d):
    """Which ids made the refused run fail."""
    traces = spark.read.parquet(f"{_refreshed(spark, d)}/traces")
    return traces.select("run_id", "contract", "n_ids", F.array_join(F.col("sample").cast("array<string>"), ",").alias("sample"))
