"""Stage logs, files, the publication log, buckets and digests."""

import json
import threading
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import contracts, digests, merge, scan
from tidemark.plans import operations, registry  # noqa: F401
from tidemark.sources import buckets, commits, files, publish, tables
from tidemark.sources.stage_log import LOG_SCHEMA, StageLog, error_text

T = [datetime(2024, 2, d) for d in range(1, 9)]
SF = "/root/testdata/sf0.001"


def test_stage_log_times_counts_and_keeps_failures(spark, tmp_path):
    ticks = iter(range(100))
    log = StageLog(spark, "r", f"{tmp_path}/log", clock=lambda: next(ticks) * 2.5)
    with log.stage("two tables") as s:
        s.watch(spark.range(5), F.col("id") > 1).write.parquet(f"{tmp_path}/a")
        s.watch(spark.range(3).where("id < 0")).write.parquet(f"{tmp_path}/b")
    with log.stage("no table"):
        pass
    with pytest.raises(ValueError, match="hunter2"), log.stage("raises") as s:
        s.watch(spark.range(5))
        raise ValueError("password=hunter2 and 'payload'\nmore payload")
    with pytest.raises(Exception, match="payload-7"), log.stage("task") as s:
        s.watch(spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.concat(F.lit("payload-"), "id"))).otherwise(F.col("id")).alias("x"))).write.parquet(f"{tmp_path}/c")
    with pytest.raises(AnalysisException), log.stage("plan"):
        spark.table("payload_table")
    rows = {r["stage"]: r for r in log.read().collect()}
    assert log.read().schema.simpleString() == spark.createDataFrame([], LOG_SCHEMA).schema.simpleString()
    assert {k: (r["n_rows"], r["n_bad"], r["elapsed_seconds"], r["status"]) for k, r in rows.items()} == {
        "two tables": (5, 2, 2.5, "PASS"), "no table": (None, None, 2.5, "PASS"), "raises": (None, None, 2.5, "FAIL"), "task": (None, None, 2.5, "FAIL"), "plan": (None, None, 2.5, "FAIL"),
    }
    assert rows["raises"]["error"] == "ValueError: password=[removed] and [removed]"
    assert "USER_RAISED_EXCEPTION" in rows["task"]["error"] and rows["plan"]["error"] == "AnalysisException [TABLE_OR_VIEW_NOT_FOUND]"
    assert not any("payload" in (r["error"] or "") or "hunter2" in (r["error"] or "") for r in rows.values())


def test_error_text_is_short_and_quotes_nothing():
    assert error_text(KeyError("secret id")) == "KeyError: [removed]" and error_text(ValueError()) == "ValueError"
    assert error_text(RuntimeError('open "quote')) == "RuntimeError: open [removed]" and len(error_text(RuntimeError("x" * 9000))) < 400


def test_files_read_as_written(spark, tmp_path, monkeypatch):
    rows = [(".env", b"a=1"), (".env.example", b""), ("a/.hidden/_b/c.txt", "é😀".encode()), ("a/b.bin", b"\0\xff"), ("a b/ü.txt", b"x"), ("_c", None), (".git/config", b"no")] + [(f"flat/f{i}.txt", str(i).encode()) for i in range(450)] + [(f"deep/{i}/x/y.md", b"z") for i in range(30)]
    root = f"{tmp_path}/repo"
    files.write_files(spark.createDataFrame(rows, "path string, content binary").repartition(3), root)
    want = sorted((p, bytes(c or b""), len(c or b"")) for p, c in rows if not p.startswith(".git/"))
    for planned in (1_000, 3):
        monkeypatch.setattr(files, "PLANNED_DIRECTORIES", planned)
        df = files.read_files(spark, root)
        got = sorted((r["path"], bytes(r["content"]), r["length"]) for r in df.collect())
        assert got == want and df.rdd.getNumPartitions() >= 2
        shares = files.FilesReader({"path": root}).partitions()
        assert any(d.parts == 3 for s in shares for d in s.of) == (planned == 1_000) and any(d.below for s in shares for d in s.of) == (planned == 3)
    assert ".git/config" in {r["path"] for r in files.read_files(spark, root, skip=()).select("path").collect()}
    small = {r["path"]: (r["content"], r["length"]) for r in files.read_files(spark, root, max_bytes=2).collect()}
    assert small[".env"] == (None, 3) and bytes(small["a/b.bin"][0]) == b"\0\xff"


def _shares(root, **options) -> list[list[str]]:
    """What each partition of a folder reads."""
    reader = files.FilesReader({"path": str(root), **options})
    return [[p for b in reader.read(share) for p in b.column("path").to_pylist()] for share in reader.partitions()]


@pytest.mark.parametrize("n", [60, 600])
def test_more_directories_make_larger_partitions_not_more(tmp_path, monkeypatch, n):
    monkeypatch.setattr(files, "PLANNED_DIRECTORIES", 20)
    want = sorted(f"d{i}/{j}/a/x" for i in range(n) for j in range(5))
    for f in want:
        (tmp_path / f).parent.mkdir(parents=True)
        (tmp_path / f).touch()
    shares = [s for s in _shares(tmp_path, partitions="6") if s]
    assert sorted(p for s in shares for p in s) == want and len(shares) <= 6
    assert max(map(len, shares)) < 1.5 * len(want) / len(shares)


def test_more_files_of_one_directory_make_larger_partitions_not_more(tmp_path):
    want = sorted(f"flat/{i}" for i in range(3000))
    (tmp_path / "flat").mkdir()
    for f in want:
        (tmp_path / f).touch()
    shares = [s for s in _shares(tmp_path, partitions="6") if s]
    assert sorted(p for s in shares for p in s) == want and len(shares) == 6 and max(map(len, shares)) < 700


def test_planning_holds_no_list_of_a_wide_directory(tmp_path, monkeypatch):
    monkeypatch.setattr(files, "HELD_DIRECTORIES", 50, raising=False)
    monkeypatch.setattr(files, "PLANNED_DIRECTORIES", 20)
    want = [f"w/{i}/x" for i in range(400)] + [f"n/{i}/y/z" for i in range(30)] + ["top", "w/own"]
    for f in want:
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).touch()
    shares = files.FilesReader({"path": str(tmp_path), "partitions": "6"}).partitions()
    assert sum(len(s.of) for s in shares) < 100 and sorted(p for s in _shares(tmp_path, partitions="6") for p in s) == sorted(want)


def test_scan_of_files_with_odd_ones(spark, tmp_path):
    root = tmp_path / "r"
    (root / "logs").mkdir(parents=True)
    (root / ".env").write_bytes(b"KEY=1")
    (root / "logs" / "big.txt").write_bytes(b"x" * 2_000_001)
    (root / "link").symlink_to(root / "nowhere")
    (root / "key.txt").write_text("ghp_" + "a1" * 15)
    corpus = tables.scan_files(spark, str(root))
    assert sorted((r["rule"], r["path"]) for r in scan.violations(corpus).collect()) == [("forbidden filename", ".env"), ("forbidden runtime-artifact directory", "logs/big.txt"), ("possible secret pattern", "key.txt")]
    assert scan.skipped(corpus).first().asDict() == {"unreadable": 0, "too_large": 1, "binary": 0, "not_utf8": 0}
    (tmp_path / "none").mkdir()
    assert files.read_files(spark, str(tmp_path / "none")).count() == 0 and files.read_files(spark, str(tmp_path / "not there")).count() == 0
    with pytest.raises(Exception, match="leads out"):
        files.write_files(spark.createDataFrame([("../x", b"")], "path string, content binary"), str(root))


@pytest.mark.parametrize("by_link", [True, False])
def test_an_entry_is_created_once(spark, tmp_path, by_link):
    at, won = f"{tmp_path}/log/{1:020d}.json", []
    (tmp_path / "log").mkdir()
    assert commits.create_once(spark, f"{tmp_path}/log/0.json", "{}", by_link) and not commits.create_once(spark, f"{tmp_path}/log/0.json", "[]", by_link)
    assert commits.read_text(spark, f"{tmp_path}/log/0.json") == "{}"
    if by_link:  # a rename on a local disk is not one step
        threads = [threading.Thread(target=lambda i=i: won.append(i) if commits.create_once(spark, at, json.dumps([i] * 5000)) else None) for i in range(8)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert len(won) == 1 and json.loads(commits.read_text(spark, at)) == won * 5000
    assert not [f for f in (tmp_path / "log").iterdir() if f.name.startswith(".0") and not f.name.endswith(".crc")]


def test_of_two_writers_one_is_refused(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1, 0.0)], "id bigint, v double")
    publish.publish_validated(one, contracts.no_duplicates(one), root, "run-0", T[0])
    base, ended, gate = publish.head(spark, root), {}, threading.Barrier(2)

    def writer(name):
        mine = one.unionByName(spark.createDataFrame([(len(name), 1.0)], "id bigint, v double"))
        gate.wait()
        try:
            publish.publish_validated(mine, contracts.no_duplicates(mine), root, name, T[1], base)
            ended[name] = "current"
        except publish.ConcurrentPublication:
            ended[name] = "refused"

    threads = [threading.Thread(target=writer, args=(n,)) for n in ("run-aa", "run-bbb")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(ended.values()) == ["current", "refused"]
    log = publish.publication_log(spark, root).orderBy("entry").collect()
    assert [(r["entry"], r["status"]) for r in log] == [(1, "PASS"), (2, "PASS"), (3, "FAIL")]
    assert publish.current_version(spark, root) == next(k for k, v in ended.items() if v == "current")


def test_failures_of_others_do_not_conflict(spark, tmp_path):
    root = str(tmp_path)
    base = publish.head(spark, root)
    commits.commit(spark, root, base, "other", "other", T[0], "FAIL")
    assert commits.commit(spark, root, base, "mine", "mine", T[1], "PASS") == 2 and publish.current_version(spark, root) == "mine"
    with pytest.raises(publish.ConcurrentPublication):
        commits.commit(spark, root, base, "late", "late", T[2], "PASS")
    assert commits.commit(spark, root, base, "late", "late", T[2], "FAIL") == 3


def test_publish_onto_gives_up_after_its_attempts(spark, tmp_path):
    root, n = str(tmp_path), iter(range(99))

    def build(on):
        k = next(n)
        df = spark.createDataFrame([(k,)], "id bigint")
        commits.commit(spark, root, publish.head(spark, root), f"o{k}", f"o{k}", T[0], "PASS")
        publish.publish(df, root, f"o{k}")
        return df, contracts.no_duplicates(df)

    with pytest.raises(publish.ConcurrentPublication):
        publish.publish_onto(spark, root, "r", T[1], build, attempts=2)
    assert [(r["version"], r["status"]) for r in publish.publication_log(spark, root).orderBy("entry").collect()] == [("o0", "PASS"), ("r", "FAIL"), ("o1", "PASS"), ("r.2", "FAIL")]


def test_rollbacks_are_replayed(spark, tmp_path):
    root = str(tmp_path)
    stands = lambda: [r["version"] for r in commits.standing(publish.publication_log(spark, root)).orderBy("depth").collect()]
    put = lambda v, status="PASS": commits.commit(spark, root, publish.head(spark, root), v, v, T[0], status)
    with pytest.raises(LookupError):
        publish.rollback(spark, root, "b", T[0])
    put("a"), put("b"), put("x", "FAIL"), put("c"), put("d")
    assert stands() == ["d", "c", "b", "a"]
    assert publish.rollback(spark, root, "r1", T[1]) == "c" and publish.rollback(spark, root, "r2", T[1]) == "b" and stands() == ["b", "a"]
    put("e")
    assert stands() == ["e", "b", "a"] and publish.rollback(spark, root, "r3", T[2], steps=2) == "a" and publish.current_version(spark, root) == "a"
    with pytest.raises(LookupError):
        publish.rollback(spark, root, "r4", T[2])
    with pytest.raises(ValueError):
        publish.rollback(spark, root, "r4", T[2], steps=0)
    # A writer that began before a rollback built on what is no longer current.
    with pytest.raises(publish.ConcurrentPublication):
        commits.commit(spark, root, 6, "late", "late", T[3], "PASS")


def test_sweep_spares_what_is_named_or_young(spark, tmp_path):
    root, df = str(tmp_path), spark.range(2)
    for v in ("a", "b"):
        publish.publish_validated(df, contracts.no_duplicates(df), root, v, T[0])
    publish.publish(df, root, "lost")
    publish.rollback(spark, root, "back", T[1])
    swept = lambda **k: {r["version"]: r["kept"] for r in commits.sweep(spark, root, **k).collect()}
    assert swept() == {"a": True, "b": True, "lost": True} and swept(older_than=0.0, dry=True) == {"a": True, "b": True, "lost": False}
    assert swept(older_than=0.0) == {"a": True, "b": True, "lost": False} and swept(older_than=0.0) == {"a": True, "b": True}
    assert publish.read_current(spark, root).count() == 2 and publish.current_version(spark, root) == "a"
    (tmp_path / "shared" / "tidemark-1" / "t").mkdir(parents=True)
    (tmp_path / "shared" / "someone's").mkdir()
    assert [tuple(r) for r in commits.sweep_scratch(spark, f"{tmp_path}/shared", older_than=0.0).collect()] == [("tidemark-1", False)] and (tmp_path / "shared" / "someone's").exists()
    assert commits.sweep(spark, f"{tmp_path}/nothing").count() == 0


def test_buckets_survive_a_merge_without_moving_the_master(spark, tmp_path):
    root = str(tmp_path)
    master = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") * 1.5).alias("v"), F.lit("a'b").alias("t"))
    publish.publish(master, root, "v0", buckets=8)
    with pytest.raises(AnalysisException):
        publish.publish(master, root, "v0", buckets=8)
    run = spark.range(900, 1100).select("id", F.lit(None).cast("double").alias("v"), F.lit("new").alias("t"), (F.col("id") % 2).alias("n_success"))
    before = publish.read_version(spark, root, "v0")
    made = merge.merge_snapshot(before, run, ["v", "t"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    publish.publish(made, root, "v1", buckets=8, placed=True)
    after = publish.read_version(spark, root, "v1")
    assert after.count() == made.count() == 1050
    # Rows already lie by bucket: a file each, and a grouping by id moves nothing.
    assert len([f for f in (tmp_path / "versions" / "v1").iterdir() if f.name.endswith(".parquet")]) == 8
    assert "Exchange" not in after.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, merge.merge_snapshot(master, run, ["v", "t"]).collect()))
    empty = spark.createDataFrame([], "id bigint, v double")
    publish.publish(empty, root, "v2", buckets=4)
    assert publish.read_version(spark, root, "v2").count() == 0 and buckets.damaged_buckets(spark, f"{root}/versions/v2") == []


@pytest.mark.parametrize("n", [1, 7, 16, 300])
def test_hash_tree_names_what_differs(spark, n):
    a = spark.range(2000).select("id", F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"), F.lit(None).cast("string").alias("w"))
    b = a.withColumn("v", F.when(F.col("id").isin(17, 1200), F.lit(-1)).otherwise(F.col("v"))).where("id <> 900")
    want = sorted({r[0] for r in spark.createDataFrame([(17,), (1200,), (900,)], "id bigint").select(digests.bucket_of("id", n)).collect()})
    one, other = digests.tree_of(a, n), digests.tree_of(b.repartition(5), n)
    assert digests.differing(one, other) == want and digests.differing(one, one) == [] and len(one[-1]) == 1
    row, bad = digests.same_by_bucket("READBACK", a, b, n)
    assert tuple(row.first()) == ("READBACK", "FAIL", 5) and bad == want
    assert tuple(digests.same_by_bucket("READBACK", a, a.repartition(3), n)[0].first()) == ("READBACK", "PASS", 0)


def test_digests_see_nulls_repeats_and_moved_values(spark):
    of = lambda rows: digests.tree_of(spark.createDataFrame(rows, "id bigint, a string, b string"), 4)[-1][0]
    roots = [of(r) for r in ([(1, "x", None)], [(1, None, "x")], [(1, "x", ""), (1, "x", "")], [(1, "x", "")], [(None, "x", None)], [])]
    assert len(set(roots)) == len(roots)


def test_a_damaged_bucket_is_named_and_backups_see_it(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(200).select("id", (F.col("id") * 2).alias("v"))
    publish.publish_validated(df, contracts.no_duplicates(df), root, "v0", T[0], buckets=8)
    kept, path = publish.backup(spark, root), f"{root}/versions/v0"
    assert set(kept) == {"version", "root"} and publish.backup_intact(spark, root, kept)
    (victim,) = [f for f in (tmp_path / "versions" / "v0").iterdir() if "_00003.c" in f.name and f.name.endswith(".parquet") and not f.name.startswith(".")]
    lost = spark.read.parquet(str(victim)).count()
    victim.unlink()
    assert buckets.damaged_buckets(spark, path) == [3] and not publish.backup_intact(spark, root, kept)
    assert tuple(publish.readback_contract(df, root, "v0").first()) == ("READBACK", "FAIL", lost)
    assert buckets.read_buckets(spark, path, [2]).select(digests.bucket_of("id", 8)).distinct().collect()[0][0] == 2
    with pytest.raises(RuntimeError, match="backup"):
        publish.publish_validated(df, contracts.no_duplicates(df), root, "v1", T[1])


def test_the_master_is_not_exchanged(spark):
    plan = registry.QUERIES["q10_bucketed_candidate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    master = plan[plan.index(":- Sort") : plan.index("\n            +- Sort")]
    assert "Bucketed: true" in master and "Exchange" not in master
