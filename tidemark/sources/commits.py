"""The publication log: numbered entries that are each created once, and what they add up to."""

from __future__ import annotations

import json
import os
import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.contracts import PASS

PUBLISH, ROLLBACK = "publish", "rollback"
ENTRY_SCHEMA = "entry bigint, action string, base bigint, steps bigint, run_id string, version string, published_at timestamp, status string"


class ConcurrentPublication(RuntimeError):
    """Another writer made a version current after this one had read what it builds on."""


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path in its full form."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = hadoop_path(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole, one that Spark's sources hide too."""
    fs, p = hadoop_path(spark, path)
    source = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def create_once(spark: SparkSession, path: str, text: str, by_link: bool | None = None) -> bool:
    """Creates a file with its whole content, or returns False where it is there: of any number of writers one succeeds.

    A hidden file is written first. On a local file system a hard link puts it in place, elsewhere a rename that never overwrites, which the
    store has to carry out as one step.
    """
    fs, p = hadoop_path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    write_text(spark, draft.toString(), text)
    try:
        if by_link if by_link is not None else p.toUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), p.toUri().getPath())
        else:
            no_option = spark._sc._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, p, no_option)
        return True
    except FileExistsError:
        return False
    except Exception as e:
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    finally:
        fs.delete(draft, False)


def _folder(root: str) -> str:
    return f"{root}/publication_log"


def publication_log(spark: SparkSession, root: str) -> DataFrame:
    """All entries, a row a publication that passed or failed or a rollback."""
    if not exists(spark, _folder(root)):
        return spark.createDataFrame([], ENTRY_SCHEMA)
    return spark.read.schema(ENTRY_SCHEMA).json(_folder(root))


def head(spark: SparkSession, root: str) -> int:
    """The number of the last entry; 0 if there is none. What a writer builds on is what this entry left current."""
    return publication_log(spark, root).agg(F.max("entry")).first()[0] or 0


def commit(spark: SparkSession, root: str, base: int, run_id: str, version: str | None, at: datetime, status: str, action: str = PUBLISH, steps: int = 0) -> int:
    """Appends an entry by creating its number, and returns that.

    A writer that finds its number taken reads what has come since ``base``. Where that left another version current, an entry that would too is
    refused: it was built on what is no longer there. Failures of others, and own ones, change nothing, so the next number is tried.
    """
    n = base + 1
    while True:
        entry = {"entry": n, "action": action, "base": base, "steps": steps, "run_id": run_id, "version": version, "published_at": at.isoformat(sep=" "), "status": status}
        if create_once(spark, f"{_folder(root)}/{n:020d}.json", json.dumps(entry)):
            return n
        since = publication_log(spark, root).where(F.col("entry") > base)
        last, changed = since.agg(F.max("entry"), F.count_if(F.col("status") == PASS)).first()
        if status == PASS and changed:
            raise ConcurrentPublication(f"another version became current while {run_id} was built")
        n = max(n, last or 0) + 1


def standing(log: DataFrame) -> DataFrame:
    """``(depth, version)`` of the versions that the entries, replayed in order, leave standing: 0 is current, 1 what a rollback would return to.

    A publication that passed goes on top; a rollback takes its steps off again. The log has a row a run, so that its fold in one row is small.
    """
    entry = F.struct("entry", "action", "steps", "version")
    entries = log.where(F.col("status") == PASS).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    put = lambda stack, e: F.when(e["action"] == PUBLISH, F.concat(F.array(e["version"]), stack)).otherwise(F.slice(stack, F.least(e["steps"], F.size(stack)) + 1, F.size(stack)))
    empty = F.array().cast("array<string>")
    return entries.select(F.posexplode(F.aggregate("entries", empty, put)).alias("depth", "version"))


def current_version(spark: SparkSession, root: str) -> str | None:
    row = standing(publication_log(spark, root)).where("depth = 0").first()
    return row["version"] if row else None


def rollback(spark: SparkSession, root: str, run_id: str, at: datetime, steps: int = 1) -> str:
    """Makes the version ``steps`` before the current one current, by an entry: no table is touched, and a later rollback goes back further."""
    if steps < 1:
        raise ValueError("a rollback goes back by one step at least")
    base = head(spark, root)
    left = standing(publication_log(spark, root).where(F.col("entry") <= base)).where(F.col("depth") == steps).first()
    if left is None:
        raise LookupError(f"no version stands {steps} before the current one under {root}")
    commit(spark, root, base, run_id, left["version"], at, PASS, ROLLBACK, steps)
    return left["version"]


def sweep(spark: SparkSession, root: str, older_than: float = 86_400.0, dry: bool = False) -> DataFrame:
    """Deletes versions that no passed entry names, if nothing in them was written for ``older_than`` seconds; ``(version, kept)`` of all.

    What is marked is what any publication that passed put in place: current versions, backups and rolled-back ones stay. Failed and lost
    publications leave folders that nothing leads to. The age spares those of writers that are still at work. There is a folder a run here.
    """
    named = {r["version"] for r in publication_log(spark, root).where((F.col("status") == PASS) & (F.col("action") == PUBLISH)).select("version").collect()}
    return _swept(spark, f"{root}/versions", "", named, older_than, dry)


def sweep_scratch(spark: SparkSession, shared: str, older_than: float = 7 * 86_400.0, dry: bool = False) -> DataFrame:
    """Deletes folders of scratch tables in the shared folder in which nothing was written for ``older_than`` seconds; ``(version, kept)`` of all."""
    return _swept(spark, shared, "tidemark-", set(), older_than, dry)


def _swept(spark: SparkSession, folder: str, prefix: str, kept: set[str], older_than: float, dry: bool) -> DataFrame:
    fs, at = hadoop_path(spark, folder)
    out = []
    for status in fs.listStatus(at) if fs.exists(at) else []:
        name = status.getPath().getName()
        if not status.isDirectory() or not name.startswith(prefix):
            continue
        within = fs.listStatus(status.getPath())
        newest = max([status.getModificationTime(), *(x.getModificationTime() for x in within)])
        stays = name in kept or time.time() - newest / 1000 < older_than
        if not stays and not dry:
            fs.delete(status.getPath(), True)
        out.append((name, stays))
    return spark.createDataFrame(out, "version string, kept boolean")
