"""Versions written in buckets by id, with their manifest: what is joined to them by id is shuffled, they are not."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.operators import digests as D
from tidemark.sources.commits import read_text, write_text


def _manifest_path(path: str) -> str:
    return f"{path}/_manifest.json"


def write_bucketed(df: DataFrame, path: str, n: int, id: str = "id", placed: bool = False) -> None:
    """Writes ``df`` in n buckets, each sorted by id and in one file; refuses a path that has files.

    ``placed`` says that rows already lie so, a bucket a task, as they do out of a join with a table of the same buckets: they are not shuffled again.
    """
    df = df if placed else df.repartition(n, id)
    name = f"tidemark_{uuid.uuid4().hex}"
    df.write.format("parquet").mode("errorifexists").bucketBy(n, id).sortBy(id).option("path", path).saveAsTable(name)
    # The table was only the way to a bucketed layout; its files stay.
    df.sparkSession.sql(f"DROP TABLE {name}")


def write_manifest(spark: SparkSession, path: str, schema: StructType, n: int, id: str = "id") -> dict:
    """Digests a version as it reads from its files and keeps the hash tree beside them."""
    tree = D.tree_of(_table(spark, path, schema, n, id), n, id)
    manifest = {"id": id, "buckets": n, "schema": schema.json(), "root": tree[-1][0], "tree": tree}
    write_text(spark, _manifest_path(path), json.dumps(manifest))
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, _manifest_path(path)))


def _table(spark: SparkSession, path: str, schema: StructType, n: int, id: str) -> DataFrame:
    name = f"tidemark_{hashlib.md5(f'{path}:{n}:{id}:{schema.json()}'.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{id}`) SORTED BY (`{id}`) INTO {n} BUCKETS LOCATION '{quoted}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A version with its buckets known to the planner, in any session: what it needs to know is in the manifest."""
    m = read_manifest(spark, path)
    return _table(spark, path, StructType.fromJson(json.loads(m["schema"])), m["buckets"], m["id"])


def read_buckets(spark: SparkSession, path: str, buckets: Iterable[int]) -> DataFrame:
    """Only the files of these buckets."""
    schema = StructType.fromJson(json.loads(read_manifest(spark, path)["schema"]))
    found = sorted(buckets)
    return spark.read.schema(schema).option("pathGlobFilter", "*_{" + ",".join(f"{b:05d}" for b in found) + "}.c*").parquet(path) if found else spark.createDataFrame([], schema)


def damaged_buckets(spark: SparkSession, path: str) -> list[int]:
    """Buckets whose files no longer give the digests of the manifest."""
    m = read_manifest(spark, path)
    return D.differing(m["tree"], D.tree_of(read_bucketed(spark, path), m["buckets"], m["id"]))
