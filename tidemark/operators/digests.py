"""Digests of a table by buckets of its ids, and comparisons that read rows only where digests differ."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.contracts import contract_row, same_rows
from tidemark.operators.merge import preserve_unselected

#: Nodes that a node of the hash tree stands for.
FANOUT = 16


def bucket_of(id: str, n: int) -> Column:
    """The bucket, of n, into which Spark's bucketed tables put an id."""
    return F.pmod(F.hash(id), F.lit(n))


def digests(df: DataFrame, n: int, id: str = "id", columns: Sequence[str] | None = None) -> DataFrame:
    """``(bucket, n_rows, digest)`` of the buckets that have rows: no order or partitioning of rows changes it.

    A row's two 64-bit hashes are summed by bucket, so that what is shuffled is a row a bucket and task. The hash skips nulls, so a flag goes beside each value.
    """
    parts = [x for c in columns or sorted(df.columns) for x in (F.col(c).isNull(), F.col(c))]
    wide = lambda *extra: F.sum(F.xxhash64(*extra, *parts).cast("decimal(38,0)"))
    sums = df.groupBy(bucket_of(id, n).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"), wide().alias("_a"), wide(F.lit("second")).alias("_b"))
    return sums.select("bucket", "n_rows", F.sha2(F.concat_ws(":", "n_rows", "_a", "_b"), 256).alias("digest"))


def tree(leaves: dict[int, str], n: int) -> list[list[str]]:
    """The hash tree over n buckets, level by level from the leaves to the root; an empty bucket's leaf is the empty text."""
    levels = [[leaves.get(b, "") for b in range(n)]]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([hashlib.sha256(":".join(below[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(below), FANOUT)])
    return levels


def differing(a: list[list[str]], b: list[list[str]]) -> list[int]:
    """Buckets in which two trees of one shape differ, found from the root: where nodes are equal nothing below them is looked at."""
    open_nodes = [0]
    for k in range(len(a) - 1, -1, -1):
        open_nodes = [i for i in open_nodes if a[k][i] != b[k][i]]
        if k:
            open_nodes = [j for i in open_nodes for j in range(i * FANOUT, min((i + 1) * FANOUT, len(a[k - 1])))]
    return open_nodes


def tree_of(df: DataFrame, n: int, id: str = "id", columns: Sequence[str] | None = None) -> list[list[str]]:
    """The hash tree of a table; at most a row a bucket reaches the driver."""
    return tree({r["bucket"]: r["digest"] for r in digests(df, n, id, columns).collect()}, n)


def in_buckets(df: DataFrame, buckets: Iterable[int], n: int, id: str = "id") -> DataFrame:
    found = sorted(buckets)
    return df.where(bucket_of(id, n).isin(found)) if found else df.limit(0)


def same_by_bucket(name: str, a: DataFrame, b: DataFrame, n: int, id: str = "id", columns: Sequence[str] | None = None) -> tuple[DataFrame, list[int]]:
    """A contract that two tables have the same rows, and the buckets where they have not. Only the rows of these are compared one by one."""
    columns = list(columns or a.columns)
    bad = differing(tree_of(a, n, id, columns), tree_of(b, n, id, columns))
    only = lambda df: in_buckets(df, bad, n, id).select(*columns)
    if not bad:
        return contract_row(name, a.sparkSession.range(1), F.lit(0)), bad
    return same_rows(only(a), only(b)).withColumn("contract", F.lit(name)), bad


def unselected_by_bucket(master: DataFrame, selected: DataFrame, candidate: DataFrame, columns: Sequence[str], n: int, id: str = "id") -> tuple[DataFrame, list[int]]:
    """UNSELECTED_PRESERVATION by digests: rows of unselected ids are, before and after, the same. A row more than before counts as well."""
    return same_by_bucket("UNSELECTED_PRESERVATION", preserve_unselected(master, selected, id), preserve_unselected(candidate, selected, id), n, id, [id, *columns])
