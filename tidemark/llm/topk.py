"""Exact top-k search: a Voronoi join by inner product, with bounds from each cell's and each query group's summary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table

PIVOTS = 64
#: About so many rows, and so many queries, meet in one task.
BLOCK_ROWS = 8_192
QUERY_ROWS = 16_384
K = 5
#: Queries whose scores a task holds at once.
CHUNK = 512
LOWEST = -(2**63)
FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``(row, vec_id, v)``: floor(scale * x) of every component; rows without an id, without components, or with null or non-finite ones are left out."""
    x = F.col("embedding").cast("array<double>")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    whole = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).withColumn("_x", x).where((F.size("_x") > 0) & F.forall("_x", fine))
    return whole.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.transform("_x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; a shorter vector's missing components are 0."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _packed(x: np.ndarray, kind: str) -> list[bytes]:
    return [r.tobytes() for r in x.astype(kind)]


def _unpacked(packed: pd.Series, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind).reshape(len(packed), width).astype(float) if len(packed) else np.zeros((0, width))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: by doubles where those are exact, else by 64-bit integers."""
    if len(a) and len(b) and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= 2**53:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return (a @ b.T).astype(np.int64)


class Space:
    """Pivots in a space of one more coordinate, where the highest inner product is the shortest distance.

    A row x gets the height sqrt(m - |x|^2), m being the largest |x|^2, and a query q the height 0, so that the squared
    distance of the two is |q|^2 + m - 2 q.x. Distances obey the triangle inequality, which inner products do not.
    """

    def __init__(self, pivots: np.ndarray, m: float, kind: str):
        self.pivots, self.m, self.kind, self.width = pivots, m, kind, pivots.shape[1]
        self.heights = self.height(pivots)
        self.slack = 1e-6 * (1 + np.sqrt(m))

    def height(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, self.m - (x * x).sum(1)))

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        """Distances of rows to all pivots."""
        return np.sqrt(np.maximum(0, 2 * self.m - 2 * (x @ self.pivots.T + self.height(x)[:, None] * self.heights)))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        """Distances of queries to all pivots."""
        return np.sqrt(np.maximum(0, (q * q).sum(1)[:, None] + self.m - 2 * q @ self.pivots.T))

    def reach(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far away a row may be that scores ``least`` with its query; a query without such a score reaches everything."""
        far = np.sqrt(np.maximum(0, (q * q).sum(1) + self.m - 2 * least.astype(float))) + self.slack
        return np.where(least == LOWEST, np.inf, far)

    def place(self, rows: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                x = _matrix(b["v"], self.width)
                d = self.of_rows(x) if rows else self.of_queries(x)
                cell = d.argmin(1)
                yield pd.DataFrame({"row": b["row"], "vec_id": b["vec_id"], "x": _packed(x, self.kind), "cell": cell.astype("int32"), "distance": d[np.arange(len(x)), cell]})

        return run

    def intervals(self):
        """By query group and cell: between which distances from the pivot a row must lie to matter to any query of the group."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                q = _unpacked(b["x"], self.width, self.kind)
                d, reach = self.of_queries(q), self.reach(q, b["least"].to_numpy())
                for team in np.unique(b["team"]):
                    at = np.flatnonzero(b["team"] == team)
                    lo, hi = (d[at] - reach[at, None]).min(0), (d[at] + reach[at, None]).max(0)
                    yield pd.DataFrame({"team": np.int32(team), "cell": np.arange(len(lo), dtype=np.int32), "lo": lo, "hi": hi})

        return run


def _solver(space: Space, k: int):
    """The k best of a block's rows for each query; a query meets only cells that its reach touches, and not its home block again."""

    def run(key: tuple, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["cell", "vec_id"], kind="stable")
        ids, rows, x = block["vec_id"].to_numpy(), block["row"].to_numpy(), _unpacked(block["x"], space.width, space.kind)
        cells, first = np.unique(block["cell"].to_numpy(), return_index=True)
        edges = [*first.tolist(), len(ids)]
        near = [block["distance"].to_numpy()[s:e] for s, e in zip(edges, edges[1:], strict=False)]
        queries = queries[queries["home"].to_numpy() != key[-1]]
        out = [pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")]
        for at in range(0, len(queries) if len(ids) else 0, CHUNK):
            part = queries.iloc[at : at + CHUNK]
            q, least = _unpacked(part["x"], space.width, space.kind), part["least"].to_numpy()
            d, reach = space.of_queries(q), space.reach(q, least)
            scores = np.full((len(q), len(ids)), LOWEST, np.int64)
            for c, s, e, r in zip(cells, edges, edges[1:], near, strict=False):
                touched = np.flatnonzero((r.max() + space.slack >= d[:, c] - reach) & (r.min() - space.slack <= d[:, c] + reach))
                if len(touched):
                    scores[touched, s:e] = _products(q[touched], x[s:e])
            scores[rows[None, :] == part["row"].to_numpy()[:, None]] = LOWEST
            floor = np.maximum(least, LOWEST + 1)
            if len(ids) > k:
                floor = np.maximum(floor, np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k])
            i, j = np.nonzero(scores >= floor[:, None])
            order = np.lexsort((ids[j], -scores[i, j], i))
            i, j = i[order], j[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            i, j = i[rank < k], j[rank < k]
            out.append(pd.DataFrame({"query": part["row"].to_numpy()[i], "query_id": part["vec_id"].to_numpy()[i], "vec_id": ids[j], "score": scores[i, j]}))
        return pd.concat(out)

    return run


def dealt(counts: dict[int, int], order: list[int], size: int) -> list[tuple[int, int, int]]:
    """``(cell, first, parts)``: cells in their order share a block up to ``size`` members; a larger one gets blocks of its own."""
    out, block, room = [], -1, 0
    for c in order:
        n = counts.get(c, 0)
        if not n:
            continue
        parts = -(-n // size)
        if parts > 1 or n > room:
            out.append((c, block + 1, parts))
            block, room = block + parts, size - n if parts == 1 else 0
        else:
            out.append((c, block, 1))
            room -= n
    return out


def _chain(points: np.ndarray) -> list[int]:
    """Pivots in an order in which the next one is the nearest that is left."""
    left, order = list(range(1, len(points))), [0] if len(points) else []
    while left:
        order.append(left.pop(int(((points[left] - points[order[-1]]) ** 2).sum(1).argmin())))
    return order


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, report: dict | None = None) -> DataFrame:
    """For each row of ``queries`` the k rows of ``vectors`` of the highest inner product, its own row apart.

    Both are ``(row, vec_id, v)``, the queries a part of the vectors. A few vectors, first by a hash, are pivots, in a space
    where a high inner product is a short distance (see Space). Every vector joins the nearest pivot's cell, and so does every
    query. Neighbouring cells are dealt to blocks of about block_rows rows, and to teams of about query_rows queries; a large cell is split.

    First each query meets the block of its own cell; the k-th score that it finds there bounds how far away a better row can be. From
    these reaches come, for each team and cell, the distances from the cell's pivot between which a row can matter (a triangle has no side
    longer than the other two together). Only rows in that ring are sent to the team, and only teams that a block has rows for
    meet it; there each query meets the cells that its own reach touches. The k best of both rounds are the answer.

    The summaries have a row a cell, and a row a team and cell. Where vectors are spread evenly over many dimensions no ring
    excludes anything, and each row goes once to every team: ``report``, if given, gets what share of (team, row) pairs was kept.

    Equal vectors are rows of their own; ties go to the smaller vec_id. With fewer than k other rows, all are returned. No
    vectors or queries: no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    first = vectors.orderBy(F.xxhash64("vec_id", F.lit("pivot")), "vec_id", "row").limit(pivots).toPandas()
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    large = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    width, m, top = vectors.agg(F.max(F.size("v")), F.max(square), F.max(large)).first()
    kind = "<i2" if (top or 0) < 2**15 else "<i4" if top < 2**31 else "<i8"
    points = _matrix(first["v"], width or 1) if len(first) else np.zeros((1, 1))
    space, chain = Space(points, m or 0.0, kind), _chain(points)

    placed_schema = "row bigint, vec_id bigint, x binary, cell int, distance double"
    placed = scratch.table(vectors.mapInPandas(space.place(True), placed_schema), "placed")
    asked = scratch.table(queries.mapInPandas(space.place(False), placed_schema).drop("distance"), "asked")
    sizes = lambda df: {r["cell"]: r["n"] for r in df.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # noqa: E731, a row a pivot
    n_rows, n_asked = sizes(placed), sizes(asked)
    # A query whose cell has no rows goes to the block before it.
    blocks = dealt(n_rows, chain, block_rows)
    held, at = dict((c, (b, p)) for c, b, p in blocks), (0, 1)
    homes = [(c, *(at := held.get(c, at))) for c in chain]
    part = lambda of, key: F.col(of) + F.pmod(F.xxhash64(key), F.col("parts")).cast("int")
    small = lambda rows, of: F.broadcast(spark.createDataFrame(rows, f"cell int, {of} int, parts int"))  # noqa: E731, a row a pivot

    in_blocks = placed.join(small(blocks, "first"), "cell").withColumn("block", part("first", "row")).drop("first", "parts")
    asked = asked.join(small(homes, "first"), "cell").withColumn("home", part("first", "row")).drop("first", "parts")
    asked = asked.join(small(dealt(n_asked, chain, query_rows), "first"), "cell").withColumn("team", part("first", "row")).drop("first", "parts", "cell")

    # The first round: every query against the block of its own cell.
    own = asked.withColumn("block", F.col("home")).withColumn("home", F.lit(-1)).withColumn("least", F.lit(LOWEST).cast("long"))
    begun = own.groupBy("block").cogroup(in_blocks.groupBy("block")).applyInPandas(_solver(space, k), FOUND)
    begun = scratch.table(begun, "begun")
    least = begun.groupBy("query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select(F.col("query").alias("row"), "least")
    asked = scratch.table(asked.join(least, "row", "left").withColumn("least", F.coalesce("least", F.lit(LOWEST).cast("long"))), "bounded")

    # The second round: rings by team and cell.
    rings = asked.select("team", "x", "least").mapInPandas(space.intervals(), "team int, cell int, lo double, hi double")
    rings = scratch.table(rings.groupBy("team", "cell").agg((F.min("lo") - space.slack).alias("lo"), (F.max("hi") + space.slack).alias("hi")), "rings")
    inside = (F.col("distance") >= F.col("lo")) & (F.col("distance") <= F.col("hi"))
    sent = in_blocks.join(rings, "cell").where(inside).select("team", "block", "row", "vec_id", "x", "cell", "distance")
    spans = in_blocks.groupBy("block", "cell").agg(F.min("distance").alias("least"), F.max("distance").alias("most"))
    meets = spans.join(rings, "cell").where((F.col("most") >= F.col("lo")) & (F.col("least") <= F.col("hi"))).select("team", "block").distinct()
    routed = asked.join(scratch.table(meets, "meets"), "team")
    if report is not None:
        report["kept"] = sent.count() / max(1, sum(n_rows.values()) * asked.select("team").distinct().count())
    found = routed.groupBy("team", "block").cogroup(sent.groupBy("team", "block")).applyInPandas(_solver(space, k), FOUND)
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return begun.union(found).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all embeddings for every fiftieth one."""
    vectors = Scratch(spark).table(quantised(table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP3_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
k AS (SELECT r, query_id, vec_id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM k WHERE n <= 5
"""
