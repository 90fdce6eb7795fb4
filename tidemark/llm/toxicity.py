"""Toxicity: the nearest labelled examples by exact TF-IDF cosine, found with a block-max inverted index."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, drawn, table

WORD = re.compile(r"[^\W\d_]+")
#: Beginnings of so many letters count as terms beside the whole word.
PREFIXES = (4, 5, 6, 7)
#: So many labelled examples of either label are fitted on at most, chosen by a hash of id and text.
SAMPLE_DOCS = 2_000
#: A term is indexed if at least this share of the examples, and at least three of them, hold it.
FLOOR = 0.005
NEIGHBOURS = 12
BLOCK = 64
SHARPNESS = 4.0
THRESHOLD = 0.3
#: Terms that this share of the vectors hold, the commonest MATRIX_TERMS of them at most, have rows of a matrix in place of postings.
COMMON = 1 / 16
MATRIX_TERMS = 1_024
#: Texts that are searched together, and blocks that each is held against first.
CHUNK = 64
FIRST_BLOCKS = 2
#: So many words are remembered in a task.
KNOWN_WORDS = 200_000


def word_terms(word: str) -> list[str]:
    return [word, *(f"{word[:p]}*" for p in PREFIXES if len(word) > p)]


def _term_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents that hold a term."""
    for b in batches:
        held = Counter(t for text in b["text"] for t in {t for w in set(WORD.findall(text.lower())) for t in word_terms(w)})
        yield pd.DataFrame({"term": list(held), "n": list(held.values())})


class Terms:
    """Counts of the indexed terms in a text. Words met before are remembered, up to a number of them."""

    def __init__(self, terms: list[str]):
        self.at = {t: i for i, t in enumerate(terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        known, at = self.known, self.at
        if len(known) > KNOWN_WORDS:
            known.clear()
        ids: list[int] = []
        for word in WORD.findall(text.lower()):
            found = known.get(word)
            if found is None:
                found = known[word] = tuple(at[t] for t in word_terms(word) if t in at)
            ids += found
        return np.unique(np.array(ids, np.int32), return_counts=True)


@dataclass
class Index:
    """Distinct example vectors with the weight of toxic and of all examples that have them, in blocks of documents.

    A term's postings lie together, by document. What a block's documents hold at most of each term bounds their cosines.
    """

    terms: list[str]
    weights: np.ndarray  # of terms
    ptr: np.ndarray  # where a term's postings begin
    doc: np.ndarray
    weight: np.ndarray
    toxic: np.ndarray
    total: np.ndarray
    example: np.ndarray  # the smallest doc_id with the vector
    none: tuple[float, float]  # toxic and total weight of examples without any term
    raw: np.ndarray  # calibration: votes and what share was toxic
    share: np.ndarray

    @cached_property
    def matrix(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each term's column (-1: none), the columns' weights by block and document, and the highest of them by block."""
        blocks, df = -(-len(self.toxic) // BLOCK), np.diff(self.ptr)
        common = np.argsort(-df, kind="stable")[:MATRIX_TERMS]
        common = common[df[common] >= max(1, COMMON * len(self.toxic))]
        column = np.full(len(self.terms), -1)
        column[common] = np.arange(len(common))
        dense = np.zeros((blocks * BLOCK, len(common)), np.float32)
        for i, t in enumerate(common.tolist()):
            s, e = self.ptr[t], self.ptr[t + 1]
            dense[self.doc[s:e], i] = self.weight[s:e]
        dense = dense.reshape(blocks, BLOCK, len(common))
        return column, dense, dense.max(1)

    def vector(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.weights[ids]
        return w / math.sqrt((w * w).sum()) if len(w) else w

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each vector the k example vectors of the highest cosine, and all that tie with the last: exact, to single precision.

        The rarer terms' postings are read first. The highest weights of the common terms in a block bound what these can add there.
        The blocks with the highest bounds are scored in full, then all whose bound reaches the k-th cosine so far; texts that
        need the same block are scored together.
        """
        n, blocks = len(self.toxic), -(-len(self.toxic) // BLOCK)
        for at in range(0, len(vectors), CHUNK):
            part = vectors[at : at + CHUNK]
            if not n:
                yield from ((np.zeros(0, np.int64), np.zeros(0)) for _ in part)
                continue
            column, dense, most = self.matrix
            q = np.repeat(np.arange(len(part)), [len(v[0]) for v in part])
            ids, w = (np.concatenate([v[i] for v in part]) for i in (0, 1))
            common = column[ids] >= 0
            known = np.zeros((len(part), dense.shape[2]), np.float32)
            known[q[common], column[ids[common]]] = w[common]
            rare, of, x = ids[~common], q[~common], w[~common]
            size = self.ptr[rare + 1] - self.ptr[rare]
            post = np.repeat(self.ptr[rare] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            cell = np.repeat(of * (blocks * BLOCK), size) + self.doc[post]
            got = np.bincount(cell, np.repeat(x, size) * self.weight[post], len(part) * blocks * BLOCK).astype(float).reshape(len(part), blocks, BLOCK)
            bound = got.max(2) + known @ most.T + 1e-4
            scores = np.zeros_like(got)
            first = bound >= np.sort(bound, 1)[:, -min(FIRST_BLOCKS, blocks), None]
            self._score(first, got, known, scores)
            flat = scores.reshape(len(part), -1)
            kth = np.partition(flat, flat.shape[1] - min(k, n), axis=1)[:, -min(k, n)]
            self._score((bound >= kth[:, None]) & ~first, got, known, scores)
            for row in flat:
                d = np.flatnonzero(row > 1e-6)
                if len(d) > k:
                    d = d[row[d] >= np.partition(row[d], len(d) - k)[len(d) - k] - 1e-6]
                order = np.lexsort((self.example[d], -row[d]))
                yield d[order], row[d[order]]

    def _score(self, wanted: np.ndarray, got: np.ndarray, known: np.ndarray, scores: np.ndarray) -> None:
        """Full cosines of the texts and blocks that are wanted."""
        for b in np.flatnonzero(wanted.any(0)).tolist():
            texts = np.flatnonzero(wanted[:, b])
            scores[texts, b] = got[texts, b] + known[texts] @ self.matrix[1][b].T

    def vote(self, d: np.ndarray, c: np.ndarray, without: tuple[float, float] | None = None) -> tuple[float, int | None, float]:
        """The share of toxic weight among the nearest, by cosine to the power of SHARPNESS; the nearest example and its cosine.

        ``without``: this toxic and total weight is taken off the vector's own examples (for calibration).
        """
        if not len(d):
            t, n = self.none
            if without:
                t, n = t - without[0], n - without[1]
            return (t / n if n > 1e-9 else 0.0), None, 0.0
        t, n = self.toxic[d].copy(), self.total[d].copy()
        if without and c[0] > 1 - 1e-5:
            t[0], n[0] = t[0] - without[0], max(0.0, n[0] - without[1])
        v = c**SHARPNESS
        return (float((v * t).sum() / (v * n).sum()) if (v * n).sum() > 1e-9 else 0.0), int(self.example[d[0]]), float(min(1.0, c[0]))

    def score(self, counted: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, int | None, float]]:
        """Calibrated score, nearest example and its cosine of each text's terms and counts."""
        out = []
        for d, c in self.nearest([(ids, self.vector(ids, counts)) for ids, counts in counted]):
            raw, example, cosine = self.vote(d, c)
            if len(self.raw):
                raw = float(np.interp(raw, self.raw, self.share))
            out.append((min(1.0, max(0.0, raw)), example, cosine))
        return out


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares that rise with x: neighbours that fall are pooled."""
    pools: list[list[float]] = []
    for i in np.argsort(x, kind="stable"):
        if pools and pools[-1][0] == x[i]:
            pools[-1][1:] = [pools[-1][1] + y[i] * w[i], pools[-1][2] + w[i]]
        else:
            pools.append([x[i], y[i] * w[i], w[i]])
    merged: list[list[float]] = []  # low, high, toxic, weight
    for v, t, n in pools:
        merged.append([v, v, t, n])
        while len(merged) > 1 and merged[-2][2] * merged[-1][3] >= merged[-1][2] * merged[-2][3]:
            low = merged.pop(-2)
            merged[-1] = [low[0], merged[-1][1], low[2] + merged[-1][2], low[3] + merged[-1][3]]
    xs = [v for m in merged for v in (m[0], m[1])]
    # Half an example on either side keeps a small pool from claiming certainty.
    ys = [(m[2] + 0.25) / (m[3] + 0.5) for m in merged for _ in range(2)]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


def term_weights(clean: np.ndarray, toxic: np.ndarray, n_clean: float, n_toxic: float) -> np.ndarray:
    """IDF times how surely a term stands oftener under one label than under the other: its log odds ratio in standard errors.

    Every term keeps a weight above 0, and so every term counts in the cosine.
    """
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    sure = np.abs(odds) / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return (np.log((1 + n_clean + n_toxic) / (1 + clean + toxic)) + 1) * (sure + 0.01)


def build_index(terms: list[str], doc_ids: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], toxic: list[int], weights: list[float]) -> Index:
    """The index over these examples, ``vectors`` being their terms and counts, and its calibration by leaving each example out in turn."""
    n = len(doc_ids)
    held_by = [np.bincount(np.concatenate([np.zeros(0, np.int32)] + [v[0] for v, t in zip(vectors, toxic, strict=True) if t == label]), minlength=len(terms)) for label in (0, 1)]
    of_term = term_weights(*held_by, toxic.count(0), toxic.count(1))
    groups: dict[tuple[bytes, bytes], list] = {}
    none = [0.0, 0.0]
    for doc, (ids, counts), t, w in zip(doc_ids, vectors, toxic, weights, strict=True):
        if not len(ids):
            none = [none[0] + t * w, none[1] + w]
            continue
        g = groups.setdefault((ids.tobytes(), counts.tobytes()), [0.0, 0.0, doc, ids, counts])
        g[:3] = [g[0] + t * w, g[1] + w, min(g[2], doc)]
    empty = np.zeros(0)
    held = Index(terms, of_term, np.zeros(len(terms) + 1, np.int64), empty.astype(np.int32), empty.astype(np.float32), empty, empty, empty.astype(np.int64), (none[0], none[1]), empty, empty)
    known = [(g[3], held.vector(g[3], g[4]), g) for g in groups.values()]
    # Vectors with the same heaviest term stand together, which keeps the blocks' bounds tight.
    known.sort(key=lambda v: (int(v[0][v[1].argmax()]), -float(v[1].max()), v[2][2]))
    if known:
        term, doc = np.concatenate([v[0] for v in known]), np.repeat(np.arange(len(known), dtype=np.int32), [len(v[0]) for v in known])
        order = np.argsort(term, kind="stable")
        held.ptr = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
        held.doc, held.weight = doc[order], np.concatenate([v[1] for v in known])[order].astype(np.float32)
    held.toxic, held.total, held.example = (np.array([v[2][i] for v in known], float if i < 2 else np.int64) for i in range(3))
    found = held.nearest([(ids, held.vector(ids, counts)) for ids, counts in vectors])
    raw = np.array([held.vote(d, c, without=(t * w, w))[0] for (d, c), t, w in zip(found, toxic, weights, strict=True)])
    if n:
        # Weights count examples of the table; the pools' half example is one of the sample.
        held.raw, held.share = _isotonic(raw, np.array(toxic, float), np.array(weights) / max(1e-12, min(weights)))
    return held


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, floor: float = FLOOR) -> Index:
    """An index over a sample of ``labels (doc_id, toxic)`` with their texts of ``docs (doc_id, text)``.

    Of each label at most sample_docs documents get in, the first by a hash of their ids, and count as many times as
    they stand for. Terms are words and word beginnings; all that a share ``floor`` of the examples hold are indexed, whatever their label. Labels
    other than 0 and 1, null ids and null texts teach nothing; a doc_id labelled twice is toxic if one label says so.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = drawn(known, "toxic", totals, sample_docs, "doc_id")
    # At most twice sample_docs ids; where an id repeats, so do its texts, and those are drawn once more.
    scratch = Scratch(spark)
    met = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = scratch.table(drawn(met, "toxic", {k: sample_docs for k in totals}, sample_docs, "doc_id", "text"), "examples")

    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = sample.mapInPandas(_term_batches, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    names = [r["term"] for r in held.where(F.col("n") >= max(3, math.ceil(floor * sum(n.values())))).select("term").orderBy("term").collect()]

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Terms(names)
        for b in batches:
            found = [reader.of(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "terms": [f[0].tobytes() for f in found], "counts": [f[1].astype("<i4").tobytes() for f in found]})

    rows = sample.mapInPandas(vectors, "doc_id bigint, toxic int, terms binary, counts binary").orderBy("doc_id", "toxic", "terms", "counts").collect()
    scratch.drop("examples")
    return build_index(
        names,
        [r["doc_id"] for r in rows],
        [(np.frombuffer(r["terms"], np.int32), np.frombuffer(r["counts"], "<i4")) for r in rows],
        [r["toxic"] for r in rows],
        [totals[r["toxic"]] / n[r["toxic"]] for r in rows],
    )


def _scorer(held):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = held.value
        reader = Terms(index.terms)
        for b in batches:
            found = index.score([reader.of(t) for t in b["text"]])
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": [x[0] for x in found], "nearest_example": pd.array([x[1] for x in found], "Int64"), "cosine": [x[2] for x in found]})

    return run


def score(docs: DataFrame, index: Index) -> DataFrame:
    """``docs (doc_id, text)`` with score, predicted, and as evidence the nearest example and its cosine; other columns are dropped.

    Whole texts count. Null and empty texts, and texts without any indexed term, get the share of toxic examples among those without
    terms. Equal rows each get a row, a null doc_id too; an empty table gives an empty result. Without labels all
    scores are 0. The index, of a bounded sample, is broadcast.
    """
    kind = docs.schema["doc_id"].dataType
    held = docs.sparkSession.sparkContext.broadcast(index)
    whole = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    out = whole.mapInPandas(_scorer(held), "doc_id string, score double, nearest_example bigint, cosine double")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out(doc_id: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels of those held out teach nothing."""
    docs = table(spark, sf_dir, "documents")
    index = fit(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    return score(docs, index).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "nearest_example", "cosine")
