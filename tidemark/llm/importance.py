"""Importance resampling towards a target distribution, over hashed n-gram counts."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, ship, table

BUCKETS = 10_000
NGRAMS = (1, 1)
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Occurrences that one table interns; a table has at least twice as many slots.
TABLE_ROWS = 2**19
#: Up to so many bytes n-grams are compared eight bytes a step, all at once; longer ones one by one.
LANES_UP_TO = 64
_WORD = np.ones(256, bool)
_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
_WORD[0x41:0x5B] = True  # A to Z, which are lowered
_NORMAL = np.where(_WORD, np.arange(256), 0x20).astype(np.uint8)
_NORMAL[0x41:0x5B] += 0x20


@dataclass
class Features:
    """N-grams of a batch of texts: ``data`` holds words, a space after each, and an n-gram is a slice of it."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    #: The text that each comes from.
    doc: np.ndarray
    n_words: np.ndarray


def features(texts: Sequence[bytes], ngrams: tuple[int, int] = NGRAMS) -> Features:
    """All runs of ``ngrams[0]`` to ``ngrams[1]`` words of lowered texts, joined by one space."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    word = _WORD[raw]
    before = np.concatenate(([False], word[:-1]))
    begin, end = np.flatnonzero(word & ~before), np.flatnonzero(before & ~word)
    size = end - begin
    of = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begin, side="right")
    at = np.cumsum(size + 1) - size - 1
    starts, lengths, docs = [], [], []
    for n in range(ngrams[0], ngrams[1] + 1):
        first = np.arange(max(0, len(at) - n + 1))
        first = first[of[first] == of[first + n - 1]]
        last = first + n - 1
        starts.append(at[first])
        lengths.append(at[last] + size[last] - at[first])
        docs.append(of[first])
    return Features(_NORMAL[raw[word | before]], np.concatenate(starts), np.concatenate(lengths), np.concatenate(docs), np.bincount(of, minlength=len(texts)))


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the slices at a and b, of equal lengths, hold the same bytes."""
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    same = np.ones(len(a), bool)
    for done in range(0, LANES_UP_TO, 8):
        left = np.flatnonzero(same & (length > done) & (length <= LANES_UP_TO))
        if not len(left):
            break
        unused = (8 * np.maximum(0, done + 8 - length[left])).astype(np.uint64)
        same[left] = (lanes[a[left] + done] ^ lanes[b[left] + done]) << unused == 0
    for i in np.flatnonzero(length > LANES_UP_TO):
        same[i] = np.array_equal(data[a[i] : a[i] + length[i]], data[b[i] : b[i] + length[i]])
    return same


@dataclass
class Slots:
    """An open-addressed table of distinct n-grams: each occurrence's slot, and by slot its bucket and count (0: free)."""

    of: np.ndarray
    bucket: np.ndarray
    count: np.ndarray


def intern(data: np.ndarray, start: np.ndarray, length: np.ndarray, buckets: int = BUCKETS, hashed=xxhash.xxh64_intdigest) -> Slots:
    """Interns n-grams by their 64-bit hash, with linear probing; equal keys share a slot only if their bytes are equal.

    All occurrences go one step of their probe sequence a round. Those of one n-gram go together, so whichever of them takes a free slot, the
    others find their bytes in it.
    """
    n, view = len(start), memoryview(data)
    data = np.concatenate((data, np.zeros(8, np.uint8)))
    keys = np.fromiter((hashed(view[s:e]) for s, e in zip(start.tolist(), (start + length).tolist(), strict=True)), np.uint64, n)
    size = 1 << max(4, (2 * n).bit_length())
    owner = np.full(size, -1, np.int64)
    at = (keys & np.uint64(size - 1)).astype(np.int64)
    slots, rest = np.empty(n, np.int64), np.arange(n)
    while len(rest):
        here = at[rest]
        free = owner[here] < 0
        owner[here[free]] = rest[free]
        held = owner[here]
        same = (keys[rest] == keys[held]) & (length[rest] == length[held])
        near = np.flatnonzero(same)
        same[near] = _same_bytes(data, start[rest[near]], start[held[near]], length[rest[near]])
        slots[rest[same]] = here[same]
        rest = rest[~same]
        at[rest] = (at[rest] + 1) & (size - 1)
    used = np.flatnonzero(owner >= 0)
    first = owner[used]
    bucket = np.zeros(size, np.int64)
    bucket[used] = [zlib.crc32(view[s:e]) % buckets for s, e in zip(start[first].tolist(), (start[first] + length[first]).tolist(), strict=True)]
    return Slots(slots, bucket, np.bincount(slots, minlength=size))


def _tables(f: Features, buckets: int) -> Iterator[tuple[slice, Slots]]:
    """The features of a batch in pieces, each interned in a table of its own, so that a table's size is bounded."""
    for i in range(0, len(f.start), TABLE_ROWS):
        part = slice(i, i + TABLE_ROWS)
        yield part, intern(f.data, f.start[part], f.length[part], buckets)


def _texts(b: pa.RecordBatch, column: str) -> list[bytes]:
    return [t.as_buffer().to_pybytes() for t in b.column(column)]


def _as_bytes(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text")


def bucket_counts(texts: DataFrame, ngrams: tuple[int, int] = NGRAMS, buckets: int = BUCKETS) -> dict[int, int]:
    """How many features of ``texts (text)`` lie in each bucket. Tasks give a row a bucket, and at most ``buckets`` rows reach the driver."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, slots in _tables(features(_texts(b, "text"), ngrams), buckets):
                np.add.at(total, slots.bucket, slots.count)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = texts.select(_as_bytes()).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r["bucket"]: r["n"] for r in counted.collect()}


def bucket_gains(raw: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """By bucket, how much likelier the target makes it than the raw texts, in thousandths of natural logarithms; one is added to every count."""
    s_all, t_all = float(sum(raw.values()) + buckets), float(sum(target.values()) + buckets)
    ratio = lambda b: (target.get(b, 0) + 1.0) * s_all / ((raw.get(b, 0) + 1.0) * t_all)
    return np.array([math.floor(1000 * math.log(ratio(b))) for b in range(buckets)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, ngrams: tuple[int, int] = NGRAMS) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)``: the floored mean gain of each row's features; 0 without any."""
    ship(docs.sparkSession)
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b, "text")
            f = features(texts, ngrams)
            n, total = np.bincount(f.doc, minlength=len(texts)), np.zeros(len(texts), np.int64)
            for part, slots in _tables(f, len(gains)):
                by_slot = gains[slots.bucket]
                np.add.at(total, f.doc[part], by_slot[slots.of])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, (f.n_words, n, total // np.maximum(n, 1)))], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", _as_bytes()).mapInArrow(run, f"doc_id {id_type}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise of a row in thousandths, from its id: the highest of weight plus noise are a draw without replacement."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 2.0**32)))


def rank_highest(rows: DataFrame, eligible: Column, score: str, tie: str, percent: int) -> DataFrame:
    """Adds ``rank`` to ``rows``: 1 to floor(percent * N / 100) by descending score among the N eligible ones, ties to the smaller ``tie``; null to all others.

    Scores are integers within a range that no table's size widens, so there are few different ones: the rows of each are counted, and the sums over higher scores tell
    where each score's ranks begin. Only drawn rows are ordered, within their own score. ``rows`` is read several times: give a written table.
    """
    at = F.col(score)
    levels = rows.where(eligible).groupBy(at.alias("_level")).agg(F.count(F.lit(1)).alias("_n"))
    # A row a score.
    higher = W.partitionBy(F.lit(0)).orderBy(F.desc("_level")).rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("_n").over(W.partitionBy(F.lit(0)))
    placed = levels.select("_level", F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_above"), F.floor(percent * total / 100).alias("_drawn")).where("_above < _drawn")
    found = rows.withColumn("_eligible", F.coalesce(eligible, F.lit(False))).join(F.broadcast(placed), F.col("_eligible") & (at == F.col("_level")), "left")
    within = F.row_number().over(W.partitionBy("_level").orderBy(F.col(tie).asc_nulls_first()))
    drawn = found.where("_above is not null").withColumn("rank", (F.col("_above") + within).cast("long"))
    rest = found.where("_above is null").withColumn("rank", F.lit(None).cast("long"))
    both = drawn.unionByName(rest)
    return both.withColumn("rank", F.when(F.col("rank") <= F.col("_drawn"), F.col("rank"))).select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, ngrams: tuple[int, int] = NGRAMS, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)``, one row a row of ``docs (doc_id, text)``; draws towards ``target (text)``.

    Features are hashed word n-grams. Counts of their buckets over all of both tables give each bucket's gain; a document's weight is the mean gain of its features, its
    score adds noise that follows from seed and doc_id, and of the documents with ``least_words`` words or more the highest scores are drawn. In tasks, n-grams of a batch are
    interned in a NumPy table, and occurrences gather gains by their slots. What is shuffled is counts, and the drawn rows' numbers; texts are read twice and never moved.

    Null and empty texts have no words, weight 0, and are not drawn. Rows that repeat each count and each may be drawn; of rows with one id and score either comes first. Rows
    without an id share one noise. An empty table gives an empty result, an empty target draws by what is rare. Only doc_id and text are used.
    """
    raw = bucket_counts(docs, ngrams, buckets)
    gains = bucket_gains(raw, bucket_counts(target, ngrams, buckets), buckets)
    scored = weigh(docs, gains, ngrams).withColumn("score", F.col("weight") + noise(seed=seed))
    return rank_highest(Scratch(docs.sparkSession).table(scored, "scored"), F.col("n_words") >= least_words, "score", "doc_id", percent)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, drawn towards the benchmark's texts."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = r"""
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], range(0, 8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(0, 256) AS r(i))),
src AS (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
w AS (SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM src),
o AS (SELECT side, doc_id, unnest(ws) AS word FROM w),
v AS (SELECT DISTINCT word FROM o),
bytes AS (SELECT word, list_transform(range(0, octet_length(encode(word))), lambda i: CAST(concat('0x', hex(encode(word))[2 * i + 1:2 * i + 2]) AS BIGINT)) AS bs FROM v),
b AS (SELECT word, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], bs), lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) % 10000 AS bucket FROM bytes, tab),
n AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM o JOIN b USING (word) GROUP BY bucket),
z AS (SELECT CAST(sum(s) AS BIGINT) AS s_all, CAST(sum(t) AS BIGINT) AS t_all FROM n),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (s_all + 10000.0::DOUBLE) / ((s + 1.0::DOUBLE) * (t_all + 10000.0::DOUBLE)))) AS BIGINT) AS gain FROM n, z),
m AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM o JOIN b USING (word) JOIN g USING (bucket) WHERE side = 'd' GROUP BY doc_id),
q AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(concat('0x', sha256(concat('2024:', CAST(d.doc_id AS VARCHAR)))[1:8]) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM documents d LEFT JOIN m USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM q WHERE n_features >= 20)
SELECT q.doc_id, q.n_features, q.weight, q.score, CASE WHEN r.rank <= 10 * r.n // 100 THEN r.rank END AS rank FROM q LEFT JOIN r USING (doc_id)
"""
