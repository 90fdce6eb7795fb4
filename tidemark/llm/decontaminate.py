"""Benchmark decontamination: a broadcast hash set of test n-grams against the token windows of all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, let, table

WIDTH = 10
#: Test windows that are broadcast at most; with ten words and an item each they take about 100 MB.
BROADCAST_WINDOWS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between two words, in lower-cased text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of A-Z-lowered text: runs of digits, letters a-z and anything beyond ASCII. Null has none."""
    whole = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    return F.array_remove(F.split(lowered, GAP), "")


def _window_hashes(words: Column, lengths: list[int]) -> Column:
    """Hashes of all windows of each of these lengths, length by length.

    Hashes of two words make those of four, and so on, so a window's hash costs a few steps, whatever its length.
    """
    both = lambda a, b: F.xxhash64(a, b)

    def of_length(levels: dict[int, Column], n: int) -> Column:
        powers = [q for q in sorted(levels, reverse=True) if n & q]
        out, used = levels[powers[0]], powers[0]
        for q in powers[1:]:
            m = F.greatest(F.size(levels[1]) - (used + q) + 1, F.lit(0))
            out, used = F.zip_with(F.slice(out, F.lit(1), m), F.slice(levels[q], F.lit(used + 1), m), both), used + q
        return out

    def doubled(levels: dict[int, Column], power: int) -> Column:
        if 2 * power > max(lengths):
            return F.concat(*[of_length(levels, n) for n in lengths])
        m = F.greatest(F.size(levels[power]) - power, F.lit(0))
        pairs = F.zip_with(F.slice(levels[power], F.lit(1), m), F.slice(levels[power], F.lit(power + 1), m), both)
        return let(pairs, lambda p: doubled({**levels, 2 * power: p}, 2 * power))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: doubled({1: h}, 1))


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct windows ``(known, gram, n_gram, items)`` of ``benchmark (item_id, text)``, ``known`` a hash; a short item is one window.

    Items without words have no window. An item whose id is null marks words, but is not among the items.
    """
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    grams = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, width))).alias("gram"))
    found = grams.groupBy("gram").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")).withColumn("n_gram", F.size("gram"))
    known = F.coalesce(*[F.when(F.col("n_gram") == n, _window_hashes(F.col("gram"), [n])[0]) for n in range(1, width + 1)])
    return found.select(known.alias("known"), "gram", "n_gram", "items")


def find_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Adds ``n_words``, ``hits`` and ``items`` to ``docs (doc_id, text)``, one row a document row, other columns dropped.

    ``hits`` are the verified windows (0-based word start, number of words), ``items`` the sorted ids of the items they
    come from. A document's windows are hashed where its text is read, and meet the set of test windows there; a match
    counts only if its words are the same. What is shuffled is the matches and one row a document. The test windows are
    counted first and broadcast up to ``broadcast_windows``; beyond that the documents' words are written once, hashes of windows and set
    are shuffled, and matches meet their documents' words again to be verified.

    Null and empty texts have no words and no hits; whole texts of any length count. Equal rows each get a row. No benchmark: no hits.
    """
    windows = benchmark_windows(benchmark, width)
    spread = {r["n_gram"]: r["n"] for r in windows.groupBy("n_gram").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `width` rows
    lengths = sorted(spread)
    # Windows stand length by length, so a place among them tells where in the text it is.
    before = [(n, sum((F.greatest(F.col("n_words") - m + 1, F.lit(0)) for m in lengths if m < n), F.lit(0))) for n in lengths]
    start = (F.col("pos") - F.coalesce(*[F.when(F.col("n_gram") == n, offset) for n, offset in before], F.col("pos"))).alias("start")
    hashed = _window_hashes(F.col("words"), lengths) if lengths else F.array().cast("array<bigint>")
    same = F.slice("words", F.col("start") + 1, F.col("n_gram")) == F.col("gram")
    split = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    empty = F.array().cast("array<string>")
    if sum(spread.values()) <= broadcast_windows:
        # A row of its own for every document, beside its windows: it meets this entry of the set.
        own = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("known"), empty.alias("gram"), F.lit(0).alias("n_gram"), empty.alias("items"))
        opened = split.select("row", "doc_id", "words", "n_words", F.posexplode(F.concat(hashed, F.array(F.lit(0).cast("long")))).alias("pos", "hash"))
        met = opened.join(F.broadcast(windows.unionByName(own)), F.col("hash") == F.col("known")).select("*", start).where(same)
        found = met.select("row", "doc_id", "n_words", "start", "n_gram", "items")
    else:
        split = Scratch(docs.sparkSession).table(split, "words")
        opened = split.select("row", "n_words", F.posexplode(hashed).alias("pos", "hash"))
        met = opened.join(windows, F.col("hash") == F.col("known")).select("row", start, "gram", "n_gram", "items")
        met = met.join(split, "row").where(same).select("row", "doc_id", "n_words", "start", "n_gram", "items")
        found = met.union(split.select("row", "doc_id", "n_words", F.lit(0), F.lit(0), empty))
    return found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("n_gram") > 0, F.struct("start", F.col("n_gram").alias("n"))))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def covered(hits: Column) -> Column:
    """How many words the windows cover, each once; ``hits`` by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    add = lambda a, h: F.struct(F.greatest(a["end"], h["start"] + h["n"]).alias("end"), (a["n"] + F.greatest(F.lit(0), h["start"] + h["n"] - F.greatest(a["end"], h["start"]))).alias("n"))
    return F.aggregate(hits, zero, add, lambda a: a["n"])


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document row: n_words, n_hit, n_items, items_sha256, contaminated; see find_hits."""
    return find_hits(docs, benchmark, width).select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        covered(F.col("hits")).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH it AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
ig AS (SELECT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS n FROM it, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dg AS (SELECT doc_id, i, l.n AS n, array_to_string(w[i:i + l.n - 1], ' ') AS g FROM d, (SELECT DISTINCT n FROM ig) AS l, unnest(range(1, len(w) - l.n + 2)) AS u(i)),
h AS (SELECT DISTINCT dg.doc_id, dg.i, dg.n, ig.item_id FROM dg JOIN ig ON dg.g = ig.g AND dg.n = ig.n),
p AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM h, unnest(range(i, i + n)) AS u(j) GROUP BY doc_id),
k AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(k.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(k.ids, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN k USING (doc_id)
"""
