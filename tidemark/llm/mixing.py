"""Mixing sources to target weights: Sainte-Laguë block quotas, then a seeded selection of blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SHARD_ROWS = 1_000
BLOCK_WORDS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _lot(seed: int, *parts: str) -> Column:
    """A number below 2^60 that any SQL engine can compute: the first digits of an MD5; nulls count as empty."""
    return _number(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])))


def _number(md5: Column) -> Column:
    return F.conv(F.substring(md5, 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to ``(source, source_size)``: shares of the whole by weight, none above max_epochs times its size.

    Weights repeat over the sources by code point, null last. The shares are the fixed point of resharing the
    excess: with level L, a source gets min(cap, L * weight). Going by cap / weight, a source is capped as long as its
    ratio is within the level that the sources from it on would share. There is a row a source here, never one a
    document.
    """
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    by_ratio = W.orderBy("_ratio", F.col("source").isNull(), "source")
    before, after = by_ratio.rowsBetween(W.unboundedPreceding, -1), by_ratio.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy(F.lit(0))
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_weight").over(after)
    return (
        sources.withColumn("_weight", F.element_at(kinds, (F.row_number().over(by_name) - 1) % len(weights) + 1))
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(whole))
        .withColumn("_level", level)
        .withColumn("_free", F.max(F.when(F.col("_ratio") > F.col("_level"), F.col("_level"))).over(whole))
        .withColumn("target", F.when(F.col("_ratio") <= F.col("_level"), F.col("_cap").cast("double")).otherwise(F.col("_free") * F.col("_weight")))
        .drop("_weight", "_cap", "_ratio", "_total", "_level", "_free")
    )


def sainte_lague(parties: DataFrame, votes: str, seats: str, by: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """Adds ``quota``: the ``seats`` of each ``by`` go to the parties with the highest quotients votes / (2 s + 1).

    The divisor that hands out all seats rounds n parties' shares, so it lies where the shares add up to the
    seats within n / 2 on either side. Every party therefore holds the seats rounded at the lower end, and only those up to
    the upper end compete: about two rows a party. Ties go by ``ties``.
    """
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    share = lambda sign: F.col(votes) * F.greatest(F.lit(0.0), F.col(seats) + sign * F.col("_n") / 2) / F.col("_votes")
    ranked = group.orderBy(F.col("_quotient").desc(), *[F.col(x) for x in ties], "_seat")
    bounds = (
        parties.withColumn("_n", F.count(F.lit(1)).over(group))
        .withColumn("_votes", F.sum(votes).over(group))
        .withColumn("_sure", F.when(F.col("_votes") > 0, F.greatest(F.lit(0), F.floor(share(-1) + 0.5) - 1)).otherwise(0).cast("long"))
        .withColumn("_most", F.when((F.col("_votes") > 0) & (F.col(votes) > 0), F.floor(share(1) + 0.5) + 1).otherwise(0).cast("long"))
        .withColumn("_open", F.col(seats) - F.sum("_sure").over(group))
    )
    kept = parties.columns
    return (
        bounds.withColumn("_seat", F.explode_outer(F.when(F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure"), F.col("_most") - 1))))
        .withColumn("_quotient", F.col(votes) / (2 * F.col("_seat") + 1))
        .withColumn("_won", F.when(F.col("_seat").isNotNull() & (F.row_number().over(ranked) <= F.col("_open")), 1).otherwise(0))
        .groupBy(*kept, "_sure")
        .agg(F.sum("_won").alias("_won"))
        .select(*kept, (F.col("_sure") + F.col("_won")).alias("quota"))
    )


def _within_limits(plan: DataFrame, block: int, max_epochs: int) -> DataFrame:
    """Adds ``_words``: a shard's quota in words, at most max_epochs times its size.

    What that limit cuts goes to the source's other shards in proportion to the room that they have left, to the word: each
    takes the step of the running sum that its room makes. A source without a cut keeps its quotas. There is a row a source and shard here.
    """
    source = W.partitionBy("source")
    along = source.orderBy("shard")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    due, limit = F.col("quota") * block, F.col("shard_size") * max_epochs
    return (
        plan.withColumn("_cut", F.greatest(F.lit(0), due - limit))
        .withColumn("_room", F.greatest(F.lit(0), limit - due))
        .withColumn("_all_room", F.sum("_room").over(source))
        .withColumn("_given", F.least(F.sum("_cut").over(source), "_all_room"))
        .withColumn("_till", F.sum("_room").over(along.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("_from", F.col("_till") - F.col("_room"))
        .withColumn("_more", exact("_till") * exact("_given"))
        .withColumn("_less", exact("_from") * exact("_given"))
        .withColumn("_more", F.when(F.col("_given") > 0, F.expr("_more div _all_room - _less div _all_room")).otherwise(0))
        .withColumn("_words", F.least(due, limit) + F.col("_more"))
        .drop("_cut", "_room", "_all_room", "_given", "_till", "_from", "_more", "_less")
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 17, shard_rows: int = SHARD_ROWS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Mixes ``docs (doc_id, text, source)``: how many words of each document the training mix takes.

    Documents are dealt to seeded shards, so that a source with a third of all rows is spread like any other. Blocks of
    equal words go to sources by highest quotients of their targets, and each source's blocks to its shards by highest
    quotients of their words; what exceeds a shard's limit goes to the source's shards with room left. Within a shard the documents stand in a seeded order; its quota takes whole
    passes over it, and the rest as a run of blocks from a seeded place, round the end. Blocks hold ``block_words``
    words, or fewer where all texts together have under 10,000 blocks.

    Null texts and texts without words have size 0 and take 0. A null source is a source, weighed last. Rows that repeat count
    as often as they occur; equal rows may share their words out either way. Rows without an id, or of one id, are dealt by their texts. An empty table
    gives an empty result. Only doc_id, text and source are used; other columns play no part. Rerunning gives the same rows: everything random is a
    hash of seed, doc_id and text.

    Returns doc_id, source, size, source_size, target, taken, and the row's shard.
    """
    scratch = Scratch(docs.sparkSession)
    content = _number(F.md5(F.coalesce("text", F.lit("")))).alias("_content")
    sized = scratch.table(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), content), "sized")
    n, words = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    # Both a shard's rows and the number of shards grow as the root of a very large input.
    shards = max(1, n // max(shard_rows, int(n**0.5)))
    block = max(1, min(block_words, words // 10_000))
    dealt = sized.select("*", (_lot(seed, "doc_id", "_content") % shards).alias("shard"), _lot(seed + 1, "doc_id", "_content").alias("_order"))

    per_shard = dealt.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    per_source = per_shard.groupBy("source").agg(F.sum("shard_size").alias("source_size"))
    targets = source_targets(per_source, weights, max_epochs).withColumn("_blocks", F.lit(round(words / block)))
    quotas = sainte_lague(targets, "target", "_blocks", [], ["source"]).withColumnRenamed("quota", "_source_blocks")
    named = per_shard.withColumnRenamed("source", "_source")
    joined = named.join(quotas.drop("_blocks"), F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    plan = scratch.table(sainte_lague(joined, "shard_size", "_source_blocks", ["source"], ["shard"]).drop("_source_blocks"), "plan")

    plan = _within_limits(plan, block, max_epochs).withColumnsRenamed({"source": "_source", "shard": "_shard"})
    within = W.partitionBy("source", "shard").orderBy("_order", "doc_id", "_content").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(within), F.lit(0))
    overlap = lambda lo, hi: F.greatest(F.lit(0), F.least(F.col("_start") + F.col("size"), hi) - F.greatest(F.col("_start"), lo))
    return (
        dealt.withColumn("_start", start)
        .join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
        .withColumn("_passes", F.when(F.col("shard_size") > 0, F.expr("_words div shard_size")).otherwise(0))
        .withColumn("_rest", F.col("_words") - F.col("_passes") * F.col("shard_size"))
        .withColumn("_lot", _lot(seed + 2, "source", "shard"))
        .withColumn("_from", F.when(F.col("shard_size") > 0, F.expr(f"(_lot % shard_size) div {block} * {block}")).otherwise(0))
        .withColumn("_till", F.col("_from") + F.col("_rest"))
        .withColumn("taken", F.col("_passes") * F.col("size") + overlap(F.col("_from"), F.col("_till")) + overlap(F.lit(0), F.col("_till") - F.col("shard_size")))
        .select("doc_id", "source", "size", "source_size", "target", "taken", "shard")
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


OP10_SQL = r"""
WITH z AS (SELECT doc_id, source, CAST(concat('0x', substr(md5(coalesce(text, '')), 1, 15)) AS BIGINT) AS content, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
g AS (SELECT count(*) AS n, CAST(coalesce(sum(size), 0) AS BIGINT) AS words, greatest(1, n // greatest(1000, CAST(floor(sqrt(n)) AS BIGINT))) AS shards, greatest(1, least(64, words // 10000)) AS block FROM z),
d AS (SELECT z.*, CAST(concat('0x', substr(md5(concat('17:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', CAST(content AS VARCHAR))), 1, 15)) AS BIGINT) % shards AS shard,
             CAST(concat('0x', substr(md5(concat('18:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', CAST(content AS VARCHAR))), 1, 15)) AS BIGINT) AS o FROM z, g),
h AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size FROM d GROUP BY ALL),
s0 AS (SELECT source, CAST(sum(shard_size) AS BIGINT) AS source_size FROM h GROUP BY source),
s1 AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 3 * source_size AS cap FROM s0),
s2 AS (SELECT *, CAST(g.words - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
              / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s1, g),
s3 AS (SELECT *, max(CASE WHEN cap / weight > level THEN level END) OVER () AS free FROM s2),
s AS (SELECT source, source_size, CASE WHEN cap / weight <= level THEN CAST(cap AS DOUBLE) ELSE free * weight END AS target, CAST(round_even(words / block, 0) AS BIGINT) AS blocks FROM s3),
q AS (SELECT source, target / (2 * k + 1) AS quotient, k, max(blocks) OVER () AS blocks FROM s, unnest(range(0, blocks)) AS u(k)),
w AS (SELECT source, count(*) AS won FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, source, k) AS r FROM q) WHERE r <= blocks GROUP BY source),
hq AS (SELECT h.source, h.shard, shard_size / (2 * k + 1) AS quotient, k, w.won FROM h JOIN w ON h.source IS NOT DISTINCT FROM w.source, unnest(range(0, w.won)) AS u(k)),
hw AS (SELECT source, shard, count(*) AS quota FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard, k) AS r FROM hq) WHERE r <= won GROUP BY ALL),
r0 AS (SELECT h.source, h.shard, h.shard_size, coalesce(hw.quota, 0) * block AS wanted, 3 * h.shard_size AS most, greatest(0, wanted - most) AS cut, greatest(0, most - wanted) AS room
      FROM h LEFT JOIN hw ON h.source IS NOT DISTINCT FROM hw.source AND h.shard = hw.shard, g),
r1 AS (SELECT *, sum(room) OVER (PARTITION BY source) AS rooms, least(sum(cut) OVER (PARTITION BY source), rooms) AS given, sum(room) OVER (PARTITION BY source ORDER BY shard) AS till FROM r0),
p AS (SELECT source, shard, shard_size, CAST(least(wanted, most) + CASE WHEN given > 0 THEN CAST(till AS HUGEINT) * given // rooms - CAST(till - room AS HUGEINT) * given // rooms ELSE 0 END AS BIGINT) AS due, due // greatest(shard_size, 1) AS passes, due - passes * shard_size AS rest,
             CASE WHEN shard_size > 0 THEN CAST(concat('0x', substr(md5(concat('19:', coalesce(source, ''), ':', CAST(shard AS VARCHAR))), 1, 15)) AS BIGINT) % shard_size // block * block ELSE 0 END AS lo, lo + rest AS hi
      FROM r1, g),
e AS (SELECT d.*, CAST(coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY o, doc_id, content ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a FROM d)
SELECT e.doc_id, e.size, s.source_size, s.target, CAST(p.passes * e.size + greatest(0, least(a + e.size, hi) - greatest(a, lo)) + greatest(0, least(a + e.size, hi - shard_size) - a) AS BIGINT) AS taken, e.source
FROM e JOIN p ON e.source IS NOT DISTINCT FROM p.source AND e.shard = p.shard JOIN s ON e.source IS NOT DISTINCT FROM s.source
"""
