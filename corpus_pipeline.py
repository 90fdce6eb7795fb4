"""From raw documents to a training mix, in stages that are each written as Parquet and read again.

Every stage takes ``documents (doc_id, text, lang, source, n_chars)``, with whatever columns come beside them, and all but the last return
the same columns. An empty table goes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, language_id, mixing, secrets
from tidemark.llm.common import Scratch, ship, table
from tidemark.sources.workspace import freed

#: A text whose best language knows fewer of its n-grams than this is in none of the learned languages.
LEAST_LANGUAGE_SCORE = 0.05
#: Up to so many keys are broadcast; more are joined.
BROADCAST_KEYS = 1_000_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those in no learned language; a missing lang becomes the predicted one.

    Null and empty texts have no letters and go. Rows that repeat, and rows without an id, are judged by their texts. Columns named like a
    prediction stay as they were. Where no document has a language nothing can be learned, and all with letters stay; a
    model that has languages and not one n-gram of theirs is refused, as it would reject everything.
    """
    ship(spark)
    filters = language_id.fit(docs.where(F.col("doc_id").isNotNull() & ~language_id.held_out("doc_id")))
    if not filters.languages:
        return docs.where(F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False)))
    if filters.empty:
        raise RuntimeError("the language model is empty: no language of the labelled documents has an n-gram")
    found = docs.withColumn("_found", language_id.prediction(spark, filters)(F.col("text")))
    kept = found.where((F.col("_found.lang_pred") != language_id.UND) & (F.col("_found.score") >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "_found.lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies: the one with the smallest doc_id.

    Rows without an id are compared like others, and stay only where no row with one is in their class. Of rows that repeat one stays.
    Null and empty texts are no copies of anything but rows of the same id and text.
    """
    ship(spark)
    return jaccard_join.keep_one(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item.

    A row is known by its id and 128 bits of its text, so rows without an id, or of one id, go and stay by their own texts. Null and
    empty texts hold no window and stay. Without benchmark items all stay.
    """
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("first"), F.xxhash64(F.lit("second"), "text").alias("second"))
    report = decontaminate.report(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = Scratch(spark).table(report.where("contaminated").select(F.col("doc_id").alias("_gone")).distinct(), "contaminated")
    few = gone.count() <= BROADCAST_KEYS
    same = (key["first"] == F.col("_gone.first")) & (key["second"] == F.col("_gone.second")) & key["id"].eqNullSafe(F.col("_gone.id"))
    return docs.join(F.broadcast(gone) if few else gone, same, "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secret spans by a mark; n_chars follows the text, and no document goes.

    Null texts stay null, empty ones empty. Which random tokens count follows from all documents, so rows that repeat are redacted alike.
    """
    ship(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, by source: doc_id, source, size, source_size, target, taken.

    Null and empty texts have size 0 and take nothing. A null source is one of the sources. Rows that repeat each get a row.
    """
    return mixing.mix(docs).drop("shard")


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
]

#: Language scores and shingle classes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote for itself is freed once its table is written, and that once the next one is."""
    docs, scratch, before = table(spark, sf_dir, "documents"), Scratch(spark), None
    for name, stage in STAGES:
        with freed(spark):
            docs = scratch.table(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
