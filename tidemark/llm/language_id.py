"""Language ID: bit-sliced Bloom filters tell all languages that hold an n-gram; corrected popcounts decide."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, drawn, table

SIZES = (3, 4)
HASHES = 3
#: A filter has at least as many slots as bits for each hash of an n-gram that set one.
SLOTS_A_HASH = 6
LEAST_SLOT_BITS, MOST_SLOT_BITS = 16, 26
#: Languages a mask word holds; more take several words a slot.
MASK_LANGUAGES = 64
#: So many documents of each language are fitted on at most, chosen by a hash of id and text.
SAMPLE_DOCS = 2_000
#: A language holds the n-grams that at least this share of its sampled documents have; so a language has at most 1 / SHARE times as many as a document.
SHARE = 0.01
PIECE = 1 << 16
UND = "und"
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def gram_hashes(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of the n-grams of a text's words, in pieces: letters only, lower case, a mark at either end of a word."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    reach = max(SIZES) - 1
    for at in range(0, len(points), PIECE):
        # A piece begins with the end of the one before; that n-gram ends in this piece.
        lead = min(at, reach)
        x = points[at - lead : at + PIECE]
        x = np.where(_letters()[x], x, 0)
        edge = np.zeros(1, x.dtype)
        x = np.concatenate([edge] * (at == 0) + [x] + [edge] * (at + PIECE >= len(points)))
        wide = x.astype(np.uint64)
        word = x != 0
        for n in SIZES:
            if len(x) < n:
                continue
            skip = max(0, lead - n + 1) if at else 0
            inner = np.ones(len(x) - n + 1, bool)
            for k in range(1, n - 1):
                inner &= word[k : len(x) - n + 1 + k]
            h = np.full(len(x) - n + 1, n, np.uint64)
            for k in range(n):
                h = (h ^ wide[k : len(x) - n + 1 + k]) * M1
                h ^= h >> np.uint64(29)
            h = h[skip:][inner[skip:]]
            yield h * M2


def _slots(h: np.ndarray, bits: int) -> list[np.ndarray]:
    step = np.uint64(64 - bits)
    return [(h * np.uint64(2 * k + 1) + (h >> np.uint64(32)) * np.uint64(k)) * M1 >> step for k in range(HASHES)]


@dataclass
class Filters:
    """Slot by slot, bit l says that language l has an n-gram there; over 64 languages, a row of slots for each 64. ``false`` is each language's false-positive rate."""

    languages: list[str]
    slots: np.ndarray
    false: np.ndarray
    bits: int

    @classmethod
    def build(cls, grams: dict[str, np.ndarray]) -> Filters:
        """Filters of the n-grams of each language, all of them; the slots grow with the language that has most."""
        languages = sorted(grams)
        words = max(1, -(-len(languages) // MASK_LANGUAGES))
        most = max([1, *(len(g) for g in grams.values())])
        bits = min(MOST_SLOT_BITS, max(LEAST_SLOT_BITS, (SLOTS_A_HASH * HASHES * most - 1).bit_length()))
        slots, fill = np.zeros((words, 1 << bits), np.uint64), []
        for at, name in enumerate(languages):
            word, bit = slots[at // MASK_LANGUAGES], np.uint64(1 << at % MASK_LANGUAGES)
            for s in _slots(grams[name], bits):
                word[s] |= bit
            fill.append(np.count_nonzero(word & bit) / len(word))
        kind = next((t for most, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32)) if len(languages) <= most), np.uint64)
        return cls(languages, (slots if words > 1 else slots[0]).astype(kind), np.array(fill) ** HASHES, bits)

    @property
    def empty(self) -> bool:
        """Whether no language holds any n-gram, so that no prediction means anything."""
        return not self.slots.any()

    def masks(self, h: np.ndarray) -> np.ndarray:
        """All languages that hold each n-gram, as bits; a row for each 64 where there are more."""
        out = None
        for s in _slots(h, self.bits):
            out = self.slots[..., s] if out is None else out & self.slots[..., s]
        return out

    def counts(self, h: np.ndarray) -> np.ndarray:
        """By language and by how many languages hold an n-gram, from none on: the number of n-grams."""
        masks, n = np.atleast_2d(self.masks(h)), len(self.languages)
        held = np.bitwise_count(masks).sum(0, dtype=np.int64)
        out = np.zeros((n, n + 1), np.int64)
        for at in range(n):
            bit = masks.dtype.type(1 << at % MASK_LANGUAGES)
            out[at] = np.bincount(held[(masks[at // MASK_LANGUAGES] & bit) != 0], minlength=n + 1)
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language with the highest corrected popcount of rare n-grams (of equal ones the first by name), and its popcount as a share of the n-grams; ``und`` without letters.

        An n-gram that m of L languages hold counts log((L + 1) / m) for each of them. Those that a filter holds by mistake are taken off: they stand alone, as a rule.
        """
        languages, n = len(self.languages), 0
        counts = np.zeros((languages, languages + 1), np.int64)
        for h in gram_hashes(text or ""):
            counts += self.counts(h)
            n += len(h)
        if not n or not self.languages:
            return UND, 0.0
        weight = np.concatenate(([0.0], np.log((languages + 1) / np.arange(1, languages + 1))))
        best = int((counts @ weight - weight[1] * n * self.false).argmax())
        real = np.clip((counts[best].sum() - n * self.false[best]) / (1 - min(self.false[best], 0.99)), 0, n)
        return self.languages[best], float(real / n)


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for lang, texts in b.groupby("lang")["text"]:
            found: dict[int, int] = {}
            for t in texts:
                if parts := list(gram_hashes(t)):
                    for h in np.unique(np.concatenate(parts)).view(np.int64).tolist():
                        found[h] = found.get(h, 0) + 1
            yield pd.DataFrame({"lang": lang, "gram": np.fromiter(found, np.int64, len(found)), "n": np.fromiter(found.values(), np.int64, len(found))})


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, share: float = SHARE) -> Filters:
    """Filters from ``labelled (doc_id, text, lang)``.

    Of each language at most sample_docs documents are taken, the first by a hash of doc_id and text. An n-gram's documents are counted per
    language; a language holds all n-grams that at least ``share`` of its sampled documents (two, of a few) have, whatever other languages hold them
    too. Rows with a null text or language teach nothing.
    """
    known = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    # Counted without the texts, which a columnar scan then leaves unread.
    totals = {r["lang"]: r["n"] for r in labelled.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return Filters.build({})
    scratch = Scratch(labelled.sparkSession)
    sample = scratch.table(drawn(known, "lang", totals, sample_docs, "doc_id", "text").select("lang", "text"), "sample")
    sizes = sample.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    counts = sample.mapInPandas(_count_batches, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A row a language, of which there are few.
    held = counts.join(F.broadcast(sizes), "lang").where(F.col("n") >= F.greatest(F.lit(share) * F.col("docs"), F.when(F.col("docs") >= 20, 2).otherwise(1)))
    top = held.select("lang", "gram").toPandas()
    scratch.drop("sample")
    found = {name: part.to_numpy(np.int64).view(np.uint64) for name, part in top.groupby("lang")["gram"]}
    return Filters.build({name: found.get(name, np.zeros(0, np.uint64)) for name in totals})


def prediction(spark: SparkSession, filters: Filters):
    """A column function of text: lang_pred and score. The filters, whose size follows from what the bounded sample holds, are broadcast."""
    held = spark.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        found = [held.value.predict(t) for t in texts]
        return pd.DataFrame({"lang_pred": [x[0] for x in found], "score": [x[1] for x in found]})

    # Else a filter on the prediction would run it once more.
    return predicted.asNondeterministic()


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with lang_pred and score; a column of either name is replaced.

    Null texts and texts without letters are ``und`` with score 0. Whole texts count, in pieces. Equal rows each get
    a row; an empty table gives an empty result.
    """
    found = prediction(docs.sparkSession, filters)(F.col("text"))
    kept = docs.drop("lang_pred", "score").withColumn("_found", found)
    return kept.select("*", "_found.lang_pred", "_found.score").drop("_found")


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents; learned from those that are not held out. A null doc_id is not held out, and teaches nothing."""
    docs = table(spark, sf_dir, "documents")
    filters = fit(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")))
    return predict(docs.select("doc_id", "text"), filters).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
