"""Token counts by a digest cache: only distinct texts that the cache lacks are encoded."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: Up to so many missing keys, of 40 bytes, are broadcast, and only their texts are read on; the texts of more are shuffled.
BROADCAST_KEYS = 20_000
#: Scripts in which both libraries' patterns class every character alike: below the end of Latin Extended-B, and common punctuation.
ELSEWHERE = re.compile("[^\x00-ɏ‐-‧‰-⁞]")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_version(path: str, ranks_path: str | None = None) -> str:
    """The digest of the vocabulary files and of the libraries that encode with them: any change makes new cache keys."""
    import tiktoken
    import tokenizers

    parts = [tokenizers.__version__, tiktoken.__version__ if ranks_path else ""]
    for p in (path, ranks_path):
        if p:
            with open(p, "rb") as f:
                parts.append(hashlib.sha256(f.read()).hexdigest())
    return hashlib.sha256(":".join(parts).encode()).hexdigest()


@lru_cache(maxsize=2)
def _counter(path: str, ranks_path: str | None):
    """A function from text to its number of tokens, as the tokenizers library counts them by default.

    Given the same vocabulary as ranks, texts of Latin script go through the faster encoder of it, special strings by
    themselves as the library takes them out; the rest goes through the library.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    by_library = lambda text: len(library.encode(text, add_special_tokens=False))
    if not ranks_path:
        return by_library

    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    cut = re.compile("|".join(map(re.escape, special))) if special else None

    def count(text: str) -> int:
        if ELSEWHERE.search(text):
            return by_library(text)
        if cut is None or not cut.search(text):
            return len(fast.encode_ordinary(text))
        pieces = cut.split(text)
        return len(pieces) - 1 + sum(len(fast.encode_ordinary(x)) for x in pieces)

    return count


def _encode(path: str, ranks_path: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, seen = _counter(path, ranks_path), set()
        for b in batches:
            # Rows that repeat an id and its text come to one task.
            b = b[[d not in seen and not seen.add(d) for d in b["digest"]]]
            yield pd.DataFrame({"digest": b["digest"], "n_tokens": [count(t) for t in b["text"]]})

    return run


def count_tokens(docs: DataFrame, cache_dir: str, tokenizer: str = TOKENIZER, ranks: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit to ``docs (doc_id, text)``; other columns are dropped.

    A text's key is the SHA-256 of its content beside the tokenizer version's digest. Content is normalised only in that
    null is the empty text: any other normalisation would change the counts. Keys are reduced to distinct ones
    before any text moves; those that the table at ``cache_dir`` (a folder a version) holds are left out, one row of each other
    key is encoded, whole, and the new counts are appended to the cache. Few missing keys are broadcast, so that no text moves; the texts
    of many are shuffled by key. A run that dies before appending leaves the
    cache as it was; counts that two runs append at once are equal, and one of them is read.

    Null and empty texts have 0 bytes and 0 tokens. Equal rows each get a row, a null doc_id too. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    path = tokenizer_path(tokenizer)
    ranks_path = tokenizer_path(ranks) if ranks else None
    whole = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", whole.alias("text"), F.unhex(F.sha2(whole, 256)).alias("digest"), F.octet_length(whole).cast("long").alias("n_bytes"))

    schema, scratch = "digest binary, n_tokens bigint", Scratch(spark)
    folder = f"{cache_dir}/version={tokenizer_version(path, ranks_path)}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    known = spark.read.schema(schema).parquet(folder) if there else spark.createDataFrame([], schema)
    # The smallest doc_id stands for its key.
    wanted = keyed.groupBy("digest").agg(F.min("doc_id").alias("first_id")).join(known, "digest", "left_anti")
    wanted = scratch.table(wanted.withColumnRenamed("digest", "wanted"), "wanted")
    few = wanted.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    wanted = F.broadcast(wanted) if few else wanted.hint("shuffle_hash")
    misses = keyed.join(wanted, (F.col("digest") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("first_id"))).select("digest", "text")
    if few:
        # Rows that repeat an id and its text may stand in several tasks.
        misses = misses.dropDuplicates(["digest"])
    fresh = misses.mapInPandas(_encode(path, ranks_path), "digest binary, n_tokens bigint")
    fresh.write.mode("append").parquet(folder)

    # As a table of its own the counts meet the rows in a plain join, whose hot keys Spark can split.
    counts = spark.read.schema(schema).parquet(folder).groupBy("digest").agg(F.first("n_tokens").alias("n_tokens"))
    sized = keyed.select("doc_id", "digest", "n_bytes")
    return sized.join(scratch.table(counts, "counts"), "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, against a cache that this run starts and fills, so that each run does the whole work."""
    return count_tokens(table(spark, sf_dir, "documents"), f"{Scratch(spark).root}/token_cache", ranks="byte_bpe_50k.tiktoken")
