"""Scans of file and text tables for secrets and forbidden artifacts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import paths, text

MAX_BYTES = 2_000_000


@dataclass(frozen=True)
class Rules:
    """What a scan looks for; every part is the caller's to change."""

    basenames: Sequence[str] = paths.BASENAMES
    suffixes: Sequence[str] = paths.SUFFIXES
    directories: Sequence[str] = paths.DIRECTORIES
    patterns: Sequence[str] = text.SECRETS
    exempt: str = paths.EXEMPT
    max_bytes: int = MAX_BYTES


def size_gate(length: Column, max_bytes: int = MAX_BYTES) -> Column:
    """Contents strictly over the limit are not scanned."""
    return length <= max_bytes


def binary_gate(content: Column) -> Column:
    """Contents with a NUL byte are not scanned."""
    return F.position(F.lit(b"\0"), content) == 0


def utf8_gate(content: Column) -> Column:
    """Contents that are no UTF-8 are not scanned."""
    return F.is_valid_utf8(content.cast("string"))


def content_hit(content: Column, length: Column, rules: Rules = Rules()) -> Column:
    """Whether a readable content holds a secret. The gates come first, so the patterns see only what passes; unreadable (null) content holds none."""
    gates = size_gate(length, rules.max_bytes) & binary_gate(content) & utf8_gate(content)
    return F.coalesce(F.when(gates, text.any_pattern(content.cast("string"), rules.patterns)), F.lit(False))


def violations(corpus: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``(rule, path)``: up to four findings a file of ``corpus (path, content, length)``, in one pass and without a shuffle.

    The three path rules are independent of each other; contents give one finding, however many patterns hit.
    """
    p = F.col("path")
    guarded = lambda rule: paths.exempt_guard(p, rule, rules.exempt)
    found = F.array_compact(F.array(
        F.when(guarded(paths.bad_basename(p, rules.basenames)), "forbidden filename"),
        F.when(guarded(paths.bad_suffix(p, rules.suffixes)), "forbidden artifact type"),
        F.when(guarded(paths.bad_directory(p, rules.directories)), "forbidden runtime-artifact directory"),
        F.when(content_hit(F.col("content"), F.col("length"), rules), "possible secret pattern"),
    ))
    return corpus.select("path", F.explode(found).alias("rule")).select("rule", "path")


def skipped(corpus: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: how many contents were not scanned, by the gate that stopped them."""
    c, n = F.col("content"), F.col("length")
    small = size_gate(n, rules.max_bytes)
    return corpus.agg(
        F.count_if(c.isNull() & F.coalesce(small, F.lit(True))).alias("unreadable"),
        F.count_if(~small).alias("too_large"),
        F.count_if(small & ~binary_gate(c)).alias("binary"),
        F.count_if(small & binary_gate(c) & ~utf8_gate(c)).alias("not_utf8"),
    )


def dedupe(found: DataFrame) -> DataFrame:
    return found.select(text.message(F.col("rule"), F.col("path")).alias("message")).distinct()


def sorted_report(found: DataFrame) -> DataFrame:
    """Messages, each once, by code point."""
    return dedupe(found).orderBy("message")


def verdict(found: DataFrame) -> DataFrame:
    """One row, of an empty table too: PASS or FAIL, and the exit code that goes with it."""
    n = F.count(F.lit(1))
    return found.agg(F.when(n > 0, "FAIL").otherwise("PASS").alias("verdict"), F.when(n > 0, 1).otherwise(0).alias("exit_code"), n.alias("n_findings"))


def scan_table(df: DataFrame, id: str, column: str, patterns: Sequence[str] = text.SECRETS) -> DataFrame:
    """Ids of rows whose text holds a secret; the text itself does not come along."""
    return df.where(text.any_pattern(F.col(column), patterns)).select(id)
