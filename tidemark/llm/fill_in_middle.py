"""Fill-in-middle: texts cut in three at seeded places and put together in another order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ship, table

SEED = 1
# The control strings before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100: how many texts are transformed, and how many of those put the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class PointIndex:
    """Code points and bytes of a UTF-8 text: only its multibyte characters are recorded.

    ``at`` are their first bytes, ``excess`` how many bytes more than code points the text has before each and at its end. A place is found among them by a
    search; between two of them, in ASCII, a byte is a code point. Bytes that no UTF-8 has count as what their first byte says.
    """

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        first = data[self.at]
        self.excess = np.concatenate(([0], np.cumsum(1 + (first >= 0xE0) + (first >= 0xF0))))
        self.point = self.at - self.excess[:-1]
        self.n_points = len(data) - int(self.excess[-1])

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        return points + self.excess[np.searchsorted(self.point, points)]

    def to_points(self, at_bytes: np.ndarray) -> np.ndarray:
        return at_bytes - self.excess[np.searchsorted(self.at, at_bytes)]


def _token_starts(data: np.ndarray) -> np.ndarray:
    """First bytes of the tokens: runs of ASCII letters, and single other characters."""
    letter = _LETTER[data]
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def _lots(doc_id: int | None, seed: int) -> list[int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]


def _row(doc_id: int | None, text: bytes, unit: str, seed: int, marks: Sequence[bytes], transformed: int, suffix_first: int) -> tuple:
    """n, form, code points of prefix and middle, and the output of one text."""
    data = np.frombuffer(text, np.uint8)
    starts = _token_starts(data) if unit == "token" else None
    index = PointIndex(data)
    n = index.n_points if starts is None else len(starts)
    h1, h2, h3, h4 = _lots(doc_id, seed)
    if not text or any(m in text for m in marks) or h3 % 100 >= transformed:
        return n, PLAIN, None, None, text
    cuts = np.array(sorted((h1 % (n + 1), h2 % (n + 1))))
    if starts is None:
        points, (a, b) = cuts, index.to_bytes(cuts)
    else:
        a, b = (int(starts[c]) if c < n else len(text) for c in cuts)
        points = index.to_points(np.array([a, b]))
    form = SPM if h4 % 100 < suffix_first else PSM
    prefix, middle, suffix = marks[0] + text[:a], marks[2] + text[a:b], marks[1] + text[b:]
    return n, form, int(points[0]), int(points[1] - points[0]), suffix + prefix + middle if form == SPM else prefix + suffix + middle


def fill_in_middle(docs: DataFrame, unit: str = "token", seed: int = SEED, marks: Sequence[str] = MARKS, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, one row a row of ``docs (doc_id, text)``; other columns play no part.

    A text of n units (``token``: a run of ASCII letters, or any other code point; ``char``: a code point) is cut at two places that follow from the
    seed and doc_id alone: rows that repeat an id are cut alike, as far as their lengths are alike. Texts are read as bytes; cuts are found among the bytes of the
    units, and code points counted by a sparse index. No shuffle, and memory in proportion to the text.

    Null and empty texts give an empty output in form plain, as do texts that hold a mark (unchanged). A null doc_id counts as no digits. An empty table gives an
    empty result.
    """
    if unit not in ("token", "char"):
        raise ValueError(f"unknown unit: {unit}")
    ship(docs.sparkSession)
    as_bytes = tuple(m.encode() for m in marks)
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            rows = [_row(i, t.as_buffer().to_pybytes(), unit, seed, as_bytes, transformed, suffix_first) for i, t in zip(ids.to_pylist(), b.column(1), strict=True)]
            n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ((),) * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip((n, form, prefix, middle, output), kinds, strict=True))], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    raw = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    cut = raw.mapInArrow(run, f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary")
    return cut.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output of a form was made of. It holds no mark of its own, and no mark's end begins another, so marks are where they were put.

    Bytes that no UTF-8 has come back as replacement characters.
    """
    parts = F.split(output, "|".join(marks))
    put = lambda *order: F.concat(*[F.get(parts, F.lit(i)) for i in order])
    return F.when(form == PSM, put(1, 3, 2)).when(form == SPM, put(2, 3, 1)).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, cut by tokens, with the digest of each output and of the text rebuilt from it."""
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    again = restored(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS u, sha256(concat('1:', CAST(doc_id AS VARCHAR))) AS h FROM documents),
g AS (SELECT *, len(u) AS n, CAST(concat('0x', h[1:8]) AS BIGINT) % (len(u) + 1) AS c1, CAST(concat('0x', h[9:16]) AS BIGINT) % (len(u) + 1) AS c2,
             CAST(concat('0x', h[17:24]) AS BIGINT) % 100 AS h3, CAST(concat('0x', h[25:32]) AS BIGINT) % 100 AS h4 FROM t),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM g)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256, sha256(text) AS restored_sha256
FROM f
"""
