"""Chat formatting: conversations as marked text with a loss mask, by Spark expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import let, table

# The template. A mark stands at the start of a line; what looks like one inside a text gets a backslash before it.
OPEN, MORE, CLOSE = "<turn>", "\n<turn/>\n", "\n</turn>\n"
CONTROL = "(</?turn/?>)"
TRAINED = ("assistant",)
#: The conversation that the query adds: its text holds an escape, a foreign mark and one of ours.
PLANTED_ID, PLANTED_TEXT = -7, r"\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    """Takes off the one backslash that escape has put right before a control string; any before it are the text's own."""
    return F.regexp_replace(text, r"\\" + CONTROL, "$1")


def _role_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_of(line: Column) -> Column:
    return F.replace(F.replace(line, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def merged_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, blocks)``: the sorted turns of each conversation, adjacent ones of a role in one block ``(role, texts)``.

    Turns are collected once and sorted; a block begins where the role changes, and is the slice up to the next beginning, so the work grows
    with the turns, not with their square.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    role = lambda i: F.col("turns")[i - 1]["role"]
    begins = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (i == 1) | (role(i) != F.get(F.col("turns"), i - 2)["role"]))
    till = lambda k: F.coalesce(F.get(F.col("begins"), k + 1), F.size("turns") + 1)
    block = lambda b, k: F.struct(role(b).alias("role"), F.transform(F.slice("turns", b, till(k) - b), lambda t: t["text"]).alias("texts"))
    return sorted_turns.withColumn("begins", begins).select("conv_id", F.transform("begins", block).alias("blocks"))


def format_chats(turns: DataFrame, trained: Sequence[str] = TRAINED) -> DataFrame:
    """``(conv_id, formatted, segments)`` of ``turns (conv_id, turn, role, text)``; other columns play no part.

    A block is ``<turn>role``, its texts, and ``</turn>``, each on lines of their own; texts that were turns of their own stay apart by ``<turn/>``, so
    that all turns can be read back. ``formatted`` is the texts of ``segments (text, loss)`` in order; ``loss`` marks the texts of ``trained`` roles, and
    nothing else: no mark is under the loss.

    Turns go by number, then role, then text: ties and repeated rows each count, and a null number comes first. A null role or text is an empty
    one. Rows without a conv_id make one conversation, whose id is null. An empty table gives an empty result. A conversation is one value, so
    its turns have to fit in one row; there is no other limit.
    """
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)

    def segments(block: Column) -> Column:
        loss = block["role"].isin(*trained)
        head = F.concat(F.lit(OPEN), _role_line(block["role"]), F.lit("\n"))
        texts = F.flatten(F.transform(block["texts"], lambda t, i: F.array(segment(F.when(i == 0, head).otherwise(F.lit(MORE)), no), segment(escape(t), loss))))
        return F.concat(texts, F.array(segment(F.lit(CLOSE), no)))

    cut = merged_turns(turns).select("conv_id", F.flatten(F.transform("blocks", segments)).alias("segments"))
    return cut.select("conv_id", F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns ``(role, text)`` that a formatted conversation holds, in order and unescaped."""
    blocks = F.split(formatted, CLOSE)

    def turns(block: Column) -> Column:
        return let(F.split(block, "\n", 2), lambda parts: F.transform(F.split(parts[1], MORE), lambda t: F.struct(_role_of(F.substring(parts[0], len(OPEN) + 1, 2**31 - 1)).alias("role"), unescape(t).alias("text"))))

    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def loss_spans(chats: DataFrame) -> DataFrame:
    """``(conv_id, start, end)`` of every text under the loss mask, in code points of ``formatted``, end exclusive."""
    opened = chats.withColumn("_row", F.monotonically_increasing_id()).select("conv_id", "_row", F.posexplode("segments").alias("_at", "_s"))
    end = F.sum(F.length("_s.text")).over(W.partitionBy("_row").orderBy("_at"))
    return opened.withColumn("end", end.cast("long")).where("_s.loss").select("conv_id", (F.col("end") - F.length("_s.text")).alias("start"), "end")


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the planted one, read back from what was formatted."""
    n = F.col("id")
    planted = spark.range(2).select(F.lit(PLANTED_ID).cast("long").alias("conv_id"), n.alias("turn"), F.when(n == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_TEXT).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    read = format_chats(rows).select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP13_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(0, 2) AS r(i)),
o AS (SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, before IS NOT DISTINCT FROM role AND n > 1 AS more, regexp_replace(text, '(</?turn/?>)', '\\\1', 'g') AS body, replace(replace(role, '%', '%25'), chr(10), '%0A') AS named FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + CASE WHEN more THEN 9 ELSE 6 + length(named) + 1 + 9 END) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
