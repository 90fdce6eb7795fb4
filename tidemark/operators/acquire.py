"""From the attempts of one run to one measured row per id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StructField, StructType, TimestampNTZType, TimestampType


def select_ids(attempts: DataFrame, id: str = "id", where: Column | None = None) -> DataFrame:
    """The ids to refresh, from data: those with an attempt, or those of any table that meet a predicate."""
    return (attempts if where is None else attempts.where(where)).select(id).distinct()


def attempts_per_id(attempts: DataFrame, id: str = "id", ok: str = "ok") -> DataFrame:
    """Attempts, successes and failures of each id."""
    return attempts.groupBy(id).agg(F.count(F.lit(1)).alias("n_attempts"), F.count_if(ok).alias("n_success"), F.count_if(~F.col(ok)).alias("n_failed"))


def run_counts(per_id: DataFrame) -> DataFrame:
    """One row: ids selected, refreshed and failed, and requests made. An id fails if none of its attempts succeeded."""
    return per_id.agg(
        F.count(F.lit(1)).alias("selected_count"),
        F.count_if(F.col("n_success") > 0).alias("success_count"),
        F.count_if(F.col("n_success") == 0).alias("failed_count"),
        F.coalesce(F.sum("n_attempts"), F.lit(0)).alias("http_request_count"),
    )


def latest_good(attempts: DataFrame, id: str = "id", ok: str = "ok", ts: str = "ts", attempt_id: str = "attempt_id") -> DataFrame:
    """The newest successful attempt of each id; ties go to the higher attempt_id."""
    newest = W.partitionBy(id).orderBy(F.desc(ts), F.desc(attempt_id))
    return attempts.where(ok).withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def measure(attempts: DataFrame, metrics: Mapping[str, Column], id: str = "id", ok: str = "ok", ts: str = "ts", attempt_id: str = "attempt_id", last: Mapping[str, str] | None = None) -> DataFrame:
    """A row per id in one aggregation: its attempts and successes, the ``metrics``, and columns of its newest success.

    ``metrics`` are aggregates that see all attempts; ``last`` names columns taken from the row that latest_good would
    keep. An id without a success has nulls there.
    """
    newest = lambda c: F.max_by(c, F.when(F.col(ok), F.struct(ts, attempt_id)))
    return attempts.groupBy(id).agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.count_if(ok).alias("n_success"),
        *[c.alias(name) for name, c in metrics.items()],
        *[newest(c).alias(name) for name, c in (last or {}).items()],
    )


def _read(field: StructField, formats: Mapping[str, str]) -> Column:
    if field.name in formats and isinstance(field.dataType, DateType):
        return F.try_to_date(field.name, formats[field.name])
    if field.name in formats and isinstance(field.dataType, (TimestampType, TimestampNTZType)):
        return F.try_to_timestamp(F.col(field.name), F.lit(formats[field.name])).cast(field.dataType)
    return F.col(field.name).try_cast(field.dataType)


def coerce_types(df: DataFrame, schema: StructType, formats: Mapping[str, str] | None = None) -> DataFrame:
    """Columns in their physical types. Text that does not read as its type becomes null, and unread() counts it; a column that is missing is null."""
    return df.select(*[(_read(f, formats or {}) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def unread(df: DataFrame, schema: StructType, formats: Mapping[str, str] | None = None) -> DataFrame:
    """One row: per column, how many non-null values coerce_types cannot read."""
    fields = [f for f in schema.fields if f.name in df.columns]
    return df.agg(*[F.count_if(F.col(f.name).isNotNull() & _read(f, formats or {}).isNull()).alias(f.name) for f in fields])


# Why a value has no place in its column; never the value itself.
MISSING, NOT_A_NUMBER, OUT_OF_RANGE, NOT_IN_FORMAT, NO_SUCH_DATE, NOT_A_BOOLEAN, UNREADABLE = "missing", "not a number", "out of range", "not in the format", "no such date", "not a boolean", "unreadable"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _reason(field: StructField, formats: Mapping[str, str]) -> Column:
    """Why a value does not read as its type."""
    text = F.col(field.name).cast("string")
    if isinstance(field.dataType, NumericType):
        return F.when(text.rlike(_NUMBER), OUT_OF_RANGE).otherwise(NOT_A_NUMBER)
    if isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
        form = formats.get(field.name, "yyyy-MM-dd" if isinstance(field.dataType, DateType) else "yyyy-MM-dd HH:mm:ss")
        # A format's letters stand for digits, anything else for itself.
        shape = "".join(r"\d" if c.isalpha() else r"\x{%x}" % ord(c) for c in form)
        return F.when(text.rlike(f"^{shape}$"), NO_SUCH_DATE).otherwise(NOT_IN_FORMAT)
    return F.lit(NOT_A_BOOLEAN if isinstance(field.dataType, BooleanType) else UNREADABLE)


def coerce_or_reject(df: DataFrame, schema: StructType, keys: tuple[str, ...], formats: Mapping[str, str] | None = None) -> DataFrame:
    """coerce_types with ``problems (column, reason)`` beside: empty for a row that has its types, and all that is wrong with one that has not.

    A value that does not read as its type is a problem, and so is a null in a field that may hold none. A rejected row keeps its ``keys``, as far as they
    read, and no other value. One pass over the rows, none of which is dropped.
    """
    formats = formats or {}
    there = [f for f in schema.fields if f.name in df.columns]
    wrong = lambda f: F.col(f.name).isNotNull() & _read(f, formats).isNull()
    problem = lambda f, reason: F.struct(F.lit(f.name).alias("column"), reason.alias("reason"))
    found = [F.when(wrong(f), problem(f, _reason(f, formats))) for f in there]
    found += [F.when(F.col(f.name).isNull() if f in there else F.lit(True), problem(f, F.lit(MISSING))) for f in schema.fields if not f.nullable]
    problems = F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<column:string,reason:string>>")
    read = lambda f: _read(f, formats) if f in there else F.lit(None).cast(f.dataType)
    rows = df.withColumn("_problems", problems)
    good = F.size("_problems") == 0
    return rows.select(*[(read(f) if f.name in keys else F.when(good, read(f))).alias(f.name) for f in schema.fields], F.col("_problems").alias("problems"))


def quarantined(rejected: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """A row a problem: the keys, column and reason."""
    return rejected.select(*keys, F.explode("problems").alias("_p")).select(*keys, F.col("_p.column").alias("column"), F.col("_p.reason").alias("reason"))


def rejections(rejected: DataFrame) -> DataFrame:
    """How many values of each column were rejected for each reason."""
    return quarantined(rejected, ()).groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n"))
