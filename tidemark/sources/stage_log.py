"""A run's stages, timed and logged as they end, failing ones too."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import sanitize
from tidemark.operators.contracts import FAIL, PASS

LOG_SCHEMA = "run_id string, stage string, n_rows bigint, n_bad bigint, elapsed_seconds double, status string, error string"
MOST_CHARS = 300


def error_text(error: BaseException) -> str:
    """What of an error a log may hold, before it is sanitized: its class, and Spark's name of the condition or the first line without what is quoted.

    Messages of Spark's own errors quote the values that they are about, so none of their text is kept.
    """
    name = type(error).__name__
    if isinstance(error, Py4JJavaError):
        return f"{name} [{error.java_exception.getClass().getName()}]"
    if isinstance(error, PySparkException):
        return f"{name} [{error.getCondition()}]" if error.getCondition() else name
    line = (str(error).splitlines() or [""])[0]
    return f"{name}: {re.sub(r'''(["'`]).*?(?:\\1|$)''', '[removed]', line)[:MOST_CHARS]}" if line else name


@dataclass
class Stage:
    """What a running stage counts."""

    name: str
    seen: list[Observation] = field(default_factory=list)

    def watch(self, df: DataFrame, valid: Column | None = None) -> DataFrame:
        """``df`` with its rows, and those for which ``valid`` does not hold, counted as it is written. The stage has to write it, once."""
        seen = Observation()
        self.seen.append(seen)
        bad = F.lit(False) if valid is None else ~F.coalesce(valid, F.lit(False))
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_bad"))

    def counted(self, what: str) -> int | None:
        return sum(s.get.get(what) or 0 for s in self.seen) if self.seen else None


class StageLog:
    """The stage log of one run under ``path``: a row a stage, appended when the stage ends, so that a run that dies has logged what it did."""

    def __init__(self, spark: SparkSession, run_id: str, path: str, clock: Callable[[], float] = time.monotonic):
        self.spark, self.run_id, self.path, self.clock = spark, run_id, path, clock

    def _append(self, stage: str, n_rows: int | None, n_bad: int | None, elapsed: float, status: str, error: str | None) -> None:
        row = self.spark.createDataFrame([(self.run_id, stage, n_rows, n_bad, float(elapsed), status, error)], LOG_SCHEMA)
        row.withColumn("error", sanitize(F.col("error"))).coalesce(1).write.mode("append").parquet(self.path)

    @contextmanager
    def stage(self, name: str) -> Iterator[Stage]:
        """Times what stands inside and logs it. An error is logged, sanitized and without counts, and goes on up: a failing stage ends the run visibly."""
        stage, began = Stage(name), self.clock()
        try:
            yield stage
        except Exception as e:
            try:
                self._append(name, None, None, self.clock() - began, FAIL, error_text(e))
            except Exception as also:
                e.add_note(f"the stage log could not be written: {type(also).__name__}")
            raise
        elapsed = self.clock() - began
        self._append(name, stage.counted("n_rows"), stage.counted("n_bad"), elapsed, PASS, None)

    def read(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)
