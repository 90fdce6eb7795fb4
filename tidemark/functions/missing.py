"""Measures that keep a missing value apart from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_or_missing(value: Column, where: Column) -> Column:
    """The sum over rows where the condition holds; null where none does."""
    return F.sum(F.when(where, value))
