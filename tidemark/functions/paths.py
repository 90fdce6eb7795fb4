"""Rules on file paths, as columns. Paths are relative and divided by slashes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names, endings and directories that have no place in a public repository.
BASENAMES = (".env", "credentials.json", "service-account.json", "service_account.json")
SUFFIXES = (".pem", ".key", ".p12", ".pfx", ".sqlite", ".sqlite3", ".db", ".xlsx", ".xls", ".parquet", ".ndjson", ".jsonl")
DIRECTORIES = ("artifacts", "backups", "snapshots", "outputs", "output", "logs", "cache")
EXEMPT = ".env.example"


def path_parts(path: Column) -> Column:
    """Directories of a path, without its last name; case is kept."""
    parts = F.split(path, "/")
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def base_name(path: Column) -> Column:
    """The last name, in lower case."""
    return F.lower(F.element_at(F.split(path, "/"), -1))


def suffix(path: Column) -> Column:
    """The last extension, in lower case; a name that begins with its only dot has none."""
    return F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"(?s)^.+(\.[^.]+)\z", 1))


def is_exempt(path: Column, exempt: str = EXEMPT) -> Column:
    """Exactly this path, at the root."""
    return path == F.lit(exempt)


def bad_basename(path: Column, names: Iterable[str] = BASENAMES) -> Column:
    return base_name(path).isin(list(names))


def bad_suffix(path: Column, suffixes: Iterable[str] = SUFFIXES) -> Column:
    return suffix(path).isin(list(suffixes))


def bad_directory(path: Column, directories: Iterable[str] = DIRECTORIES) -> Column:
    """Any directory of the path is one of these; unlike names and endings, case counts."""
    return F.arrays_overlap(path_parts(path), F.array(*[F.lit(d) for d in directories]))


def exempt_guard(path: Column, rule: Column, exempt: str = EXEMPT) -> Column:
    """A path rule, switched off on the exempt path. Content rules take no part in this."""
    return ~is_exempt(path, exempt) & rule
