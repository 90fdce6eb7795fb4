"""Contract checks. Each gives one row: contract, status and the number of offending rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.merge import lost_ids, preserve_unselected, same_values, snapshot_diff

PASS, FAIL = "PASS", "FAIL"


def contract_row(name: str, counted: DataFrame, n_bad: Column | str = "n_bad", also: Column | None = None) -> DataFrame:
    """The row of a one-row table that has the offending number."""
    bad = F.coalesce(F.col(n_bad) if isinstance(n_bad, str) else n_bad, F.lit(0)).cast("long")
    good = bad == 0 if also is None else (bad == 0) & also
    return counted.select(F.lit(name).alias("contract"), F.when(good, PASS).otherwise(FAIL).alias("status"), bad.alias("n_bad"))


def duplicate_ids(df: DataFrame, id: str = "id") -> DataFrame:
    """Ids that occur more than once, and how often."""
    return df.groupBy(id).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def row_and_id_counts(df: DataFrame, id: str = "id") -> DataFrame:
    """One row: rows, distinct ids, ids that occur more than once, and rows without an id."""
    per_id = df.groupBy(id).agg(F.count(F.lit(1)).alias("n"))
    there = F.col(id).isNotNull()
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("final_rows"),
        F.count_if(there).alias("final_unique_ids"),
        F.count_if(there & (F.col("n") > 1)).alias("duplicate_ids"),
        F.coalesce(F.sum(F.when(~there, F.col("n"))), F.lit(0)).alias("null_ids"),
    )


def accounting(run_counts: DataFrame) -> DataFrame:
    """Selected ids are those that succeeded and those that failed."""
    return contract_row("ACCOUNTING", run_counts, F.abs(F.col("selected_count") - F.col("success_count") - F.col("failed_count")))


def acquired_something(run_counts: DataFrame) -> DataFrame:
    """Failures alone do not fail a run; a run with selected ids and no success does."""
    return contract_row("ACQUISITION", run_counts, F.when((F.col("selected_count") > 0) & (F.col("success_count") == 0), F.col("selected_count")).otherwise(0))


def run_contracts(run_counts: DataFrame) -> DataFrame:
    """ACCOUNTING and ACQUISITION from one row of counts."""
    lost = F.abs(F.col("selected_count") - F.col("success_count") - F.col("failed_count"))
    nothing = F.when((F.col("selected_count") > 0) & (F.col("success_count") == 0), F.col("selected_count")).otherwise(0)
    return _lines(run_counts, [("ACCOUNTING", lost, None), ("ACQUISITION", nothing, None)])


def no_duplicates(df: DataFrame, id: str = "id") -> DataFrame:
    return contract_row("DUPLICATES", row_and_id_counts(df, id), "duplicate_ids")


def counts_agree(df: DataFrame, id: str = "id") -> DataFrame:
    """As many rows as distinct ids, and no row without an id."""
    return contract_row("COUNTS", row_and_id_counts(df, id), F.col("final_rows") - F.col("final_unique_ids"), F.col("null_ids") == 0)


def _lines(counted: DataFrame, lines: Sequence[tuple[str, Column, Column | None]]) -> DataFrame:
    """Rows of several contracts from one one-row table: name, offending number, and what else has to hold."""
    of = lambda name, bad, also: F.struct(F.lit(name).alias("contract"), F.when((bad == 0) & (F.lit(True) if also is None else also), PASS).otherwise(FAIL).alias("status"), bad.cast("long").alias("n_bad"))
    return counted.select(F.inline(F.array(*[of(name, F.coalesce(bad, F.lit(0)), also) for name, bad, also in lines])))


def id_contracts(df: DataFrame, id: str = "id") -> DataFrame:
    """DUPLICATES and COUNTS from one aggregation on id."""
    rest = F.col("final_rows") - F.col("final_unique_ids")
    return _lines(row_and_id_counts(df, id), [("DUPLICATES", F.col("duplicate_ids"), None), ("COUNTS", rest, F.col("null_ids") == 0)])


def _metadata(df: DataFrame, name: str, n_bad: int) -> DataFrame:
    return contract_row(name, df.sparkSession.range(1), F.lit(n_bad))


def schema_contract(df: DataFrame, expected: StructType) -> DataFrame:
    """Names and their order are the expected ones. Decided from metadata: no rows are read."""
    names, wanted = df.columns, expected.names
    return _metadata(df, "SCHEMA", sum(a != b for a, b in zip(names, wanted, strict=False)) + abs(len(names) - len(wanted)))


def type_contract(df: DataFrame, expected: StructType, unread: DataFrame | None = None) -> DataFrame:
    """Types are the expected ones, and no value became null on the way to its type (``unread`` of coerce_types)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wrong = sum(kinds.get(f.name) != f.dataType for f in expected.fields)
    if unread is None or not unread.columns:
        return _metadata(df, "TYPE", wrong)
    return contract_row("TYPE", unread, reduce(lambda a, b: a + b, [F.col(c) for c in unread.columns]) + wrong)


def metadata_contracts(df: DataFrame, expected: StructType) -> DataFrame:
    """SCHEMA and TYPE from metadata: no rows are read."""
    names, wanted, kinds = df.columns, expected.names, {f.name: f.dataType for f in df.schema.fields}
    order = sum(a != b for a, b in zip(names, wanted, strict=False)) + abs(len(names) - len(wanted))
    return _lines(df.sparkSession.range(1), [("SCHEMA", F.lit(order), None), ("TYPE", F.lit(sum(kinds.get(f.name) != f.dataType for f in expected.fields)), None)])


def non_shrink(master: DataFrame, candidate: DataFrame, id: str = "id") -> DataFrame:
    """No published id is lost, and there are as many rows as before or more."""
    rows = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    counted = rows(lost_ids(master, candidate, id), "n_bad").crossJoin(rows(master, "_before")).crossJoin(rows(candidate, "_after"))
    return contract_row("MASTER_NON_SHRINK", counted, "n_bad", F.col("_after") >= F.col("_before"))


def _kept(name: str, expected: DataFrame, candidate: DataFrame, columns: Sequence[str], id: str) -> DataFrame:
    diff = snapshot_diff(expected, candidate.join(expected.select(id), id, "left_semi"), columns, id)
    return contract_row(name, diff.agg(F.count_if(F.col("change") != "same").alias("n_bad")))


def unselected_preserved(master: DataFrame, selected: DataFrame, candidate: DataFrame, columns: Sequence[str], id: str = "id") -> DataFrame:
    """Every unselected prior row is in the candidate as it was; leave the sync stamp out of ``columns``."""
    return _kept("UNSELECTED_PRESERVATION", preserve_unselected(master, selected, id), candidate, columns, id)


def last_good_carried(carried: DataFrame, candidate: DataFrame, columns: Sequence[str], id: str = "id") -> DataFrame:
    """Every failed id with a prior row has that row."""
    return _kept("LAST_GOOD", carried, candidate, columns, id)


def semantic(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Every predicate holds on every row, in one pass; one that is null does not hold."""
    failed = [F.count_if(~F.coalesce(p, F.lit(False))) for p in predicates.values()]
    return contract_row("SEMANTIC_VALIDATION", df.agg(reduce(lambda a, b: a + b, failed, F.lit(0)).alias("n_bad")))


def missing_not_zero(before: DataFrame, after: DataFrame, columns: Sequence[str], id: str = "id") -> DataFrame:
    """No value that was missing has become 0."""
    was = before.select(id, *[F.col(c).alias(f"_was_{c}") for c in columns])
    bad = [F.count_if(F.col(f"_was_{c}").isNull() & F.coalesce(F.col(c) == 0, F.lit(False))) for c in columns]
    return contract_row("MISSING_NOT_ZERO", after.join(was, id).agg(reduce(lambda a, b: a + b, bad).alias("n_bad")))


def _met(master: DataFrame, run: DataFrame, candidate: DataFrame, columns: Sequence[str], id: str, success: str, flags: Mapping[str, Column] | None = None) -> DataFrame:
    """A row an id from one aggregation over the three tables: how often it is in each, its values, and how many of its candidate rows have each flag."""
    none = F.lit(None).cast("long")
    flags = flags or {}

    def side(df: DataFrame, mark: str, ok: Column) -> DataFrame:
        own = [F.coalesce(c, F.lit(True)).alias(f"_f_{name}") if mark == "c" else F.lit(False).alias(f"_f_{name}") for name, c in flags.items()]
        return df.select(id, F.lit(mark).alias("_side"), F.struct(*columns).alias("_v"), ok.alias("_ok"), *own)

    rows = side(master, "m", none).unionByName(side(run, "r", F.col(success).cast("long"))).unionByName(side(candidate, "c", none))
    on = lambda mark, c="_v": F.when(F.col("_side") == mark, F.col(c))
    count = lambda mark: F.count_if(F.col("_side") == mark).alias(f"_n{mark}")
    return rows.groupBy(id).agg(
        count("m"), count("r"), count("c"), F.max(on("m")).alias("_m"), F.max(on("r")).alias("_r"), F.max(on("r", "_ok")).alias("_ok"), F.min(on("c")).alias("_lo"), F.max(on("c")).alias("_hi"),
        *[F.count_if(f"_f_{name}").alias(f"_f_{name}") for name in flags],
    )


def _departures(columns: Sequence[str], measured: Sequence[str]) -> tuple[Column, Column, Column, list[Column]]:
    """Of a row of _met: whether its id was lost, changed though unselected, not carried though failed, and, by measure, became 0 where it is missing."""
    had, ran, there = (F.col(c) > 0 for c in ("_nm", "_nr", "_nc"))
    same = there & same_values(columns, "_m", "_lo") & same_values(columns, "_m", "_hi")
    failed = ran & (F.col("_ok") == 0)
    zero = lambda c: F.coalesce(F.col(f"_lo.{c}") == 0, F.lit(False)) | F.coalesce(F.col(f"_hi.{c}") == 0, F.lit(False))
    return had & ~there, had & ~ran & ~same, had & failed & ~same, [ran & ~failed & F.col(f"_r.{c}").isNull() & zero(c) for c in measured]


def kept_contracts(master: DataFrame, run: DataFrame, candidate: DataFrame, columns: Sequence[str], measured: Sequence[str], id: str = "id", success: str = "n_success") -> DataFrame:
    """Four contracts at the cost of one: MASTER_NON_SHRINK, UNSELECTED_PRESERVATION, LAST_GOOD and MISSING_NOT_ZERO.

    The three tables are one union with a mark of its side, and meet in one aggregation on id, where the single contracts would join them
    pair by pair. Numbers are of ids: where a candidate repeats an id, its least and its greatest row must both be as they should.
    """
    met = _met(master, run, candidate, columns, id, success)
    lost, changed, not_carried, zeroed = _departures(columns, measured)
    counted = met.agg(
        F.count_if(lost).alias("lost"), F.count_if(changed).alias("changed"), F.count_if(not_carried).alias("not_carried"),
        reduce(lambda a, b: a + b, map(F.count_if, zeroed), F.lit(0)).alias("zeroed"), F.sum("_nm").alias("before"), F.sum("_nc").alias("after"),
    )
    grown = F.coalesce(F.col("after") >= F.col("before"), F.lit(True))
    return _lines(counted, [("MASTER_NON_SHRINK", F.col("lost"), grown), ("UNSELECTED_PRESERVATION", F.col("changed"), None), ("LAST_GOOD", F.col("not_carried"), None), ("MISSING_NOT_ZERO", F.col("zeroed"), None)])


def row_contracts(df: DataFrame, predicates: Mapping[str, Column], stamp: str) -> DataFrame:
    """SEMANTIC_VALIDATION and UNIFORM_STAMP from one pass over the rows."""
    failed = [F.count_if(~F.coalesce(p, F.lit(False))) for p in predicates.values()]
    late = F.count_if(F.col(stamp).isNull()) + F.when(F.min(stamp) != F.max(stamp), 1).otherwise(0)
    counted = df.agg(reduce(lambda a, b: a + b, failed, F.lit(0)).alias("rules"), late.alias("late"))
    return _lines(counted, [("SEMANTIC_VALIDATION", F.col("rules"), None), ("UNIFORM_STAMP", F.col("late"), None)])


def offenders(
    master: DataFrame, run: DataFrame, candidate: DataFrame, columns: Sequence[str], measured: Sequence[str], predicates: Mapping[str, Column], stamp: str | None = None, id: str = "id", success: str = "n_success"
) -> DataFrame:
    """``(contract, id)``: which ids make a contract over a candidate fail, each once a contract, from one aggregation on id.

    A late stamp is one that is not the table's earliest. Rows without an id have nothing to be traced by, and are left to COUNTS.
    """
    rules = reduce(lambda a, b: a | b, [~F.coalesce(p, F.lit(False)) for p in predicates.values()], F.lit(False))
    if stamp:
        least = candidate.agg(F.min(stamp).alias("_least"))
        candidate = candidate.crossJoin(F.broadcast(least))
    late = (F.col(stamp).isNull() | (F.col(stamp) != F.col("_least"))) if stamp else F.lit(False)
    met = _met(master, run, candidate, columns, id, success, {"rules": rules, "late": late}).where(F.col(id).isNotNull())
    lost, changed, not_carried, zeroed = _departures(columns, measured)
    named = {
        "MASTER_NON_SHRINK": lost, "UNSELECTED_PRESERVATION": changed, "LAST_GOOD": not_carried, "MISSING_NOT_ZERO": reduce(lambda a, b: a | b, zeroed, F.lit(False)),
        "DUPLICATES": F.col("_nc") > 1, "SEMANTIC_VALIDATION": F.col("_f_rules") > 0, "UNIFORM_STAMP": F.col("_f_late") > 0,
    }
    return met.select(id, F.explode(F.array_compact(F.array(*[F.when(c, name) for name, c in named.items()]))).alias("contract")).select("contract", id)


def samples(offending: DataFrame, k: int = 5, id: str = "id") -> DataFrame:
    """``(contract, n_ids, sample)``: how many ids offend, and the k of them with the smallest MD5, so that reruns and other engines name the same.

    Each task keeps the k first of every contract before anything is shuffled, however many offend. Give a written table: it is read twice.
    """
    first = W.partitionBy("contract").orderBy(F.md5(F.col(id).cast("string")), id)
    few = offending.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= k)
    sample = few.groupBy("contract").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", id))), lambda x: x[id]).alias("sample"))
    return offending.groupBy("contract").agg(F.count(F.lit(1)).alias("n_ids")).join(sample, "contract")


def uniform_stamp(df: DataFrame, column: str = "synced_at") -> DataFrame:
    """One sync time, on every row."""
    least, most = F.min(column), F.max(column)
    bad = F.count_if(F.col(column).isNull()) + F.when(least != most, 1).otherwise(0)
    return contract_row("UNIFORM_STAMP", df.agg(bad.alias("n_bad")))


def same_id_set(a: DataFrame, b: DataFrame, id: str = "id") -> DataFrame:
    """Both tables have the same set of ids."""
    both = a.select(id).subtract(b.select(id)).union(b.select(id).subtract(a.select(id)))
    return contract_row("ID_SET", both.agg(F.count(F.lit(1)).alias("n_bad")))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both tables have the same rows, as often: one aggregation, in which a row's occurrences in b take off those in a."""
    both = a.withColumn("_side", F.lit(1)).union(b.select(*a.columns).withColumn("_side", F.lit(-1)))
    left = both.groupBy(*a.columns).agg(F.sum("_side").alias("_left")).where("_left <> 0")
    return contract_row("READBACK", left.agg(F.sum(F.abs("_left")).alias("n_bad")))


def _fingerprint(df: DataFrame, columns: Sequence[str] | None) -> tuple[Column, Column]:
    """The hash skips nulls, so a flag goes beside each value: (null, 1) and (1, null) differ."""
    parts = [x for c in columns or sorted(df.columns) for x in (F.col(c).isNull(), F.col(c))]
    return F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*parts).cast("decimal(38,0)")).alias("checksum")


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of rows, and a checksum of their content that no repartitioning changes."""
    return df.agg(*_fingerprint(df, columns))


def fingerprinted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its fingerprint taken as it is written; what reads back can be held against that without the rows being made or shuffled again."""
    seen = Observation(name)
    return df.observe(seen, *_fingerprint(df, None)), seen


def reads_as_written(name: str, written: Observation, read: DataFrame) -> DataFrame:
    """A contract that a table reads with the fingerprint that it was written with; 1 is the number of tables that do not. One pass, no shuffle of rows."""
    was = written.get
    same = [F.col(c).eqNullSafe(F.lit(was.get(c)).cast(kind)) for c, kind in (("n_rows", "bigint"), ("checksum", "decimal(38,0)"))]
    return _lines(fingerprint(read), [(name, F.when(same[0] & same[1], 0).otherwise(1), None)])


def all_contracts(*rows: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def final_status(contracts: DataFrame) -> DataFrame:
    """One row: PASS if all contracts pass."""
    return contracts.agg(F.when(F.count_if(F.col("status") != PASS) > 0, FAIL).otherwise(PASS).alias("final_status"), F.count_if(F.col("status") != PASS).alias("n_failed"))


def require(contracts: DataFrame, stage: str) -> None:
    """Raises where a contract fails, naming the stage and the contracts; there is one row a contract."""
    failed = [f"{r['contract']} ({r['n_bad']})" for r in contracts.where(F.col("status") != PASS).orderBy("contract").collect()]
    if failed:
        raise RuntimeError(f"contract failed at {stage}: {', '.join(failed)}")
