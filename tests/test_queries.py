"""Every core query against its SQL at sf0.01, and the fixture's known numbers."""

from pathlib import Path

import duckdb
import pytest

from tidemark.plans import operations, registry  # noqa: F401  operations registers queries too

SF = Path("/root/testdata/sf0.01")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def normal(v):
    if isinstance(v, list):
        return tuple(map(normal, v))
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, str(SF))
    con = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in con.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted((tuple(normal(v) for v in r) for r in con.fetchall()), key=repr)
    got = sorted((tuple(normal(v) for v in r) for r in df.select(*names).collect()), key=repr)
    assert got == want


@pytest.mark.parametrize(("sf", "counts"), [("sf0.001", (15, 10, 9, 1, 5)), ("sf0.01", (174, 110, 97, 13, 40))])
def test_known_numbers(spark, sf, counts):
    d = f"/root/testdata/{sf}"
    c = registry.QUERIES["q01_run_counts"](spark, d).first()
    unselected = registry.QUERIES["q12_unselected"](spark, d).count()
    assert (c["http_request_count"], c["selected_count"], c["success_count"], c["failed_count"], unselected) == counts


def test_candidate_is_one_join_without_python(spark):
    plan = registry.QUERIES["q10_candidate"](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "Python" not in plan and "PushedFilters" in plan


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 15
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.queries())
