import posixpath
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import paths, text
from tidemark.operators import scan
from tidemark.sources.tables import scan_corpus

SECRET = b'password = "hunter2222"'
FILES = [
    ("a/nul.txt", b"\0" + SECRET), ("a/latin.txt", b"\xff" + SECRET), ("a/edge.txt", SECRET.ljust(2_000_000)), ("a/over.txt", SECRET.ljust(2_000_001)),
    ("a/none.txt", None), ("a/empty.txt", b""), (".env.example", SECRET), ("a/.env.example", b"x"), ("a/two.txt", SECRET + b" ghp_" + b"a" * 30),
    (".env", b"x"), ("logs/K.PEM", SECRET), ("Logs/y.txt", b"x"), ("cfg/Credentials.JSON", b"x"), ("logs", b"x"), ("", SECRET),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return scan_corpus(spark.createDataFrame(FILES, "path string, content binary"))


def found(df):
    return {(r["path"], r["rule"].split()[1]) for r in df.collect()}


def test_violations(corpus):
    rows = scan.violations(corpus).collect()
    assert sorted((r["path"], r["rule"]) for r in rows) == sorted([
        ("a/edge.txt", "possible secret pattern"), (".env.example", "possible secret pattern"), ("a/two.txt", "possible secret pattern"), (".env", "forbidden filename"),
        ("logs/K.PEM", "forbidden artifact type"), ("logs/K.PEM", "forbidden runtime-artifact directory"), ("logs/K.PEM", "possible secret pattern"), ("cfg/Credentials.JSON", "forbidden filename"),
    ])


def test_exemption_is_for_the_root_path_and_path_rules_only(corpus):
    rules = scan.Rules(suffixes=(*paths.SUFFIXES, ".example"))
    hit = {(r["path"], r["rule"]) for r in scan.violations(corpus, rules).collect()}
    assert ("a/.env.example", "forbidden artifact type") in hit and (".env.example", "forbidden artifact type") not in hit
    assert (".env.example", "possible secret pattern") in hit


def test_skipped_contents_are_counted(corpus):
    assert scan.skipped(corpus).first().asDict() == {"unreadable": 1, "too_large": 1, "binary": 1, "not_utf8": 1}


def test_report_and_verdict(corpus):
    v = scan.violations(corpus)
    messages = [r["message"] for r in scan.sorted_report(v.unionByName(v)).collect()]
    assert messages == sorted(set(messages)) and len(messages) == 8 and not any("hunter" in m for m in messages)
    assert tuple(scan.verdict(v).first()) == ("FAIL", 1, 8)
    assert tuple(scan.verdict(v.limit(0)).first()) == ("PASS", 0, 0)


TEXTS = [
    "-----BEGIN PRIVATE KEY-----", "-----BEGIN OPENSSH PRIVATE KEY-----", "-----BEGIN DSA PRIVATE KEY-----", "gho_" + "a" * 30, "gho_" + "a" * 29, "xgho_" + "a" * 30,
    "égho_" + "a" * 30, "github_pat_" + "b" * 20, "github_pat_" + "b" * 19, "AIza" + "c" * 30, "AIza" + "c" * 29, "ACCESS-TOKEN = '12345678\"", "paſſword: '12345678'",
    "api_key = '1234\n5678'", "refresh_token: \"1234567\"", "apikey='abcdefgh'", "tokens = 'abcdefgh'", None, "",
]
PATTERNS = [re.compile(p.replace("(?iuU)", "(?i)")) for p in text.SECRETS]


def test_each_pattern_agrees_with_plain_regular_expressions(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r["i"]: tuple(r)[1:] for r in df.select("i", *[F.col("t").rlike(p).alias(str(k)) for k, p in enumerate(text.SECRETS)], text.any_pattern(F.col("t")).alias("any")).collect()}
    for i, t in enumerate(TEXTS):
        want = [None if t is None else bool(p.search(t)) for p in PATTERNS]
        assert got[i] == (*want, any(want)), t
    assert [r["i"] for r in scan.scan_table(df, "i", "t").orderBy("i").collect()] == [i for i, t in enumerate(TEXTS) if t and any(p.search(t) for p in PATTERNS)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("aB.é/ _-", min_size=1, max_size=12).filter(lambda s: all(p not in ("", ".", "..") for p in s.split("/"))), min_size=30, max_size=60))
def test_paths_agree_with_plain_splitting(spark, names):
    p = F.col("p")
    rows = spark.createDataFrame([(n,) for n in names], "p string").select("p", paths.path_parts(p).alias("parts"), paths.base_name(p).alias("base"), paths.suffix(p).alias("suffix")).collect()
    for r in rows:
        *parts, last = r["p"].split("/")
        stem, dot, end = last.rpartition(".")
        assert r["parts"] == parts and r["base"] == posixpath.basename(r["p"]).lower()
        assert r["suffix"] == ((dot + end).lower() if stem and end else "")


def test_sanitize_links_and_ids(spark):
    raw = "GET https://h.example/a?key=1 failed\nAuthorization: Bearer abcdefgh1\nSet-Cookie: a=b\npassword = \"x y\" token=abc, n=3"
    df = spark.createDataFrame([(raw, "see https://a.example/b, (http://c.example)", "x /d/abc123 /d/zz y")], "e string, t string, r string")
    r = df.select(text.sanitize(F.col("e")).alias("e"), text.find_links(F.col("t")).alias("t"), text.find_resource_ids(F.col("r"), ["/d/[a-z0-9]+"]).alias("r")).first()
    assert r["e"] == "GET https://h.example/a?[removed] failed\nAuthorization: [removed]\nSet-Cookie: [removed]\npassword = [removed] token=[removed], n=3"
    assert r["t"] == ["https://a.example/b,", "http://c.example"] and r["r"] == ["/d/abc123", "/d/zz"]


def test_no_python_on_the_executors(corpus):
    plan = scan.violations(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
