"""Licence scans, top-k search, decontamination, the Jaccard join, toxicity, mixing and the pipeline."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import components, decontaminate, entries, jaccard_join, language_id, licenses, mixing, topk, toxicity
from tidemark.llm.common import Scratch, drawn, hash_bound, ship

DOCS = "doc_id bigint, text string"
SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_queries_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in entries.ORACLES.items():
        df = entries.QUERIES[name](spark, SF)
        got = con.execute(sql)
        columns = [c[0] for c in got.description]
        assert sorted(map(tuple, df.select(*columns).collect())) == sorted(got.fetchall()), name


def test_licences_of_planted_lines(spark):
    texts = {1: "a b\nReleased under the MIT License.\nc", 2: "Licensed under CC BY-NC 4.0.", 3: "licensed under the road of the work", 4: None, 5: "", 6: "This work is licensed under the GNU General Public License, version 3.\r\nLicensed under the Apache License, Version 2.0", 7: "the license of license under a permission " * 20_000}
    corpus = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = licenses.fit(corpus)
    df = spark.createDataFrame([*texts.items(), (2, texts[2])], DOCS).withColumn("family", F.lit("clash"))
    got = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in licenses.find_licenses(df, model).collect())
    assert got == [(1, 1, "MIT"), (2, 0, "CC-BY-NC"), (2, 0, "CC-BY-NC"), (6, 0, "GPL"), (6, 1, "Apache-2.0")]
    assert licenses.find_licenses(df.limit(0), model).count() == 0
    wanted = {"This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    want = {(r["doc_id"], i, wanted[line]) for r in corpus.collect() for i, line in enumerate(r["text"].split("\n")) if line in wanted}
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in licenses.find_licenses(corpus, model).collect()} == want


def test_licences_of_wrapped_notices(spark):
    model = licenses.fit(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    mit = "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software and\nassociated documentation files (the \"Software\"), to deal\nin the Software without restriction"
    gpl = "# This program is free software: you can redistribute it\n# and/or modify it under the terms of the GNU\n# General Public License as published by\n# the Free Software Foundation, either version 3"
    apache = " * Unless required by applicable law or agreed to\r\n * in writing, software distributed under the\r\n * License is distributed on an \"AS\r\n * IS\" BASIS, WITHOUT WARRANTIES"
    code = "".join(f"the value of x{i} is set to one of the values in a list\n" for i in range(60))
    texts = {1: bsd, 2: f"a b\n\n{mit}\n\nc d", 3: f"#\n{gpl}\n#\n# x", 4: apache, 5: f"{code}{bsd}\n{code}", 6: f"{bsd}\n{mit}", 7: code, 8: f"Released under the MIT License\n{bsd}"}
    texts |= {9: bsd.replace("\n", "\n\n"), 10: f"\n\n \n{bsd}"}
    got = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in licenses.find_licenses(spark.createDataFrame(list(texts.items()), DOCS), model).collect())
    assert got == [(1, 0, "BSD"), (2, 2, "MIT"), (3, 1, "GPL"), (4, 0, "Apache-2.0"), (5, 60, "BSD"), (6, 0, "BSD"), (6, 3, "MIT"), (8, 0, "MIT"), (8, 1, "BSD"), (10, 3, "BSD")]


HEADERS = {
    "BSD": "/*\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:\n */",
    "GPL": "// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU General Public License as published by\n// the Free Software Foundation, either version 3 of the License, or\n// (at your option) any later version.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction",
    "Apache-2.0": "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at",
    "LGPL": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary",
}


def test_licences_of_seven_usual_headers_and_none_of_their_fragments(spark):
    model = licenses.fit(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    texts = [*HEADERS.values(), *(f"code before\n\n{t}\n\ncode behind" for t in HEADERS.values())]
    fragments = [" ".join(t.split()[k : k + 6]) for t in HEADERS.values() for k in (8, 14)]
    rows = list(enumerate([*texts, *fragments, "the software is free of charge to any person", "all copies of the book are in the library", "public license plates of the road"]))
    found = licenses.find_licenses(spark.createDataFrame(rows, DOCS), model).collect()
    names = [*HEADERS, *HEADERS]
    assert {(r["doc_id"], r["family"]) for r in found if r["doc_id"] < 14} >= set(enumerate(names))
    assert not [r for r in found if r["doc_id"] >= 14] and all(0.5 <= r["probability"] <= 1 for r in found)


def test_licence_probabilities_are_calibrated_on_what_training_has_not_seen(spark):
    """Held-back parts of templates: two fifths are no licence, four fifths are."""
    model = licenses.fit(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    weights, grams = dict(model.weights), [r["grams"] for r in licenses.templates(spark).collect() if len(r["grams"]) >= 5]
    score = lambda g: [float(sum(weights[x][i] for x in g)) for i in range(len(model.families))]
    rows = [(label, score(licenses._parts(g, kept))) for g in grams for label, parts in ((1, licenses.LICENSED[3:]), (0, licenses.UNLICENSED[3:])) for kept in parts] + [(0, score([]))] * 1000
    df = spark.createDataFrame(rows, "label int, scores array<double>")
    p = [(r["label"], r["p"]) for r in df.select("label", model.calibrated(model.probabilities(F.col("scores"))[0]).alias("p")).collect()]
    assert abs(np.mean([x for _, x in p]) - np.mean([y for y, _ in p])) < 0.05
    assert np.mean([x >= 0.5 for y, x in p if y]) > 0.8 and np.mean([x >= 0.5 for y, x in p if not y]) < 0.02


def test_licence_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    plan = licenses.find_licenses(docs, licenses.fit(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_topk_against_all_products(spark):
    rnd = np.random.RandomState(4)
    rows = [(i, rnd.randn(6).astype("float32").tolist(), "x") for i in range(400)]
    rows += [(i, [0.5] * 6, "x") for i in range(400, 480)] + [(450, [0.5] * 6, "x")]  # one common vector, an id twice
    rows += [(500, None, "x"), (550, [1.0, None], "x"), (600, [float("nan")] * 6, "x"), (650, [float("inf")] * 6, "x"), (None, [9.0] * 6, "x"), (700, [], "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string")
    v = Scratch(spark).table(topk.quantised(df), "v")
    for pivots, block, asked in ((8, 50, 3), (64, 4096, 4096), (1, 100, 2)):
        got = sorted(map(tuple, topk.top_k(v, v.where("vec_id % 50 = 0"), pivots=pivots, block_rows=block, query_rows=asked).select("query_id", "rank", "vec_id", "score").collect()))
        held = [(i, x, np.floor(256 * np.array(e, float)).astype(int)) for i, (x, e, _) in enumerate(rows) if x is not None and e and all(c is not None and np.isfinite(c) for c in e)]
        want = []
        for i, q, e in held:
            if q % 50 == 0:
                best = sorted((-int(e @ o), y) for j, y, o in held if j != i)[:5]
                want += [(q, r + 1, y, -s) for r, (s, y) in enumerate(best)]
        assert got == sorted(want)
    few = Scratch(spark).table(topk.quantised(df.where("vec_id in (0, 1)")), "few")
    assert topk.top_k(few, few.where("vec_id = 0")).count() == 1
    assert topk.top_k(few.limit(0), few.limit(0)).count() == 0


def test_topk_sends_only_rows_within_reach(spark):
    rnd = np.random.RandomState(8)
    centres = rnd.randn(40, 12) * 6
    points = centres[np.arange(4000) % 40] + rnd.randn(4000, 12) * 0.05
    df = spark.createDataFrame([(i, (x * (1 + i % 3 / 10)).tolist()) for i, x in enumerate(points)], "vec_id bigint, embedding array<double>")
    v = Scratch(spark).table(topk.quantised(df), "clustered")
    report = {}
    got = topk.top_k(v, v.where("vec_id % 50 = 0"), block_rows=200, query_rows=8, report=report).collect()
    x = np.floor(256 * np.array([r["embedding"] for r in df.collect()])).astype(np.int64)
    want = set()
    for q in range(0, 4000, 50):
        best = sorted((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:5]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert set(map(tuple, got)) == want
    assert report["kept"] < 0.3


def test_cells_are_dealt_to_bounded_blocks():
    assert topk.dealt({0: 30, 1: 30, 2: 250, 3: 90, 4: 10}, [4, 3, 0, 5, 1, 2], 100) == [(4, 0, 1), (3, 0, 1), (0, 1, 1), (1, 1, 1), (2, 2, 3)]


def test_decontamination_against_loops(spark):
    rnd = random.Random(2)
    items = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(n))) for i, n in enumerate((12, 10, 3, 25, 0, 9))] + [(None, "p q r s t u v w x y z"), (7, None), (10, "a a a a a a a a a a")]
    texts = ["", None, "A" + " a" * 40, "!?", "É é Éa"] + [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 60))) for _ in range(60)] + [f"x {t} y, {t}!" for _, t in items if t]
    docs = [(i if i % 11 else None, t, 0) for i, t in enumerate([*texts, *texts[:5]])]
    df = spark.createDataFrame(docs, f"{DOCS}, n_words int")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, hash int")
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - 9, 1) if w else 0):
            grams[tuple(w[k : k + 10])].add(i)
    want = []
    for i, t, _ in docs:
        w, hit, ids = words(t), set(), set()
        for g, owners in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    ids |= owners - {None}
        want.append((i if i is not None else -1, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit)))
    for limit in (decontaminate.BROADCAST_WINDOWS, 0):
        decontaminate.find_hits.__defaults__, kept = (10, limit), decontaminate.find_hits.__defaults__
        got = [tuple(r) for r in decontaminate.report(df, bench).collect()]
        decontaminate.find_hits.__defaults__ = kept
        assert sorted((i if i is not None else -1, *rest) for i, *rest in got) == sorted(want)
    assert not decontaminate.report(df, bench.limit(0)).where("contaminated").count()
    assert decontaminate.report(df.limit(0), bench).count() == 0
    # A very long text: one passage far behind, and windows of every length.
    long = " ".join(f"n{i}" for i in range(120_000)) + " " + items[0][1]
    got = decontaminate.report(spark.createDataFrame([(1, long)], DOCS), bench).first()
    assert got["n_words"] == 120_012 and got["n_hit"] >= 12


def test_equal_windows_have_equal_hashes_wherever_they_stand(spark):
    rnd = random.Random(1)
    w = [rnd.choice("abc") for _ in range(60)]
    for lengths in ([10], [1, 2, 3], [5, 7, 10], [4, 8], [9]):
        row = spark.createDataFrame([(w,)], "w array<string>").select(decontaminate._window_hashes(F.col("w"), lengths).alias("h")).first()["h"]
        every = [tuple(w[i : i + n]) for n in lengths for i in range(len(w) - n + 1)]
        assert len(row) == len(every)
        of = {}
        for g, h in zip(every, row, strict=True):
            assert of.setdefault(g, h) == h
        assert len(set(of.values())) == len(of)


def test_decontamination_runs_no_python(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    for df in (decontaminate.report(docs, bench), mixing.mix(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def near(texts, similarity=0.8):
    """Links and classes by comparing all sets that share a shingle."""
    sets = []
    for t in texts:
        w = words(t)
        n = min(5, len(w))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    links = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (both := len(sets[i] & sets[j])) and both >= similarity * len(sets[i] | sets[j])}
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    return links, root


def near_texts(seed):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéÉ") for _ in range(4)) for _ in range(300)]
    base = [[rnd.choice(vocabulary) for _ in range(n)] for n in (3, 5, 40, 80, 200)]
    out = ["", None, "?!", " ".join(vocabulary) * 400]
    for w in base:
        for _ in range(25):
            x = list(w)
            for _ in range(rnd.choice((0, 0, 1, 2, 4))):
                x[rnd.randrange(len(x))] = rnd.choice(vocabulary)
            out.append(rnd.choice((" ", ", ")).join(x))
    return out


def test_jaccard_join_against_all_pairs(spark, monkeypatch):
    texts = near_texts(3)
    links, root = near(texts)
    degree = Counter(itertools.chain(*links))
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], f"{DOCS}, key1 int").repartition(3)
    for block, large in ((384, 8), (4, 8), (4, 1)):  # in one block, in many that meet pairwise, and by a center
        monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", block)
        monkeypatch.setattr(jaccard_join, "LARGE_BLOCKS", large)
        got = {r["doc_id"]: (r["n_links"], r["class_id"]) for r in jaccard_join.near_duplicates(df).collect()}
        assert got == {i: (degree[i], root[i]) for i in range(len(texts))}
    kept = jaccard_join.keep_one(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root)) and kept.columns == df.columns


def test_jaccard_join_of_repeated_null_and_no_rows(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    df = spark.createDataFrame([(1, a), (1, a), (1, b), (2, b), (None, a), (None, None), (3, "")], DOCS)
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.near_duplicates(df).collect())
    assert got == {(1, 1, 2): 2, (None, 1, 2): 1, (1, 1, 1): 1, (2, 1, 1): 1, (None, None, 0): 1, (3, 3, 0): 1}
    assert jaccard_join.near_duplicates(df).where("keeps").count() == 4
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0 and jaccard_join.keep_one(df.limit(0)).count() == 0


def test_one_of_near_copies_stays_with_repeated_and_null_ids(spark):
    base = [f"w{i}" for i in range(60)]
    a, near_a = " ".join(base), " ".join([*base, "more"])  # 56 of 57 shingles
    b, near_b = " ".join(f"v{i}" for i in range(60)), " ".join(f"v{i}" for i in range(61))
    c, near_c, alone = "one two three four five six seven eight nine", "one two three four five six seven eight nine ten", "nothing like the others at all"
    rows = [(1, a), (None, near_a), (None, b), (None, near_b), (None, alone), (5, c), (5, c), (5, near_c), (6, alone + " x y z"), (6, near_a), (None, None)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = Counter((r["doc_id"], r["text"]) for r in jaccard_join.keep_one(df).collect())
    assert max(got.values()) == 1 and got.keys() >= {(1, a), (None, alone), (6, alone + " x y z"), (None, None)} and (None, near_a) not in got and (6, near_a) not in got
    assert ((None, b) in got) + ((None, near_b) in got) == 1 and ((5, c) in got) + ((5, near_c) in got) == 1 and len(got) == 6


def test_prefixes_are_shortened_until_recall_is_reached():
    J = jaccard_join
    seen = lambda depth, *found: [sum(J.found_chance(s, d) / s**depth for s in found) for d in range(1, J.DEEPEST + 1)] + [sum(1 / s**depth for s in found)]
    # Nothing found: the threshold alone decides, as long as a prefix can be shortened.
    d = J.next_depth(8, seen(8), 0.8, 0.999)
    assert J.found_chance(0.8, d) >= 0.999 > J.found_chance(0.8, d + 1)
    # Close copies are found by the deepest prefixes; loose ones call for shorter ones.
    assert J.next_depth(8, seen(8, *[0.97] * 500), 0.8, 0.999) is None
    assert J.next_depth(8, seen(8, *[0.97] * 500, *[0.8] * 60), 0.8, 0.999) in (6, 7)
    assert J.next_depth(8, seen(8, *[0.8] * 500), 0.8, 0.999) == d
    assert J.next_depth(1, seen(1), 0.5, 0.9999999999) is None


@pytest.mark.parametrize("depth", [4, 6, 8])
def test_signatures_share_prefixes_as_often_as_computed(depth):
    rnd = np.random.RandomState(1)
    found = 0
    for _ in range(400):
        s = rnd.randint(0, 2**63, 900, dtype=np.int64).astype(np.uint64)
        a, b = np.unique(s[:810]), np.unique(np.concatenate([s[:720], s[810:]]))  # 0.8
        x, y = (jaccard_join.signature(v).reshape(jaccard_join.TREES, -1)[:, :depth] for v in (a, b))
        found += bool((x == y).all(1).any())
    assert abs(found / 400 - float(jaccard_join.found_chance(0.8, depth))) < 0.02


def test_unlike_texts_that_share_a_prefix_stay_apart(spark):
    """A chain of texts, each half of the next: candidates by short prefixes, links none."""
    pool = [f"w{i}" for i in range(60 * 120)]
    chain = [(i, " ".join(pool[60 * i : 60 * i + 120])) for i in range(100)]
    found = jaccard_join.near_duplicates(spark.createDataFrame(chain, DOCS), recall=0.9999999).collect()
    assert len({r["class_id"] for r in found}) == 100 and not any(r["n_links"] for r in found)


def test_recall_of_pairs_at_the_threshold_and_above(spark):
    rnd = random.Random(12)
    texts = []
    for i in range(150):
        base = [f"{rnd.random():.9f}" for _ in range(104)]
        texts += [" ".join(base), " ".join([*base[:96], f"x{i}"]), " ".join([*base[: 90 + i % 5], *(f"y{i}{k}" for k in range(4))])]
    links, root = near(texts)
    rows = jaccard_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    assert len(links) > 150 and sum(r["n_links"] for r in rows) >= 2 * 0.995 * len(links)
    assert all(r["class_id"] >= root[r["doc_id"]] for r in rows)


def test_links_of_a_large_class_without_all_its_pairs(spark, monkeypatch):
    """Thousands of different near copies: all links are counted, by few of the pairs."""
    rnd = random.Random(21)
    base = [f"w{i}" for i in range(400)]

    def copy(edits):
        x = list(base)
        for at in rnd.sample(range(400), edits):
            x[at] = f"{rnd.random():.9f}"
        return " ".join(x)

    texts = [copy(rnd.choice((1, 2))) for _ in range(2_700)] + [copy(8) for _ in range(300)]
    sets = [jaccard_join.shingles(t) for t in texts]
    column = {h: i for i, h in enumerate(sorted({int(h) for s in sets for h in s}))}
    held = np.zeros((len(sets), len(column)), np.float32)
    for i, s in enumerate(sets):
        held[i, [column[int(h)] for h in s]] = 1
    size = held.sum(1)
    both = held @ held.T
    links = (both >= 0.8 * (size[:, None] + size[None, :] - both) - 1e-6).sum(1) - 1

    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 128)
    compared, in_blocks = [], jaccard_join._in_blocks

    def watched(members):
        dealt = in_blocks(members)
        pairs = dealt.groupBy("grp", "first", "second").agg(F.count_if(F.col("block") == F.col("first")).alias("a"), F.count_if(F.col("block") == F.col("second")).alias("b"))
        compared.append(pairs.agg(F.coalesce(F.sum(F.when(F.col("first") == F.col("second"), F.col("a") * F.col("a") / 2).otherwise(F.col("a") * F.col("b"))), F.lit(0.0))).first()[0])
        return dealt

    monkeypatch.setattr(jaccard_join, "_in_blocks", watched)
    rows = jaccard_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    assert {r["doc_id"]: r["n_links"] for r in rows} == dict(enumerate(links.tolist())) and {r["class_id"] for r in rows} == {0}
    # All pairs are 4.5 million. In the search and in the counting, the loose copies meet all.
    assert sum(compared) < 2 * 300 * 3_000
    compared.clear()
    assert jaccard_join.keep_one(spark.createDataFrame(list(enumerate(texts)), DOCS)).count() == 1 and sum(compared) < 300 * 3_000


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000)]
    random.Random(1).shuffle(edges)
    got = {r["id"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark), "t").collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1100)}


def _shares_that_rise(points):
    """(vote, toxic, weight) pooled until the shares rise: brute force over runs of distinct votes."""
    votes = sorted({v for v, *_ in points})
    pools = [[v, v, sum(t * w for x, t, w in points if x == v), sum(w for x, _, w in points if x == v)] for v in votes]
    while True:
        falls = [i for i in range(len(pools) - 1) if pools[i][2] / pools[i][3] >= pools[i + 1][2] / pools[i + 1][3]]
        if not falls:
            break
        a, b = pools[falls[0]], pools.pop(falls[0] + 1)
        a[1:] = [b[1], a[2] + b[2], a[3] + b[3]]
    xs = [v for p in pools for v in p[:2]]
    return xs, np.maximum.accumulate([(p[2] + 0.25) / (p[3] + 0.5) for p in pools for _ in range(2)])


@pytest.mark.parametrize(("first", "common"), [(1, 1 / 16), (100, 2.0), (1, 0.0)])
def test_toxicity_against_all_cosines(spark, monkeypatch, first, common):
    """Neighbours, votes, calibration and scores of every text, by loops over all examples."""
    monkeypatch.setattr(toxicity, "FIRST_BLOCKS", first)
    monkeypatch.setattr(toxicity, "COMMON", common)
    rnd = random.Random(6)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(60)]
    texts = [" ".join(rnd.choices(vocabulary[: 60 - 20 * (i % 2)], k=rnd.choice((0, 3, 8, 20)))) for i in range(400)]
    texts += texts[:30]
    toxic = [int(rnd.random() < (0.8 if i % 2 else 0.1)) for i in range(430)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    index = toxicity.fit(df, spark.createDataFrame(list(enumerate(toxic)), "doc_id bigint, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(df, index).collect()}

    counts = [Counter(t for w in x.split() for t in [w, *(f"{w[:p]}*" for p in (4, 5, 6, 7) if len(w) > p)]) for x in texts]
    df_of = [Counter(t for c, y in zip(counts, toxic, strict=True) if y == label for t in c) for label in (0, 1)]
    known = {t for t in df_of[0] + df_of[1] if df_of[0][t] + df_of[1][t] >= 3}
    n = [toxic.count(0), toxic.count(1)]
    weight = {}
    for t in known:
        a, b = df_of[0][t], df_of[1][t]
        z = abs(np.log((b + 0.5) / (n[1] + 1)) - np.log((a + 0.5) / (n[0] + 1))) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        weight[t] = (np.log(431 / (1 + a + b)) + 1) * (z + 0.01)
    vectors = []
    for c in counts:
        v = {t: (1 + np.log(k)) * weight[t] for t, k in c.items() if t in known}
        length = np.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / length for t, x in v.items()})

    def vote(v, without=None):
        group = defaultdict(list)
        for i, e in enumerate(vectors):
            if e:
                group[tuple(sorted((t, c) for t, c in counts[i].items() if t in known))].append(i)
        if not v:
            rest = [toxic[i] for i, e in enumerate(vectors) if not e and i != without]
            return (sum(rest) / len(rest) if rest else 0.0), None
        near = sorted(((sum(x * vectors[g[0]].get(t, 0) for t, x in v.items()), -g[0], g) for g in group.values()), reverse=True)
        near = [x for x in near if x[0] > 1e-6]
        near = [x for x in near if x[0] >= near[min(12, len(near)) - 1][0] - 1e-6]
        up = sum(c**4 * sum(toxic[i] for i in g if i != without) for c, _, g in near)
        down = sum(c**4 * sum(i != without for i in g) for c, _, g in near)
        return (up / down if down else 0.0), near[0][2][0]

    loo = [(round(vote(v, i)[0], 6), y, 1.0) for i, (v, y) in enumerate(zip(vectors, toxic, strict=True))]
    assert np.allclose([x for x, *_ in loo], _votes(index, counts, toxic), atol=2e-5)
    xs, ys = _shares_that_rise(loo)
    for i, v in enumerate(vectors):
        raw, nearest = vote(v)
        assert got[i]["nearest_example"] == nearest
        assert got[i]["score"] == pytest.approx(float(np.interp(raw, xs, ys)), abs=0.02)


def _votes(index, counts, toxic):
    """Votes of the examples by the index, each left out in turn."""
    at = {t: i for i, t in enumerate(index.terms)}
    out, vectors = [], []
    for c in counts:
        ids = np.array(sorted(at[t] for t in c if t in at), np.int32)
        vectors.append((ids, np.array([c[index.terms[i]] for i in ids], np.int64)))
    for (d, c), y in zip(index.nearest([(i, index.vector(i, k)) for i, k in vectors]), toxic, strict=True):
        out.append(index.vote(d, c, without=(float(y), 1.0))[0])
    return np.array(out)


def test_a_drawn_sample_is_bounded_and_never_empty(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 2).alias("kind"))
    for n in (10_000, 50_000_000_000):
        # The table pretends to be larger than it is: the bound is never below the share that it stands for.
        assert drawn(rows, "kind", {0: n, 1: n}, 200, "id").count() == (400 if n == 10_000 else 0)
    assert drawn(rows, "kind", {0: 10_000}, 10**6, "id").count() == 10_000
    first = drawn(rows, "kind", {0: 10_000, 1: 10_000}, 50, "id").collect()
    assert sorted(first) == sorted(drawn(rows.repartition(7), "kind", {0: 10_000, 1: 10_000}, 50, "id").collect()) and len(first) == 100
    lots = rows.where("kind = 0").select("id", F.xxhash64("id", F.lit("sample")).alias("lot")).orderBy("lot", "id").limit(50)
    assert {r["id"] for r in lots.collect()} == {r["id"] for r in first if r["kind"] == 0}


def test_a_bound_of_a_huge_table_is_above_the_least_hash():
    for n in (10**9, 5 * 10**10, 10**15):
        assert hash_bound(n, 2_000) > -(2**63) and abs((hash_bound(n, 2_000) + 2**63) / 2**64 * n - 4_064) < 1


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    rows = entries.QUERIES["op9_toxicity"](spark, d).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) >= 0.95


def test_toxicity_edges(spark):
    docs = [(i, ("moron idiot clown " if i % 2 else "tree river cloud ") + "a b c", 1) for i in range(60)]
    labels = spark.createDataFrame([*[(i, i % 2, 1) for i in range(60)], (3, 1, 1), (None, 1, 1), (4, None, 1), (5, 7, 1)], "doc_id bigint, toxic int, score int")
    df = spark.createDataFrame([*docs, (None, "you moron", 1), (61, None, 1), (62, "", 1), (62, "", 1), (63, "idiot " * 200_000, 1)], f"{DOCS}, score int")
    got = toxicity.score(df, toxicity.fit(df, labels)).collect()
    of = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == df.count() and of[1] > 0.8 and of[63] > 0.8 and of[2] < 0.2 and of[None] > 0.8 and of[61] == of[62]
    none = toxicity.score(df, toxicity.fit(df, labels.limit(0))).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.score(df.limit(0), toxicity.fit(df.limit(0), labels)).count() == 0


def water_levels(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, total = {}, set(names), sum(sizes.values())
    while free:
        rest, w = total - sum(target.values()), sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w > 3 * sizes[s]]
        target |= {s: float(3 * sizes[s]) for s in over} if over else {s: rest * weight[s] / w for s in free}
        free -= set(over or free)
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixing_against_loops(spark, seed):
    rnd = random.Random(seed)
    names = ["b", "a", None, "é", "tiny", "none", "hot"]
    rows = [(i, " ".join(["w"] * rnd.randint(0, 90)) if s != "none" else "\t", s, 5) for i in range(900) for s in [rnd.choice([*names, "hot", "hot", "hot"])] if s != "tiny" or rnd.random() < 0.1]
    rows += [(1, "x y z", "hot", 5), (1, "x y z", "hot", 5), (None, "x y", None, 5), (7, None, "a", 5)]
    df = spark.createDataFrame(rows, f"{DOCS}, source string, size int")
    first, second = (mixing.mix(x, shard_rows=100).collect() for x in (df, df.repartition(7)))
    assert sorted(map(repr, first)) == sorted(map(repr, second))
    sizes, taken, target = Counter(), Counter(), {}
    for r in first:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert len(first) == len(rows) and sizes == {s: sum(len((t or "").split()) for _, t, x, _ in rows if x == s) for s in sizes}
    want = water_levels(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s]) and abs(taken[s] - want[s]) <= 25


def test_mixing_of_a_tiny_source_among_many_shards(spark):
    rows = [(i, "w " * 40, "big") for i in range(4_000)] + [(10_000 + i, "a b c d e", s) for i in range(300) for s in ("some", "tiny")]
    df = spark.createDataFrame(rows, f"{DOCS}, source string")
    for weights in ((100.0, 1.0, 100.0), (100.0, 1.35, 1.0)):  # "tiny" at its limit of three passes; "some" at about one and a half
        got = mixing.mix(df, weights=weights, shard_rows=10, block_words=64).collect()
        assert len({r["shard"] for r in got if r["source"] == "tiny"}) > 30
        taken, target = Counter(), {}
        for r in got:
            assert 0 <= r["taken"] <= 3 * r["size"]
            taken[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
        for s in target:
            assert abs(taken[s] - target[s]) <= 64, (s, taken[s], target[s])


def test_mixing_of_a_very_long_text_and_ties(spark):
    rows = [(1, "w " * 400_000, "a"), *((i, "w w w", s) for i in range(2, 400) for s in ("a", "b", "c"))]
    got = mixing.mix(spark.createDataFrame(rows, f"{DOCS}, source string")).collect()
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= 64 for s in target)


def test_mixing_of_little_or_nothing(spark):
    df = spark.createDataFrame([(1, "a b c", "s"), (2, None, "t"), (3, "", None)], f"{DOCS}, source string")
    assert {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix(df).collect()} == {1: (3, 3), 2: (0, 0), 3: (0, 0)}
    assert mixing.mix(df.limit(0)).count() == 0


def test_seats_against_the_quotients(spark):
    rnd = random.Random(9)
    for n, seats in ((1, 7), (5, 3), (12, 100), (30, 0)):
        votes = [rnd.choice((0, 1, 5, 5, 70, 900)) + rnd.random() for _ in range(n)]
        df = spark.createDataFrame([(i, v, seats) for i, v in enumerate(votes)], "name int, votes double, seats int")
        got = {r["name"]: r["quota"] for r in mixing.sainte_lague(df, "votes", "seats", [], ["name"]).collect()}
        ranked = sorted(((-v / (2 * k + 1), i) for i, v in enumerate(votes) for k in range(seats)))[:seats]
        assert got == {i: sum(j == i for _, j in ranked) for i in range(n)}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(9001, "12345 !!", None, "src0", 8), (9002, docs.first()["text"], "en", "src1", 1), (9003, "a token=abcdefgh1 " + docs.first()["text"][:50], None, None, 1)]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    extra.append((9004, f"the thing is {bench} of that and the", "en", "src2", 1))
    now = docs.unionByName(spark.createDataFrame(extra, docs.schema)).repartition(3)
    before = {r["doc_id"]: r["text"] for r in now.collect()}
    stages = dict(corpus_pipeline.STAGES)
    scratch = Scratch(spark)

    one = scratch.table(stages["language_id"](spark, now, SF), "one")
    assert set(before) - {r["doc_id"] for r in one.collect()} == {9001} and one.columns == docs.columns
    assert one.where("doc_id = 9003").first()["lang"] is not None

    two = scratch.table(stages["ngram_jaccard_join"](spark, one, SF), "two")
    ids = sorted(i for i in before if i != 9001)
    _, root = near([before[i] for i in ids])
    assert {r["doc_id"] for r in two.collect()} == {ids[k] for k in set(root)} and two.columns == docs.columns

    three = scratch.table(stages["benchmark_decontamination"](spark, two, SF), "three")
    hit = {r["doc_id"] for r in decontaminate.report(two, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    assert 9004 in hit and {r["doc_id"] for r in three.collect()} == {r["doc_id"] for r in two.collect()} - hit and three.columns == docs.columns

    four = scratch.table(stages["secret_scans"](spark, three, SF), "four")
    assert four.count() == three.count() and four.columns == docs.columns
    assert not any(re.search(r'token = "[0-9a-f]{40}"', r["text"]) for r in four.collect())
    assert "token=abc" not in four.where("doc_id = 9003").first()["text"]

    five = stages["mixing"](spark, four, SF)
    assert {r["doc_id"] for r in five.collect()} == {r["doc_id"] for r in four.collect()}


def test_pipeline_of_nulls_repeats_and_clashing_columns(spark):
    """Every stage over rows with nulls in any column, repeated rows, a very long text and columns that are named like results."""
    good = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 300").limit(6).collect()]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(1, good[0], "en", "a"), (1, good[1], "en", "a"), (None, good[2], "en", None), (None, good[3], None, "b"), (None, None, None, None), (2, None, "en", "a"), (3, "", "de", "b"),
            (None, good[4] + " " + bench, None, "b"), (4, good[5], "fr", "a"), (4, good[5], "fr", "a"), (5, " ".join(good) * 40, None, None), (6, "x token=abcdefgh1 " + good[3], "en", "c")]
    df = spark.createDataFrame([(*r, len(r[1] or ""), "x", 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, lang_pred string, score int")
    scratch = Scratch(spark)
    docs, sizes = df, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, SF), f"edge_{name}")
        assert docs.columns == df.columns
        sizes.append(docs.count())
    left = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # The row 4 that repeats goes, and of the two with the fourth text the one without an id; then the one with a benchmark item.
    assert sizes == [9, 7, 6, 6] and all(t for _, t in left)
    assert not any(bench in t for _, t in left) and len(set(left)) == len(left) and not any("token=abc" in t for _, t in left)
    assert docs.where("n_chars <> length(text) or lang is null or lang_pred <> 'x' or score <> 1").count() == 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(mixed) == 6 and all(0 <= r["taken"] <= 3 * r["size"] for r in mixed)


def test_pipeline_of_an_empty_table_and_of_an_empty_model(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc def", None, "a", 7), (2, "12 34", None, "a", 5), (3, None, None, "a", 0)], empty.schema)
    assert [r["doc_id"] for r in corpus_pipeline.identify_language(spark, unlabelled, SF).collect()] == [1]
    with pytest.raises(RuntimeError, match="empty"):
        corpus_pipeline.identify_language(spark, unlabelled.withColumn("lang", F.lit("en")).where("doc_id = 2"), SF)


def test_pipeline_runs_and_reruns(spark):
    a, b = (sorted(map(repr, corpus_pipeline.run(spark, SF).collect())) for _ in range(2))
    assert a == b and len(a) > 100


def test_language_sample_is_a_share_of_each_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    f = language_id.fit(docs, sample_docs=50)
    assert f.languages == ["de", "en", "es", "fr"]
