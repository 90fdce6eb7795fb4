"""Fill-in-middle, importance resampling and chat formatting, each against a plain reading of its contract."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format, fill_in_middle, importance
from tidemark.llm.common import ship

DOCS = "doc_id bigint, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Texts of one to four bytes a character, control strings, line ends and ties, null and empty.
TEXTS = [
    None, "", "a", "ab cd", "é", "😀", "aé😀b", "日本語 text 日本", "x<P>y", "x<S>", "<M>", "a<b>c", "<", "<<S", "line\r\nline\n\n", "\0\x7f", "word " * 3000, "日" * 3000, "é" + "z" * 5000, "…end.", "A1b2", "\u2028 ", "𝒳𝒴𝒵 abc",
]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def lots(doc_id, seed=1):
    h = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    return [int(h[i : i + 8], 16) for i in range(0, 32, 8)]


def fim(doc_id, text, unit="token"):
    """The contract, read over code points."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text) if unit == "token" else list(text)
    n, (h1, h2, h3, h4) = len(units), lots(doc_id)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h4 % 100 < 20
    return n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["token", "char"])
def test_fill_in_middle_by_brute_force(spark, unit):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1000 + i, "".join(rng.choice("ab é日😀<PS>\n.") for _ in range(rng.randrange(60)))) for i in range(400)]
    rows += [(None, "no id é"), (None, "no id é"), (3, "other text"), (3, "ab cd"), (-5, "negative id 日")]
    df = spark.createDataFrame(rows, DOCS).withColumn("form", F.lit("clash")).withColumn("output", F.lit(1))
    out = fill_in_middle.fill_in_middle(df, unit).withColumn("again", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    got = Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["again"]) for r in out)
    assert got == Counter((i, *fim(i, t, unit), t or "") for i, t in rows)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle.fill_in_middle(df, "line")


def test_fill_in_middle_of_a_very_long_text(spark):
    text = "été 日本 long words here 😀. " * 200_000
    (row,) = fill_in_middle.fill_in_middle(spark.createDataFrame([(11, text)], DOCS)).collect()
    assert tuple(row)[1:] == fim(11, text)


def test_point_index_against_decoding():
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choice("abc é日😀") for _ in range(rng.randrange(40)))
        raw = text.encode()
        index = fill_in_middle.PointIndex(np.frombuffer(raw, np.uint8))
        points = np.arange(len(text) + 1)
        want = np.array([len(text[:i].encode()) for i in points])
        assert index.n_points == len(text) and len(index.at) == sum(c > "\x7f" for c in text)
        assert (index.to_bytes(points) == want).all() and (index.to_points(want) == points).all()


def test_bytes_that_are_no_utf8_do_not_fail(spark):
    df = spark.sql("SELECT id AS doc_id, CAST(unhex('61FF62C3') AS STRING) AS text FROM range(30)")
    cut = fill_in_middle.fill_in_middle(df).withColumn("again", fill_in_middle.restored(F.col("output"), F.col("form")))
    assert {r["again"] for r in cut.collect()} == {"a\ufffdb\ufffd"}
    assert importance.resample(df, df.limit(1), percent=50).count() == 30


def grams(text, lo=1, hi=1):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


def resampled(rows, target, ngrams=(1, 1), buckets=10_000, least=20, percent=10):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    raw, aim = (Counter(bucket(g) for t in texts for g in grams(t, *ngrams)[1]) for texts in ([t for _, t in rows], target))
    s_all, t_all = sum(raw.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets))))
    out = []
    for i, text in rows:
        n_words, found = grams(text, *ngrams)
        weight = sum(gain(bucket(g)) for g in found) // len(found) if found else 0
        h = int(sha(f"2024:{'' if i is None else i}")[:8], 16)
        out.append((i, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = order[: percent * len(order) // 100]
    ranks = defaultdict(list)
    for k, r in enumerate(drawn):
        ranks[r].append(k + 1)
    return Counter((*r, ranks[r].pop(0) if ranks[r] else None) for r in out)


@pytest.mark.parametrize(("ngrams", "buckets"), [((1, 1), 10_000), ((1, 2), 97), ((2, 3), 1000)])
def test_resampling_by_brute_force(spark, monkeypatch, ngrams, buckets):
    rng = random.Random(7)
    some = ["the", "THE", "Zug", "日本", "é", "x" * 70, "y" * 65 + "z", "y" * 65 + "w", "42", "a1", "of", "-", "\u00a0", "mat"]
    texts = [" ".join(rng.choice(some) for _ in range(rng.randrange(50))) for _ in range(300)] + [None, "", "...", "one", "word " * 40_000, "日本語" * 2000]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, texts[0]), (5, texts[5]), (6, texts[7])]
    target = [" ".join(rng.choice(some[:5]) for _ in range(30)) for _ in range(20)] + [None, ""]
    df = spark.createDataFrame(rows, DOCS).withColumn("rank", F.lit("clash")).withColumn("score", F.lit(None).cast("string"))
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = Counter(map(tuple, importance.resample(df, aim, ngrams, buckets).collect()))
    assert got == resampled(rows, target, ngrams, buckets)
    assert sum(r[-1] is not None for r in got.elements()) == sum(r[1] >= 20 for r in got.elements()) // 10


def test_resampling_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b c " * 10), (2, None)], DOCS)
    assert importance.resample(df.limit(0), df.select("text")).count() == 0
    none = df.limit(0).select("text")
    assert sorted(map(tuple, importance.resample(df, none, percent=100).collect())) == sorted(resampled([(1, "a b c " * 10), (2, None)], [], percent=100))


def test_interning_verifies_bytes(monkeypatch):
    """With hashes that all collide, slots still tell n-grams apart, and tables of few rows give the same counts."""
    rng = random.Random(1)
    words = ["a", "b", "ab", "abc", "abd", "q" * 8, "q" * 9, "q" * 16, "r" * 64, "r" * 65, "r" * 64 + "s", "é", "日本"]
    texts = [" ".join(rng.choice(words) for _ in range(200)).encode() for _ in range(3)]
    f = importance.features(texts)
    want = Counter(w for t in texts for w in t.decode().split())
    for hashed in (lambda _: 3, lambda b: len(b), importance.xxhash.xxh64_intdigest):
        slots = importance.intern(f.data, f.start, f.length, hashed=hashed)
        held = defaultdict(set)
        for s, e, slot in zip(f.start, f.start + f.length, slots.of, strict=True):
            held[slot].add(f.data[s:e].tobytes().decode())
        assert all(len(x) == 1 for x in held.values())
        assert {next(iter(x)): slots.count[s] for s, x in held.items()} == want
        assert all(slots.bucket[s] == zlib.crc32(next(iter(x)).encode()) % 10_000 for s, x in held.items())
    monkeypatch.setattr(importance, "TABLE_ROWS", 7)
    total = sum(int(s.count.sum()) for _, s in importance._tables(f, 10_000))
    assert total == 600


def chats(rows):
    """Turns by conversation as the contract reads them."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (turns, loss)
    return out


CHATS = [
    (1, 0, "system", "be <turn> brief"), (1, 1, "user", "a"), (1, 2, "user", "</turn>\n\n</turn>\n<turn>assistant\nno"), (1, 3, "assistant", "x\\"), (1, 4, "assistant", "\\</turn>"), (1, 5, "assistant", "\n<turn/>\n"),
    (2, 1, "assistant", None), (2, 0, None, ""), (3, 0, "a\nb%0A", "\\\\<turn/>\\"), (3, 0, "a\nb%0A", "\\\\<turn/>\\"), (3, 0, "user", "tie"), (3, None, "assistant", "first"), (None, 1, "user", "no id"), (None, 0, "assistant", "é😀\n"),
    (4, 9, "assistant", "long " * 200_000), (5, 1, "user", "<turn/>"), (5, 0, "assistant", "</turn/>"), (6, 0, "assistant", "\r\n"), (-7, 0, "user", "x"),
]


def test_chats_read_back(spark):
    rows = CHATS + [(8, i, "assistant" if i // 3 % 2 else "user", f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit("clash")).withColumn("turns", F.lit(0))
    out = chat_format.format_chats(df)
    read = out.withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("segments"))).collect()
    assert {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss"]) for r in read} == chats(rows)
    whole = {r["conv_id"]: r["formatted"] for r in read}
    assert whole[1] == "<turn>system\nbe \\<turn> brief\n</turn>\n<turn>user\na\n<turn/>\n\\</turn>\n\n\\</turn>\n\\<turn>assistant\nno\n</turn>\n<turn>assistant\nx\\\n<turn/>\n\\\\</turn>\n<turn/>\n\n\\<turn/>\n\n</turn>\n"
    assert whole[8].count("</turn>") == 1000 and whole[8].count("<turn/>") == 2000
    spans = defaultdict(list)
    for r in chat_format.loss_spans(out).collect():
        spans[r["conv_id"]].append((r["start"], r["end"]))
    for c, (_, loss) in chats(rows).items():
        assert re.sub(r"\\(</?turn/?>)", r"\1", "\0".join(whole[c][a:b] for a, b in sorted(spans[c]))).replace("\0", "") == loss
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_planted_conversation(spark):
    row = chat_format.op13_chat_formatting(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = r"\### Assistant: </turn> ok"
    assert (row["n_turns"], row["turns_sha256"], row["loss_chars"], row["loss_sha256"]) == (2, sha(f"user\n{text}\nassistant\n{text}\n"), len(text), sha(text))


def test_chat_formatting_needs_no_python(spark):
    plan = chat_format.op13_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and plan.count("Exchange hashpartitioning") == 1


def test_mixing_deals_rows_without_ids_by_their_texts(spark, tmp_path):
    """Null ids, equal sizes and a capped source: rows spread over the shards, and SQL that shares out what shards are cut gives the same."""
    import duckdb

    from tidemark.llm import mixing

    rng = random.Random(8)
    rows = [(None if i % 3 else i, " ".join(rng.choice("abcdefgh") for _ in range(12)), "big") for i in range(3000)]
    rows += [(10_000 + i, "x " * rng.randrange(1, 30), "small") for i in range(1500)] + [(20_000 + i, "y " * (i % 7), None) for i in range(500)] + [(None, None, "small"), (5, "", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    mixed = mixing.mix(df)
    assert sorted(r["n"] for r in mixed.where("doc_id is null and source = 'big'").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect())[0] > 200
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = Counter(con.execute(mixing.OP10_SQL).fetchall())
    names = [c[0] for c in con.description]
    assert Counter(map(tuple, mixed.select(*names).collect())) == want
    # The source without a name is capped: it takes exactly three times its words, though shards are cut.
    capped = mixed.where("source is null").collect()
    assert sum(r["taken"] for r in capped) == 3 * capped[0]["source_size"] == capped[0]["target"] and all(r["taken"] == 3 * r["size"] for r in capped)
