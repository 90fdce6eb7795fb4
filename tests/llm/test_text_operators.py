"""HTML extraction, secret scans, language ID and token counts."""

import hashlib
import html
import math
import random
import re
import string
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_text, language_id, secrets, token_counts
from tidemark.llm.common import ship

DOCS = "doc_id bigint, text string"
LONG = "the and of " * 200_000


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


ARTICLE = "<article><h1>Head &amp; line</h1><p>First <b>bold</b>ly set,\n second  line.</p><ul><li>One<li>Two</ul><p>Of.<br>End.</article>"
TEXT = "Head & line First boldly set, second line. One Two Of. End."


@pytest.mark.parametrize(
    ("source", "want"),
    [
        (page(f"<header>Site</header><nav><a href=/>Home</a></nav>{ARTICLE}<aside>Side</aside><footer>&copy; x</footer>"), TEXT),
        (page(f'<div class="sidebar">Long text of a sidebar, long text.</div><div id="content">{ARTICLE}</div><div class="cookie-notice">We use cookies</div>'), TEXT),
        (page(f'{ARTICLE[:-10]}<form><label>Mail</label><input></form><div class="ad">Buy now</div><script>var t="</p>";</script></article><section id="comments"><article class="comment"><p>A reader says a lot of things here.</p></article></section>'), TEXT),
        (page(f'<main><div role="navigation">a b</div>{ARTICLE}<div class="related-posts"><h2>More</h2></div></main>'), TEXT),
        (page(f'<div class="menu"><a href=1>a</a><a href=2>b</a></div><div class="has-sidebar"><div id="post">{ARTICLE[9:-10]}</div></div><div id="footer">foot</div>'), TEXT),
        (page("<article><p hidden>no</p><p style='display: none'>no</p><noscript>no</noscript><p>A&nbsp;b&#8212;c</p><!-- no --></article>"), "A b—c"),
        ("", ""), (None, ""), ("<", "<"), ("plain words only", "plain words only"), (page("<nav>menu</nav>"), ""), ("<p>unclosed <b>tags", "unclosed tags"),
    ],
)
def test_main_text(source, want):
    assert html_text.main_text(source) == want


@pytest.mark.parametrize("wrapper", ["<div class='content-sidebar-wrap'>{}</div>", "<div id='search-and-article'>{}</div>", "<form id='aspnetForm'>{}</form>", "<form role='form'><div class='widget-area'>{}</div></form>"])
@pytest.mark.parametrize("inner", [ARTICLE, f"<main>{ARTICLE[9:-10]}</main>", f"<div>{ARTICLE[9:-10]}</div>"])
def test_wrappers_of_the_article_stay(wrapper, inner):
    more = '<div class="sidebar">Some text aside.</div><form><label>Mail</label></form><section id="comments"><div class="comment">A reader says a lot of things here, and more of them than the article says in all of its lines.</div></section>'
    assert html_text.main_text(page("<nav><a href=/>Home</a></nav>" + wrapper.format(inner + more))) == TEXT
    related = '<div class="related-posts"><article><p>Another.</p></article></div>'
    assert html_text.main_text(page(ARTICLE + related)) == TEXT


#: Markup that is broken off or that HTML does not have.
BROKEN = {
    "<p>ok</p><![ x": "ok <![ x", "<![>": "", "<![foo[ x ]]>": "", "if (x <![0] )": "if (x <![0] )", "<p>a<![CDATA[b<c]]>d</p>": "ad", "<p>a<![CDATA[b>d</p>": "ad", "<p>a<![endif]-->b</p>": "ab",
    "<p>a<!-- b <p>c": "a<!-- b c", "<p>a</p": "a</p", "<?php x": "<?php x", "<!doctype": "<!doctype", "<p>1 <2 and 3> 2</p>": "1 <2 and 3> 2", "<": "<", "</": "</", "<!": "<!", "<!--": "<!--", "<script>x<p>y": "",
    "<p>a&#" + "9" * 6000 + ";b&#00000000065;c&#x0000000041;": "a\ufffdbAcA", "<p>x <!-- c --> y</p>": "x y", "<a href=\"x>y<p>z</p>": "<a href=\"x>y z", "&#x110000;&#0;": "\ufffd\ufffd",
}


def test_broken_markup_ends_no_job(spark):
    pages = [*BROKEN, "<p>good</p>"]
    df = spark.createDataFrame([(i, None, h) for i, h in enumerate(pages)], "page_id bigint, url string, html string")
    got = {pages[r["page_id"]]: r["text"] for r in html_text.extract(df).collect()}
    assert got == {**BROKEN, "<p>good</p>": "good"}


@pytest.mark.parametrize(
    "piece", ["<a ", "<!--", "<!-- >", "</a ", "<?", "<![", "<![CDATA[", "<!x", "<a x=\"", "<a x='\">", "<script>", "</scrip", "&#1", "<", "<a/", "<a =", "<a x=\">\" ", "<b>", "-- ", "<!DOCTYPE "]
)
@pytest.mark.parametrize("end", ["", ">", "x=\">\" "])
def test_a_megabyte_of_markup_without_ends_takes_seconds(piece, end):
    began = time.process_time()
    html_text.main_text(piece * (1_000_000 // len(piece)) + end)
    assert time.process_time() - began < 20


@pytest.mark.parametrize(
    "block",
    ["div class=share-price", "section class=related-work", "div id=search-strategy", "table class=form-factors", "figure class=banner-photo", "div class=copyright-law-section", "section class=public-notice", "div class=skip-level-meetings"],
)
def test_blocks_of_an_article_stay_whatever_they_are_about(block):
    tag = block.split()[0]
    words = "<tr><td>Words of it.</td></tr>" if tag == "table" else "Words of it."
    assert html_text.main_text(page(f"<article><p>First.</p><{block}>{words}</{tag}><p>Last one.</p></article>")) == "First. Words of it. Last one."
    links = "".join(f"<a href={i}>Elsewhere {i}</a> " for i in range(6))
    if tag != "table":
        assert html_text.main_text(page(f"<article><p>First.</p><{block}>{links}</{tag}><p>Last one.</p></article>")) == "First. Last one."


@pytest.mark.parametrize("name", ["ad", "ad-slot-3", "share-buttons", "social share", "related-posts", "newsletter-signup", "cookie-notice", "comment-list", "promo-box", "sidebar-left", "search-form", "copyright", "skip-link", "advert-price", "promo-price"])
def test_named_blocks_that_are_no_article_go(name):
    assert html_text.main_text(page(f'<article><p>First.</p><div class="{name}">Words of it.</div><p>Last one.</p></article>')) == "First. Last one."


def brute_marks(values):
    """Smoothing and clustering by the letter: a weighted mean of up to five lines, then the best split of all into two."""
    out = []
    for i in range(len(values)):
        w = {j: np.exp(-0.5 * (i - j) ** 2) for j in range(max(0, i - 2), min(len(values), i + 3))}
        out.append(np.log1p(sum(values[j] * x for j, x in w.items()) / sum(w.values())))
    spread = lambda xs: sum((x - np.mean(xs)) ** 2 for x in xs)
    cuts = sorted(set(out))[:-1]
    best = min(cuts, key=lambda c: spread([x for x in out if x <= c]) + spread([x for x in out if x > c])) if cuts else -1
    return [x > best or x >= np.log1p(html_text.SURE) for x in out]


def test_clusters_against_all_splits():
    rnd = random.Random(4)
    for _ in range(60):
        shape = [rnd.choice((4, 300)) for _ in range(rnd.randint(1, 6))]
        values = [max(0.0, rnd.gauss(m, m / 5)) for m in shape for _ in range(rnd.randint(4, 9))]
        assert html_text.content_lines(np.array(values)).tolist() == brute_marks(values)


PARAGRAPHS = "".join(f"<p>{'A sentence of the story that goes on for a while, as sentences do. ' * k}</p>" for k in (2, 3, 1, 4)) + "<p>Short end.</p>"
STORY = " ".join(f"{'A sentence of the story that goes on for a while, as sentences do. ' * k}".strip() for k in (2, 3, 1, 4)) + " Short end."
LINKS = "".join(f"<li><a href={i}>Entry {i}</a></li>" for i in range(12))


@pytest.mark.parametrize(
    "source",
    [
        f"<div><ul>{LINKS}</ul></div><div><h1>Title</h1>{PARAGRAPHS}</div><div><span>One</span><br><b>Two</b><br>Three</div>",
        f"<table><tr><td>{LINKS}</td><td><h1>Title</h1>{PARAGRAPHS}</td><td>{'<b>x</b> <i>y</i><br>' * 9}</td></tr></table>",
        f"<div><div><h1>Title</h1>{PARAGRAPHS}</div><div>{'<p>posted by <a href=1>ann</a> in <a href=2>news</a></p>' * 9}</div></div>",
    ],
)
def test_ratios_decide_where_no_element_bounds_the_article(source, monkeypatch):
    assert html_text.main_text(page(source)) == f"Title {STORY}"
    monkeypatch.setattr(html_text, "content_lines", lambda r: np.ones(len(r), bool))
    assert html_text.main_text(page(source)) != f"Title {STORY}"


def test_every_article_and_what_only_sounds_like_a_menu_stay():
    two = f"<article>{PARAGRAPHS}</article><article><p>A short one.</p></article>"
    assert html_text.main_text(page(two)) == f"{STORY} A short one."
    teaser = f"<article>{PARAGRAPHS}</article><article><a href=1>Another story of ours</a></article>"
    assert html_text.main_text(page(teaser)) == STORY
    assert html_text.main_text(page(f'<article><p class="share-price">Shares rose.</p>{PARAGRAPHS}</article>')) == f"Shares rose. {STORY}"
    assert html_text.main_text(page(f'<article><div class="story rail-photo">{PARAGRAPHS}</div><p>Then.</p></article>')) == f"{STORY} Then."


def test_deep_pages_take_time_in_proportion():
    import time

    for nest in ("<div>x", "<b>", "<p><i>y", "<ul><li>z", "<div></x>"):
        took = []
        for n in (4_000, 16_000):
            began = time.process_time()
            html_text.main_text(nest * n)
            took.append(time.process_time() - began)
        assert took[1] < 10 * took[0] + 0.5, (nest, took)


def test_pages_of_every_kind(spark):
    rows = [(1, "u", page(ARTICLE), 9), (1, "u", page(ARTICLE), 9), (None, None, None, 1), (3, "v", page(f"<article><p>{LONG}</p></article>"), 2)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int").withColumn("text", F.lit("clash"))
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(df).collect()), key=repr)
    assert got == sorted([(1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (None, "", 0), (3, LONG.strip(), len(LONG.strip()))], key=repr)
    assert html_text.extract(df.limit(0)).count() == 0


def test_pages_of_the_fixture(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.sub(r"</?(?:p|h1|br)[^>]*>", "\n", re.sub(r"<script.*?</script>", "", inner, flags=re.S))
        assert html_text.main_text(r["html"]) == " ".join(html.unescape(re.sub(r"<[^>]*>", "", blocks)).split())


def base_spans(text):
    """The contract read literally, one match after another."""
    name = "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY])"
    assign = re.compile(name + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [x[2] for x in sorted(out)]


def test_secrets_against_the_contract(spark):
    rnd = random.Random(5)
    parts = ['token = "', "Password:", "api_key='", "APIKEY=", "secret", "AKIA" + "Z9" * 8, "AKIA" + "Z" * 15, "ab" * 12, "ab" * 11 + "c", "paſſword=abcdefgh", "é", " ", "=", ":", "x1y2z3", "abc", "\n"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(400)] + ["", None, "token=" + "f" * 30, LONG + "ab" * 20]
    df = spark.createDataFrame([(i // 2 if i % 7 else None, t, "c") for i, t in enumerate(texts)], f"{DOCS}, spans string")
    rows = secrets.find_secrets(df).collect()
    assert len(rows) == len(texts)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in rows)
    want = []
    for i, t in enumerate(texts):
        spans = base_spans(t or "")
        n = [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]
        want.append((i // 2 if i % 7 else -1, *n, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert got == sorted(want)
    assert all(set(base_spans(t or "")) <= {f"{k}:{s}:{e}" for k, s, e in secrets.scan(t or "", {})} for t in texts)
    assert secrets.find_secrets(df.limit(0)).count() == 0


def key(rnd, letters, n):
    return "".join(rnd.choice(letters) for _ in range(n))


PLACES = ("the {} and", "session_id={}", "x={}", "https://h.example/a-b/{}?q", "a/b/{}/c", "id_{}")
KEYS = {
    "base62": (string.ascii_letters + string.digits, 40), "base64url": (string.ascii_letters + string.digits + "-_", 43), "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32),
    "digits": (string.digits, 40), "upper hex": ("0123456789ABCDEF", 40), "short": (string.ascii_letters + string.digits, 20), "lower": (string.ascii_lowercase + string.digits, 32),
}
NO_KEYS = ("this_is_a_long_identifier_name", "https://example.com/articles/some-long-title-of-a-page", "Donaudampfschifffahrtsgesellschaft", "NotificationCenterDelegateProxy", "1" * 30,
           "2024-01-02_03-04-05_backup", "MAX_BUFFER_SIZE_OF_CONNECTION", "00000000000000000042", "aaaaaaaaaaaaaaaaaaaaaaaa", "getUserAccountSettingsByName", "electroencephalographically")


@pytest.mark.parametrize("kind", sorted(KEYS))
def test_random_keys_pass_the_battery_wherever_they_stand(kind):
    rnd = random.Random(1)
    letters, n = KEYS[kind]
    for place in PLACES:
        at, found = place.index("{}"), 0
        for _ in range(200):
            # A key whose cuts are marks of its own alphabet may be found with what stands before it.
            found += any(s <= at and e >= at + n and p >= secrets.LEVELS[0] for s, e, _, p in secrets.candidates(place.format(key(rnd, letters, n))))
        assert found >= (190 if kind != "base64url" or place in PLACES[:3] else 150), (place, found)


def test_words_and_numbers_fail_the_battery():
    for words in NO_KEYS:
        assert all(p < secrets.LEVELS[0] for *_, p in secrets.candidates(f"a {words} b")), words


def test_battery_gives_p_values():
    rnd = random.Random(3)
    p = [secrets.combined(secrets.battery(key(rnd, *KEYS["base62"]), "base62").values()) for _ in range(2000)]
    for t in secrets.LEVELS:
        assert abs(np.mean([x < t for x in p]) - t) < max(0.015, 0.25 * t)


def test_cutoffs_rise_where_words_look_random():
    level = (*secrets.LEVELS, secrets.SURELY)
    even = {t: round(10_000 * (1 - t)) for t in level}
    mixed = {t: even[t] + (3_000 if t < 0.01 else 0) for t in level}
    one = {t: int(t <= 0.3) for t in level}
    words = {0.001: 703, 0.003: 400, 0.01: 150, 0.03: 60, 0.1: 12, 0.3: 2, 0.5: 0}
    assert secrets.cutoffs({"a": even, "b": mixed, "c": one, "d": words}) == {"a": 0.001, "b": 0.01, "c": 0.001, "d": 0.5}


def plain_battery(token, letters):
    """The three tests written out in plain loops, the chi-squared tail summed exactly where it can be."""
    x, n, k = [letters.index(c) for c in token], len(token), len(letters)
    bins = [b for b in ("".join(c for c in chars if c in letters) for chars in secrets.BINS) if b]
    cells, o, e = [], 0, 0.0
    for b in bins:
        o, e = o + sum(letters[i] in b for i in x), e + n * len(b) / k
        if e >= secrets.LEAST_EXPECTED:
            cells.append([o, e])
            o, e = 0, 0.0
    if e and cells:
        cells[-1] = [cells[-1][0] + o, cells[-1][1] + e]
    chi, df = sum((o - e) ** 2 / e for o, e in cells), len(cells) - 1
    # The tail by the trapezoid rule over the density.
    grid = np.linspace(0, chi, 20_001)[1:]
    density = grid ** (df / 2 - 1) * np.exp(-grid / 2) / (2 ** (df / 2) * math.gamma(df / 2))
    uniform = 1 - float(np.trapezoid(density, grid)) if df > 0 else 1.0
    high = [i >= k / 2 for i in x]
    n1, n2 = sum(high), n - sum(high)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean, var = 1 + 2 * n1 * n2 / n, 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))
    p_runs = math.erfc(abs(runs - mean) / math.sqrt(2 * var))
    m = sum(x) / n
    r = sum((a - m) * (b - m) for a, b in zip(x, x[1:], strict=False)) / sum((a - m) ** 2 for a in x)
    product = uniform * p_runs * math.erfc(abs((r + 1 / n) * math.sqrt(n)) / math.sqrt(2))
    y = -math.log(max(product, 1e-300))
    return math.exp(-y) * (1 + y + y * y / 2)


@pytest.mark.parametrize("encoding", ["hex", "base32", "base36", "base62", "base64"])
def test_battery_against_plain_loops(encoding):
    rnd = random.Random(4)
    for n in (20, 33, 64):
        for _ in range(40):
            token = key(rnd, secrets.ALPHABETS[encoding], n)
            if len(set(token)) > 3 and secrets.infer_encoding(token) == encoding:
                got = secrets.combined(secrets.battery(token, encoding).values())
                assert abs(got - plain_battery(token, secrets.ALPHABETS[encoding])) < 0.02, token


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_keys_are_found_whatever_the_table_holds(sf):
    """Recall after the cut-offs, keys alone and in groups planted among the given documents, which hold thousands of words that are as long."""
    import pyarrow.parquet as pq

    def histogram(texts, into):
        for t in texts:
            for s, e, c, p in secrets.examined(t or "")[1]:
                of = into.setdefault(secrets._class(c, e - s), dict.fromkeys((*secrets.LEVELS, secrets.SURELY), 0))
                for level in of:
                    of[level] += p >= level
        return into

    background = histogram(pq.read_table(f"/root/testdata/{sf}/documents.parquet", columns=["text"]).column(0).to_pylist(), {})
    alphabets = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": secrets.ALPHABETS["base32"], "base36": secrets.ALPHABETS["base36"], "base62": secrets.ALPHABETS["base62"], "base64": secrets.ALPHABETS["base64"], "digits": "0123456789"}
    rnd = random.Random(9)
    for name, letters in alphabets.items():
        for n in (20, 23) if name in ("hex", "digits") else (20, 40):  # from 24 on these are a base kind
            for group in (1, 5, 10, 20):
                found = total = 0
                for _ in range(max(6, 200 // group)):
                    keys = [f"the {key(rnd, letters, n)} and" for _ in range(group)]
                    cuts = secrets.cutoffs(histogram(keys, {k: dict(v) for k, v in background.items()}))
                    for k in keys:
                        found += any(kind == "random" and s <= 4 and e >= 4 + n for kind, s, e in secrets.scan(k, cuts))
                    total += group
                assert found >= 0.9 * total, (name, n, group, found, total)


def test_clean_words_of_the_table_are_no_secrets():
    import pyarrow.parquet as pq

    for text in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column(0).to_pylist():
        assert all(c == "digits" for *_, c, p in secrets.examined(text or "")[1] if p >= secrets.LEVELS[0])


def test_long_runs_of_letters_are_examined():
    rnd = random.Random(6)
    assert not secrets.candidates("a " + key(rnd, string.ascii_lowercase, 31) + " b")
    assert sum(p >= secrets.LEVELS[0] for _ in range(100) for *_, p in secrets.candidates("a " + key(rnd, string.ascii_letters, 48) + " b")) >= 90
    assert all(p < secrets.LEVELS[0] for *_, p in secrets.candidates("verkehrsinfrastrukturfinanzierungsgesellschaft x"))


def test_secrets_by_their_class_in_the_table(spark):
    """Spans of all rows, by a loop over all candidates; the cut-off of a class follows from the whole table."""
    rnd = random.Random(2)
    rows = [(i, " ".join([rnd.choice(NO_KEYS), PLACES[i % 6].format(key(rnd, *KEYS[sorted(KEYS)[i % 7]])) if i % 3 else "plain words"]), "c") for i in range(500)]
    rows += [(None, None, "c"), (7, "", "c"), (8, "x=" + "Ab1" * 300_000, "c")]
    df = spark.createDataFrame(rows, f"{DOCS}, spans string")
    each = [secrets.examined(t or "") for _, t, _ in rows]
    count = {}
    for _, others in each:
        for s, e, c, p in others:
            for t in (*secrets.LEVELS, secrets.SURELY):
                of = count.setdefault(secrets._class(c, e - s), dict.fromkeys((*secrets.LEVELS, secrets.SURELY), 0))
                of[t] += p >= t
    cuts = secrets.cutoffs(count)
    want = sorted((i if i is not None else -1, ",".join(f"{k}:{s}:{e}" for k, s, e in secrets.scan(t or "", cuts))) for i, t, _ in rows)
    got = secrets.find_secrets(df).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["spans"]) for r in got) == want
    assert sum(r["n_random"] for r in got) >= 260


def test_redacted_texts(spark):
    df = spark.createDataFrame([(1, "a token=abcdefgh b", 18, "k"), (2, None, None, "k"), (3, "clean", 5, "k")], f"{DOCS}, n_chars bigint, extra string")
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["extra"]) for r in secrets.redact(df).collect()}
    assert got == {1: ("a [SECRET] b", 12, "k"), 2: (None, None, "k"), 3: ("clean", 5, "k")}


def test_language_accuracy_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    filters = language_id.fit(docs.where(~language_id.held_out("doc_id")))
    held = language_id.predict(docs.where(language_id.held_out("doc_id")), filters)
    assert held.where("lang_pred = lang").count() >= 0.98 * held.count()
    odd = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "123 !?", 1), (None, "the", 1), (5, LONG, 1), (5, LONG, 1), (6, "\U0001d400", 1)], f"{DOCS}, score int")
    rows = language_id.predict(odd, filters).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows[:3]] == [("und", 0.0)] * 3
    assert [r["lang_pred"] for r in rows[3:6]] == ["en"] * 3 and all(0 <= r["score"] <= 1 for r in rows)
    assert language_id.predict(odd.limit(0), filters).count() == 0
    assert language_id.Filters.build({}).predict("abc") == ("und", 0.0)


def plain_grams(text):
    """The n-grams of a text's words as strings, a mark at either end of a word."""
    t = "\0" + "".join(c if c.isalpha() else "\0" for c in text.lower()) + "\0"
    return [g for n in language_id.SIZES for i in range(len(t) - n + 1) if "\0" not in (g := t[i : i + n])[1:-1]]


def test_predictions_against_sets_of_strings(spark):
    """Each language's n-grams as plain sets, with no filter and no hash: the masks hold all languages of an n-gram, and counts decide alike."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    filters = language_id.fit(docs.where(~language_id.held_out("doc_id")))
    rows = docs.withColumn("held", language_id.held_out("doc_id")).collect()
    seen, n_docs = {}, {}
    for r in rows:
        if not r["held"] and r["lang"] and r["text"] is not None:
            n_docs[r["lang"]] = n_docs.get(r["lang"], 0) + 1
            for g in set(plain_grams(r["text"])):
                seen.setdefault(r["lang"], {}).setdefault(g, 0)
                seen[r["lang"]][g] += 1
    held = {lang: {g for g, n in found.items() if n >= max(language_id.SHARE * n_docs[lang], 2 if n_docs[lang] >= 20 else 1)} for lang, found in seen.items()}
    names = sorted(held)
    for g in sorted({g for found in held.values() for g in found if len(g) == 3 and "\0" not in g})[::7]:
        of_three = next(language_id.gram_hashes(g))  # of the word's beginning, all of it, and its end
        mask = int(filters.masks(of_three)[1])
        assert all(mask >> i & 1 for i, x in enumerate(names) if g in held[x]), g
    wrong = 0
    for r, got in zip(rows, language_id.predict(docs, filters).collect(), strict=True):
        grams = plain_grams(r["text"] or "")
        if grams:
            counts = {x: sum(math.log((len(names) + 1) / m) for g in grams if g in held[x] and (m := sum(g in held[y] for y in names))) for x in names}
            wrong += max(names, key=lambda x: (counts[x], -names.index(x))) != got["lang_pred"]
            share = sum(g in held[got["lang_pred"]] for g in grams) / len(grams)
            assert abs(share - got["score"]) < 0.02
        else:
            assert (got["lang_pred"], got["score"]) == ("und", 0.0)
    assert wrong <= 1


def test_more_languages_than_a_mask_word_holds(spark):
    rnd = random.Random(5)
    vocabulary = {f"l{k:02}": ["".join(rnd.choice(string.ascii_lowercase) for _ in range(7)) for _ in range(12)] for k in range(70)}
    rows = [(10 * k + i, " ".join(vocabulary[name]), name) for k, name in enumerate(sorted(vocabulary)) for i in range(2)]
    df = spark.createDataFrame(rows, f"{DOCS}, lang string")
    filters = language_id.fit(df)
    assert filters.languages == sorted(vocabulary)
    got = language_id.predict(df, filters).collect()
    assert len(got) == 140 and all(r["lang_pred"] == r["lang"] and r["score"] > 0.9 for r in got)


def test_pieces_of_a_long_text_give_the_same_grams(monkeypatch):
    text = "ab cde fghij " * 50 + "é"
    whole = np.sort(np.concatenate(list(language_id.gram_hashes(text))))
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert (np.sort(np.concatenate(list(language_id.gram_hashes(text)))) == whole).all()


def test_filters_against_sets_of_grams():
    grams = {name: np.concatenate(list(language_id.gram_hashes(t))) for name, t in (("a", "alpha beta gamma"), ("b", "delta epsilon beta"))}
    f = language_id.Filters.build(grams)
    assert (f.masks(grams["a"]) & 1).all() and (f.masks(grams["b"]) & 2).all()
    assert f.predict("alpha gamma")[0] == "a" and f.predict("delta")[0] == "b"


def test_token_counts_against_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_counts.tokenizer_path("byte_bpe_50k.json"))
    texts = ["", None, "a", "a<|endoftext|>b", "<|endoftext|>", "été déjà vu", "日本語のテキスト", "x" * 5000, "  \n\n\t mixed   space ", "don't it's I'LL", "🙂 ok", "1234567 89", "ß" * 300, LONG[:50_000]]
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).collect()]
    rows = [(i if i % 9 else None, t, 1) for i, t in enumerate([*texts, *docs, *texts])]
    df = spark.createDataFrame(rows, f"{DOCS}, n_tokens int")
    cache = str(tmp_path / "cache")
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t, _ in rows)
    for ranks in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.tiktoken", None):  # the second run finds all in the cache, the third has another version
        got = token_counts.count_tokens(df, cache, ranks=ranks).collect()
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    cached = spark.read.parquet(cache)
    assert cached.count() / 2 == len({t or "" for _, t, _ in rows}) == cached.select("digest").distinct().count()
    assert token_counts.count_tokens(df.limit(0), str(tmp_path / "other")).count() == 0


@pytest.mark.parametrize("most", [0, 20_000])
def test_only_texts_that_the_cache_lacks_are_encoded(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(token_counts, "BROADCAST_KEYS", most)
    cache = str(tmp_path / "cache")
    first = spark.createDataFrame([(i % 5, f"text {i % 7}") for i in range(40)], DOCS)
    second = spark.createDataFrame([(9, f"text {i}") for i in range(4, 12)] * 2 + [(None, "text 11"), (None, None)], DOCS)
    token_counts.count_tokens(first, cache, ranks="byte_bpe_50k.tiktoken").collect()
    before = {r["digest"]: r["n_tokens"] for r in spark.read.parquet(cache).collect()}
    # Counts that the cache holds are taken from it: it says so, though the numbers here are not the library's.
    files = spark.read.parquet(cache).withColumn("n_tokens", F.col("n_tokens") + 1000)
    files.write.partitionBy("version").parquet(str(tmp_path / "changed"))
    got = token_counts.count_tokens(second, str(tmp_path / "changed"), ranks="byte_bpe_50k.tiktoken").collect()
    assert len(got) == 18 and sum(r["n_tokens"] >= 1000 for r in got) == 6
    after = spark.read.parquet(str(tmp_path / "changed"))
    assert after.count() == after.select("digest").distinct().count() == len(before) + 6


def test_both_encoders_agree_on_every_character_of_the_fast_path():
    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    fast, library = token_counts._counter(path, token_counts.tokenizer_path("byte_bpe_50k.tiktoken")), token_counts._counter(path, None)
    for c in map(chr, [*range(1, 0x300), *range(0x2000, 0x2070), 0x3000, 0xFEFF]):
        for t in (c, f"a{c}b", f" {c} ", f"1{c}2", f"{c}{c} {c}"):
            assert fast(t) == library(t), repr(t)
