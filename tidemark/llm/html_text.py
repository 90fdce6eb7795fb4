"""HTML extraction: parser events, text-to-tag ratios per line, smoothing and clustering pick the content region."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

# Fixed values of HTML: elements without content, and elements that begin a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose text is never the article's.
DROPPED = frozenset(
    "script style noscript template head title nav header footer aside form button select textarea menu dialog iframe object svg canvas audio video search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert status menu menubar toolbar".split())
#: Words in a class or id of a container that mark what is no article: menus, page frames, sidebars, notices, adverts, forms and reader comments.
MARKS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar sidebar sidenav rail aside widget widgets "
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay paywall newsletter subscribe subscription signup login search share sharing social related recommended recommendations teaser teasers "
    "comment comments commentlist respond replies reply disqus form copyright disclaimer skip".split()
)
#: Those of them that are also words of what articles are about, and words that only say how a page is laid out. Inside an article, a container whose name has one of
#: the first, and beside it any word that is in none of these lists, is taken for the article's unless it is mostly links.
COMMON = frozenset("share sharing social related recommended search form banner notice notices notification alert copyright disclaimer skip rail aside overlay promotion respond reply replies header head top".split())
LAYOUT = frozenset(
    "box block boxes blocks container wrapper wrap inner outer list lists item items post posts page pages site link links button buttons btn bar area areas section sections content left right top bottom center main col cols column columns "
    "row rows grid title heading head body text module modules component panel card cards region slot unit zone holder icon icons logo image images img desktop mobile sticky fixed field fields input label group global primary secondary "
    "article articles story stories news more tools tool dialog bottom small large wide full hidden visible new js id".split()
)
#: These mark it when they are the whole name, or name a part of the page and not of the article.
HEADERS = frozenset("header head top siteheader pageheader".split())
#: Words in a class or id that speak for an article: beside one of MARKS, the ratios decide.
STORY = frozenset("article story content post entry body main text".split())
#: Elements that a name can drop; and those whose lines are judged together where no article bounds the region.
NAMED = frozenset("div section article center fieldset figure details dl ol table ul hgroup address".split())
CONTAINERS = frozenset("html body main article section div td th center form fieldset details".split())
#: Closed by an opening of one of these, up to the nearest of the others.
CLOSES = {
    "p": (BLOCK - {"br", "option", "td", "th", "tr"}, frozenset("td th li dd dt div section article main body blockquote".split())),
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset("td th tr tbody".split()), frozenset(["table"])),
    "th": (frozenset("td th tr tbody".split()), frozenset(["table"])),
    "tr": (frozenset("tr tbody tfoot".split()), frozenset(["table"])),
    "option": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "head": (frozenset(["body"]), frozenset(["html"])),
}
#: What an opening tag may close.
CLOSED_BY = {tag: frozenset(k for k, (by, _) in CLOSES.items() if tag in by) for tag in set().union(*(by for by, _ in CLOSES.values()))}
#: Readers' comments can be longer than the article, so length alone does not bring these back.
COMMENTS = frozenset("comment comments commentlist respond replies reply disqus".split())
#: An element that goes by such a tag or role alone is looked at again, as names are.
FORMS = frozenset(["form"])
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
LINKED = 0.5
#: Characters a tag from which a line is content wherever the clusters part.
SURE = 80.0
#: What its tag, role or name says of an element.
PLAIN, HARD, NAMED_SO, MIXED, COMMENT, TOPIC = range(6)
#: Reading tags that never close may cost so many times the page's length; after that a tag has to close within so many characters.
PATIENCE, SHORT_TAG = 8, 128
#: Numbers of character references with more digits than any character has.
LONG_REFERENCE = re.compile(r"&#(?:([0-9]{8,})|[xX]([0-9a-fA-F]{8,}));?")


def _kind(tag: str, attrs: dict[str, str]) -> int:
    """HARD: goes whatever it holds. NAMED_SO: goes, as a form or by its name, unless it holds the article. MIXED: its name says both. COMMENT: named as readers' comments.
    TOPIC: its name has a mark that is a common word, beside words of its own: inside an article it goes only if it is mostly links."""
    role = attrs.get("role", "").lower()
    if tag in DROPPED - FORMS or role in ROLES - FORMS or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return HARD
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return HARD
    if tag not in NAMED and tag not in FORMS and role not in FORMS:
        return PLAIN
    marked, story, comment = tag in FORMS or role in FORMS, False, False
    topic = not marked
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = [w.lower() for w in NAME.findall(name)]
        if not words or words[0] in ("has", "with", "no", "is", "js"):
            continue
        comment |= not COMMENTS.isdisjoint(words)
        story |= not STORY.isdisjoint(words)
        if tag == "article":
            # An article that is a reader's comment or a teaser goes; one with such a word beside others stays.
            marked |= words[0] in ("comment", "reply", "teaser", "promo", "ad", "related")
        else:
            this = not MARKS.isdisjoint([*words, "".join(words)]) or "".join(words) in HEADERS or (words[-1] == "header" and words[0] in ("site", "page", "main", "global", "top"))
            marked |= this
            # Every name that marks the element has to have words of its own.
            topic &= not this or (MARKS.isdisjoint({*words, "".join(words)} - COMMON) and any(w not in MARKS | LAYOUT and not w.isdigit() for w in words))
    return (COMMENT if comment else MIXED if story and tag != "article" else TOPIC if topic and tag != "article" else NAMED_SO) if marked else PLAIN


class _Page(HTMLParser):
    """A page's lines, ``(text, tags, linked characters, innermost element)``, and its elements, each with tag, parent and kind.

    Elements are numbered in their order, so a parent comes before what it holds; number 0 holds all. Lines name one
    element, not all around it, so memory grows with the page and not with its depth.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.kind = ["html"], [0], [PLAIN]
        self.stack: list[tuple[str, int, bool]] = []  # tag, number, whether it drops its text
        self.open: Counter[str] = Counter()
        self.drops = self.links = self.tags = self.linked = 0
        self.text: list[str] = []
        self.lines: list[tuple[str, int, int, int]] = []
        self.spent = 0

    def read(self, source: str) -> None:
        """Parses a whole page at once, so that what has no end is known to have none.

        A markup without its end is text from its first sign on. Searches for an end that cannot be found are not made, and those for the ends of tags are
        limited in sum, so the time is in proportion to the page, whatever is left open in it.
        """
        self.rawdata = LONG_REFERENCE.sub(_short_reference, source)
        # After these places nothing of the kind ends.
        self.last = {sign: self.rawdata.rfind(sign) for sign in (">", "-->", "]]>")}
        self.comments_end = True
        try:
            self.close()
        except (AssertionError, ValueError):
            # An input that the standard library's parser gives up on: what was read up to there stays.
            pass
        self.flush()

    def as_text(self, at: int) -> int:
        self.handle_data(self.rawdata[at : at + 1])
        return at + 1

    def parse_starttag(self, i: int) -> int:
        whole = self.rawdata
        if i > self.last[">"]:
            return self.as_text(i)
        if self.spent <= PATIENCE * len(whole):
            k = super().parse_starttag(i)
            if k < 0:
                self.spent += len(whole) - i
        else:
            self.rawdata = whole[i : i + SHORT_TAG]
            try:
                k = super().parse_starttag(0)
            finally:
                self.rawdata = whole
            k += i if k >= 0 else 0
        return k if k >= 0 else self.as_text(i)

    def parse_endtag(self, i: int) -> int:
        return super().parse_endtag(i) if i < self.last[">"] else self.as_text(i)

    def parse_pi(self, i: int) -> int:
        return super().parse_pi(i) if i < self.last[">"] else self.as_text(i)

    def parse_comment(self, i: int, report: bool = True) -> int:
        k = super().parse_comment(i, report) if self.comments_end else -1
        # Of a comment that does not end no later one does.
        self.comments_end = k >= 0
        return k if k >= 0 else self.as_text(i)

    def parse_html_declaration(self, i: int) -> int:
        if i > self.last[">"]:
            return self.as_text(i)
        if self.rawdata.startswith("<![", i):
            return self.parse_marked_section(i)
        return super().parse_html_declaration(i)

    def parse_marked_section(self, i: int, report: bool = True) -> int:
        """Up to its end if it is character data, else up to the next end of a tag: HTML has no others, and takes them for comments."""
        data = self.rawdata[i + 3 : i + 9].upper() == "CDATA[" and i < self.last["]]>"]
        return self.rawdata.find("]]>", i) + 3 if data else self.rawdata.find(">", i) + 1

    def flush(self) -> None:
        if self.text and (line := " ".join("".join(self.text).split())):
            self.lines.append((line, self.tags, min(self.linked, len(line)), self.stack[-1][1] if self.stack else 0))
            self.tags = self.linked = 0
        self.text = []

    def pop(self, at: int) -> None:
        for tag, _, drops in reversed(self.stack[at:]):
            if tag in BLOCK:
                self.flush()
            self.drops -= drops
            self.links -= tag == "a"
            self.open[tag] -= 1
            self.stack.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if any(self.open[k] for k in CLOSED_BY.get(tag, ())):
            for i in range(len(self.stack) - 1, -1, -1):
                closed_by, stops = CLOSES.get(self.stack[i][0], ((), ()))
                if tag in closed_by:
                    self.pop(i)
                    break
                if self.stack[i][0] in BLOCK and self.stack[i][0] != "p" and (self.stack[i][0] in stops or not closed_by):
                    break
        if tag in BLOCK:
            self.flush()
        self.tags += not self.drops
        if tag in VOID:
            return
        kind = _kind(tag, {k: v or "" for k, v in attrs})
        self.tag.append(tag)
        self.parent.append(self.stack[-1][1] if self.stack else 0)
        self.kind.append(kind)
        self.stack.append((tag, len(self.tag) - 1, kind == HARD))
        self.open[tag] += 1
        self.drops += kind == HARD
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.open[tag]:
            self.pop(next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag))
        elif tag in BLOCK:
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.drops:
            self.text.append(data)
            if self.links:
                self.linked += len(data.strip())


def _short_reference(m: re.Match) -> str:
    """The reference without zeros before it; what is no character is the replacement character."""
    digits = (m[1] or m[2]).lstrip("0") or "0"
    return f"&#{'x' if m[2] else ''}{digits};" if len(digits) < 8 else "\ufffd"


def smoothed(ratios: np.ndarray, radius: int = 2) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; the kernel is renormalised at both ends."""
    kernel = np.exp(-0.5 * np.arange(-radius, radius + 1) ** 2 / max(1.0, radius / 2) ** 2)
    full = lambda x: np.convolve(x, kernel)[radius : radius + len(x)]
    return full(ratios) / full(np.ones(len(ratios)))


def ratios(lines: list[tuple[str, int, int, int]]) -> np.ndarray:
    """Characters outside links a tag, line by line."""
    return np.array([(len(text) - linked) / max(1, tags) for text, tags, linked, _ in lines])


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Lines of the higher of two clusters of smoothed ratios, by two means of their logarithms begun at least and most; and all from SURE on."""
    x = np.log1p(smoothed(ratios))
    low, high = x.min(), x.max()
    for _ in range(20):
        cut = (low + high) / 2
        if not (x > cut).any() or (x > cut).all():
            return x >= min(cut, np.log1p(SURE))
        moved = x[x <= cut].mean(), x[x > cut].mean()
        if moved == (low, high):
            break
        low, high = moved
    return x > min((low + high) / 2, np.log1p(SURE))


def _gone(page: _Page) -> list[bool]:
    """Which elements go, by their names or as a form, with all they hold.

    One of them that is inside an article and whose name has words of its own (TOPIC) stays unless it is mostly links.
    Any other stays if it holds more text of an article or main part than stands in others outside such elements; if it holds most
    of the text that the ratios mark, readers' comments apart; and, where its name says both, if most of its own text is marked. Inner
    elements are decided first, and what goes in them does not count.
    """
    n, doubtful = len(page.tag), [k in (NAMED_SO, MIXED, COMMENT, TOPIC) for k in page.kind]
    gone = [False] * n
    if not any(doubtful) or not page.lines:
        return gone
    inside, doubted, commented = [False] * n, list(doubtful), [k == COMMENT for k in page.kind]
    for i in range(1, n):
        p = page.parent[i]
        inside[i] = inside[p] or page.tag[i] in ("article", "main")
        doubted[i], commented[i] = doubted[i] or doubted[p], commented[i] or commented[p]
    # Comments are set aside first: long ones would lift the lines beside them.
    told = [i for i, x in enumerate(page.lines) if not commented[x[3]]]
    marks = np.zeros(len(page.lines), bool)
    if told:
        marks[told] = content_lines(ratios([page.lines[i] for i in told]))
    plain, marked, article, links = [0] * n, [0] * n, [0] * n, [0] * n
    total = free = 0
    for (text, _, linked, at), m in zip(page.lines, marks.tolist(), strict=True):
        size = len(text) - linked
        plain[at] += size
        links[at] += linked
        marked[at] += size * m
        total += size * m
        free += size * (inside[at] and not doubted[at])
    for i in range(n - 1, 0, -1):
        if doubtful[i]:
            holds = article[i] > free or (page.kind[i] != COMMENT and not free and marked[i] > total / 2) or (page.kind[i] == MIXED and marked[i] > plain[i] / 2)
            if page.kind[i] == TOPIC and inside[i]:
                holds |= links[i] <= LINKED * (plain[i] + links[i])
            if not holds:
                gone[i] = True
                continue
        elif page.tag[i] in ("article", "main"):
            article[i] = plain[i]
        p = page.parent[i]
        plain[p], marked[p], article[p], links[p] = plain[p] + plain[i], marked[p] + marked[i], article[p] + article[i], links[p] + links[i]
    for i in range(1, n):
        gone[i] = gone[i] or gone[page.parent[i]]
    return gone


def _outermost(page: _Page, tag: str) -> list[int]:
    """The outermost element of a tag around each element, 0 without any."""
    out = [0] * len(page.tag)
    for i in range(1, len(out)):
        out[i] = out[page.parent[i]] or (i if page.tag[i] == tag else 0)
    return out


def main_text(html: str | None) -> str:
    """The article's text of a page; empty where there is none.

    Parser events become lines, one a block. Lines of elements that are no article by their tag or role are never made; those of
    containers named so, and of forms, go unless the ratios or an article inside speak for them (see _gone). Each
    line has its characters outside links a tag; smoothed ratios fall in two clusters, and the higher one marks content.
    Where a page has article elements (or else a main part), these are the region, but for those that are mostly links. Where it has
    neither, the clusters decide: the lines of each container are kept if most of their text is marked, short lines
    and headings among them too; if that is so of none, the container with most marked text is.
    """
    page = _Page()
    page.read(html or "")
    gone = _gone(page)
    lines = [x for x in page.lines if not gone[x[3]]]
    if not lines:
        return ""
    for tag in ("article", "main"):
        owner = _outermost(page, tag)
        size, linked = Counter(), Counter()
        for text, _, k, at in lines:
            size[owner[at]] += len(text)
            linked[owner[at]] += k
        kept = {o for o in size if o and linked[o] <= LINKED * size[o]} or {o for o in size if o}
        if kept:
            return " ".join(text for text, _, _, at in lines if owner[at] in kept)

    container = [0] * len(page.tag)
    for i in range(1, len(container)):
        container[i] = i if page.tag[i] in CONTAINERS else container[page.parent[i]]
    size, marked = Counter(), Counter()
    for (text, _, k, at), m in zip(lines, content_lines(ratios(lines)).tolist(), strict=True):
        size[container[at]] += len(text)
        marked[container[at]] += (len(text) - k) * m
    kept = {c for c in size if marked[c] > size[c] / 2} or {max(size, key=lambda c: (marked[c], size[c], -c))}
    return " ".join(text for text, _, _, at in lines if container[at] in kept)


def _extract_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": [main_text(h) for h in b["html"]]})


def extract(pages: DataFrame) -> DataFrame:
    """Main text of ``pages (page_id, url, html)``: page_id, url, text, n_chars; other columns are dropped.

    Pages are read one by one in their own tasks and no rows move. Time and memory grow with a page's length, however deep its elements are
    nested and whatever is left open in it: markup without an end is text, and declarations that HTML does not have are left out. A null or empty page has an empty text; so has one of which nothing but menus and the like is left. Equal rows each get a row; null ids and urls stay null. An empty table gives an empty result.
    """
    kind = pages.schema["page_id"].dataType
    whole = pages.select(F.col("page_id").cast("string"), "url", F.coalesce("html", F.lit("")).alias("html"))
    out = whole.mapInPandas(_extract_batches, "page_id string, url string, text string")
    return out.select(F.col("page_id").cast(kind).alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
