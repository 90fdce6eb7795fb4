"""Secret scans: fixed patterns, and a battery of randomness tests over every other token."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "random")

#: A run that may hold a secret, not inside a longer run of letters beyond ASCII; its padding goes along.
RUN = re.compile(r"(?<![^\W_])[A-Za-z0-9+/_-]{16,}(?![^\W_])={0,2}")
LEAST_RANDOM = 16
#: Where a run is cut if it is not random as a whole, one after the other: paths and sums, then words of identifiers.
CUTS = (re.compile(r"[+/]"), re.compile(r"[_-]"))
ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: Alphabets that words are written in too: a run of them is examined from so many characters on, where words no longer pass for random. Of keys of 20
#: characters in a wider alphabet, one in 30 at most has letters only, and the longer the fewer.
WORDS, LEAST_LETTERS = frozenset(["lower", "upper", "letters"]), 32
#: Bins of the uniformity test: characters that words, names and numbers use alike often.
BINS = ("01", "234", "56789", "etaoinsr", "hldcumfpg", "wybvkxjqz", "ETAOINSR", "HLDCUMFPG", "WYBVKXJQZ", "+/-_")
LEAST_EXPECTED = 2.0
FALSE_DISCOVERY = 0.01
#: Combined p values at which the battery can be cut, and the one from which only random tokens are expected.
LEVELS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.3)
SURELY = 0.5
#: A class is taken to hold others than random tokens where random ones alone would look like it less often than so.
CHANCE = 0.001


@lru_cache(maxsize=None)
def _tables(encoding: str) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Each character's place in the alphabet, the bin of each place, and the bins' shares of the alphabet."""
    letters = ALPHABETS[encoding]
    bins = [b for b in ("".join(c for c in chars if c in letters) for chars in BINS) if b]
    bin_of = np.array([next(i for i, b in enumerate(bins) if c in b) for c in letters])
    return {c: i for i, c in enumerate(letters)}, bin_of, np.bincount(bin_of) / len(letters)


def infer_encoding(token: str) -> str | None:
    """The smallest alphabet that holds the token without its padding."""
    found = set(token.rstrip("="))
    return next((name for name, letters in ALPHABETS.items() if found <= set(letters)), None)


def _upper_chi2(x: float, df: int) -> float:
    """P(chi squared with df > x), by the cube root's normal approximation."""
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str, encoding: str) -> dict[str, float]:
    """P values under the null that the characters are drawn evenly and independently from the encoding's alphabet."""
    at, bin_of, shares = _tables(encoding)
    x = np.array([at[c] for c in token.rstrip("=")])
    n, k = len(x), len(at)
    # Alphabet uniformity: bins too small for so short a token join the next one.
    seen, expected, cells = np.bincount(bin_of[x], minlength=len(shares)), shares * n, [[0.0, 0.0]]
    for o, e in zip(seen.tolist(), expected.tolist(), strict=True):
        if cells[-1][1] >= LEAST_EXPECTED:
            cells.append([0.0, 0.0])
        cells[-1] = [cells[-1][0] + o, cells[-1][1] + e]
    if len(cells) > 1 and cells[-1][1] < LEAST_EXPECTED:
        last = cells.pop()
        cells[-1] = [cells[-1][0] + last[0], cells[-1][1] + last[1]]
    chi = sum((o - e) ** 2 / e for o, e in cells)
    # Runs above and below the middle of the alphabet.
    high = x >= k / 2
    n1, n2 = int(high.sum()), int((~high).sum())
    if n1 and n2:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean, var = 1 + 2 * n1 * n2 / n, 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))
        p_runs = math.erfc(abs(runs - mean) / math.sqrt(2 * var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    # Serial correlation of neighbours.
    c = x - x.mean()
    r = float((c[1:] * c[:-1]).sum() / (c * c).sum()) if c.any() else 1.0
    z = (r + 1 / n) * math.sqrt(n)
    return {"uniform": _upper_chi2(chi, len(cells) - 1) if len(cells) > 1 else 1.0, "runs": p_runs, "serial": math.erfc(abs(z) / math.sqrt(2))}


def combined(p_values: Iterable[float]) -> float:
    """Fisher's combination of three p values."""
    x = -sum(math.log(max(p, 1e-300)) for p in p_values)
    return math.exp(-x) * (1 + x + x * x / 2)


def candidates(text: str, taken: Callable[[int, int], bool] = lambda s, e: False) -> list[tuple[int, int, str, float]]:
    """``(start, end, encoding, p)`` of the runs of a text that may be secrets; ``taken`` tells spans that others have.

    A run that the battery refuses is cut, first at signs of paths, then at those of identifiers, and its pieces are tested: a key in a
    path or behind a name is found by itself. What is refused at every cut is given as a whole, as what chance has to be judged by.
    """
    out = []

    def test(s: int, e: int, cuts: int) -> list[tuple[int, int, str, float]]:
        body = text[s:e].rstrip("=")
        if len(body) < LEAST_RANDOM:
            return []
        encoding, whole = infer_encoding(body), []
        if encoding and not (encoding in WORDS and len(body) < LEAST_LETTERS) and not taken(s, e):
            whole = [(s, e, encoding, combined(battery(body, encoding).values()))]
            if whole[0][3] >= LEVELS[0]:
                return whole
        for at in range(cuts, len(CUTS)):
            ends = [m.start() for m in CUTS[at].finditer(text, s, s + len(body))]
            if ends:
                pieces = zip([s, *(i + 1 for i in ends)], [*ends, e], strict=True)
                found = [x for a, b in pieces for x in test(a, b, at + 1)]
                good = [x for x in found if x[3] >= LEVELS[0]]
                return good or whole or found
        return whole

    for m in RUN.finditer(text):
        out += test(m.start(), m.end(), 0)
    return out


def _class(encoding: str, length: int) -> str:
    """What candidates are judged with: those of the same encoding and about the same length."""
    return f"{encoding}:{min(length.bit_length(), 8)}"


def _few_by_chance(n: int, share: float, seen: int) -> float:
    """P(at most ``seen`` of n), each with probability ``share``: exact for few, by the normal approximation for many."""
    if n <= 1_000:
        return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(share) + (n - i) * math.log1p(-share)) for i in range(seen + 1))
    return 0.5 * math.erfc((n * share - seen - 0.5) / math.sqrt(2 * n * share * (1 - share)))


def cutoffs(histogram: dict[str, dict[float, int]], level: float = FALSE_DISCOVERY) -> dict[str, float]:
    """The combined p value from which tokens of a class count as random; ``histogram`` has a class's candidates at or above each level and SURELY.

    Random tokens spread evenly over p values, and others fall towards 0, the more so the longer they are. Twice those from SURELY on are
    therefore about all random ones of a class, and what stands above a level beyond their share of it are false discoveries. The lowest level is the
    class's cut-off at which those are ``level`` of all at most. At the first level a class passes too if chance leaves as few from SURELY on among random
    tokens alone: a few keys that happen to lie low are not given up. A class that fails there holds others, and is cut where these end, but for two standard
    errors of what lies from SURELY on.
    """
    out = {}
    for name, above in histogram.items():

        def holds(t: float) -> bool:
            false = above[t] - 2 * (1 - t) * above[SURELY]
            if t == LEVELS[0] and _few_by_chance(above[t], (1 - SURELY) / (1 - t), above[SURELY]) >= CHANCE:
                return True
            return false - (t > LEVELS[0]) * 2 * math.sqrt(above[SURELY]) <= level * above[t]

        out[name] = next((t for t in LEVELS if holds(t)), SURELY)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans (kind, start, end) of the base patterns, by start."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def examined(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, str, float]]]:
    """A text's base spans, and its candidates that touch none of them."""
    base = base_spans(text)
    starts, reach = [s for _, s, _ in base], []
    for _, _, e in base:
        reach.append(max(e, reach[-1]) if reach else e)
    # The spans that begin before a candidate's end reach into it if the farthest of them does.
    touched = lambda s, e: (k := bisect_left(starts, e)) > 0 and reach[k - 1] > s
    return base, candidates(text, touched)


def scan(text: str, cuts: dict[str, float]) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text by start, then kind: the base patterns', and those of random tokens."""
    base, others = examined(text)
    return sorted(base + [("random", s, e) for s, e, c, p in others if p >= cuts.get(_class(c, e - s), SURELY)], key=lambda x: (x[1], KINDS.index(x[0])))


CANDIDATES = "array<struct<s: bigint, e: bigint, class: string, p: double>>"


def _examine_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found = [examined(t) for t in b["text"]]
        spans = [[{"s": s, "k": KINDS.index(k), "e": e} for k, s, e in f[0]] for f in found]
        others = [[{"s": s, "e": e, "class": _class(c, e - s), "p": p} for s, e, c, p in f[1]] for f in found]
        yield pd.DataFrame({"doc_id": b["doc_id"], "base": spans, "others": others})


def _examine(docs: DataFrame) -> DataFrame:
    """``(doc_id as string, base, others)``: each text read once."""
    # Whether the id is nullable must not turn it into a float on the way through pandas.
    whole = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return whole.mapInPandas(_examine_batches, f"doc_id string, base array<struct<s: bigint, k: int, e: bigint>>, others {CANDIDATES}")


def fit_cutoffs(examined_docs: DataFrame, level: float = FALSE_DISCOVERY) -> dict[str, float]:
    """Cut-offs from the candidates of all texts: there is a row a class here, and classes are at most eight an encoding."""
    each = examined_docs.select(F.explode("others").alias("o")).select("o.class", "o.p")
    counts = each.groupBy("class").agg(*[F.count_if(F.col("p") >= t).alias(f"n{i}") for i, t in enumerate((*LEVELS, SURELY))]).collect()
    return cutoffs({r["class"]: {t: r[f"n{i}"] for i, t in enumerate((*LEVELS, SURELY))} for r in counts}, level)


def find_secrets(docs: DataFrame, level: float = FALSE_DISCOVERY) -> DataFrame:
    """Secrets in every whole text of ``docs (doc_id, text)``; other columns are dropped.

    A span is a pattern's whole match, in code points, end exclusive. Base kinds are assign, access and hex. Runs of key characters
    elsewhere go through the battery under their inferred encoding; its three p values are combined, and those of all texts'
    candidates, by encoding and length, set from which on one counts as ``random``. Each text is read once; spans and candidates are written,
    and the counts of the candidates are all that meets. A null or empty text has no spans. Equal rows each get a row, a null doc_id too; an
    empty table gives an empty result.
    """
    found = Scratch(docs.sparkSession).table(_examine(docs), "examined")
    cuts = fit_cutoffs(found, level)
    known = F.create_map(*[x for name, t in cuts.items() for x in (F.lit(name), F.lit(t))]) if cuts else F.create_map().cast("map<string,double>")
    passed = F.filter("others", lambda o: o["p"] >= F.coalesce(F.try_element_at(known, o["class"]), F.lit(SURELY)))
    random = F.transform(passed, lambda o: F.struct(o["s"].alias("s"), F.lit(KINDS.index("random")).alias("k"), o["e"].alias("e")))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1), x["s"], x["e"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda x: x["k"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), count("assign"), count("access"), count("hex"), F.size(random).cast("long").alias("n_random"),
        F.sha2(joined("base"), 256).alias("base_sha256"), joined(F.array_sort(F.concat("base", random))).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", level: float = FALSE_DISCOVERY) -> DataFrame:
    """``docs`` with every secret span replaced by ``mark``; overlapping spans by one. Rows and other columns stay, n_chars follows the text.

    Candidates of all texts set the cut-offs first, so texts are read twice. Null texts stay null, empty ones empty.
    """
    cuts = fit_cutoffs(_examine(docs), level)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else _redacted(t, cuts, mark))

    # Else the length below would run it once more.
    out = docs.withColumn("text", cleaned.asNondeterministic()("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _redacted(text: str, cuts: dict[str, float], mark: str) -> str:
    out, at = [], 0
    for _, s, e in scan(text, cuts):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return find_secrets(table(spark, sf_dir, "documents"))
