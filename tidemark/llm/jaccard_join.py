"""N-gram Jaccard join: a MinHash LSH forest finds candidates, its prefixes shortened until recall is reached; exact set comparison decides."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table
from tidemark.llm.components import connected_components

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
TREES = 24
#: Minhashes of a signature in each tree: the longest prefixes, with which the search begins.
DEEPEST = 8
#: A block of representatives that one task compares holds about so many of them, and of shingles.
BLOCK_DOCS = 384
BLOCK_SHINGLES = 500_000
BROADCAST_IDS = 1_000_000
#: From so many blocks on a class is measured against its center first; a smaller one is compared whole, each member with a bounded number of others.
LARGE_BLOCKS = 8
#: Members of a class, by a hash, whose signatures tell what most of the class have.
TYPICAL = 256
CHUNK = 4_096
GAMMA, MIX1, MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing in which every bit of x moves every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0xD6E8FEB86659FD93)  # odd, so that it has an inverse
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_OF_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * GAMMA)
#: A-Z become a-z; digits, letters and all bytes of characters beyond ASCII make words.
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the step and of its inverse, as many as the longest text so far needs."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = _powers(_STEP, 2 * n), _powers(_BACK, 2 * n)


_POWERS = _Powers()


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word of A-Z-lowered text, in order."""
    raw = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    if not len(raw):
        return np.zeros(0, np.uint64)
    edge = np.diff(np.concatenate([[False], _WORD[raw], [False]]).view(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    _POWERS.to(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_OF_BYTE[raw] * _POWERS.up[: len(raw)])])
    return _mixed((sums[end] - sums[start]) * _POWERS.down[start] + (end - start).astype(np.uint64) * GAMMA)


def shingles(text: str | None) -> np.ndarray:
    """The sorted set of 64-bit hashes of the text's windows of five words; of fewer words, but not none, one window."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    n = min(SHINGLE, len(w))
    out = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mixed(out * GAMMA + w[k : len(w) - n + 1 + k])
    return np.unique(out)


def found_chance(similarity: np.ndarray | float, depth: int, trees: int = TREES) -> np.ndarray | float:
    """The chance that two sets share a prefix of this depth in some tree."""
    return 1 - (1 - np.asarray(similarity, float) ** depth) ** trees


def next_depth(depth: int, seen: list[float], similarity: float, recall: float) -> int | None:
    """The depth at which to search next after ``depth``, or None if recall is reached.

    ``seen`` has, for every depth from 1 on, the sum over the links found of the chance to find the link there, each link divided by
    how often it is met at the present depth; and as its last the sum of those weights. A link at the threshold
    itself is counted among them, so that where nothing is found the threshold alone decides.
    """
    weight = 1 / similarity**depth
    total = seen[-1] + weight
    expected = lambda d: (seen[d - 1] + weight * float(found_chance(similarity, d))) / total
    if expected(depth) >= recall:
        return None
    return next((d for d in range(depth - 1, 0, -1) if expected(d) >= recall), 1) if depth > 1 else None


#: One linear permutation of 32-bit numbers a minhash.
_SEEDS = _mixed(np.arange(1, 2 * TREES * DEEPEST + 1, dtype=np.uint64) * GAMMA).astype(np.uint32)
_TIMES, _PLUS = _SEEDS[: TREES * DEEPEST] | np.uint32(1), _SEEDS[TREES * DEEPEST :]
MINHASH_ROWS = 1_024


def minhashes(s: np.ndarray) -> np.ndarray:
    """The least of permuted 32-bit hashes over a set, some rows at a time."""
    out = np.full(TREES * DEEPEST, np.iinfo(np.uint32).max, np.uint32)
    x = (s >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), MINHASH_ROWS):
        h = x[at : at + MINHASH_ROWS, None] * _TIMES
        h += _PLUS
        np.minimum(out, h.min(0), out=out)
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """16 bits of each minhash, tree by tree: a path from the root of each of the forest's tries."""
    return (minhashes(s) * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16).view(np.int16)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with their set's keys and signature; a column ``digest`` goes along."""
    for b in batches:
        sets = [shingles(t) for t in b["text"]]
        both = [_set_keys(s) for s in sets]
        yield pd.DataFrame({
            "row": b["row"], "doc_id": b["doc_id"], "key1": [x[0] for x in both], "key2": [x[1] for x in both], "n": [len(s) for s in sets],
            "signature": [signature(s) if len(s) else None for s in sets], "digest": b["digest"],
        })


def _set_keys(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    return (int(s.sum().view(np.int64)), int(_mixed(s + GAMMA).sum().view(np.int64))) if len(s) else (0, 0)


def _shingler(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        sets = [shingles(t) for t in b["text"]]
        keys = [_set_keys(s) for s in sets]
        yield pd.DataFrame({"rep": b["rep"], "key1": [k[0] for k in keys], "key2": [k[1] for k in keys], "shingles": [s.tobytes() for s in sets]})


def _counts(sets: list[np.ndarray], others: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all sets with all others (or each other).

    Shingles that only one set holds meet nothing and are left out first; the rest go through a 0/1 matrix, some columns at a time.
    """
    every = sets + (others or [])
    owner = np.repeat(np.arange(len(every), dtype=np.int32), [len(s) for s in every])
    values = np.concatenate(every)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    same = values[1:] == values[:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    values, owner = values[shared], owner[shared]
    column = np.cumsum(np.concatenate([[0], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    n = len(sets)
    out = np.zeros((n, len(others) if others else n), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, CHUNK):
        lo, hi = np.searchsorted(column, (at, at + CHUNK))
        m = np.zeros((len(every), CHUNK), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        out += m[:n] @ (m[n:] if others else m).T
    return out


def _comparer(similarity: float, depth: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Links between two blocks of a group of candidates, or within one: for each representative its links and a smaller one that it hangs together with.

        The first row has, in ``seen``, what next_depth sums up of the links.
        """
        first, second = int(key[-2]), int(key[-1])
        rows = rows.sort_values("rid")
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        rid, copies, block = rows["rid"].to_numpy(), rows["copies"].to_numpy(), rows["block"].to_numpy()
        sizes = np.array([len(s) for s in sets], np.float64)
        a, b = np.flatnonzero(block == first), np.flatnonzero(block == second)
        inner = first == second
        both = _counts([sets[i] for i in a], None if inner else [sets[i] for i in b]).astype(np.float64)
        union = sizes[a][:, None] + sizes[b][None, :] - both
        linked = both >= similarity * union - 1e-9
        if inner:
            np.fill_diagonal(linked, False)
        n_docs, n_reps = np.zeros(len(rid), np.int64), np.zeros(len(rid), np.int64)
        n_docs[a], n_reps[a] = linked @ copies[b], linked.sum(1)
        if not inner:
            n_docs[b], n_reps[b] = linked.T @ copies[a], linked.sum(0)
        # What hangs together within these blocks takes the smallest label.
        label = np.arange(len(rid))
        while True:
            over = np.where(linked, label[b][None, :], len(rid)).min(1, initial=len(rid))
            new = label.copy()
            new[a] = np.minimum(new[a], over)
            new[b] = np.minimum(new[b], np.where(linked, new[a][:, None], len(rid)).min(0, initial=len(rid)))
            if (new == label).all():
                break
            label = new
        found = both[linked] / union[linked]
        weight = 1 / found**depth
        seen = [[float((weight * found_chance(found, d)).sum()) for d in range(1, DEEPEST + 1)] + [float(weight.sum())]]
        return pd.DataFrame({"rid": rid, "docs": n_docs, "reps": n_reps, "hangs": rid[label], "seen": seen + [None] * (len(rid) - 1)})

    return run


COMPARED = "rid bigint, docs bigint, reps bigint, hangs bigint, seen array<double>"


def _compared(dealt: DataFrame, sets: DataFrame, similarity: float, depth: int) -> DataFrame:
    """Comparisons of ``dealt (grp, part, first, second, block, rid)``: a task for each grp, part and two blocks."""
    return dealt.join(sets, "rid").groupBy("grp", "part", "first", "second").applyInPandas(_comparer(similarity, depth), COMPARED)


def _in_blocks(members: DataFrame) -> DataFrame:
    """``members (grp, rid, n, near)`` dealt to blocks of bounded size, and every two blocks of a group to a task, but for two of near ones.

    What is near has blocks of its own, behind the others', in groups that do not fit in one block; a group without others is left out.
    """
    blocks = lambda side: F.ceil(F.greatest(F.count_if(side) / BLOCK_DOCS, F.coalesce(F.sum(F.when(side, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy("grp").agg(blocks(F.lit(True)).alias("whole"), blocks(~F.col("near")).alias("far_blocks"), blocks(F.col("near")).alias("near_blocks")).where("far_blocks > 0")
    one = F.col("whole") == 1
    sizes = sizes.select("grp", "whole", F.when(one, 1).otherwise(F.col("far_blocks")).alias("far_blocks"), F.when(one, 0).otherwise(F.col("near_blocks")).alias("near_blocks"))
    near = F.col("near") & ~one
    lot = lambda n: F.pmod(F.xxhash64("rid"), F.col(n)).cast("int")
    block = F.when(near, F.col("far_blocks") + lot("near_blocks")).otherwise(lot("far_blocks"))
    own = members.join(sizes, "grp").withColumn("block", block)
    others = F.sequence(F.lit(0), F.col("far_blocks") + F.when(near, 0).otherwise(F.col("near_blocks")) - 1)
    pairs = F.transform(others, lambda j: F.struct(F.least("block", j).alias("first"), F.greatest("block", j).alias("second")))
    return own.select("grp", F.lit(0).alias("part"), "block", "rid", F.explode(pairs).alias("p")).select("grp", "part", "p.first", "p.second", "block", "rid")


def _most_common(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """At each place of the signatures of a few members, the value that most of them have."""
    held = np.stack(rows["signature"].to_numpy())
    common = [values[counts.argmax()] for values, counts in (np.unique(held[:, i], return_counts=True) for i in range(held.shape[1]))]
    return pd.DataFrame({"grp": [key[0]], "common": [common]})


def _to_center(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Similarities of a part of a class to its center, which is its first block."""
    sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
    center = int(np.flatnonzero(rows["block"].to_numpy() == 0)[0])
    rest = [i for i in range(len(sets)) if i != center]
    if not rest:
        return pd.DataFrame({"rid": np.zeros(0, np.int64), "similarity": np.zeros(0)})
    both = _counts([sets[center]], [sets[i] for i in rest]).astype(np.float64)[0]
    return pd.DataFrame({"rid": rows["rid"].to_numpy()[rest], "similarity": both / (len(sets[center]) + np.array([len(sets[i]) for i in rest]) - both)})


def _few(df: DataFrame) -> DataFrame:
    """A written table, broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _near_center(members: DataFrame, reps: DataFrame, sets: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """``(grp, rid)`` of those members of large classes that are so near their class's center that any two of them are linked.

    One less the similarity of two sets is a distance, so two that lie within half the distance of a link from a third are linked: these need not be compared.
    The center is the member whose signature agrees most with what is most common in the class; whichever it is, only how many pairs
    are spared depends on it. Each member is compared with it once, in parts of bounded size.
    """
    large = members.groupBy("grp").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > LARGE_BLOCKS * BLOCK_DOCS)
    large = scratch.table(large.select("grp", F.ceil(F.col("members") / BLOCK_DOCS).cast("int").alias("parts")), "large")
    if large.isEmpty():
        return members.select("grp", "rid").limit(0)
    of_large = members.join(_few(large), "grp").select("grp", "parts", "rid")
    signed = scratch.table(of_large.join(reps.select("rid", "signature"), "rid"), "large_members")
    first = W.partitionBy("grp").orderBy(F.xxhash64("rid"), "rid")
    some = signed.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= TYPICAL).select("grp", "signature")
    common = scratch.table(some.groupBy("grp").applyInPandas(_most_common, "grp bigint, common array<smallint>"), "common")
    agrees = F.aggregate(F.zip_with("signature", "common", lambda a, b: (a == b).cast("int")), F.lit(0), lambda a, b: a + b)
    centers = signed.join(_few(common), "grp").groupBy("grp").agg(F.max_by("rid", F.struct(agrees, -F.col("rid"))).alias("center"))
    centers = scratch.table(centers, "centers")
    dealt = signed.join(_few(centers), "grp").where("rid != center").select("grp", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("block"), "rid")
    leads = centers.join(large, "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("block"), F.col("center").alias("rid"))
    measured = dealt.union(leads).join(sets, "rid").groupBy("grp", "part").applyInPandas(_to_center, "rid bigint, similarity double")
    near = measured.where(F.col("similarity") > (1 + similarity) / 2 + 1e-9).select("rid")
    return scratch.table(signed.join(near, "rid").select("grp", "rid").union(centers.select("grp", F.col("center").alias("rid"))), "near")


class _Forest:
    """The search for classes over representatives ``reps (rid, signature, ...)``: what hangs together by the links verified so far.

    Only verified links join classes: candidates that share a prefix and prove unlike stay apart, however they chain.
    """

    def __init__(self, reps: DataFrame, sets_of: Callable[[DataFrame], DataFrame], scratch: Scratch, similarity: float):
        self.reps, self.sets_of, self.scratch, self.similarity = reps, sets_of, scratch, similarity
        spark = reps.sparkSession
        self.classes = spark.createDataFrame([], "rid bigint, root bigint")
        self.sets: DataFrame | None = None

    def rooted(self, df: DataFrame) -> DataFrame:
        return df.join(self.classes, "rid", "left").withColumn("root", F.coalesce("root", "rid"))

    def nodes(self, depth: int) -> tuple[DataFrame, DataFrame]:
        """Trie nodes of this depth that hold several classes ``(grp, lead, lead_root)``, each set of members once, and ``(grp, rid, root)`` of all nodes."""
        path = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(t, F.slice("signature", t * DEEPEST + 1, F.lit(depth))))
        keyed = self.rooted(self.reps.select("rid", "signature")).select("rid", "root", F.explode(path).alias("grp"))
        held = keyed.groupBy("grp").agg(F.min(F.struct("root", "rid")).alias("lead"), F.max("root").alias("most"), F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("rid")).alias("name"))
        several = held.where(F.col("lead.root") != F.col("most"))
        once = several.groupBy("size", "name").agg(F.min("grp").alias("grp"), F.first("lead").alias("lead"))
        return once.select("grp", F.col("lead.rid").alias("lead"), F.col("lead.root").alias("lead_root")), keyed

    def join(self, compared: DataFrame, name: str) -> list[float]:
        """Joins the classes of the links found; gives what next_depth needs to know of them."""
        links = self.scratch.table(compared.where((F.col("reps") > 0) | F.col("seen").isNotNull()), f"links_{name}")
        seen = links.agg(*[F.sum(F.col("seen")[i]) for i in range(DEEPEST + 1)]).first()
        # Links between classes, not between members: most are within a class by now.
        ends = self.rooted(links.where("rid != hangs").select("rid", "hangs")).select(F.col("root").alias("a"), F.col("hangs").alias("rid"))
        ends = self.scratch.table(self.rooted(ends).select("a", F.col("root").alias("b")).where("a != b").distinct(), f"ends_{name}")
        if not ends.isEmpty():
            moved = connected_components(ends, self.scratch, f"joined_{name}").select(F.col("id").alias("root"), F.col("root").alias("to"))
            known = self.classes.union(moved.select(F.col("root").alias("rid"), "root").join(self.classes.select("rid"), "rid", "left_anti"))
            self.classes = self.scratch.table(known.join(moved, "root", "left").select("rid", F.coalesce("to", "root").alias("root")), f"classes_{name}")
        return [x or 0.0 for x in seen]

    def search(self, depth: int, stars: bool) -> list[float]:
        """Verifies the candidates of all nodes of a depth: first, with ``stars``, members against their node's first, then, in nodes that still hold several classes, all pairs but those within the largest."""
        nodes, keyed = self.nodes(depth)
        members = self.scratch.table(keyed.join(nodes, "grp"), f"members_{depth}")
        wanted = members.select("rid").distinct()
        fresh = self.scratch.table(self.sets_of(wanted if self.sets is None else wanted.join(self.sets.select("rid"), "rid", "left_anti")), f"sets_{depth}")
        self.sets = fresh if self.sets is None else self.sets.union(fresh)
        seen = [0.0] * (DEEPEST + 1)
        if stars:
            pairs = members.where("root != lead_root").select("rid", F.col("lead").alias("grp")).distinct()
            parts = pairs.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).alias("parts"))
            dealt = pairs.join(parts, "grp").withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")).select("grp", "part", F.lit(1).alias("block"), "rid")
            dealt = self.scratch.table(dealt, "stars")
            leads = dealt.select("grp", "part").distinct().select("grp", "part", F.lit(0).alias("block"), F.col("grp").alias("rid"))
            both = dealt.union(leads).select("grp", "part", F.lit(0).alias("first"), F.lit(1).alias("second"), "block", "rid")
            seen = self.join(_compared(both, self.sets, self.similarity, depth), f"stars_{depth}")
        now = self.rooted(members.select("grp", "rid"))
        held = now.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("held"))
        open_ = held.groupBy("grp").agg(F.max_by("root", F.struct("held", "root")).alias("main"), F.count(F.lit(1)).alias("several")).where("several > 1").select("grp", "main")
        # Members of the node's largest class hang together already, and meet the others only.
        left = now.join(open_, "grp").join(self.reps.select("rid", "n"), "rid").select("grp", "rid", "n", (F.col("root") == F.col("main")).alias("near"))
        more = self.join(_compared(_in_blocks(left), self.sets, self.similarity, depth), f"nodes_{depth}")
        return [a + b for a, b in zip(seen, more, strict=True)]

    def grow(self, recall: float) -> list[int]:
        """Searches by ever shorter prefixes until recall is reached; gives the depths."""
        depth, depths, seen = DEEPEST, [], [0.0] * (DEEPEST + 1)
        while depth:
            depths.append(depth)
            seen = [a + b for a, b in zip(seen, self.search(depth, stars=len(depths) == 1), strict=True)]
            depth = next_depth(depth, seen, self.similarity, recall)
        return depths


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Classes of documents whose sets of five-word shingles have a Jaccard similarity of at least ``similarity``.

    Per row of ``docs (doc_id, text)``: doc_id; copy_id, the smallest doc_id with the same set; class_id, the smallest doc_id
    that links lead to; n_links, the number of other documents at that similarity or above (copies included); n_links_distinct, that of
    other sets; n_shingles; keeps, true for one row a class. Other columns are dropped.

    Words are runs of digits, letters a-z and anything beyond ASCII in A-Z-lowered text; a text of fewer than five words is
    one shingle. Whole texts are hashed, in chunks. First, equal sets become one representative. Its minhashes make a path in
    each of the forest's tries. Nodes at the deepest prefixes give the first candidates: a node's members are compared with its first one,
    and where classes are left apart, all with all but the largest class's own. From the similarities of the links found follows what share of such links these
    prefixes find; as long as it is below ``recall``, prefixes are shortened to where it is not, and what then shares a node and no class yet
    is compared. At last the pairs of each class are compared for the numbers of links, so links within a class are all counted; of a large class
    those are spared that lie so near its center that any two of them are linked. Every
    comparison is exact and runs in blocks of bounded size, and tasks return counts and forests, never pairs: no link is lost, and a
    node, a class or a set of copies that holds a third of the rows is spread over its blocks.

    Null and empty texts, and those without words, link to nothing and are classes of their own. A null doc_id is a row
    like others, but never represents a class while an id is there. Rows with the same doc_id are rows of their own. An empty table gives
    an empty result.
    """
    return _near_duplicates(docs, similarity, recall).drop("digest")


def _digest() -> F.Column:
    """Names a row's text beside its doc_id, in 128 bits, where a doc_id alone may be null or repeat."""
    return F.md5(F.coalesce("text", F.lit("")))


def _linked(members: DataFrame, reps: DataFrame, sets: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """``(rid, docs, reps)``: how many rows and how many other sets each member of a class is linked to; ``members (grp, rid, n)``."""
    near = _near_center(members, reps, sets, scratch, similarity)
    with_copies = near.join(reps.select("rid", "copies"), "rid")
    of_class = with_copies.groupBy("grp").agg(F.sum("copies").alias("all_docs"), F.count(F.lit(1)).alias("all_reps"))
    sure = with_copies.join(of_class, "grp").select("rid", (F.col("all_docs") - F.col("copies")).alias("docs"), (F.col("all_reps") - 1).alias("reps"))
    told = members.join(near.select("rid", F.lit(True).alias("near")), "rid", "left").select("grp", "rid", "n", F.coalesce("near", F.lit(False)).alias("near"))
    compared = _compared(_in_blocks(told), sets, similarity, 1).select("rid", "docs", "reps")
    return compared.union(sure).groupBy("rid").agg(F.sum("docs").alias("docs"), F.sum("reps").alias("reps"))


def _near_duplicates(docs: DataFrame, similarity: float, recall: float, count_links: bool = True) -> DataFrame:
    """Near duplicates, with a ``digest`` of each row's text; the numbers of links are those of equal sets alone where they are not to be counted."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    kind = docs.schema["doc_id"].dataType
    # Ids become the largest number where they are null, so that they come last.
    last = F.lit(2**63 - 1)
    read = docs.select(F.coalesce(F.col("doc_id").cast("long"), last).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    numbered = read.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", _digest().alias("digest"))
    signed = scratch.table(numbered.mapInPandas(_sign, "row bigint, doc_id bigint, key1 bigint, key2 bigint, n bigint, signature array<smallint>, digest string"), "signed")

    sets = signed.where("n > 0").groupBy("key1", "key2", "n")
    reps = sets.agg(F.min(F.struct("doc_id", "row")).alias("m"), F.min("row").alias("rid"), F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature"))
    reps = scratch.table(reps.select("key1", "key2", "n", "rid", "copies", F.col("m.doc_id").alias("rep"), F.col("m.row").alias("rep_row"), "signature"), "reps")
    repeated = not signed.groupBy("doc_id").count().where("count > 1").isEmpty()

    def sets_of(rids: DataFrame) -> DataFrame:
        """Shingles of representatives: from a row of its doc_id, told from others of that id by its set."""
        named = scratch.table(rids.join(reps.select("rid", "rep", "key1", "key2", "copies"), "rid"), f"wanted_{uuid4().hex}")
        wanted = named.select("rep").distinct()
        wanted = F.broadcast(wanted) if named.count() <= BROADCAST_IDS else wanted.hint("shuffle_hash")
        texts = read.withColumnRenamed("doc_id", "rep").join(wanted, "rep", "left_semi")
        out = texts.mapInPandas(_shingler, "rep bigint, key1 bigint, key2 bigint, shingles binary").join(named, ["rep", "key1", "key2"])
        return (out.dropDuplicates(["rid"]) if repeated else out).select("rid", "copies", "shingles")

    forest = _Forest(reps, sets_of, scratch, similarity)
    forest.grow(recall)
    classes = forest.classes
    counted = spark.createDataFrame([], "rid bigint, docs bigint, reps bigint")
    if count_links and forest.sets is not None:
        members = scratch.table(classes.join(reps.select("rid", "n"), "rid").select(F.col("root").alias("grp"), "rid", "n"), "class_members")
        counted = scratch.table(_linked(members, reps, forest.sets, scratch, similarity), "counted")
    named = reps.select("rid", F.struct("rep", "rep_row").alias("m"))
    least = classes.join(named, "rid").groupBy("root").agg(F.min("m").alias("m"))
    known = reps.join(classes.join(least, "root").select("rid", "m"), "rid", "left").join(counted, "rid", "left")
    known = known.select(
        "key1", "key2", "n", "rep", F.coalesce("m.rep", "rep").alias("class_id"), F.coalesce("m.rep_row", "rep_row").alias("kept_row"),
        (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("reps", F.lit(0)).alias("n_links_distinct"),
    )
    known = scratch.table(known, "known")

    out = signed.select("row", "doc_id", "key1", "key2", "n", "digest").join(known, ["key1", "key2", "n"], "left")
    id_of = lambda c: F.when(c != last, c).cast(kind)
    return out.select(
        id_of(F.col("doc_id")).alias("doc_id"),
        id_of(F.coalesce("rep", "doc_id")).alias("copy_id"),
        id_of(F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_links_distinct", F.lit(0)).alias("n_links_distinct"),
        F.col("n").alias("n_shingles"),
        F.coalesce(F.col("row") == F.col("kept_row"), F.lit(True)).alias("keeps"),
        "digest",
    )


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``docs`` without near copies: the row with the smallest doc_id of each class stays, with all its columns.

    A row is known by its doc_id and a digest of its text, so rows whose doc_id is null or repeats go and stay by what their own
    texts are. The keys of rows that go are broadcast where there are few, else joined. Of rows with equal doc_id and text one stays.
    """
    found = Scratch(docs.sparkSession).table(_near_duplicates(docs, similarity, recall, count_links=False).select("doc_id", "digest", "keeps"), "kept")
    per_row = found.groupBy("doc_id", "digest").agg(F.max("keeps").alias("keeps"), F.count(F.lit(1)).alias("n"))
    last = F.lit(2**63 - 1)
    gone = per_row.where(~F.col("keeps")).select(F.coalesce(F.col("doc_id").cast("long"), last).alias("_gone_id"), F.col("digest").alias("_gone_digest"))
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    kept = docs.join(gone, (F.coalesce(F.col("doc_id").cast("long"), last) == F.col("_gone_id")) & (_digest() == F.col("_gone_digest")), "left_anti")
    return kept if per_row.where("keeps and n > 1").isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes and links of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("keeps")


OP8_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g, least(len(w), 5) AS m FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.m = b.m AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y, k = nx.n AND k = ny.n AS same FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE k >= 0.8 * (nx.n + ny.n - k) - 1e-9),
c AS (SELECT d.doc_id, least(d.doc_id, coalesce(min(l.y), d.doc_id)) AS copy_id FROM d LEFT JOIN l ON l.x = d.doc_id AND l.same GROUP BY d.doc_id),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
k AS (SELECT x AS doc_id, min(y) AS class_id FROM r GROUP BY x),
t AS (SELECT l.x AS doc_id, count(*) AS n_links, count(DISTINCT c.copy_id) FILTER (NOT l.same) AS n_links_distinct FROM l JOIN c ON c.doc_id = l.y GROUP BY l.x)
SELECT d.doc_id, c.copy_id, k.class_id, coalesce(t.n_links, 0) AS n_links, coalesce(t.n_links_distinct, 0) AS n_links_distinct, coalesce(n.n, 0) AS n_shingles
FROM d JOIN c USING (doc_id) JOIN k USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN n USING (doc_id)
"""
