"""Near-duplicates by word shingles: candidates by SimHash under Golay keys and by MinHash bands, exact Jaccard similarity, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierweave.llm import simhash
from tierweave.llm.common import small_batches, staged
from tierweave.llm.components import components

SHINGLE = 5
#: Texts are near copies if their sets of shingles have this Jaccard similarity, NUMERATOR / DENOMINATOR, or more.
NUMERATOR, DENOMINATOR = 4, 5
SEED = 42
#: Two texts with similarity 0.8 share none of so many bands with a chance of (1 - 0.8 ** 4) ** 24 = 3e-6. SimHash finds those
#: within two bits; alone it can't do: at 0.8 about 10 of 64 bits differ, with a deviation of 3, and a radius of 18 would pair everything.
BANDS, ROWS = 24, 4
#: Texts that share a band key are paired up to this number; up to the next they meet in one task, which compares all of
#: them by counting common shingles; in still larger groups each is compared with leaders, in rounds, and what the rounds leave
#: apart is compared in full, block by block.
PAIRED, GATHERED = 24, 2_048
#: Texts of a block, of which a task compares two.
BLOCK = 1_024
#: Sizes of near copies are at most one step apart on a scale of this base. A little above 5 / 4, so that rounding can't part them.
SCALE = 1.26
#: Shingles that are permuted at once.
PERMUTED = 1 << 12

_RANDOM = np.random.default_rng(SEED)
_XOR = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)
_FACTOR = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
#: bytes.split() without argument parts at exactly the six white-space characters; A-Z become a-z.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def _node(words: list[bytes]) -> int:
    """Signed hash of all words: texts that differ in white space or ASCII case only are one node."""
    whole = xxhash.xxh64_intdigest(b" ".join(words), SEED)
    return whole - (1 << 64) if whole >> 63 else whole


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct hashes of all runs of SHINGLE words; shorter texts, even without words, are one shingle."""
    runs = [b" ".join(words)] if len(words) < SHINGLE else map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(r, SEED) for r in runs), np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key a band, made of the smallest values of ROWS permutations of the shingles' hashes."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), PERMUTED):
        part = hashes[k : k + PERMUTED]
        least = np.minimum(least, ((part[None, :] ^ _XOR[:, None]) * _FACTOR[:, None]).min(axis=1))
    bands = least.reshape(BANDS, ROWS).astype("<u8")
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), SEED + i) for i, b in enumerate(bands)], np.uint64).view(np.int64)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [_words(t) for t in batch.column(1).to_pylist()]
        sets = [shingles(w) for w in own]
        keys = pa.array([band_keys(s) for s in sets], pa.list_(pa.int64()))
        nodes, sizes = pa.array([_node(w) for w in own], pa.int64()), pa.array([len(s) for s in sets], pa.int64())
        prints = pa.array(np.array([simhash.majority(s) for s in sets], np.uint64).view(np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), nodes, sizes, keys, prints], ["doc_id", "node", "n", "keys", "print"])


def _noded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = [_node(_words(t)) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch.column(0)], ["node", "text"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether |a and b| / |a or b| >= NUMERATOR / DENOMINATOR, in whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
        known: dict[int, np.ndarray] = {}

        def of(node: int, text: str | None) -> np.ndarray:
            if node not in known:
                known[node] = shingles(_words(text))
            return known[node]

        right = pa.array([similar(of(x, s), of(y, t)) for x, y, s, t in zip(a, b, text_a, text_b)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(right), batch.column(1).filter(right)], ["a", "b"])


def _gathered(group: pa.Table) -> pa.Table:
    """Links of a group of texts: for each text the shingles in common with all former ones. A chain of links that connects the same is given;
    where the texts have a root already, only links between different roots."""
    sets = [shingles(_words(t)) for t in group.column("text").to_pylist()]
    nodes = group.column("node").to_pylist()
    sizes = np.array([len(s) for s in sets], np.int64)
    which = np.repeat(np.arange(len(sets)), sizes)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    ends = np.cumsum(np.bincount(code))
    holders, starts = which[order], np.concatenate(([0], ends[:-1]))
    root, out = np.arange(len(sets)), []
    if "root" in group.column_names:
        root = np.unique(np.array(group.column("root").to_pylist(), np.int64), return_inverse=True)[1]
    for i, own in enumerate(np.split(code, np.cumsum(sizes)[:-1])):
        common = np.bincount(np.concatenate([holders[starts[c] : ends[c]] for c in own]), minlength=len(sets))[:i]
        for j in np.nonzero(DENOMINATOR * common >= NUMERATOR * (sizes[i] + sizes[:i] - common))[0]:
            if root[i] != root[j]:
                out.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
                root[root == root[j]] = root[i]
    return pa.table([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def _edges(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are similar; a leader of many pairs is a skewed key of a join, which adaptive execution splits."""
    second = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return staged(both.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a bigint, b bigint"))


def _sized(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) whose sizes allow the similarity."""
    fits = DENOMINATOR * F.least("n", "m") >= NUMERATOR * F.greatest("n", "m")
    return pairs.where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def simhash_pairs(nodes: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Candidate pairs (a, n, b, m) of texts (node, n, print) whose SimHashes differ in two bits or fewer, found by Golay keys.

    A print's smallest node stands for it: its other nodes are paired with that one, and linked prints are by theirs.
    """
    first = staged(nodes.groupBy("print").agg(F.min(F.struct("node", "n")).alias("first")).select("print", "first.*"))
    same = nodes.select("print", F.col("node").alias("b"), F.col("n").alias("m")).join(first.select("print", F.col("node").alias("a"), "n"), "print")
    near = simhash.links(first.select("print"), paired)
    ends = [first.select(F.col("print").alias(side), F.col("node").alias(f"_{side}"), F.col("n").alias(size)) for side, size in (("a", "n"), ("b", "m"))]
    other = near.join(ends[0], "a").join(ends[1], "b").select(F.col("_a").alias("a"), "n", F.col("_b").alias("b"), "m")
    return staged(same.where("a != b").select("a", "n", "b", "m").unionByName(other))


def crossing_links(members: DataFrame, texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links between different components of the same group, none left out; members: key, node, n, root, texts: node, text.

    Of two components one is not the group's largest, so texts outside that one are compared with all texts of the group whose sizes
    allow the similarity. Texts are dealt into blocks of their key and size; a task compares two blocks, so its memory does
    not grow with the group. The work is squared only where a group has many texts outside its largest component.
    """
    shares = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("_share"))
    largest = shares.groupBy("key").agg(F.max_by("root", F.struct("_share", "root")).alias("_largest"))
    sized = members.join(largest, "key").withColumn("_level", F.floor(F.log("n") / F.lit(math.log(SCALE))).cast("int"))
    blocks = sized.groupBy("key", "_level").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("_blocks"))
    dealt = sized.join(blocks, ["key", "_level"]).withColumn("_cell", F.struct("_level", F.pmod(F.xxhash64("node"), F.col("_blocks")).alias("block")))
    dealt = staged(dealt.select("key", "node", "root", "_cell", (F.col("root") != F.col("_largest")).alias("_outer")))
    cells = dealt.groupBy("key", "_cell").agg(F.bool_or("_outer").alias("_outer"))
    left = cells.where("_outer").select("key", F.col("_cell").alias("_a"))
    right = cells.select("key", F.col("_cell").alias("_b"), F.col("_outer").alias("_other"))
    near = F.abs(F.col("_a._level") - F.col("_b._level")) <= 1
    pairs = left.join(right, "key").where(near & (~F.col("_other") | (F.col("_a") <= F.col("_b")))).select("key", "_a", "_b")
    sides = F.array_distinct(F.array("_a", "_b"))
    meeting = pairs.withColumn("_cell", F.explode(sides)).join(dealt.drop("_outer"), ["key", "_cell"])
    whole = meeting.select("key", "_a", "_b", "node", "root").join(texts, "node")
    return staged(whole.groupBy("key", "_a", "_b").applyInArrow(_gathered, "a bigint, b bigint").distinct())


def links(nodes: DataFrame, texts: DataFrame, paired: int = PAIRED, gathered: int = GATHERED, block: int = BLOCK) -> DataFrame:
    """(node, root) of every text that is linked; nodes: node, n, keys, print (distinct nodes), texts: node, text.

    Pairs by SimHash and pairs by MinHash bands are verified alike, on the whole texts.

    Groups of a key up to `paired` texts are compared pair by pair, those up to `gathered` texts whole, in one task each. In
    a larger one all are compared with one leader a round: the text with the most links so far that has not led there. A group rests once
    all its texts are in one component, and rounds end when a whole one finds no link. Components that are then still apart in a
    group are compared text by text in blocks, so no link is left out whatever the size of a group.
    """
    keyed = nodes.select("node", "n", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = staged(keyed.join(sizes, "key"))
    few, many = shared.where(F.col("size") <= paired), staged(shared.where(F.col("size") > max(paired, gathered)).drop("size"))
    some = shared.where((F.col("size") > paired) & (F.col("size") <= gathered)).select("key", "node")
    own = few.select("key", F.col("node").alias("a"), "n")
    other = few.select("key", F.col("node").alias("b"), F.col("n").alias("m"))
    hashed = simhash_pairs(nodes.select("node", "n", "print"), paired)
    pairs = own.join(other, "key").where("a < b").select("a", "n", "b", "m").unionByName(hashed)
    wanted = shared.select("node").unionByName(hashed.select(F.col("a").alias("node"))).unionByName(hashed.select(F.col("b").alias("node")))
    texts = staged(texts.join(wanted.distinct(), "node", "left_semi").dropDuplicates(["node"]))
    whole = some.join(texts, "node").groupBy("key").applyInArrow(_gathered, "a bigint, b bigint")
    found = staged(_edges(_sized(pairs), texts).unionByName(whole).distinct())
    roots = components(found)
    if many.isEmpty():
        return roots
    led = None
    while True:
        degrees = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
        now = many.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        now = now.join(degrees, "node", "left") if led is not None else now.withColumn("links", F.lit(0).cast("long"))
        open_ = now.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("key")
        now = staged(now.join(open_, "key"))
        free = now.join(led, ["key", "node"], "left_anti") if led is not None else now
        rank = F.struct(F.coalesce("links", F.lit(0)), F.xxhash64("key", "node"))
        leaders = staged(free.groupBy("key").agg(F.max_by(F.struct("node", "n", "root"), rank).alias("x")).select("key", "x.*"))
        first = leaders.select("key", F.col("node").alias("a"), "n", F.col("root").alias("root_a"))
        crossing = now.select("key", F.col("node").alias("b"), F.col("n").alias("m"), "root").join(first, "key").where("root != root_a")
        new = _edges(_sized(crossing), texts)
        if new.isEmpty():
            break
        led = leaders.select("key", "node") if led is None else staged(led.unionByName(leaders.select("key", "node")))
        found = staged(found.unionByName(new))
        roots = components(found)
    if now.isEmpty():
        return roots
    new = crossing_links(now.select("key", "node", "n", "root"), texts, block)
    return roots if new.isEmpty() else components(found.unionByName(new))


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paired: int = PAIRED, gathered: int = GATHERED, block: int = BLOCK
) -> DataFrame:
    """Per row of docs: doc_id, component_id, the smallest doc_id reachable over links between near copies.

    Linked are texts whose sets of lower-cased five-word shingles have a Jaccard similarity of 0.8 or more. Candidates have SimHashes
    within two bits or share a MinHash band; each link is verified on the whole texts. A null id is never the smallest unless all of a component are.
    Repeated rows come back as often as given, an empty table gives an empty result, and columns that are not named are never read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = staged(rows.mapInArrow(_marked, "doc_id bigint, node bigint, n bigint, keys array<bigint>, print bigint"))
    distinct = marked.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("keys").alias("keys"), F.min("print").alias("print"))
    distinct = staged(distinct)
    texts = rows.select("text").mapInArrow(_noded, "node bigint, text string")
    found = links(distinct.select("node", "n", "keys", "print"), texts, paired, gathered, block)
    of = distinct.select("node", "least").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.select("doc_id", "node").join(of.join(smallest, "root").select("node", "component_id"), "node").select("doc_id", "component_id")
