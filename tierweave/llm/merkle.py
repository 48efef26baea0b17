"""Merkle manifest of a data set: nested-interval labels, and proofs by containment joins within levels."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierweave.llm.common import broadcast_below, staged

#: Consecutive nodes that become one node.
RUN = 3
#: Levels that share a bucket of leaf ranks: a bucket holds at most RUN ** BAND nodes of its lowest level.
BAND = 7
#: Runs of one tree within one partition that are broadcast; beyond it they are joined by a shuffle.
MOST_RUNS = 200_000

NODE = "tree string, size bigint, height int, level int, lo bigint, hi bigint, digest string"
SIBLINGS = "array<struct<left: string, right: string>>"


def digest_of(*values: Column) -> Column:
    """sha256, as lowercase hex, of the values one after the other: `-` for null, else UTF-8 byte count, colon, value."""

    def spelled(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(spelled, values)), 256)


@dataclass(frozen=True)
class Forest:
    """``bands`` holds, from the leaves up, pairs of frames: a band's lowest nodes (with their carried columns) and the nodes above them."""

    bands: tuple[tuple[DataFrame, DataFrame], ...]

    def nodes(self) -> DataFrame:
        """The manifest: every node's tree, level, covered leaf ranks [lo, hi) and digest."""
        columns = ["tree", "size", "height", "level", "lo", "hi", "digest"]
        inner = [nodes for _, nodes in self.bands]
        return reduce(DataFrame.unionByName, inner, self.bands[0][0].select(*columns)).select(*columns)

    def tops(self) -> DataFrame:
        """One node a tree: the one that covers all its leaves."""
        return self.nodes().where("level = height")


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds lo, a row's rank within its tree by `order` (nulls first), size and height of the tree. Expects staged rows with a column tree.

    Rows are sorted by range, and the ranks continue from one range to the next by the counts of the ranges before, one
    row for each tree and range. Wholly equal rows are spread over ranges as well, so no tree or key is one task.
    """
    keys = ["tree", *order, "_tie"]
    laid = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = staged(laid.drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    runs = laid.groupBy("tree", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    size = F.sum("_rows").over(of_tree)
    powers = F.array(*(F.lit(RUN**k).cast("long") for k in range(40)))
    runs = runs.select(F.col("tree").alias("_tree"), "_part", shift.alias("_shift"), size.alias("size"))
    runs = runs.withColumn("height", F.size(F.filter(powers, lambda p: p < F.col("size"))))
    runs = broadcast_below(staged(runs), MOST_RUNS)
    joined = laid.join(runs, F.col("tree").eqNullSafe(F.col("_tree")) & (part == F.col("_part")))
    return joined.withColumn("lo", F.col("_at") + F.col("_shift")).drop("_at", "_tree", "_part", "_shift")


def grown(leaves: DataFrame, band: int = BAND) -> Forest:
    """All nodes over numbered leaves (tree, size, height, lo, digest and carried columns).

    A band of levels is built by one shuffle: nodes whose leaf ranks share a bucket meet, and the bucket's part of each level of the band
    follows from them. The tops of the buckets are the next band's lowest nodes, so bands shrink by RUN ** band each.
    """
    highest = leaves.agg(F.max("height")).first()[0] or 0
    lowest = leaves.withColumn("level", F.lit(0)).withColumn("hi", F.col("lo") + 1)
    bands = []
    for floor in range(0, max(highest, 1), band):
        width = RUN ** (floor + band)
        bucket = lowest.select("tree", "size", "height", "lo", "digest", _bucket(width)).repartition("tree", "bucket")
        inner = staged(bucket.sortWithinPartitions("tree", "bucket", "lo").mapInArrow(_builder(floor, band), NODE))
        bands.append((lowest, inner))
        lowest = inner.where((F.col("level") == floor + band) & (F.col("height") > floor + band))
    return Forest(tuple(bands))


def siblings(forest: Forest, above: DataFrame, carried: Sequence[str], band: int = BAND) -> DataFrame:
    """Per leaf: tree, lo, digest, the carried columns, top and siblings. `above` holds (tree, top, siblings) of each tree's top.

    Bands are gone through from the top. In each one, the nodes of a bucket meet their ancestors in a join on tree and bucket that
    holds the intervals against each other: the bucket's top gets the siblings that lie above it. Inside the bucket a
    node's parent is the node of the next level whose interval contains its own, and what the parent's
    interval has besides it, left and right, are its siblings.
    """
    found = None
    for floor, (lowest, inner) in reversed(list(zip(range(0, band * len(forest.bands), band), forest.bands))):
        kept = list(carried) if floor == 0 else []
        width = RUN ** (floor + band)
        columns = ["tree", "size", "height", "level", "lo", "hi", "digest", *kept]
        nodes = lowest.select(*columns).unionByName(inner, allowMissingColumns=True).withColumn("bucket", _bucket(width))
        is_top = F.col("level") == F.least("height", F.lit(floor + band))
        ancestors = above.select(F.col("tree").alias("_tree"), F.lit(0).cast("long").alias("_from"), "top", "siblings")
        ends_here = F.col("height") <= floor + band
        ended = nodes.where(is_top & ends_here)
        met = ended.join(ancestors, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("bucket") == 0) & (F.col("_from") <= F.col("lo")))
        met = met.drop("_tree", "_from")
        if found is not None:
            higher = found.select(F.col("tree").alias("_tree"), _bucket(width).alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "top", "siblings")
            same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("bucket") == F.col("_bucket"))
            inside = (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
            further = nodes.where(is_top & ~ends_here).join(higher, same & inside).drop("_tree", "_bucket", "_lo", "_hi")
            met = met.unionByName(further)
        rows = met.unionByName(nodes.where(~is_top), allowMissingColumns=True)
        order = ["tree", "bucket", F.col("level").desc(), "lo"]
        rows = rows.repartition("tree", "bucket").sortWithinPartitions(*order)
        schema = ", ".join(["tree string, lo bigint, hi bigint, digest string", *(f"{c} {lowest.schema[c].dataType.simpleString()}" for c in kept)])
        found = rows.mapInArrow(_climber(floor, width, kept), f"{schema}, top string, siblings {SIBLINGS}")
    return found


def proofs(leaves: DataFrame, order: Sequence[str], carried: Sequence[str], band: int = BAND) -> DataFrame:
    """Per leaf of staged leaves (tree, digest, order and carried columns): tree, digest, carried columns, subroot, root and siblings.

    A tree's leaves ascend by `order`; each RUN consecutive nodes (the last run may be shorter) become the sha256 of their digests'
    hex one after the other, until one node is left. The trees' top nodes, ordered by tree with null first, are the leaves of
    one more tree, whose top is the root. `siblings` holds, level by level from the leaf up to the root, the hex of the run's
    nodes left and right of the own one. Leaves that are equal in `order` are told apart in an arbitrary, fixed order.
    """
    forest = grown(numbered(leaves, [*order, "digest"]), band)
    members = forest.tops().select(F.lit("").alias("tree"), F.col("tree").alias("member"), F.col("digest"))
    upper = grown(numbered(staged(members), ["member"]), band)
    root = upper.tops().select("tree", F.col("digest").alias("top"), F.array().cast(SIBLINGS).alias("siblings"))
    above = siblings(upper, root, ["member"], band).select(F.col("member").alias("tree"), F.col("digest").alias("top"), "siblings")
    one = root.first()
    found = siblings(forest, above, carried, band).withColumnRenamed("top", "subroot")
    return found.withColumn("root", F.lit(one.top if one else None).cast("string")).drop("hi")


def folded(leaf: Column, siblings_of: Column) -> Column:
    """The root that follows from a leaf's digest and its siblings."""
    return F.aggregate(siblings_of, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def document_proofs(docs: DataFrame, band: int = BAND) -> DataFrame:
    """Per row of documents: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves are the rows' digests over doc_id, source, lang, n_chars and text, trees are sources. Of rows whose doc_id has an even crc32 the
    text loses its line ends before the root is folded again. Null ids come first, are not tampered with, and null sources are a
    source. Rows that share an id are leaves of their own, ordered by digest; wholly equal rows are too. An empty table gives an
    empty result, and other columns are never read. Each text is hashed whole where it is read; only digests are shuffled.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    odd_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    told = F.when(odd_out, digest_of(*fields, F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    rows = docs.select(F.col("source").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), digest_of(*fields, F.col("text")).alias("digest"), told.alias("tampered"))
    proven = proofs(staged(rows), ["doc_id"], ["doc_id", "tampered"], band)
    beside = F.array_join(F.transform("siblings", lambda s: F.concat(s["left"], s["right"])), "")
    again = folded(F.coalesce("tampered", "digest"), F.col("siblings"))
    proven = proven.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(beside, 256).alias("proof_sha256"), again.alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def _bucket(width: int) -> Column:
    return F.expr(f"lo div {width}").alias("bucket")


def _height(size: int) -> int:
    height = 0
    while RUN**height < size:
        height += 1
    return height


def _whole_buckets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole buckets with the buckets' ends; the last bucket of a batch waits for the next one. Rows come sorted by tree and bucket."""
    waiting = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if waiting is None else pa.concat_tables([waiting, rows])
        keys = list(zip(rows["tree"].to_pylist(), (rows["lo"].to_numpy() // width).tolist()))
        ends = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        if ends:
            yield rows.slice(0, ends[-1]), ends
        waiting = rows.slice(ends[-1]) if ends else rows
    if waiting is not None:
        yield waiting, [waiting.num_rows]


def _builder(floor: int, band: int) -> Callable:
    width = RUN ** (floor + band)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("tree", pa.string()), ("size", pa.int64()), ("height", pa.int32()), ("level", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("digest", pa.string())])
        for rows, ends in _whole_buckets(batches, width):
            trees, sizes, los, digests = (rows[c].to_pylist() for c in ("tree", "size", "lo", "digest"))
            out = []
            for start, end in zip([0, *ends], ends):
                tree, size, lo, now = trees[start], sizes[start], los[start], digests[start:end]
                height = _height(size)
                for level in range(floor + 1, min(height, floor + band) + 1):
                    now = [sha256("".join(now[i : i + RUN]).encode()).hexdigest() for i in range(0, len(now), RUN)]
                    step = RUN**level
                    out += [(tree, size, height, level, at, min(at + step, size), d) for at, d in zip(range(lo, size, step), now)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * len(schema), schema)], schema=schema)

    return build


def _climber(floor: int, width: int, kept: list[str]) -> Callable:
    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ends in _whole_buckets(batches, width):
            levels, los, his = (rows[c].to_numpy() for c in ("level", "lo", "hi"))
            digests, tops, paths = (rows[c].to_pylist() for c in ("digest", "top", "siblings"))
            lefts, rights, taken, lengths, places, top_of = [], [], [], [], [], []
            for start, end in zip([0, *ends], ends):
                above = paths[start]
                trail = np.arange(len(lefts), len(lefts) + len(above))[None, :]
                lefts += [s["left"] for s in above]
                rights += [s["right"] for s in above]
                at = start
                while levels[at] > floor:
                    next_at = at + int(np.searchsorted(-levels[at:end], -levels[at], side="right"))
                    last = next_at + int(np.searchsorted(-levels[next_at:end], -levels[next_at], side="right"))
                    lo, hi, names = los[next_at:last], his[next_at:last], digests[next_at:last]
                    parent = np.searchsorted(los[at:next_at], lo, side="right") - 1
                    from_, to = los[at:next_at][parent], his[at:next_at][parent]
                    if (from_ > lo).any() or (hi > to).any():
                        raise ValueError("a node lies outside its parent")
                    # What the parent's interval has besides the own one, left and right, in places of this level.
                    first, beyond = np.searchsorted(lo, from_).tolist(), np.searchsorted(lo, to).tolist()
                    own = np.arange(len(lefts), len(lefts) + len(lo))
                    lefts += ["".join(names[a:i]) for i, a in enumerate(first)]
                    rights += ["".join(names[i + 1 : b]) for i, b in enumerate(beyond)]
                    trail = np.concatenate([own[:, None], trail[parent]], axis=1)
                    at = next_at
                places.append(np.arange(at, end))
                taken.append(trail.ravel())
                lengths += [trail.shape[1]] * (end - at)
                top_of += [tops[start]] * (end - at)
            chosen, indices = pa.array(np.concatenate(places)), pa.array(np.concatenate(taken), pa.int64())
            pairs = pa.StructArray.from_arrays([pa.array(lefts, pa.string()).take(indices), pa.array(rights, pa.string()).take(indices)], ["left", "right"])
            offsets = pa.array(np.cumsum([0, *lengths]), pa.int32())
            base = rows.select(["tree", "lo", "hi", "digest", *kept]).take(chosen)
            base = base.append_column("top", pa.array(top_of, pa.string())).append_column("siblings", pa.ListArray.from_arrays(offsets, pairs))
            yield from base.combine_chunks().to_batches()

    return climb


#: The same rows in DuckDB, which has no crc32: its lowest bit is folded over the id's digits here.
SQL = """
WITH RECURSIVE field AS (
  SELECT doc_id, source, text,
    concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    replace(text, chr(10), '') AS cut,
    list_reduce([4294967295::UBIGINT] || list_transform(range(len(doc_id::VARCHAR)), lambda i: unicode(substr(doc_id::VARCHAR, i + 1, 1))::UBIGINT),
      lambda c, b: list_reduce([xor(c, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))) AS crc
  FROM documents
), leaf AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 4294967295::UBIGINT) % 2 = 0 THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) END AS told
  FROM field
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS lo, count(*) OVER (PARTITION BY source) AS n FROM leaf
), node AS (
  SELECT source, 0 AS level, lo AS nth, leaf AS digest, n FROM ranked
  UNION ALL
  SELECT source, level + 1, nth // 3, sha256(string_agg(digest, '' ORDER BY nth)), (n + 2) // 3 FROM node WHERE n > 1 GROUP BY source, level, nth // 3, n
), sub AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS nth, count(*) OVER () AS n, level AS height FROM node WHERE n = 1
), over_node AS (
  SELECT 0 AS level, nth, digest, n FROM sub
  UNION ALL
  SELECT level + 1, nth // 3, sha256(string_agg(digest, '' ORDER BY nth)), (n + 2) // 3 FROM over_node WHERE n > 1 GROUP BY level, nth // 3, n
), step AS (
  SELECT r.doc_id, r.source, r.lo, me.level,
    coalesce(string_agg(o.digest, '' ORDER BY o.nth) FILTER (o.nth < me.nth), '') AS l,
    coalesce(string_agg(o.digest, '' ORDER BY o.nth) FILTER (o.nth > me.nth), '') AS r
  FROM ranked r JOIN node me ON me.source IS NOT DISTINCT FROM r.source AND me.nth = r.lo // (3::BIGINT ** me.level)::BIGINT
  JOIN node o ON o.source IS NOT DISTINCT FROM me.source AND o.level = me.level AND o.nth // 3 = me.nth // 3
  WHERE me.n > 1 GROUP BY r.doc_id, r.source, r.lo, me.level, me.nth
  UNION ALL
  SELECT r.doc_id, r.source, r.lo, s.height + me.level,
    coalesce(string_agg(o.digest, '' ORDER BY o.nth) FILTER (o.nth < me.nth), ''),
    coalesce(string_agg(o.digest, '' ORDER BY o.nth) FILTER (o.nth > me.nth), '')
  FROM ranked r JOIN sub s ON s.source IS NOT DISTINCT FROM r.source
  JOIN over_node me ON me.nth = s.nth // (3::BIGINT ** me.level)::BIGINT JOIN over_node o ON o.level = me.level AND o.nth // 3 = me.nth // 3
  WHERE me.n > 1 GROUP BY r.doc_id, r.source, r.lo, s.height, me.level, me.nth
), proof AS (
  SELECT source, lo, list({'l': l, 'r': r} ORDER BY level) AS steps FROM step GROUP BY source, lo
), fold AS (
  SELECT r.source, r.lo, coalesce(told, leaf) AS digest, 1 AS k, coalesce(steps, []) AS steps
  FROM ranked r LEFT JOIN proof p ON p.source IS NOT DISTINCT FROM r.source AND p.lo = r.lo
  UNION ALL
  SELECT source, lo, sha256(steps[k].l || digest || steps[k].r), k + 1, steps FROM fold WHERE k <= len(steps)
)
SELECT r.doc_id, r.leaf, s.digest AS subroot, t.digest AS root,
  sha256(coalesce(array_to_string(list_transform(f.steps, lambda x: x.l || x.r), ''), '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = t.digest AS verified
FROM ranked r JOIN sub s ON s.source IS NOT DISTINCT FROM r.source
JOIN fold f ON f.source IS NOT DISTINCT FROM r.source AND f.lo = r.lo AND f.k = len(f.steps) + 1
CROSS JOIN (SELECT digest FROM over_node WHERE n = 1) t
"""
