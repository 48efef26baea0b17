"""SimHash near-duplicates: candidates by fuzzy keys of a perfect Golay code, join, verification, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import small_batches, staged
from tierweave.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: A fingerprint's segments in bits, from the top: two fill the code's 23 bits, the third is compared as it is.
SEGMENTS = (23, 23, 18)
#: Fingerprints that share a key are compared with each other up to this number; larger groups meet by single-bit neighbours.
PAIRED = 24

#: Generator polynomial of the binary Golay code of length 23 (fixed value): x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
_LENGTH, _CHECKS = 23, 11


def _syndromes(values: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial: the bit positions' remainders, added up."""
    out = np.zeros(len(values), np.int64)
    for bit in range(_LENGTH):
        rest = 1 << bit
        for k in range(bit, _CHECKS - 1, -1):
            if rest >> k & 1:
                rest ^= GENERATOR << (k - _CHECKS)
        out ^= np.where(values >> bit & 1, rest, 0)
    return out


def _error_tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the one error of weight 3 or less, and the five of weight 4 where that weight is 3 (else the first again)."""
    nearest, next_nearest = np.zeros(1 << _CHECKS, np.int64), np.zeros((1 << _CHECKS, 5), np.int64)
    for weight in range(4):
        errors = np.array([sum(1 << b for b in c) for c in combinations(range(_LENGTH), weight)] or [0], np.int64)
        nearest[_syndromes(errors)] = errors
    next_nearest[:] = nearest[:, None]
    fours = np.array([sum(1 << b for b in c) for c in combinations(range(_LENGTH), 4)], np.int64)
    found = _syndromes(fours)
    order = np.argsort(found, kind="stable")
    next_nearest[found[order[::5]]] = fours[order].reshape(-1, 5)
    return nearest, next_nearest


_NEAREST, _NEXT = _error_tables()


def golay_keys(words: np.ndarray) -> np.ndarray:
    """Six 12-bit codeword indices of each 23-bit word, some of them equal. Words that differ in one bit share an index.

    The code is perfect: one codeword lies within distance 3. If a word is 2 or less away from it, its neighbours
    decode to the same one. If it is 3 away, a neighbour may lie 4 away and decode to another codeword, which is then
    one of the five at distance 4 from the word.
    """
    syndromes = _syndromes(words)
    near = (words ^ _NEAREST[syndromes])[:, None]
    return np.concatenate([near, words[:, None] ^ _NEXT[syndromes]], axis=1) >> _CHECKS


def fingerprint(text: str | None) -> int:
    """Bit by bit, whether it is set in over half of the hashes of all shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < SHINGLE else map(b" ".join, zip(words, words[1:], words[2:]))
    return majority(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of 64-bit hashes: each bit as in over half of them."""
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _SUMMED):
        part = hashes[k : k + _SUMMED]
        total += np.unpackbits(part.byteswap().view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes)).view(">u8")[0])


#: bytes.split() without argument parts at exactly the six white-space characters; A-Z become a-z.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Hashes whose bits are unpacked at once.
_SUMMED = 1 << 15


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "print"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys so that fingerprints with at most two differing bits share one; by their bits in the three segments:

    (1, 0, any) or less: A within one bit, B equal; (0, 1, any): A equal, B within one; (1, 1, 0): A within one, C equal;
    (2, 0, 0): B and C equal; (0, 2, 0): A and C equal.
    """
    low_b, low_c = SEGMENTS[1] + SEGMENTS[2], SEGMENTS[2]
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        a = (prints >> np.uint64(low_b)).astype(np.int64)
        b = (prints >> np.uint64(low_c) & np.uint64((1 << SEGMENTS[1]) - 1)).astype(np.int64)
        c = (prints & np.uint64((1 << low_c) - 1)).astype(np.int64)
        near_a, near_b = golay_keys(a), golay_keys(b)
        groups = [
            near_a << 23 | b[:, None],
            near_b << 23 | a[:, None] | 1 << 40,
            near_a << 18 | c[:, None] | 2 << 40,
            (b << 18 | c)[:, None] | 1 << 45,
            (a << 18 | c)[:, None] | 1 << 46,
        ]
        keys = np.concatenate(groups, axis=1)
        keys.sort(axis=1)
        new = np.ones(keys.shape, bool)
        new[:, 1:] = keys[:, 1:] != keys[:, :-1]
        repeated = np.repeat(prints.view(np.int64), new.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(keys[new], pa.int64()), pa.array(repeated, pa.int64())], ["key", "print"])


def links(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column print) that connect exactly those linked by at most two bits.

    Fingerprints that share a key are joined and verified while a key has few. Those of larger groups meet by their
    single-bit neighbours instead: two fingerprints are at most two bits apart exactly if both are within one bit of some
    word, so each word links all that reach it to the smallest of them; that takes 65 rows a fingerprint and no pairs.
    """
    keyed = prints.mapInArrow(_keys, "key bigint, print bigint")
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(keyed.join(crowded, "key"))
    few, many = shared.where(F.col("n") <= paired).drop("n"), shared.where(F.col("n") > paired).select("print").distinct()
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    pairs = few.withColumnRenamed("print", "a").join(few.withColumnRenamed("print", "b"), "key").where("a < b").where(near).select("a", "b")
    words = F.expr("concat(array(print), transform(sequence(0, 63), i -> print ^ shiftleft(1L, i)))")
    reached = many.select("print", F.explode(words).alias("word"))
    least = reached.groupBy("word").agg(F.min("print").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = reached.join(least, "word").where("a != print").select("a", F.col("print").alias("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paired: int = PAIRED) -> DataFrame:
    """Per row of docs: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Fingerprints are made of lower-cased three-word shingles, repeats included, and linked at two or fewer differing
    bits; component_id is the smallest doc_id reachable over any chain of links. Copies collapse to one fingerprint before any key is made. Null, empty and
    white-space texts have fingerprint zero and are linked like all others. A null id is never the smallest unless all of a component are.
    Repeated rows come back as often as given. An empty table gives an empty result. Columns that are not named are never read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = staged(rows.mapInArrow(_fingerprints, "doc_id bigint, print bigint"))
    distinct = staged(marked.groupBy("print").agg(F.min("doc_id").alias("least")))
    found = components(links(distinct.select("print"), paired))
    of = distinct.join(found.select(F.col("node").alias("print"), "root"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = of.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = of.join(smallest, "root").select("print", "component_id")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return marked.join(labelled, "print").select("doc_id", digits.alias("fingerprint"), "component_id")
