"""Merkle manifest, byte pairs and whitening against plain Python, the library and numpy."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierweave.llm import byte_pairs, merkle, whitening
from tierweave.llm.common import staged, table
from tierweave.llm.queries import ORACLE, op11_merkle_manifest
from tierweave.llm.vocabulary import tokenizer_path

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CLASH = ("tree", "size", "level", "lo", "hi", "digest", "bucket", "leaf", "top", "siblings", "ids", "point", "n_dims", "_at", "_tie")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(digests):
    """Top of a list of digests, and for each its (left, right) siblings from the bottom up."""
    paths, now, covers = [[] for _ in digests], list(digests), [[i] for i in range(len(digests))]
    while len(now) > 1:
        above, above_covers = [], []
        for a in range(0, len(now), 3):
            run = now[a : a + 3]
            for k in range(len(run)):
                for leaf in covers[a + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(H(*run))
            above_covers.append(sum(covers[a : a + 3], []))
        now, covers = above, above_covers
    return now[0], paths


def expected_proofs(rows):
    leaf_of = lambda d, t, l, s, n: H(*map(field, (d, s, l, n, t)))
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append((r, leaf_of(*r)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    climbed = {s: climb([leaf for _, leaf in trees[s]]) for s in order}
    root, upper = climb([climbed[s][0] for s in order])
    out = []
    for s, over in zip(order, upper):
        for (r, leaf), path in zip(trees[s], climbed[s][1]):
            path = path + over
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None:
                now = leaf_of(r[0], r[1].replace("\n", ""), *r[2:])
            for left, right in path:
                now = H(left, now, right)
            out.append((r[0], leaf, climbed[s][0], root, H(*(a + b for a, b in path)), now, now == root))
    return sorted(out, key=repr)


def hostile_documents():
    rows = [(i, f"line {i}\nend" if i % 3 else f"plain {i}", "en", "hot" if i % 3 else f"s{i % 7}", i) for i in range(200)]
    rows += [(None, "no id\n", None, "hot", None)] * 5 + [(7, "line 7\nend", "en", "hot", 7)] * 3 + [(7, "other", "en", "hot", 7)]
    rows += [(1000, None, None, None, None), (1001, "", "de", "", 0), (1002, "x\n" * 50_000, "de", "ünï", 100_000), (-5, "a", "fr", None, 1)]
    return rows


@pytest.mark.parametrize("band", [1, 2, merkle.BAND])
def test_merkle_proofs(spark, band):
    rows = hostile_documents()
    docs = spark.createDataFrame(rows, DOCS).repartition(5).withColumns({c: F.lit("x") for c in CLASH})
    got = merkle.document_proofs(docs, band)
    assert sorted(map(tuple, got.collect()), key=repr) == expected_proofs(rows)


def test_merkle_small_tables(spark):
    for rows in ([], [(1, "a", "en", "s", 1)], [(1, "a", "en", "s", 1), (2, "b\n", "en", None, 2)]):
        got = merkle.document_proofs(spark.createDataFrame(rows, DOCS))
        assert sorted(map(tuple, got.collect()), key=repr) == (expected_proofs(rows) if rows else [])


def test_merkle_labels_nest(spark):
    """Children's intervals follow each other without gaps and fill their parent's."""
    rows = staged(spark.range(100).select(F.lit("t").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("digest")))
    nodes = merkle.grown(merkle.numbered(rows, ["id"]), band=2).nodes().collect()
    assert sorted({n.level for n in nodes}) == [0, 1, 2, 3, 4, 5] and len(nodes) == 100 + 34 + 12 + 4 + 2 + 1
    for parent in (n for n in nodes if n.level):
        inside = sorted((n.lo, n.hi, n.digest) for n in nodes if n.level == parent.level - 1 and parent.lo <= n.lo and n.hi <= parent.hi)
        assert inside[0][0] == parent.lo and inside[-1][1] == parent.hi and all(a[1] == b[0] for a, b in zip(inside, inside[1:]))
        assert parent.digest == H(*(d for _, _, d in inside))


def test_merkle_matches_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    result = connection.execute(ORACLE["op11_merkle_manifest"])
    names = [d[0] for d in result.description]
    mine = op11_merkle_manifest(spark, folder)
    assert sorted(names) == sorted(mine.columns)
    assert sorted(map(tuple, mine.select(*names).collect()), key=repr) == sorted(result.fetchall(), key=repr)


TEXTS = [
    None, "", " ", "\n\n  \t", "plain words  and   more\n\n", "I'll don't we've 'S they're x's", "über naïve \U0001f600‍\U0001f600 ▁ ﷽ 漢字かな 12345 ١٢٣",
    "<|endoftext|>", "a<|endoftext|>b  <|endoftext|> <|endoftext|", "\x1c\x1d\x85  z　", "x" * 30_000, "ab" * 20_000 + " tail", "-" * 5_000 + "=" * 999,
    " ".join(f"word{i % 977}x{i}" for i in range(20_000)), "same", "same", "Ā" * 3000, "�﻿\0",
]


def test_byte_pairs_against_the_library(spark):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    real = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    texts = TEXTS + real
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING").repartition(3)
    encoded = byte_pairs.encode_texts(docs.withColumns({c: F.lit("x") for c in CLASH}))
    got = {r.doc_id: r for r in encoded.withColumn("back", byte_pairs.decoded(F.col("ids"))).collect()}
    digest = {r.doc_id: r for r in byte_pairs.digests(encoded).collect()}
    assert len(got) == len(digest) == len(texts)
    for i, t in enumerate(texts):
        ids, i = library.encode(t or "", add_special_tokens=False).ids, i or None
        assert got[i].ids == ids, t
        assert got[i].back == library.decode(ids, skip_special_tokens=False) == (t or "")
        assert tuple(digest[i]) == (i, len(ids), H(",".join(map(str, ids))), H(t or ""))
    assert byte_pairs.digests(byte_pairs.encode_texts(docs.limit(0))).count() == 0


def test_decoding_any_ids(spark):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    rng = np.random.default_rng(3)
    lists = [rng.integers(0, 50257, rng.integers(0, 30)).tolist() for _ in range(200)] + [[99_999, 72], [-1]]
    df = spark.createDataFrame([(i, ids) for i, ids in enumerate(lists)], "i INT, ids ARRAY<INT>")
    for r in df.select("i", byte_pairs.decoded(F.col("ids")).alias("t")).collect():
        assert r.t == library.decode([i for i in lists[r.i] if 0 <= i < 50257], skip_special_tokens=False)


def test_merges_against_repeated_scans():
    """The queue merges as a scan for the lowest, leftmost rank does, over words with many ties and stale pairs."""
    pairs = byte_pairs.BytePairs(tokenizer_path("byte_bpe_50k.json"))
    rng = np.random.default_rng(1)
    words = ["a" * k for k in range(1, 40)] + ["".join(rng.choice(list("abeinst "), rng.integers(1, 40))) for _ in range(300)]
    for word in words:
        ids = [pairs.first_ids[b] for b in word.encode()]
        slow = list(ids)
        while True:
            ranked = [(pairs.rank_of[a * pairs.size + b], i) for i, (a, b) in enumerate(zip(slow, slow[1:])) if a * pairs.size + b in pairs.rank_of]
            if not ranked:
                break
            rank, i = min(ranked)
            slow[i : i + 2] = [pairs.made_by[rank]]
        assert pairs.merged(ids) == slow, word


def whitened_by_numpy(vectors, components):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (fit * n - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > 1e-10 * e[0]).sum()))
    return n, ((x * n - s) ** 2).sum(axis=1), ((x * n - s) / n) @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check_whitening(got, ids, vectors, components=whitening.COMPONENTS):
    n, deviation, white, explained = whitened_by_numpy(vectors, components)
    rows = sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[3], r[1]))
    k = white.shape[1]
    assert len(rows) == len(ids) * k and {r[2] for r in rows} == {n}
    order = sorted(range(len(ids)), key=lambda i: (ids[i], deviation[i]))
    mine = np.array([r[4] for r in rows]).reshape(len(ids), k)
    assert [r[3] for r in rows[::k]] == [deviation[i] for i in order]
    signs = np.sign((mine * white[order]).sum(axis=0))
    assert np.abs(mine * signs - white[order]).max() < 1e-7
    assert np.abs(np.array([r[5] for r in rows[:k]]) / explained - 1).max() < 1e-9
    assert len({r[6] for r in rows}) == 1 and rows[0][6] < 1e-9


@pytest.mark.parametrize("factory", ["plain", "hot copies", "ill-conditioned", "dependent", "narrow", "wide range"])
def test_whitening_against_numpy(spark, factory):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 20)) * np.linspace(3, 0.5, 20)
    if factory == "hot copies":
        vectors = np.concatenate([vectors, np.repeat(vectors[:1], 400, axis=0)])
    if factory == "ill-conditioned":
        vectors = vectors * np.logspace(3, 0, 20)
    if factory == "dependent":
        vectors[:, 7], vectors[:, 9], vectors[:, 3:6] = vectors[:, 8], 4.0, 0
    if factory == "narrow":
        vectors = vectors[:, :5]
    if factory == "wide range":
        vectors[0, 0], vectors[1, 1] = 1e4, -1e3
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").repartition(4).withColumns({c: F.lit("x") for c in CLASH})
    check_whitening(whitening.whiten(df), [i for i, _ in rows], [v for _, v in rows])


def test_whitening_hostile_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i // 2, rng.normal(size=4).tolist()) for i in range(40)]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0]), (903, [float("nan"), 0.0, 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [1.0, 2.0]), (906, [1e300, 0.0, 0.0, 0.0])]
    schema = "vec_id BIGINT, embedding ARRAY<DOUBLE>"
    got = whitening.whiten(spark.createDataFrame(good + bad, schema))
    check_whitening(got, [i for i, _ in good], [v for _, v in good])
    for rows in ([], bad[:5], [(1, [1.0, 2.0])] * 3):
        empty = whitening.whiten(spark.createDataFrame(rows, schema))
        assert empty.count() == 0 and empty.columns == got.columns
    huge = whitening.whiten(spark.createDataFrame([(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (None, [0.0, 5.0])], schema)).collect()
    assert {r.deviation for r in huge if r.vec_id is not None} == {None} and {r.vec_id for r in huge} == {1, 2, None}


def test_triangular_solve():
    rng = np.random.default_rng(7)
    r, rows = np.triu(rng.normal(size=(6, 6))) + 3 * np.eye(6), rng.normal(size=(9, 6))
    assert np.allclose(whitening.triangular_solve(rows, r) @ r, rows)
