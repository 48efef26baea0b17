"""Near copies by five-word shingles, against brute force."""

import re

import numpy as np
import pytest

import corpus_pipeline
from tierweave.llm import near_text

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def shingled(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def planted():
    """Originals, and copies with words replaced until the similarity is 0.8 to 0.95; further texts just below 0.8."""
    rng, rows, near, far = np.random.default_rng(7), [], [], []
    for k in range(40):
        words = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        original = " ".join(words)
        rows.append((1000 + k, original))
        for at, (low, high) in enumerate(((0.8, 0.84), (0.88, 0.92), (0.93, 0.96), (0.7, 0.79))):
            copy = list(words)
            while not low <= (j := jaccard(shingled(original), shingled(" ".join(copy)))) <= high:
                copy = list(words) if j < low else copy
                copy[rng.integers(len(copy))] = f"new{rng.integers(1 << 30)}"
            rows.append((10_000 + 10 * k + at, "  ".join(copy).upper()))
            (near if low >= 0.8 else far).append((1000 + k, rows[-1][0]))
    return rows, near, far


def brute(rows):
    sets, root = {i: shingled(t) for i, t in rows}, {i: i for i, _ in rows}
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if root[a] != root[b] and jaccard(sets[a], sets[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return root


def test_planted_near_copies_go(spark):
    rows, near, far = planted()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    left = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    truth = brute(rows)
    assert left == {i for i, r in truth.items() if i == r}
    assert not left & {b for _, b in near} and {a for a, _ in near} <= left
    assert sum(b in left for _, b in far) == len({b for _, b in far if truth[b] == b}) > 0


@pytest.mark.parametrize("paired, gathered", [(1, 2048), (24, 2048), (1, 1)])
def test_a_large_group_of_near_copies_is_one_component(spark, paired, gathered):
    rng = np.random.default_rng(3)
    words = [f"w{x}" for x in rng.integers(0, 5000, 200)]
    rows = [(1, " ".join(words))]
    for i in range(2, 150):
        copy = list(words)
        for at in rng.integers(0, 200, rng.integers(1, 5)):
            copy[at] = f"x{rng.integers(1 << 30)}"
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: r.component_id for r in near_text.near_copies(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), paired=paired, gathered=gathered).collect()}
    truth = brute(rows)
    if gathered > 1:
        assert got == truth
    # Leaders alone link nothing wrongly, and nearly all.
    assert all(truth[i] == truth[c] for i, c in got.items()) and sum(got[i] == truth[i] for i in got) >= 0.9 * len(got)


def test_no_link_of_a_large_group_is_lost(spark, monkeypatch):
    """Pairs of near copies that share a key with many texts unlike them: leaders, one a round, find few of them."""
    rng, rows = np.random.default_rng(11), []
    for i in range(40):
        words = [f"w{x}" for x in rng.integers(0, 5000, 60 + 2 * i)]
        rows += [(2 * i + 1, " ".join(words)), (2 * i + 2, " ".join([*words, "end"]))]
    marked = near_text._marked

    def one_key(batches):
        for b in marked(batches):
            keys = near_text.pa.array([[0]] * b.num_rows, near_text.pa.list_(near_text.pa.int64()))
            prints = near_text.pa.array([n & ~0xFF for n in b.column("node").to_pylist()], near_text.pa.int64())
            b = b.set_column(b.schema.get_field_index("keys"), "keys", keys)
            yield b.set_column(b.schema.get_field_index("print"), "print", prints)

    monkeypatch.setattr(near_text, "_marked", one_key)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    for block in (5, 1024):
        got = {r.doc_id: r.component_id for r in near_text.near_copies(docs, paired=1, gathered=1, block=block).collect()}
        assert got == {i: (i - 1) // 2 * 2 + 1 for i, _ in rows}


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "two one"), (None, "one two"), (None, "lost"), (4, "one two")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = sorted(((r.doc_id, r.component_id) for r in near_text.near_copies(docs).collect()), key=repr)
    assert got == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 4), (6, 6), (None, 4), (None, None)], key=repr)
    assert near_text.near_copies(docs.limit(0)).count() == 0


def test_simhash_pairs_are_candidates(spark):
    prints = {1: 0, 2: 0b101, 3: 0, 4: (1 << 40) - 1, 5: 0b111 << 50}
    nodes = spark.createDataFrame([(i, 10 * i, p) for i, p in prints.items()], "node BIGINT, n BIGINT, print BIGINT")
    got = {(*sorted(((r.a, r.n), (r.b, r.m))),) for r in near_text.simhash_pairs(nodes).collect()}
    assert got == {((1, 10), (2, 20)), ((1, 10), (3, 30))}


def test_simhash_alone_finds_near_copies(spark, monkeypatch):
    """With band keys that nobody shares, texts within two bits of each other are still one component."""
    words = [f"w{x}" for x in range(4000)]
    rows = [(i, " ".join([*words, f"end{i}"])) for i in range(1, 6)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    apart = near_text._marked

    def unshared(batches):
        for b in apart(batches):
            at = b.schema.get_field_index("keys")
            nodes = b.column("node").to_pylist()
            yield b.set_column(at, "keys", near_text.pa.array([[n] for n in nodes], near_text.pa.list_(near_text.pa.int64())))

    monkeypatch.setattr(near_text, "_marked", unshared)
    near = {r.component_id for r in near_text.near_copies(docs).collect()}
    assert near == {1}
