"""Operators with an exact answer, against plain Python on small hostile tables."""

import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tierweave.llm import exact_dedup, html_text, outliers, packing, secrets, segmentation, simhash, token_counts
from tierweave.llm.components import components
from tierweave.llm.vocabulary import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
KEY = "AKIA" + "Q7ZX" * 5
TEXTS = [
    (1, "The cat sat on the mat and the cat sat on the mat again today", "en", "a"),
    (2, "The cat  sat on\tthe mat and the cat sat on the mat again today", "en", "b"),
    (2, "The cat  sat on\tthe mat and the cat sat on the mat again today", "en", "b"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \n\t ", None, "a"),
    (6, "a\n\na\nb a\n \na", "de", None),
    (7, LONG, "en", "c"),
    (8, 'token = "0123456789abcdef0123456789abcdef" and PassWord: hunter22 ' + KEY, "en", "a"),
    (9, 'Secret="abc" api_key=xyz123!! ￿ token:\U0001f600 token : a1b2c3', "fr", "b"),
    (10, "über \U0001f600 naïve ▁ <|endoftext|> <s> x y  z\r\n", "de", "b"),
    (None, "orphan text without an id", "en", "a"),
]
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING"


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame(TEXTS, SCHEMA).repartition(3)
    clash = ("id", "body", "hash", "kept", "key", "row", "print", "n_words", "start", "length", "_text", "grp", "seed")
    return made.withColumns({c: F.lit("x") for c in clash})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("min_hot", [1, 256])
def test_exact_dedup(docs, empty, min_hot):
    got = exact_dedup.exact_dedup(docs, min_hot=min_hot).collect()
    groups = defaultdict(list)
    for i, t, _, _ in TEXTS:
        groups[normal(t)].append(i)
    assert len(got) == len(TEXTS)
    expected = sorted(((i, min((x for x in groups[normal(t)] if x is not None), default=None), len(groups[normal(t)])) for i, t, _, _ in TEXTS), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == expected
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_base_statistics(docs, empty):
    got = {(r.doc_id, r.n_words): r for r in outliers.robust_outliers(docs, min_group=5).collect()}
    for i, t, _, _ in TEXTS:
        w = WORD.findall(t or "")
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        often, covered = Counter(windows), set()
        for k, x in enumerate(windows):
            if often[x] > 1:
                covered.update(range(k, k + 5))
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = got[i, len(w)]
        assert (r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered),
        )
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
    assert outliers.robust_outliers(empty).count() == 0


def test_outliers_against_numpy(spark):
    rng = np.random.default_rng(5)
    clean = [" ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(120)) for _ in range(240)]
    junk = [" ".join(f"{w}***" for w in c.split()) for c in clean[:12]]
    rows = [(i, t, "en", "s") for i, t in enumerate([*clean, *junk])]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in outliers.robust_outliers(frame).collect()}
    assert all(got[i].kept for i in range(240)) and not any(got[i].kept for i in range(240, 252))
    # Distances by an inverse in numpy, from the same start and steps.
    stats = outliers.features(outliers.base_statistics(frame)).orderBy("doc_id").toPandas()
    x = stats[list(outliers.FEATURES)].to_numpy(float)
    floors = np.array(list(outliers.FEATURES.values())) ** 2
    low, mid, high = (np.array([sorted(c)[max(0, int(np.ceil(q * len(c))) - 1)] for c in x.T]) for q in (0.25, 0.5, 0.75))
    mean, cov = mid, np.diag(((high - low) / 1.349) ** 2)
    for _ in range(outliers.STEPS):
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov + np.diag(floors)), x - mean)
        core = x[d <= np.sort(d)[int(np.ceil(outliers.SUPPORT * len(d))) - 1]]
        mean, cov = core.mean(axis=0), np.cov(core.T, bias=True)
    d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov + np.diag(floors)), x - mean)
    scale = max(1.0, np.sort(d)[int(np.ceil(0.5 * len(d))) - 1] / outliers.CHI2_MEDIAN)
    d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov * scale + np.diag(floors)), x - mean)
    assert np.allclose([got[i].distance for i in range(252)], d, rtol=0.05, atol=0.05)


def test_secret_spans(docs, empty):
    kinds = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", r"(AKIA[A-Z0-9]+)", 1, 20), ("hex", r"([0-9a-f]+)", 1, 24)]
    got = [(r.doc_id, r.base, r.n_assign, r.n_access, r.n_hex) for r in secrets.scan_secrets(docs).withColumn("base", secrets.spelled(F.col("base"))).collect()]
    expected = []
    for i, t, _, _ in TEXTS:
        found = [(m.start(), n, k, m.end()) for n, (k, p, g, least) in enumerate(kinds) for m in re.finditer(p, t or "", re.A) if len(m[g]) >= least]
        counts = Counter(k for _, _, k, _ in found)
        expected.append((i, ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found)), counts["assign"], counts["access"], counts["hex"]))
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert secrets.scan_secrets(empty).count() == 0


def test_widely_copied_secret_is_no_live_one(spark):
    shared, own = "ghp_" + "Ab3dEf6hIj9l" * 3, "ghp_" + "Zy8xWv5uTs2r" * 3
    rows = [(i, f"key {shared} here", "en", f"owner{i % 5}") for i in range(20)] + [(20, f"x {own} y", "en", "owner1"), (21, f"{own}", "fr", "owner1")]
    got = {r.doc_id: r for r in secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(not got[i].spans and got[i].n_live == 0 for i in range(20))
    assert [len(got[i].spans) for i in (20, 21)] == [1, 1] and got[20].n_live == 1
    text = spark.createDataFrame([("ab SECRET cd HEX", [(3, 0, "k", 9), (5, 1, "k", 8), (13, 0, "k", 16)])], "t STRING, s ARRAY<STRUCT<start: BIGINT, nth: INT, kind: STRING, end: BIGINT>>")
    assert text.select(secrets.masked(F.col("t"), F.col("s"))).first()[0] == "ab [secret] cd [secret]"


def test_token_counts(docs, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs).collect()), key=repr)
    expected = [(i, len((t or "").encode()), len(n := model.encode(t or "")), len(n) > 4096) for i, t, _, _ in TEXTS]
    assert got == sorted(expected, key=repr)
    assert token_counts.token_counts(empty).count() == 0


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b   c ", " \n x ", LONG[:5000], "a" * 3000, " ".join("ab" * 900)])
def test_windows_lose_no_token(text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    counted = sum(len(model.encode(p)) for w in token_counts.windows(text, 50) for p in token_counts.cut_pieces(w))
    assert counted == len(model.encode(text))


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    got = packing.pack_documents(docs).collect()
    per_doc, sequences = Counter(), defaultdict(list)
    ids = {(i, n + 1): [*e, 1] for i, t, _, _ in TEXTS for e in [tokenizer.encode(t or "", add_special_tokens=False).ids] for n in [len(e)]}
    for r in got:
        part = ids[r.doc_id, r.doc_tokens][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        per_doc[r.doc_id, r.doc_tokens] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    repeats = Counter((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for i, t, _, _ in TEXTS)
    assert per_doc == {k: k[1] * n for k, n in repeats.items()}
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(empty).count() == 0


def test_vector_packing_holds_all_limits():
    rng = np.random.default_rng(1)
    demands = np.stack([rng.integers(1, 400, 3000), np.ones(3000, np.int64), rng.integers(0, 300, 3000)], axis=1)
    limits = np.array([2048, 16, 1000])
    bins, places = packing.dot_product_packing(demands, limits)
    sums = np.stack([np.bincount(bins, demands[:, k]) for k in range(3)], axis=1)
    assert (sums <= limits).all() and len(set(zip(bins, places))) == 3000
    assert len(sums) <= 1.05 * (demands.sum(axis=0) / limits).max() + 1
    with pytest.raises(ValueError):
        packing.dot_product_packing(np.array([[3000, 1, 0]]), limits)


def test_golay_keys_are_shared_within_one_bit():
    words = np.random.default_rng(0).integers(0, 1 << 23, 2000)
    keys = simhash.golay_keys(words)
    for b in range(23):
        assert (keys[:, :, None] == simhash.golay_keys(words ^ (1 << b))[:, None, :]).any((1, 2)).all()


def test_fingerprints(docs, empty):
    def plain(text):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    got = sorted((repr((r.doc_id, r.fingerprint)) for r in simhash.near_duplicates(docs).collect()))
    assert got == sorted(repr((i, f"{plain(t):016x}")) for i, t, _, _ in TEXTS)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("paired", [1, 24])
def test_links_are_complete(spark, paired):
    rng = np.random.default_rng(3)
    seeds = rng.integers(-(2**63), 2**63 - 1, 40)
    prints = {int(s) for s in seeds}
    for s in list(prints):
        now = s
        for _ in range(12):
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                now ^= 1 << int(b)
            now = (now + 2**63) % 2**64 - 2**63
            prints.add(now)
    prints = sorted(prints)
    got = {(r.node, r.root) for r in components(simhash.links(spark.createDataFrame([(p,) for p in prints], "print BIGINT"), paired)).collect()}
    unsigned = np.array(prints, np.int64).view(np.uint64)
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.nonzero(np.bitwise_count(unsigned[i + 1 :] ^ unsigned[i]) <= 2)[0]:
            a, b = sorted((root(prints[i]), root(prints[i + 1 + j])))
            parent[b] = a
    assert got == {(p, root(p)) for p in prints if sum(root(q) == root(p) for q in prints) > 1}


def test_html_blocks():
    tree = html_text.train_tree()
    page = """<html><head><title>T</title><style>p{}</style></head><body class="page with-sidebar"><nav><a href=1>Home</a></nav>
    <div class="cookie-notice"><p>We use cookies on this site to make it work better for all of you here.</p></div>
    <article><header><h1>A &amp; B</h1></header><p>First <b>para</b>graph,<br>with &eacute; and\n a <a href=x>link</a> in it.<p>Next one.
    <script>var x = "</p><p>no</p>";</script><div class="comments"><p>Reader says this is a very good article, thank you so much.</p></div></article>
    <form><p>Sign up for our letter with your address today please</p></form><footer>&copy; site</footer></body></html>"""
    assert html_text.main_text(page, tree) == "A & B\nFirst paragraph, with é and a link in it.\nNext one."
    assert html_text.main_text(None, tree) == html_text.main_text("", tree) == html_text.main_text("<p", tree) == ""
    assert html_text.main_text("<article><p>cut off in a com<!-- ment", tree) == "cut off in a com"
    assert html_text.main_text("<article>" + "<p>word" * 20_000, tree).count("word") == 20_000
    assert all(html_text.decide(tree, row[:-1]) == bool(row[-1]) for row in html_text.LABELLED)


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, "<article><p>Text \U0001f600</article>"), (2, None, "<article><p>Text \U0001f600</article>")], "page_id BIGINT, url STRING, html STRING")
    got = sorted(tuple(r) for r in html_text.extract_text(pages.withColumn("text", F.lit(1))).collect())
    assert got == [(1, "u", "", 0), (2, None, "Text \U0001f600", 6), (2, None, "Text \U0001f600", 6)]


def _paths(vocabulary, text):
    text, out = "▁" + text.replace(" ", "▁"), {}

    def walk(i, pieces, weight):
        if i == len(text):
            out[tuple(pieces)] = weight
        for j in range(i + 1, len(text) + 1):
            if (at := vocabulary.ids.get(text[i:j])) is not None:
                walk(j, [*pieces, at], weight + vocabulary.log_p[at])

    walk(0, [], 0.0)
    total = np.log(sum(np.exp(w) for w in out.values()))
    return {p: w - total for p, w in out.items()}


def test_gumbel_samples_follow_the_lattice():
    vocabulary = segmentation.Vocabulary(tokenizer_path("piece_bpe_32k.model"))
    paths, n = _paths(vocabulary, "the and in"), 3000
    found = segmentation.sample_batch(["the and in"] * n, np.random.default_rng(0).integers(0, 2**63, n).astype(np.uint64), vocabulary, 3)
    for own in found:
        assert len({tuple(x[0].tolist()) for x in own}) == 3 and own[0][2] > own[1][2] > own[2][2]
        assert all(abs(x[1] - paths[tuple(x[0].tolist())]) < 1e-9 for x in own)
    first, second = (Counter(tuple(own[k][0].tolist()) for own in found) for k in (0, 1))
    for p, w in paths.items():
        assert abs(first[p] / n - np.exp(w)) < 0.04
        assert abs(second[p] / n - sum(np.exp(v) * np.exp(w) / (1 - np.exp(v)) for q, v in paths.items() if q != p)) < 0.04
    # Inverse inclusion chances make the samples an unbiased estimate of the whole.
    assert abs(np.mean([sum(np.exp(x[1] - x[3]) for x in own) for own in found]) - 1) < 0.02


def test_segmentations_decode(docs, empty):
    got = segmentation.sample_segmentations(docs, with_ids=False).collect()
    assert all(r.decodes for r in got) and Counter(r.doc_id for r in got)[7] == 2
    again = segmentation.sample_segmentations(docs.repartition(5), with_ids=False).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert [(r.n_pieces, list(r.pieces)) for r in segmentation.sample_segmentations(docs.where("doc_id = 4")).collect()] == [(0, [])]
    assert segmentation.sample_segmentations(empty).count() == 0


def test_segmentation_query_gives_the_pieces(spark, tmp_path):
    import zlib

    from tierweave.llm.queries import op2_gumbel_segmentations

    spark.createDataFrame([(1, "the and in"), (2, None), (3, "naïve  ☃ text")], "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    got = op2_gumbel_segmentations(spark, str(tmp_path)).collect()
    vocabulary = segmentation.Vocabulary(tokenizer_path("piece_bpe_32k.model"))
    texts = {1: "the and in", 2: "", 3: "naïve  ☃ text"}
    assert {r.doc_id for r in got} == set(texts) and all(r.decodes for r in got)
    for r in got:
        assert segmentation.decode(r.pieces, vocabulary.pieces) == texts[r.doc_id] and len(r.pieces) == r.n_pieces
        assert r.pieces_crc32 == zlib.crc32(np.array(r.pieces, "<u4").tobytes())
        assert r.decoded == texts[r.doc_id]


def test_segmentation_work_is_by_batch():
    """Python calls follow the texts, not their pieces, also where bytes are spelled and decoded (they came to more than one a piece)."""
    import pyarrow as pa

    path = tokenizer_path("piece_bpe_32k.model")
    texts = ["the and in\nfor\tone ☃ of them, " * 1_000, "", None, "  ", "a\n b" * 3_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts), pa.array(range(5), pa.int64())], ["doc_id", "text", "seed"])
    calls = Counter()
    samples = segmentation._samples(path, 2, 1.0, True, True)
    list(samples(iter([batch])))  # the vocabulary is made once a worker
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        found = list(samples(iter([batch])))
    finally:
        sys.setprofile(None)
    got = [row for out in found for row in out.to_pylist()]
    vocabulary, seen = segmentation.Vocabulary(path), set()
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["decodes"] and segmentation.decode(r["pieces"], vocabulary.pieces) == text and r["n_pieces"] == len(r["pieces"])
        assert r["pieces_crc32"] == zlib.crc32(np.array(r["pieces"], "<u4").tobytes())
        seen.add(tuple(r["pieces"]))
    assert len(seen) == len(got) - 1 and [r["doc_id"] for r in got].count(1) == 1  # both texts without characters have the empty path
    pieces = sum(r["n_pieces"] for r in got)
    assert pieces > 20_000 and calls["call"] + calls["c_call"] < pieces / 4


def test_segmentation_words_and_numbers_match_plain_forms():
    words = re.compile("▁*[^▁]+(?:▁+\\Z)?|▁+")
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("ab \n▁é\U0001f600"), n)) for n in rng.integers(0, 12, 2_000)] + ["", " ", "   ", "▁", " a", "a  ", "\ud800 x"]
    counts, which, joined, lengths = segmentation.different_words(texts)
    ends = np.cumsum([0, *lengths])
    found = [joined[i:j] for i, j in zip(ends, ends[1:])]
    bounds = np.cumsum([0, *counts])
    for t, i, j in zip(texts, bounds, bounds[1:]):
        assert [found[w] for w in which[i:j]] == (words.findall("▁" + t.replace(" ", "▁")) if t else [])
    assert len(set(found)) == len(found) and segmentation.different_words([])[0].tolist() == segmentation.different_words([""])[1].tolist() == []
    assert segmentation.sample_batch([], np.zeros(0, np.uint64), segmentation.Vocabulary(tokenizer_path("piece_bpe_32k.model")), 2) == []
    seeds, counters = rng.integers(0, 2**64, 200, dtype=np.uint64), rng.integers(0, 2**32, 200, dtype=np.uint64)
    assert segmentation.uniforms(seeds, counters).tolist() == [segmentation.uniform(int(s), int(c)) for s, c in zip(seeds, counters)]


def test_segmentation_trie_steps_match_entries():
    vocabulary = segmentation.Vocabulary(tokenizer_path("piece_bpe_32k.model"))
    heads = {p[:k] for p in vocabulary.ids for k in range(1, len(p) + 1)}
    for word in [*list(vocabulary.ids)[::97], "▁thex", "☃☃", "▁\U0010ffff", "日本"]:
        node = np.zeros(1, np.int64)
        for k, c in enumerate(word):
            node = vocabulary.follow(node, np.array([ord(c)]))
            assert (node[0] > 0) == (word[: k + 1] in heads)
            if not node[0]:
                break
            assert vocabulary.entry[node[0]] == vocabulary.ids.get(word[: k + 1], -1)
