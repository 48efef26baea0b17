"""Packing beyond plain documents: whole-text encoding, ids that many rows share, and turns of conversations."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierweave.llm import packing
from tierweave.llm.common import staged, table
from tierweave.llm.vocabulary import LONG_RUN, tokenizer_path, whole_text_encoder

BYTE_LEVEL = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(BYTE_LEVEL))


def test_whole_texts_get_the_library_s_ids(library):
    encode = whole_text_encoder(tokenizer_path(BYTE_LEVEL))
    ids = lambda t: library.encode(t, add_special_tokens=False).ids
    rng = random.Random(1)
    letters = "aeinst 'sdlm\t\n.,-1 2Éß漢\U0001f600 ​\x1c\x85"
    texts = ["", " ", "a", "x" * LONG_RUN, " " * LONG_RUN, *("".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(3000))]
    for t in texts:
        assert encode(t) == np.array(ids(t), "<u4").tobytes(), repr(t)
    # Every code point, beside a letter, a digit, a mark and a space.
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    for i in range(0, len(points), 4000):
        for beside in "a1! ":
            t = "\n".join(f"{beside}{chr(c)}{beside} x" for c in points[i : i + 4000])
            got = encode(t)
            assert got is None or got == np.array(ids(t), "<u4").tobytes(), (beside, hex(points[i]))
    assert [encode(t) for t in ("<|endoftext|>", "a <|endoftext|> b", "x" * (LONG_RUN + 1), " \n" * LONG_RUN)] == [None] * 4


def test_a_vocabulary_in_another_order_is_refused(tmp_path):
    import json

    given = json.load(open(tokenizer_path(BYTE_LEVEL), encoding="utf-8"))
    given["model"]["merges"][3:5] = given["model"]["merges"][4:2:-1]
    (tmp_path / "other.json").write_text(json.dumps(given))
    assert whole_text_encoder(str(tmp_path / "other.json")) is None


def test_rows_that_share_an_id_spread_over_blocks(spark):
    rows = [(None if i % 3 else i, f"text {i} " + "word " * (i % 50)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    pieces = staged(packing.token_pieces(docs).withColumn("loss", F.col("length")))
    placed = packing.pack_pieces(pieces, 512, 64, 400, "loss", block=256)
    blocks = Counter(r.sequence_id >> 24 for r in placed.collect())
    assert len(blocks) == 12 and max(blocks.values()) <= 2 * 256 and sum(blocks.values()) == 3000


def test_conversations_keep_their_roles_and_the_loss_limit_binds(spark, library):
    turns = [(c, t, "assistant" if t % 2 else "user", f"turn {t} of {c} " + "word " * ((c * 7 + t) % 90)) for c in range(150) for t in range(4)]
    # One key for two turns of different roles, no key at all, no role, no text.
    turns += [(1, 1, "user", "same key"), (1, 1, "assistant", "same key"), (None, None, "assistant", "no key"), (None, None, "user", "no key"), (9, 9, None, "no role"), (9, 8, "assistant", None)]
    schema = "conv_id BIGINT, turn INT, role STRING, text STRING"
    df = spark.createDataFrame(turns, schema).repartition(3).withColumns({c: F.lit("x") for c in ("doc_id", "loss", "bears", "block", "length")})
    size, most = 400, 150
    got = packing.pack_conversations(df, size=size, max_segments=20, max_loss=most).collect()
    expected = Counter()
    for _, _, role, text in turns:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), most):
            expected[zlib.crc32(np.array(ids[start : start + most], "<u4").tobytes()), len(ids[start : start + most])] += 1
    assert Counter((r.ids_crc32, r.length) for r in got) == expected
    bearing = {zlib.crc32(np.array(part, "<u4").tobytes()) for _, _, role, text in turns if role == "assistant" for ids in [[*library.encode(text or "", add_special_tokens=False).ids, 1]] for part in [ids[s : s + most] for s in range(0, len(ids), most)]}
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    losses = []
    for own in sequences.values():
        assert sum(r.length for r in own) <= size and len(own) <= 20
        losses.append(sum(r.length for r in own if r.ids_crc32 in bearing and text_bears(r, turns, library)))
    assert max(losses) <= most and sorted(losses)[len(losses) // 2] > 0.8 * most
    assert packing.pack_conversations(df.limit(0)).count() == 0


def text_bears(row, turns, library):
    """Texts that both roles have are told apart by nothing in the result; they are left out of the count."""
    return row.ids_crc32 not in {zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for t in ("same key", "no key")}


def test_conversations_of_the_tables(spark):
    turns = table(spark, "/root/testdata/sf0.001", "conversations")
    got = packing.pack_conversations(turns)
    per_sequence = got.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("segments"))
    assert per_sequence.where("tokens > 2048 OR segments > 64").isEmpty()
    assert got.where("start = 0").count() == turns.count()
