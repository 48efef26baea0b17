"""Robust outliers where many rows of a cell are copies of one junk text, and by themselves."""

import numpy as np
import pytest

from tierweave.llm import outliers

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING"


def prose(rng, n_words):
    """Words of two to eight letters, sentences, a capital each."""
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(n_words)]
    return " ".join(f"{w.capitalize()}" if k % 12 == 0 else w for k, w in enumerate(words)) + "."


def judged(spark, texts):
    frame = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r.kept for r in outliers.robust_outliers(frame).collect()}


def test_a_third_of_copies_is_rejected(spark):
    rng = np.random.default_rng(11)
    clean = [prose(rng, 120) for _ in range(240)]
    junk = " ".join(f"{w}***" for w in prose(rng, 120).split())
    kept = judged(spark, [*clean, *[junk] * 120])
    assert all(kept[i] for i in range(240)) and not any(kept[i] for i in range(240, 360))


@pytest.mark.parametrize("every", [1, 3])
def test_symbol_heavy_texts_are_rejected(spark, every):
    """A symbol at each word, or two at every third one, in texts of 15 to 300 words."""
    rng = np.random.default_rng(12)
    clean = [prose(rng, int(n)) for n in rng.integers(15, 300, 300)]
    heavy = [" ".join(w + ("#" if every == 1 else "##") * (k % every == 0) for k, w in enumerate(prose(rng, n).split())) for n in (15, 20, 40, 60, 120, 180, 240, 300)]
    kept = judged(spark, [*clean, *heavy])
    assert sum(kept[i] for i in range(300)) >= 299 and not any(kept[i] for i in range(300, 308))
