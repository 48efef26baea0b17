"""Language identification by rank-order profiles and out-of-place distance."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierweave.llm.common import small_batches, staged

#: n-grams of a language's profile, and of a document's.
PROFILE = 400
#: Languages that the label column may have; profiles of so many fit every task.
MOST_LANGUAGES = 2_000
#: n-gram lengths. A code point takes 21 bits, so three fit a 64-bit number; RIM, no letter, stands for the rim of a word.
ORDERS = (1, 2, 3)
_BITS, RIM = 21, 1
#: A text is unlike every language if its best similarity is below this: two thirds of a language's common documents score over twice as much.
LEAST_SIMILARITY = 0.12

UNDETERMINED = "und"
#: n-grams that a task gathers for a language before it hands them on.
_GATHERED = 1 << 22


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def ngrams(text: str, letters: np.ndarray) -> np.ndarray:
    """All n-grams of the lower-cased text's words, with the rim of a word as a character; none if there is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(letters[points], points, RIM)
    # One rim between words, one at both ends.
    points = np.concatenate(([RIM], points, [RIM]))
    points = points[np.concatenate(([True], (points[1:] != RIM) | (points[:-1] != RIM)))]
    if len(points) < 3:
        return points[:0]
    pairs = points[:-1] << _BITS | points[1:]
    threes = pairs[:-1] << _BITS | points[2:]
    # No n-gram reaches from one word into the next.
    return np.concatenate([points[points != RIM], pairs, threes[points[1:-1] != RIM]])


def ranked(grams: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams, by falling count; the smaller code first among equals."""
    kinds, counts = np.unique(grams, return_counts=True)
    return kinds[np.argsort(-counts, kind="stable")[:most]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = _letters()
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    sizes: dict[str, int] = {}

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        kinds, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return kinds, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)

    def rows(lang: str) -> pa.RecordBatch:
        kinds, counts = merged(held.pop(lang))
        sizes.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(kinds)), pa.array(kinds, pa.int64()), pa.array(counts)], ["lang", "gram", "n"])

    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in set(langs):
            parts = [ngrams(t, letters) for t, own in zip(texts, langs) if own == lang]
            kinds, counts = np.unique(np.concatenate(parts), return_counts=True)
            held.setdefault(lang, []).append((kinds, counts.astype(np.int64)))
            sizes[lang] = sizes.get(lang, 0) + len(kinds)
            if len(held[lang]) > 64 or sizes[lang] > _GATHERED:
                held[lang] = [merged(held[lang])]
                sizes[lang] = len(held[lang][0][0])
                if sizes[lang] > _GATHERED // 2:
                    yield rows(lang)
    for lang in list(held):
        yield rows(lang)


def profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """Each language's most frequent n-grams, most frequent first, over all given rows with text and language.

    Counts are summed in the tasks and then by key; only `size` rows a language reach the driver, and more than
    MOST_LANGUAGES different labels raise an error.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = staged(counts.withColumn("rank", rank).where(F.col("rank") <= size))
    if (found := best.select("lang").distinct().count()) > MOST_LANGUAGES:
        raise ValueError(f"{found} languages; a label column has {MOST_LANGUAGES} at most")
    out: dict[str, list[int]] = {}
    for r in best.orderBy("lang", "rank").toLocalIterator():
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def _predict(known: dict[str, list[int]], size: int):
    names = sorted(known)
    vocabulary = np.unique(np.array([g for n in names for g in known[n]], np.int64))
    # Rank of each n-gram in each language; one that a profile lacks is as far out of place as can be.
    ranks = np.full((len(names), len(vocabulary) + 1), -1, np.int64)
    for i, n in enumerate(names):
        ranks[i, np.searchsorted(vocabulary, known[n])] = np.arange(len(known[n]))

    def distances(own: np.ndarray) -> np.ndarray:
        at = np.searchsorted(vocabulary, own)
        at[at == len(vocabulary)] = len(vocabulary) - 1
        at = np.where(vocabulary[at] == own, at, len(vocabulary))
        theirs = ranks[:, at]
        return np.where(theirs < 0, size, np.minimum(size, np.abs(theirs - np.arange(len(own))))).sum(axis=1)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = _letters()
        for batch in batches:
            langs, scores = [], []
            for text in batch.to_pylist():
                own = ranked(ngrams(text or "", letters), size)
                if not len(own) or not names:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                far = distances(own)
                best = int(np.argmin(far))
                langs.append(names[best])
                scores.append(1.0 - float(far[best]) / (size * len(own)))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict


def language(text: Column, known: dict[str, list[int]], size: int = PROFILE) -> Column:
    """A struct of lang_pred and score; see identify()."""
    return F.arrow_udf(_predict(known, size), "struct<lang_pred: string, score: double>")(text)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: the checksum of its id as text leaves 2 by 4. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, known: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """Per row of docs: doc_id, lang_pred, score.

    score is 1 for a document whose n-grams stand in the language's order and 0 for one that shares none. The first name
    among equals wins. A null text or one without a letter is "und" with score 0, as is everything if nothing was learned. Repeated rows come
    back as often as given, an empty table gives an empty result, and columns that are not named are never read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), language(F.col(text_col), known, size).alias("found"))
    return rows.select("doc_id", "found.lang_pred", "found.score")
