"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tierweave.llm.common import small_batches
from tierweave.llm.vocabulary import PIECES, Remembering, balanced, piece_counter, tokenizer_path

TOKEN_LIMIT = 4096
#: Characters of texts whose pieces are looked up together; longer texts are split into windows of about this size.
BATCH_CHARS = 1 << 20


def cut_pieces(text: str) -> list[str]:
    """The text's parts, each as the model is to see it alone: it puts a space before each, so the one that is there goes.

    A part is a run of spaces and the word behind it. No vocabulary entry has a space after another
    character, so no merge reaches across, and the parts' tokens are the text's tokens.
    """
    parts = PIECES.findall(text)
    return [parts[0], *(p[1:] for p in parts[1:])] if parts else []


def windows(text: str, size: int = BATCH_CHARS) -> Iterator[str]:
    """A long text in windows that end at a single space between words, which is left out: a window's own first space stands for it."""
    start = 0
    while len(text) - start > size:
        end = start + size
        while True:
            end = text.find(" ", end)
            if end < 0 or end + 1 >= len(text):
                end = -1
                break
            if text[end - 1] != " " and text[end + 1] != " ":
                break
            end += 1
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


def _lengths(path: str):
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = Remembering(piece_counter(path))
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            out = [0] * len(texts)
            # Windows of long texts and whole short ones, in groups of about equal size.
            todo = [(i, w) for i, t in enumerate(texts) for w in windows(t)]
            at = 0
            for group in balanced([w for _, w in todo], BATCH_CHARS):
                pieces = [cut_pieces(w) for w in group]
                known = counts.learn(p for ps in pieces for p in ps)
                for (i, _), ps in zip(todo[at : at + len(group)], pieces):
                    out[i] += sum(map(known.__getitem__, ps))
                at += len(group)
            yield pa.array(out, pa.int64())

    return lengths


def n_tokens(text: Column, model: str = "piece_bpe_32k.model") -> Column:
    """Tokens of each whole text without begin or end tokens; null counts as empty and has none."""
    # Iterators of Arrow arrays: one model and one memory of pieces serve a whole task.
    count = F.arrow_udf(_lengths(tokenizer_path(model)), LongType())
    return count(text)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_tokens, over_limit.

    Each row is counted by itself, so repeated rows come back as often as they are given, and an empty table gives an empty result. A null text
    has no bytes and no tokens. Columns that are not named are never read. No shuffle.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
