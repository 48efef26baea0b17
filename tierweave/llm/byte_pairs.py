"""Byte-pair encoding and decoding: a priority queue of merge ranks over a doubly linked list of symbols."""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Callable, Iterator, Mapping
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tierweave.llm.common import small_batches
from tierweave.llm.vocabulary import BYTE_LEVEL, balanced, byte_characters, of_worker, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
#: Characters of texts that are cut into words together.
GROUP_CHARS = 1 << 22
#: Words remembered, some 150 bytes each, twice: at most about 150 MB a Python worker, whatever the corpus.
REMEMBERED_WORDS = 500_000
#: Fixed value: the pattern by which byte-level vocabularies of this kind cut a text; no merge reaches across a cut.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


#: What stands at a place whose symbol has gone into the one before it.
GONE = -1


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit integers, the lowest byte first."""
    out = array("i", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


class Words(dict):
    """ids_of(word) for the words asked for last: between `most` and twice as many are remembered, and those in use stay."""

    def __init__(self, ids_of: Callable[[str], bytes], most: int = REMEMBERED_WORDS) -> None:
        super().__init__()
        self.ids_of, self.most, self.older = ids_of, most, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = self.ids_of(word)
        self[word] = ids
        return ids


class BytePairs:
    """Merges and vocabulary of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model, characters = given["model"], byte_characters()
        byte_of = {c: b for b, c in enumerate(characters)}
        vocabulary = model["vocab"]
        self.first_ids = [vocabulary[c] for c in characters]
        bytes_of = {i: bytes(map(byte_of.__getitem__, token)) for token, i in vocabulary.items()}
        #: Strings of added tokens are cut out of a text before anything else.
        self.added = {t["content"]: t["id"] for t in given["added_tokens"]}
        bytes_of |= {i: token.encode() for token, i in self.added.items()}
        self.cuts = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.words = regex.compile(WORDS)
        self.size = max(bytes_of) + 1
        self.strings = pa.array([bytes_of.get(i, b"") for i in range(self.size + 1)], pa.large_binary())
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made_by = [vocabulary[a + b] for a, b in merges]
        self.rank_of = {vocabulary[a] * self.size + vocabulary[b]: rank for rank, (a, b) in enumerate(merges)}

    def merged(self, ids: list[int]) -> list[int]:
        """A word's symbols after all merges: the lowest rank first, of equal ones the leftmost. The given list is used up.

        Symbols are a doubly linked list over their first places. The queue holds rank and place of every pair that arose;
        an entry whose place is gone, or holds another pair by now, is stale and skipped. O(n log n) in the word's length.
        """
        n, size = len(ids), self.size
        rank_of, made_by = self.rank_of.get, self.made_by
        # A queue entry is one number, rank and then place.
        bits = n.bit_length()
        place = (1 << bits) - 1
        # The rank that each place's symbol has with the next one by now, which tells stale entries.
        ranks = [rank_of(a * size + b) for a, b in zip(ids, ids[1:])]
        queue = [rank << bits | at for at, rank in enumerate(ranks) if rank is not None]
        if not queue:
            return ids
        ranks.append(None)
        ahead, back = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(queue)
        while queue:
            entry = heappop(queue)
            rank, at = entry >> bits, entry & place
            if ranks[at] != rank:
                continue
            right = ahead[at]
            after, before = ahead[right], back[at]
            made = ids[at] = made_by[rank]
            ids[right], ranks[right] = GONE, None
            ahead[at] = after
            if after == n:
                ranks[at] = None
            else:
                back[after] = at
                rank = ranks[at] = rank_of(made * size + ids[after])
                if rank is not None:
                    heappush(queue, rank << bits | at)
            if before >= 0:
                rank = ranks[before] = rank_of(ids[before] * size + made)
                if rank is not None:
                    heappush(queue, rank << bits | before)
        return [i for i in ids if i != GONE]

    def word_ids(self, word: str) -> bytes:
        """A word's ids as little-endian 32-bit integers."""
        return packed(self.merged(list(map(self.first_ids.__getitem__, word.encode()))))

    def parts(self, text: str) -> Iterator[str]:
        """The text cut where no merge reaches across; an added token's string is a part of its own."""
        at = 0
        for cut in self.cuts.finditer(text) if self.cuts else ():
            yield from BYTE_LEVEL.findall(text[at : cut.start()])
            yield cut.group()
            at = cut.end()
        yield from BYTE_LEVEL.findall(text[at:] if at else text)

    def part_ids(self, part: str, ids_of: Mapping[str, bytes]) -> bytes:
        """Ids of a part, given those of its words. A word that is a part alone has the same ids."""
        if part.isascii() and (part.isalpha() or (part[0] == " " and part[1:].isalpha())):
            return ids_of[part]
        if part in self.added:
            return packed([self.added[part]])
        return b"".join(map(ids_of.__getitem__, self.words.findall(part)))

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[str]:
        """Texts of the ids between consecutive ends: their vocabulary strings, as bytes, one after the other.

        Unknown ids say nothing, and bytes that are no UTF-8 become U+FFFD.
        """
        known = np.where((ids >= 0) & (ids < self.size), ids, self.size)
        # The strings of all ids lie in one buffer, in order.
        strings = self.strings.take(pa.array(known))
        _, offsets, buffer = strings.buffers()
        places = np.frombuffer(offsets, np.int64)[ends].tolist()
        joined = memoryview(buffer) if buffer is not None else b""
        for start, end in zip(places, places[1:]):
            yield str(joined[start:end], "utf-8", "replace")


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = of_worker(f"byte pairs {path}", lambda: BytePairs(path))
        words = of_worker(f"byte pairs of words {path}", lambda: Words(pairs.word_ids))
        for batch in batches:
            found: list[bytes] = []
            # Each different part of some megabytes of texts is put together once.
            for group in balanced((t or "" for t in batch.column(1).to_pylist()), GROUP_CHARS):
                cut = [list(pairs.parts(t)) for t in group]
                ids_of = {p: words.get(p) or pairs.part_ids(p, words) for p in set(chain.from_iterable(cut))}
                found += [b"".join(map(ids_of.__getitem__, parts)) for parts in cut]
            ends = np.cumsum([0, *(len(f) // 4 for f in found)], dtype=np.int64)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return encode


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row of docs: doc_id, ids (array of int), the whole text's ids.

    A text is cut into words; the strings of added tokens in it are those tokens. A worker remembers a bounded number of
    words; a word of any length is encoded whole. Null text is empty and has no ids.
    Each row is encoded by itself, so repeated rows come back as often as they are given, a null id is carried as null, and
    an empty table gives an empty result. Columns that are not named are never read. No shuffle.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encoder(tokenizer_path(vocabulary)), "doc_id bigint, ids array<int>")


def _decoder(path: str):
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = of_worker(f"byte pairs {path}", lambda: BytePairs(path))
        for batch in batches:
            first, *ends = batch.offsets.to_pylist()
            ids = batch.values.slice(first, (ends or [first])[-1] - first).fill_null(-1).to_numpy()
            texts = pairs.decode(ids, np.array([first, *ends]) - first)
            yield pa.array([t if there else None for t, there in zip(texts, batch.is_valid().to_pylist())], pa.string())

    return decode


def decoded(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The text of an array of ids, special tokens included. Null ids give null; no ids give an empty text."""
    return F.arrow_udf(_decoder(tokenizer_path(vocabulary)), StringType())(ids)


def digests(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Of encode_texts' rows: doc_id, n_tokens, ids_sha256 of the decimal ids joined by commas, decoded_sha256 of the decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decoded(F.col("ids"), vocabulary), 256).alias("decoded_sha256"),
    )
