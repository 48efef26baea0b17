"""Packing by vector bin packing: examples fill sequences under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import small_batches, staged
from tierweave.llm.vocabulary import BYTE_LEVEL, Remembering, balanced, byte_level_encoder, of_worker, tokenizer_path, whole_text_encoder

SEQUENCE = 2048
END_ID = 1
MAX_SEGMENTS = 512
#: Pieces that are packed together. A task holds some such blocks, however large the corpus is.
BLOCK = 2048
#: Blocks that a task packs one after the other, where there are more of them than shuffle partitions.
BLOCKS_A_TASK = 32
#: Characters of texts that are encoded together.
GROUP_CHARS = 1 << 20
_ID_BYTES = 4

PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PLACED_SCHEMA = PIECE_SCHEMA + ", sequence_id bigint, offset bigint"


def _cut(path: str, size: int, end_id: int):
    end = int(end_id).to_bytes(_ID_BYTES, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = of_worker(f"byte-level texts {path}", lambda: whole_text_encoder(path))
        ids_of = of_worker(f"byte-level ids {path}", lambda: Remembering(byte_level_encoder(path)))
        for batch in batches:
            out: list[tuple] = []
            doc_ids = iter(batch.column(0).to_pylist())
            # Texts are encoded whole; the words of those that cannot be, of about a megabyte of texts, are learned together.
            for group in balanced((t or "" for t in batch.column(1).to_pylist()), GROUP_CHARS):
                found = list(map(whole, group)) if whole else [None] * len(group)
                split = [BYTE_LEVEL.findall(t) if ids is None else [] for t, ids in zip(group, found)]
                known = ids_of.learn(w for words in split for w in words)
                for ids, words, doc_id in zip(found, split, doc_ids):
                    ids = (b"".join(map(known.__getitem__, words)) if ids is None else ids) + end
                    total = len(ids) // _ID_BYTES
                    for start in range(0, total, size):
                        part = ids[start * _ID_BYTES : (start + size) * _ID_BYTES]
                        out.append((doc_id, start, len(part) // _ID_BYTES, zlib.crc32(part), total))
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
            columns = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(names))

    return cut


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, end_id: int = END_ID, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Each document's ids and an end id, cut every `size` ids: doc_id, start, length, ids_crc32, doc_tokens. The ids stay in the task.

    Full pieces fill a sequence each; only one shorter piece a document is left to be packed. Null text is empty: its end id alone.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_cut(tokenizer_path(vocabulary), size, end_id), PIECE_SCHEMA)


def dot_product_packing(demands: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin, place in it) of each row of demands, under all limits at once.

    Bins are filled one after the other. The next item is the fitting one whose demand has the largest dot product
    with the room that is left, both as shares of the limits and weighted by how scarce each limit is over all
    items; the first of equals wins. An item over a limit raises.
    """
    n = len(demands)
    if (demands > limits).any():
        raise ValueError("an item is larger than a sequence")
    bins, places = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    if not n:
        return bins, places
    # Equal demands are one kind with a stack of items.
    kinds, kind_of = np.unique(demands, axis=0, return_inverse=True)
    kind_of = kind_of.reshape(-1)
    order = np.argsort(kind_of, kind="stable")
    ends = np.cumsum(np.bincount(kind_of, minlength=len(kinds)))
    at = np.concatenate(([0], ends[:-1]))
    share = kinds / limits
    weighted = share * (demands / limits).mean(axis=0)
    # Kinds are sorted by tokens, so those that have too many stand behind; of the kinds before them, the most they ask of each limit.
    tokens, most = kinds[:, 0], np.maximum.accumulate(kinds, axis=0)
    spent = np.zeros(len(kinds))
    current, inside, room = -1, 0, np.full_like(limits, -1)
    for _ in range(n):
        while True:
            cut = int(np.searchsorted(tokens, room[0], side="right"))
            if cut:
                scores = weighted[:cut] @ (room / limits) + spent[:cut]
                for limit in np.flatnonzero(most[cut - 1] > room):
                    scores[kinds[:cut, limit] > room[limit]] = -np.inf
                best = int(scores.argmax())
                if scores[best] >= 0:
                    break
            current, inside, room = current + 1, 0, limits.copy()
        # Take the kind's items one by one; after each the room differs, so it is asked again.
        item = order[at[best]]
        at[best] += 1
        if at[best] == ends[best]:
            spent[best] = -np.inf
        bins[item], places[item] = current, inside
        room = room - kinds[best]
        inside += 1
    return bins, places


def _packer(limits: tuple[int, ...], demand_cols: list[str]):
    most = np.array(limits, np.int64)

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["doc_id", "start", "length", "ids_crc32"], kind="stable", na_position="first").reset_index(drop=True)
        demands = np.stack([block["length"].to_numpy(np.int64), np.ones(len(block), np.int64), *(block[c].to_numpy(np.int64) for c in demand_cols)], axis=1)
        bins, places = dot_product_packing(demands, most)
        order = np.lexsort((places, bins))
        lengths = block["length"].to_numpy(np.int64)[order]
        before = np.cumsum(lengths) - lengths
        first = np.concatenate(([True], np.diff(bins[order]) != 0))
        offsets = np.empty(len(block), np.int64)
        offsets[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        block["sequence_id"] = block["block"].astype("int64") * (1 << 24) + bins
        block["offset"] = offsets
        return block.drop(columns=["block", *demand_cols])

    return pack


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, loss_col: str | None = None, block: int = BLOCK) -> DataFrame:
    """Adds sequence_id and offset to staged pieces (token_pieces' columns and loss_col); within a sequence, offsets are gapless from 0.

    Limits: `size` tokens, `max_segments` pieces and, with loss_col, `max_loss` loss-bearing tokens. Pieces are dealt to blocks
    of about `block` pieces by a hash of their place among the staged rows, so pieces that share an id, or have none, spread like others;
    each block is packed on its own: no task sees the corpus, and a block leaves at most its last sequences unfilled. Repeated rows are placed one by one.
    """
    blocks = max(1, -(-pieces.count() // block))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    # Packing is work for the processor, so its tasks follow the blocks and not the few bytes these have.
    tasks = max(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks // BLOCKS_A_TASK))
    dealt = dealt.repartition(min(tasks, blocks), "block")
    limits = (size, max_segments, *((max_loss if max_loss is not None else size,) if loss_col else ()))
    schema = ", ".join([PLACED_SCHEMA])
    return dealt.groupBy("block").applyInPandas(_packer(limits, [loss_col] if loss_col else []), schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """Documents to sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, one row per piece.

    All tokens but a document's first bear loss (nothing precedes it); that is the third limit. A null text is an
    empty document of one end id; a null id is carried as null. Repeated rows are documents of their own. An empty table gives an empty result; other columns are never read.
    """
    pieces = token_pieces(docs, id_col, text_col, size).withColumn("loss", F.col("length") - (F.col("start") == 0).cast("long"))
    return pack_pieces(staged(pieces), size, max_segments, size, "loss")


def pack_conversations(turns: DataFrame, size: int = SEQUENCE, max_segments: int = 64, max_loss: int = 1536, bearing_role: str = "assistant", vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Instruction data (conv_id, turn, role, text): a turn is an example, and only the tokens of one role bear loss.

    doc_id is a hash of conversation and turn. Turns of that role are cut and counted apart from the others, so turns that share a
    key, repeated ones and those without a key keep their own role. A null role bears no loss, a null text is one end id. An empty
    table gives an empty result; other columns are never read. A piece holds at most `max_loss` tokens where that is less than `size`.
    """
    most = min(size, max_loss)
    keyed = turns.select(F.xxhash64("conv_id", "turn").alias("doc_id"), "text", F.coalesce(F.col("role") == bearing_role, F.lit(False)).alias("bears"))
    bearing = token_pieces(keyed.where("bears"), "doc_id", "text", most, vocabulary=vocabulary).withColumn("loss", F.col("length"))
    others = token_pieces(keyed.where("NOT bears"), "doc_id", "text", most, vocabulary=vocabulary).withColumn("loss", F.lit(0).cast("long"))
    return pack_pieces(staged(bearing.unionByName(others)), size, max_segments, max_loss, "loss")
