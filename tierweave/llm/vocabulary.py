"""Exact encoding by pieces: texts cut at places that no token spans, each different piece encoded once a task."""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np

#: Unicode white space, as the byte-level pattern knows it (fixed values).
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: White space belongs to the word behind it: no byte-level token reaches from a word into the white space after it.
BYTE_LEVEL = re.compile(f"[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+")
#: Only U+0020 opens a piece; white space at the end stays with the last word.
PIECES = re.compile(r" *[^ ]+(?: +\Z)?| +")

#: Fixed value: the pattern by which byte-level vocabularies of this kind cut a text; no merge reaches across a cut.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The character that stands for each byte in vocabulary entries: itself where it is printable, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


#: Different pieces that a Python worker remembers, about 200 bytes each: at most some 150 MB beside the JVM, whatever the corpus.
REMEMBERED = 750_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Remembering:
    """value(piece) for many pieces, asked of `encode` in batches balanced by bytes and remembered for the next batch."""

    def __init__(self, encode: Callable[[list[str]], Iterable], batch_bytes: int = 1 << 20):
        self.encode, self.batch_bytes, self.known = encode, batch_bytes, {}

    def learn(self, pieces: Iterable[str]) -> dict:
        """A mapping that holds all given pieces."""
        known, wanted = self.known, set(pieces)
        new = [p for p in wanted if p not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(wanted)
        for batch in balanced(sorted(new, key=len), self.batch_bytes):
            known.update(zip(batch, self.encode(batch)))
        return known


def of_worker(name: str, make: Callable[[], object]):
    """make(), once for each Python worker process and name; later tasks of that process get the same object.

    Functions travel to the workers by value, with fresh globals for each task, so what shall outlive a task hangs on a module of
    its own. Only values that follow from the name belong here: a worker that starts anew makes them again.
    """
    kept = sys.modules.setdefault("_tierweave_worker", types.ModuleType("_tierweave_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def balanced(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    """Batches of about equal size: each is closed before it would pass `most` characters; a longer text is a batch alone."""
    batch, size = [], 0
    for t in texts:
        if batch and size + len(t) > most:
            yield batch
            batch, size = [], 0
        batch.append(t)
        size += len(t)
    if batch:
        yield batch


def byte_level_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Words as BYTE_LEVEL cuts them to their ids, as little-endian unsigned 32-bit bytes, by the tokenizers library.

    Words that begin with white space are encoded as one text, since no token spans two of them, and told apart again by the
    tokens' lengths in bytes; others are encoded one by one.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.models import BPE

    tokenizer = Tokenizer.from_file(path)
    # Every word comes once, so the library's own memory of words only costs. The file has no setting for it.
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    settings = {k: model[k] for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)}
    tokenizer.model = BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, **settings)
    # A byte-level entry has a character per byte; an added token is written as it is.
    sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        sizes[i] = len(token)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        sizes[i] = len(token.content.encode())

    def apart(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def together(texts: list[str]) -> list[bytes]:
        ids = np.array(tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.cumsum([len(t.encode()) for t in texts])
        reached = np.cumsum(sizes[ids])
        at = np.searchsorted(reached, ends)
        if len(ids) == 0 or reached[-1] != ends[-1] or (reached[at] != ends).any():
            return apart(texts)
        raw, stops = ids.astype("<u4").tobytes(), ((at + 1) * 4).tolist()
        return [raw[i:j] for i, j in zip([0, *stops], stops)]

    def encode(texts: list[str]) -> list[bytes]:
        out = dict.fromkeys(texts, b"")
        spaced = [t for t in texts if t[0] in " \n" and t[-1] not in _SPACES]
        for i in range(0, len(spaced), TOGETHER):
            part = spaced[i : i + TOGETHER]
            out.update(zip(part, together(part)))
        rest = [t for t in texts if not (t[0] in " \n" and t[-1] not in _SPACES)]
        out.update(zip(rest, apart(rest)))
        return list(out.values())

    return encode


def whole_text_encoder(path: str) -> Callable[[str], bytes | None] | None:
    """Texts to the ids that the tokenizers library gives them, as little-endian unsigned 32-bit bytes, by the tiktoken library, which is faster.

    Vocabulary and ranks are those of the same file; None if its ids do not follow the order of its merges, which tiktoken takes for granted.
    A text is None, and to be encoded by words, if it holds the string of an added token, or a run without a cut so long that tiktoken's
    merging, quadratic in a word's length, would show.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    characters = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = given["model"]["vocab"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in given["model"]["merges"]]
    if [vocabulary[m] for m in merged] != list(range(len(characters), len(characters) + len(merged))):
        return None
    ranks = {bytes(map(characters.__getitem__, token)): i for token, i in vocabulary.items()}
    if len(ranks) != len(characters) + len(merged):
        return None
    encoding = tiktoken.Encoding("of file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = [t["content"] for t in given["added_tokens"]]

    def encode(text: str) -> bytes | None:
        if any(a in text for a in added):
            return None
        words = text.split()
        longest = max(map(len, words), default=0)
        if longest > LONG_RUN or len(text) - sum(map(len, words)) - len(words) > LONG_RUN:
            return None
        return np.array(encoding.encode_ordinary(text), "<u4").tobytes()

    return encode


#: Characters of a run, of white space or without any, that is encoded with its text.
LONG_RUN = 200
#: Words that are encoded as one text.
TOGETHER = 2_000


def piece_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Texts to numbers of tokens, by the sentencepiece library."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
