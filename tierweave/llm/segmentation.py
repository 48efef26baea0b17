"""SentencePiece encoding and decoding with sampled segmentations: Gumbel top-k without replacement by A-star search.

A text's lattice has a node at each character and an arc for each vocabulary entry that fits there; a path is a segmentation, with the
product of its pieces' probabilities, normalised over all paths. Every path is given that log probability plus a Gumbel
noise; the k largest are k distinct samples without replacement. The search never draws the noises of all paths: the largest of a
set of paths is again Gumbel distributed, around the log of the set's mass, so sets are kept in a queue by their largest value and
split when they come first. A set is "all paths that begin so", less the beginnings already split off.
"""

from __future__ import annotations

import heapq
import math
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import small_batches
from tierweave.llm.vocabulary import of_worker, tokenizer_path

#: Samples per text, and the inverse temperature of the pieces' probabilities.
SAMPLES = 2
SHARPNESS = 1.0
#: Zipf-Mandelbrot offset: an entry's probability falls with its merge rank as 1 / (rank + offset).
RANK_OFFSET = 20.0
#: Characters of texts that are sampled together; their different words share one array of lattices.
BATCH_CHARS = 1 << 22
#: Sets of less mass than this share of the whole can't be told from nothing in double precision.
LEAST_MASS = 1e-15
SPACE = "▁"
_BITS = 21
#: Code points that lead on from a trie's nodes most often have a column each in a table of steps, beside one for all others.
COLUMNS = 128
#: Arcs of a path that are looked at first for those that hold its mass; more as long as enough is left behind them.
FIRST_ARCS = 512

SCHEMA = "doc_id bigint, sample int, n_pieces bigint, log_prob double, score double, log_inclusion double, pieces array<int>"


class Vocabulary:
    """Entries with log probabilities by rank, and single bytes for what no entry covers."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        byte_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.strings = pa.array([byte_of.get(i) or p.encode("utf-8", "surrogatepass") for i, p in enumerate(self.pieces)], pa.large_binary())
        usable = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        # Scores of a merge vocabulary are ranks: the first merges are the most frequent. Single characters stand at its end.
        order = sorted(usable, key=lambda i: (-model.get_score(i), i))
        log_p = np.full(n, -math.log(len(order) + RANK_OFFSET) * 1.5)
        log_p[order] = -np.log(np.arange(len(order)) + RANK_OFFSET)
        self.log_p = sharpness * (log_p - math.log(np.exp(log_p).sum()))
        self.ids = {self.pieces[i]: i for i in usable}
        # The entries as a trie: transitions by (node, code point), and the entry that ends at a node.
        heads = sorted({p[:k] for p in self.ids for k in range(1, len(p) + 1)})
        node = {"": 0, **{h: i + 1 for i, h in enumerate(heads)}}
        keys = np.array([node[h[:-1]] << _BITS | ord(h[-1]) for h in heads], np.int64)
        order_of = np.argsort(keys)
        self.steps, self.reached = keys[order_of], order_of + 1
        self.entry = np.array([-1, *(self.ids.get(h, -1) for h in heads)], np.int64)
        # Most steps are read from a table, with a row for each node that has any and an empty one for the others.
        parents, points = self.steps >> _BITS, self.steps & ((1 << _BITS) - 1)
        different, often = np.unique(points, return_counts=True)
        common = different[np.argsort(-often, kind="stable")[: COLUMNS - 1]]
        self.column = np.zeros(sys.maxunicode + 1, np.uint8)
        self.column[common] = np.arange(1, len(common) + 1)
        inner = np.unique(parents)
        self.leaf_row = len(inner)
        self.row = np.full(len(self.entry), self.leaf_row, np.int64)
        self.row[inner] = np.arange(len(inner))
        self.table = np.zeros((len(inner) + 1, COLUMNS), np.int32)
        known = self.column[points] > 0
        self.table[self.row[parents[known]], self.column[points[known]]] = self.reached[known]

    def follow(self, nodes: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Trie nodes reached, 0 where there is none."""
        rows, columns = self.row[nodes], self.column[points]
        reached = self.table[rows, columns].astype(np.int64)
        rare = np.nonzero((columns == 0) & (rows != self.leaf_row))[0]
        keys = nodes[rare] << _BITS | points[rare]
        at = np.minimum(np.searchsorted(self.steps, keys), len(self.steps) - 1)
        reached[rare] = np.where(self.steps[at] == keys, self.reached[at], 0)
        return reached

    def bytes_of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the single bytes that spell each code point, a row of four for each, and how many of them count."""
        different, which = np.unique(points, return_inverse=True)
        ids, sizes = np.zeros((len(different), 4), np.int64), np.zeros(len(different), np.int64)
        for row, point in enumerate(different.tolist()):
            own = [self.byte_ids[b] for b in chr(point).encode("utf-8", "surrogatepass")]
            ids[row, : len(own)], sizes[row] = own, len(own)
        return ids[which], sizes[which]

    def spell(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids with bytes spelled out, and how many of them each piece gives."""
        sizes = np.ones(len(pieces), np.int64)
        bare = np.nonzero(pieces < 0)[0]
        if not len(bare):
            return pieces.astype(np.int32), sizes
        spelled, sizes[bare] = self.bytes_of(-1 - pieces[bare])
        ids = np.repeat(pieces, sizes).astype(np.int32)
        places = (np.cumsum(sizes) - sizes)[bare]
        for k in range(spelled.shape[1]):
            there = sizes[bare] > k
            ids[places[there] + k] = spelled[there, k]
        return ids, sizes

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
        """The texts, in UTF-8, of the segmentations between consecutive ends, as decode() gives them one by one."""
        # The strings of all ids lie in one buffer, in order.
        _, offsets, buffer = self.strings.take(pa.array(ids)).buffers()
        places = np.frombuffer(offsets, np.int64)[ends].tolist()
        joined, mark = memoryview(buffer) if buffer is not None else b"", SPACE.encode()
        for start, end in zip(places, places[1:]):
            yield bytes(joined[start:end]).replace(mark, b" ")[1:]


def decode(ids: list[int], pieces: list[str]) -> str:
    """The text of a segmentation: entries and bytes are joined, space marks become spaces, and the one put before the text goes."""
    joined = [pieces[i] for i in ids]
    text = "".join(joined)
    if "<0x" in text:
        text = b"".join(bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.encode("utf-8", "surrogatepass") for p in joined).decode("utf-8", "surrogatepass")
    return text.replace(SPACE, " ")[1:]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function on counters: uniform numbers that depend on the row's seed and the place only."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniforms(seeds: np.ndarray, counters: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = _mix(_mix(seeds + np.uint64(0x9E3779B97F4A7C15) * (counters + np.uint64(1))))
    return ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def uniform(seed: int, counter: int) -> float:
    """uniforms() of one number."""
    mask = (1 << 64) - 1
    x = (seed + 0x9E3779B97F4A7C15 * (counter + 1)) & mask
    for _ in range(2):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        x ^= x >> 31
    return ((x >> 11) + 0.5) / (1 << 53)


def different_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, str, np.ndarray]:
    """(words of each text, numbers of all words, the different words by number as one string, their lengths).

    A text is given a space in front; the empty one has no words. Spaces belong to the word behind them, those at the end to the
    last word: no entry has a space mark after another character. Spaces and space marks are the same.
    """
    spaced = [(" " + t.replace(SPACE, " ")).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    ends = np.cumsum([0, *map(len, spaced)])
    joined = b"".join(spaced)
    space = np.frombuffer(joined, np.uint8) == 0x20
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    own = np.nonzero(ends[1:] > ends[:-1])[0]
    begins[ends[own]] = True
    starts = np.nonzero(begins)[0]
    # The last beginning of a text that ends in spaces is theirs, unless the text is nothing else.
    trailing = own[space[ends[own + 1] - 1]]
    last = starts[np.searchsorted(starts, ends[trailing + 1]) - 1]
    begins[last[last > ends[trailing]]] = False
    starts = np.nonzero(begins)[0]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(joined))), pa.py_buffer(joined)]).dictionary_encode()
    _, offsets, buffer = words.dictionary.buffers()
    bounds = np.frombuffer(offsets, np.int64)[: len(words.dictionary) + 1]
    raw = buffer.to_pybytes()[: bounds[-1]] if buffer is not None else b""
    # Bytes that begin a character, up to each word's end.
    characters = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))[bounds]
    counts = np.diff(np.searchsorted(starts, ends))
    return counts, words.indices.to_numpy().astype(np.int64), raw.decode("utf-8", "surrogatepass").replace(" ", SPACE), np.diff(characters)


class Lattices:
    """The lattices of many different words, one after the other: a node per character, arcs in the order of their nodes.

    cumulative: node number plus the probability of a node's arcs up to this one. ends: the node an arc leads to, -1 at the
    word's end. pieces: its entry, or -1 - code point for a character that no entry covers. node: where it starts.
    first: first arc of each node, with the number of arcs behind it. log_share: log probability of an arc at its node.
    starts: first node of each word.
    """

    def __init__(self, vocabulary: Vocabulary, words: str, lengths: np.ndarray):
        v = vocabulary
        stop = np.cumsum(lengths)
        self.starts = stop - lengths
        points = np.frombuffer(words.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        n = len(points)
        last = np.repeat(stop, lengths)
        at, state, k = np.arange(n), np.zeros(n, np.int64), 0
        found = []
        while len(at):
            state = v.follow(state, points[at + k])
            if k:
                at, state = at[state > 0], state[state > 0]
            entry = v.entry[state]
            hit = entry >= 0
            if k == 0:
                # A character that no entry covers is an arc too.
                found.append((at, np.where(hit, entry, -1 - points)))
            else:
                found.append((at[hit], entry[hit]))
            k += 1
            more = (at + k < last[at]) & (state > 0)
            at, state = at[more], state[more]
        sizes = np.zeros(n, np.int64)
        for nodes, _ in found:
            sizes[nodes] += 1
        first = np.concatenate(([0], np.cumsum(sizes)))
        node, end, piece = np.repeat(np.arange(n), sizes), np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
        behind = first[:-1].copy()
        for k, (nodes, entries) in enumerate(found):
            to = behind[nodes]
            end[to], piece[to] = nodes + k + 1, entries
            behind[nodes] += 1
        weight = v.log_p[np.maximum(piece, 0)]
        bare = np.nonzero(piece < 0)[0]
        spelled, of = v.bytes_of(-1 - piece[bare])
        weight[bare] = np.where(np.arange(4) < of[:, None], v.log_p[spelled], 0.0).cumsum(axis=1)[:, -1]
        # Log mass from each node to its word's end, by distance from the end.
        beta = np.zeros(n + 1)
        at_end = end == last[node] if n else end < 0
        distance = last - np.arange(n)
        most = int(distance.max()) if n else 0
        # Numbers of 16 bits are sorted in linear time.
        by_distance = np.argsort(distance.astype(np.uint16) if most < 1 << 16 else distance, kind="stable")
        bounds = np.searchsorted(distance[by_distance], np.arange(1, most + 2))
        for d in range(len(bounds) - 1):
            nodes = by_distance[bounds[d] : bounds[d + 1]]
            sizes = first[nodes + 1] - first[nodes]
            offsets = np.cumsum(sizes) - sizes
            arcs = np.repeat(first[nodes] - offsets, sizes) + np.arange(sizes.sum())
            mass = weight[arcs] + np.where(at_end[arcs], 0.0, beta[end[arcs]])
            top = np.maximum.reduceat(mass, offsets)
            beta[nodes] = top + np.log(np.add.reduceat(np.exp(mass - np.repeat(top, sizes)), offsets))
        self.log_share = np.minimum(0.0, weight + np.where(at_end, 0.0, beta[np.minimum(end, n)]) - beta[node])
        self.cumulative = np.cumsum(np.exp(self.log_share))
        self.cumulative[first[1:] - 1] = np.arange(1, n + 1)
        self.ends, self.pieces, self.node, self.first = np.where(at_end, -1, end), piece, node, first


def _walk(lattices: Lattices, nodes: np.ndarray, seeds: np.ndarray, places: np.ndarray, tag: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples a path to the end of a word from each node: (where each node's arcs end, with a 0 before; the arcs of all, in path order).

    The number that chooses an arc depends on the row's seed, the word's place in it, the step and the tag.
    """
    sizes = np.zeros(len(nodes) + 1, np.int64)
    who, taken, step = np.arange(len(nodes)), [], 0
    counters = (places.astype(np.uint64) << np.uint64(24)) + np.uint64(tag)
    while len(who):
        u = uniforms(seeds, counters + np.uint64(step << 8))
        # From a node's last arc (its longest entry) back to the one whose part of the unit interval holds the number.
        arcs, least = lattices.first[nodes + 1] - 1, lattices.first[nodes]
        moving = np.nonzero(arcs > least)[0]
        targets = nodes + u
        while len(moving):
            moving = moving[lattices.cumulative[arcs[moving] - 1] >= targets[moving]]
            arcs[moving] -= 1
            moving = moving[arcs[moving] > least[moving]]
        taken.append((who, arcs))
        step += 1
        nodes = lattices.ends[arcs]
        going = nodes >= 0
        sizes[who[~going] + 1] = step
        who, nodes, seeds, counters = who[going], nodes[going], seeds[going], counters[going]
    ends = np.cumsum(sizes)
    path = np.empty(ends[-1], np.int64)
    for k, (who, arcs) in enumerate(taken):
        path[ends[who] + k] = arcs
    return ends, path


def _gumbel_below(location: float, top: float, u: float) -> float:
    """A Gumbel number around the location, given that it is at most `top`."""
    own = location - math.log(-math.log(u))
    if math.isinf(top):
        return own
    # -log(exp(-top) + exp(-own)) is distributed so; written to keep precision where either is large.
    low, high = min(top, own), max(top, own)
    return low - math.log1p(math.exp(low - high))


class _Search:
    """The queue of one text. A set is (path, place, excluded): all paths that share the path's first `place` arcs, less those of
    the excluded arcs at later places of it and less the path itself."""

    def __init__(self, seed: int, lattices: Lattices):
        self.seed, self.lattices, self.queue, self.drawn = seed, lattices, [], 0

    def uniform(self) -> float:
        self.drawn += 1
        return uniform(self.seed, (self.drawn << 8) | 0xFF)

    def push_rest(self, arcs: np.ndarray, place: int, excluded: dict[int, list[int]], base: float, top: float) -> None:
        """Queue the set of (arcs, place, excluded); base is the log mass of its common beginning."""
        # Where so little mass is left, nothing can be told from nothing; the arcs behind are not looked at.
        least, ahead = math.log(LEAST_MASS), FIRST_ARCS
        while True:
            own = self.lattices.log_share[arcs[place : place + ahead]]
            before = np.concatenate(([0.0], np.cumsum(own)))
            if before[-1] <= least or place + ahead >= len(arcs):
                break
            ahead *= 4
        n = min(len(own), int(np.searchsorted(-before, -least)))
        rest = -np.expm1(own[:n])
        for j, gone in excluded.items():
            if place <= j < place + n:
                rest[j - place] -= sum(self._share(x) for x in gone)
        shares = np.where(rest > 1e-12, rest, 0.0) * np.exp(before[:n])
        mass = float(shares.sum())
        if mass > 0.0:
            score = _gumbel_below(base + math.log(mass), top, self.uniform())
            heapq.heappush(self.queue, (-score, self.drawn, arcs, place, excluded, base, shares))

    def _share(self, arc: int) -> float:
        """Probability of an arc at its node."""
        return math.exp(self.lattices.log_share[arc])

    def branch(self):
        """Takes the best set off the queue: (score, its path's beginning, the arc that leaves the path, log mass of both). The rest goes back."""
        negative, _, arcs, place, excluded, base, shares = heapq.heappop(self.queue)
        score, sums = -negative, np.cumsum(shares)
        j = place + min(int(np.searchsorted(sums, self.uniform() * sums[-1])), len(shares) - 1)
        node = self.lattices.node[arcs[j]]
        gone = {int(arcs[j]), *excluded.get(j, ())}
        others = [(a, self._share(a)) for a in range(self.lattices.first[node], self.lattices.first[node + 1]) if a not in gone]
        u = self.uniform() * sum(p for _, p in others)
        for arc, p in others:
            if (u := u - p) <= 0:
                break
        common = base + float(self.lattices.log_share[arcs[place:j]].sum())
        self.push_rest(arcs, place, {**excluded, j: [*excluded.get(j, ()), arc]}, base, score)
        return score, arcs[:j], arc, common + math.log(p)


def sample_batch(texts: list[str], seeds: np.ndarray, vocabulary: Vocabulary, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """Per text up to k samples, best first: (arcs' pieces, log probability, perturbed score, log inclusion probability).

    Fewer than k where the lattice has fewer paths; the empty text has one, the empty path. Inclusion: the chance that a path's
    noise lifts it over the best score left in the queue; certain if nothing is left.
    """
    counts, which, words, lengths = different_words(texts)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    lattices = Lattices(vocabulary, words, lengths)
    all_nodes = lattices.starts[which]
    starts = [all_nodes[i:j] for i, j in zip(bounds, bounds[1:])]
    ends_of, arcs = _walk(lattices, all_nodes, np.repeat(seeds, counts), np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts), 0)
    edges = ends_of[bounds]
    searches, taken = [_Search(int(s), lattices) for s in seeds], [[] for _ in texts]
    for t in range(len(texts)):
        own = arcs[edges[t] : edges[t + 1]]
        score = _gumbel_below(0.0, math.inf, searches[t].uniform())
        taken[t].append((own, score))
        searches[t].push_rest(own, 0, {}, 0.0, score)
    for round_ in range(1, k):
        ends = lattices.ends
        begun, nodes, places, of = [], [], [], []
        for t in range(len(texts)):
            if len(taken[t]) < round_ or not searches[t].queue:
                continue
            score, head, arc, base = searches[t].branch()
            whole_words = int((ends[head] < 0).sum()) if len(head) else 0
            node = int(ends[arc])
            rest = starts[t][whole_words + 1 :]
            mine = rest if node < 0 else np.concatenate(([node], rest))
            begun.append((t, np.append(head, arc), base, score, len(mine)))
            nodes.append(mine)
            places.append(np.arange(len(starts[t]) - len(mine), len(starts[t])))
            of.append(np.full(len(mine), seeds[t], np.uint64))
        if not begun:
            break
        ends_of, arcs = _walk(lattices, np.concatenate(nodes), np.concatenate(of), np.concatenate(places), round_)
        edges = ends_of[np.cumsum([0, *(b[4] for b in begun)])]
        for i, (t, head, base, score, _) in enumerate(begun):
            whole = np.concatenate((head, arcs[edges[i] : edges[i + 1]]))
            taken[t].append((whole, score))
            searches[t].push_rest(whole, len(head), {}, base, score)
    out = []
    for t in range(len(texts)):
        left = -searches[t].queue[0][0] if searches[t].queue else -math.inf
        own = []
        for path, score in taken[t]:
            log_p = float(lattices.log_share[path].sum())
            # log(1 - exp(-exp(log_p - left)))
            gap = log_p - left
            inclusion = 0.0 if math.isinf(left) else gap if gap < -30 else math.log(-math.expm1(-math.exp(min(gap, 30.0))))
            own.append((lattices.pieces[path], log_p, score, inclusion))
        out.append(own)
    return out


def _samples(path: str, k: int, sharpness: float, with_ids: bool, with_digests: bool, with_texts: bool = False):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), *[pa.list_(pa.int32())] * with_ids, *[pa.int64(), pa.bool_()] * with_digests, *[pa.string()] * with_texts]
    names = ["doc_id", "sample", "n_pieces", "log_prob", "score", "log_inclusion", *["pieces"] * with_ids, *["pieces_crc32", "decodes"] * with_digests, *["decoded"] * with_texts]

    def done(vocabulary: Vocabulary, group: list[tuple]) -> pa.RecordBatch:
        found = sample_batch([t for _, t, _ in group], np.array([x for _, _, x in group], np.int64).view(np.uint64), vocabulary, k)
        samples = [(text, doc_id, i, *own) for (doc_id, text, _), all_own in zip(group, found) for i, own in enumerate(all_own)]
        texts, doc_ids, numbers, pieces, *figures = zip(*samples)
        bounds = np.cumsum([0, *map(len, pieces)])
        ids, sizes = vocabulary.spell(np.concatenate(pieces))
        ends = np.concatenate(([0], np.cumsum(sizes)))[bounds]
        columns = [doc_ids, numbers, np.diff(ends), *figures]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
        decoded = list(vocabulary.decode(ids, ends)) if with_digests or with_texts else []
        if with_digests:
            raw = ids.astype("<i4", copy=False).view(np.uint8)
            columns.append([zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(ends.tolist(), ends[1:].tolist())])
            columns.append([own == text.replace(SPACE, " ").encode("utf-8", "surrogatepass") for own, text in zip(decoded, texts)])
        if with_texts:
            columns.append(decoded)
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds)], names)

    def samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = of_worker(f"segmentation {path} {sharpness}", lambda: Vocabulary(path, sharpness))
        group, size = [], 0
        for batch in batches:
            for doc_id, text, seed in zip(*(c.to_pylist() for c in batch.columns)):
                group.append((doc_id, text or "", seed))
                size += len(text or "")
                if size >= BATCH_CHARS:
                    yield done(vocabulary, group)
                    group.clear()
                    size = 0
        if group:
            yield done(vocabulary, group)

    return samples


def sample_segmentations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SAMPLES,
    sharpness: float = SHARPNESS,
    model: str = "piece_bpe_32k.model",
    seed: int = 0,
    with_ids: bool = True,
    with_digests: bool | None = None,
    with_texts: bool = False,
) -> DataFrame:
    """Up to k rows per row of docs: doc_id, sample (from 0, best first), n_pieces, log_prob, score, log_inclusion, pieces.

    Samples of one text are distinct paths, drawn without replacement; score is the perturbed log probability, which falls with
    sample, and log_inclusion the log of the chance that the sample is among those above the best one left out. A text has
    fewer rows if it has fewer segmentations. All numbers drawn follow from the seed and the row's id, so a task that is run again draws the same;
    rows that repeat an id and text get the same samples. Null and empty texts have one sample without pieces. An empty
    table gives an empty result; columns that are not named are never read. No shuffle. with_digests adds pieces_crc32 (ids as
    little-endian unsigned 32-bit numbers) and decodes (whether the pieces decode to the text); with_ids=False leaves pieces out, and
    then digests are given unless told otherwise. with_texts adds decoded, the text that each sample's pieces decode to.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("seed"))
    with_digests = not with_ids if with_digests is None else with_digests
    schema = ", ".join([SCHEMA if with_ids else SCHEMA.replace(", pieces array<int>", ""), *["pieces_crc32 bigint, decodes boolean"] * with_digests, *["decoded string"] * with_texts])
    return rows.mapInArrow(_samples(tokenizer_path(model), k, sharpness, with_ids, with_digests, with_texts), schema)
