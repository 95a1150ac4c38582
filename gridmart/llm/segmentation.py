"""Sampled segmentations of texts into pieces of a vocabulary, without replacement.

A text is cut into units, each a word with the blanks before it, or a part of LONGEST_UNIT
characters of a longer one; pieces never cross units, so the lattice of a text is the
lattices of its units one after the other, and equal units share one. Every path through the lattice is a segmentation, with a
probability in proportion to the product of its pieces' weights.

Top-k sampling without replacement is a search over the tree of decisions: a node stands
for all segmentations below it and carries the largest of their Gumbel-perturbed log
probabilities. Drawn from the top down, a child's value is bound by its parent's, so the
value is an exact bound for the search (A*), and the leaves come out in falling order:
they are a sample without replacement.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import chunks, map_batches, whole

SAMPLES = 2

# Characters of texts whose units share one table of lattices.
_CHUNK = 1 << 19

# Chunks are of a size, and the next one takes the memory of the last.
_TRIM_EVERY = 16

# Characters of a unit; what is summed character by character is so bounded.
LONGEST_UNIT = 1024

# A task keeps the lattices of so many units that came up in several chunks, none of them
# longer than so many characters. They are chosen after these chunks.
_KEPT_UNITS = 1 << 15
_KEPT_LENGTH = 32
_CHOSEN_AFTER = (4, 12)
_SPACES = re.compile(r"\s ")
_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def units(text: str) -> list[str]:
    """The text with a blank before it, cut before each blank after another character, and
    every LONGEST_UNIT characters of what is longer then."""
    if not text:
        return []
    if text[0] != " " and not _SPACES.search(text):
        if "\0" in text:
            found = [" " + word for word in text.split(" ")]
        else:
            found = (" " + text.replace(" ", "\0 ")).split("\0")
    else:
        found = re.split(r"(?<=\S)(?= )", " " + text)
    if len(text) < LONGEST_UNIT or max(map(len, found)) <= LONGEST_UNIT:
        return found
    return [
        unit[at : at + LONGEST_UNIT]
        for unit in found
        for at in range(0, len(unit), LONGEST_UNIT)
    ]


class _Steps:
    """A hash table from numbers to numbers, probed for many at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.zeros(size, np.int64)
        at, left = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            slot = at[left]
            free = self.keys[slot] == -1
            # Of several keys for one free slot the last one written gets it.
            self.keys[slot[free]] = keys[left[free]]
            self.values[slot[free]] = values[left[free]]
            left = left[self.keys[slot] != keys[left]]
            at[left] = (at[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(_GOLDEN)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are in the table, and the values of these."""
        slot = self._slot(keys)
        held = self.keys[slot]
        match = held == keys
        open_ = np.flatnonzero(~match & (held != -1))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[open_]]
            here = held == keys[open_]
            match[open_[here]] = True
            open_ = open_[~here & (held != -1)]
        return match, self.values[slot[match]]


class Vocabulary:
    """Pieces, their ids and weights, as a trie in sorted arrays.

    The model's scores order its pieces by merge; the weight of the piece of rank r is
    1 / (1 + r), Zipf's law, raised to ``sharpness`` and normalised. A character without
    a piece falls back to the byte pieces of its UTF-8 form, each of the last rank.
    """

    def __init__(self, path: str, sharpness: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes_of: list[bytes] = [b""] * size
        pieces = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append((-model.get_score(i), i, piece.replace("▁", " ")))
                self.bytes_of[i] = pieces[-1][2].encode()
        self.size_of = np.array([len(part) for part in self.bytes_of], np.int64)
        self.begin_of = np.cumsum(self.size_of) - self.size_of
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        pieces.sort()
        total = sum(1.0 / (1 + rank) ** sharpness for rank in range(len(pieces) + 1))
        self.byte_weight = -sharpness * math.log(1 + len(pieces)) - math.log(total)
        self.longest = max(len(piece) for _, _, piece in pieces)

        children: dict[tuple[int, int], int] = {}
        ids, weights = {}, {}
        for rank, (_, i, piece) in enumerate(pieces):
            state = 0
            for character in piece:
                state = children.setdefault((state, ord(character)), len(children) + 1)
            ids[state] = i
            weights[state] = -sharpness * math.log(1 + rank) - math.log(total)
        self.steps = _Steps(
            np.array([state << 21 | code for state, code in children], np.int64),
            np.array(list(children.values()), np.int64),
        )
        self.kept = Kept()
        self.first = np.zeros(1 << 21, np.int32)  # from the root, by code point
        for (state, code), to in children.items():
            if not state:
                self.first[code] = to
        self.ids = np.full(len(children) + 1, -1, np.int64)
        self.weights = np.zeros(len(children) + 1)
        for state, i in ids.items():
            self.ids[state], self.weights[state] = i, weights[state]

    def step(
        self, live: np.ndarray, state: np.ndarray, code: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The walks that a piece goes on with, and where they stand then."""
        if not state.any():
            to = self.first[code]
            match = to > 0
            return live[match], to[match].astype(np.int64)
        match, to = self.steps.find(state << 21 | code)
        return live[match], to


class Lattices:
    """The lattices of some units: for every edge its piece and probability at its node.

    A unit of n characters has nodes 0 to n; an edge leads on by a piece's characters.
    ``piece`` is an id, or -1 minus a code point that falls back to bytes.
    """

    def __init__(self, vocabulary: Vocabulary, parts: list[str]):
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.astype(np.int64)
        lengths = np.array([len(part) for part in parts], np.int64)
        ends = np.cumsum(lengths)
        self.rooms: dict[str, np.ndarray] = {}
        unit = np.repeat(np.arange(len(parts)), lengths)
        node = np.arange(len(codes)) + unit
        left = ends[unit] - np.arange(len(codes))
        self.first = ends - lengths + np.arange(len(parts))
        self.last = self.first + lengths

        source, target, piece, weight = [], [], [], []
        single = np.zeros(len(codes), bool)
        live, state = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for length in range(1, vocabulary.longest + 1):
            fits = left[live] >= length
            live, state = live[fits], state[fits]
            if not len(live):
                break
            live, state = vocabulary.step(live, state, codes[live + length - 1])
            whole_piece = vocabulary.ids[state] >= 0
            found, ended = live[whole_piece], state[whole_piece]
            if length == 1:
                single[found] = True
            source.append(node[found])
            target.append(node[found] + length)
            piece.append(vocabulary.ids[ended])
            weight.append(vocabulary.weights[ended])
        rare = np.flatnonzero(~single)
        source.append(node[rare])
        target.append(node[rare] + 1)
        piece.append(-1 - codes[rare])
        width = 1 + (codes[rare] > 0x7F) + (codes[rare] > 0x7FF) + (codes[rare] > 0xFFFF)
        weight.append(width * vocabulary.byte_weight)

        source, target = np.concatenate(source), np.concatenate(target)
        piece, weight = np.concatenate(piece), np.concatenate(weight)
        order = np.argsort(source, kind="stable")
        self.source, self.target = source[order], target[order]
        self.piece, weight = piece[order], weight[order]
        nodes = len(codes) + len(parts)
        del source, target, piece, order, unit, node, left, live, state
        self.begin = np.append(0, np.cumsum(np.bincount(self.source, minlength=nodes)))
        self._weigh(weight, nodes, lengths)

    def _weigh(self, weight: np.ndarray, nodes: int, lengths: np.ndarray) -> None:
        """Sums over all paths to a unit's end, from its last characters to its first."""
        after = np.zeros(nodes)
        paths = np.ones(nodes)
        steps = np.repeat(self.last, lengths + 1) - np.arange(nodes)
        most = int(steps.max(initial=0))
        left = steps[self.source].astype(np.int16 if most < 1 << 15 else np.int64)
        order = np.argsort(left, kind="stable")
        source, target, weights = self.source[order], self.target[order], weight[order]
        cuts = np.searchsorted(left[order], np.arange(1, most + 2))
        for low, high in zip(cuts.tolist(), cuts[1:].tolist()):
            here, to = source[low:high], target[low:high]
            starts = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
            value = weights[low:high] + after[to]
            top = np.maximum.reduceat(value, starts)
            counts = np.diff(np.append(starts, high - low))
            total = np.add.reduceat(np.exp(value - np.repeat(top, counts)), starts)
            after[here[starts]] = top + np.log(total)
            paths[here[starts]] = np.add.reduceat(paths[to], starts)
        del left, order, source, target, weights
        self.paths = paths
        self.log_p = weight + after[self.target] - after[self.source]
        chance = np.exp(self.log_p)
        # A node's likeliest edges come first, so most draws end at the first they try.
        order = np.argsort(self.source - chance, kind="stable")
        for name in ("target", "piece", "log_p"):
            setattr(self, name, getattr(self, name)[order])
        total = np.cumsum(chance[order])
        full = np.diff(self.begin) > 0
        first, last = self.begin[:-1][full], self.begin[1:][full] - 1
        base = np.zeros(nodes)
        base[full] = np.append(0.0, total)[first]
        self.until = total - base[self.source]
        self.until[last] = 2.0  # every draw ends at the last edge at the latest

    def followed_by(self, other: Lattices) -> Lattices:
        """The lattices of this table, then those of another, until the next call.

        This table is copied once, into arrays that have room for what follows it.
        """
        both = object.__new__(Lattices)
        nodes, edges = len(self.paths), len(self.target)
        more = {name: getattr(other, name) for name in ("piece", "log_p", "until", "paths")}
        more |= {"first": other.first + nodes, "last": other.last + nodes}
        more |= {"begin": other.begin + edges, "target": other.target + nodes}
        for name, after in more.items():
            mine = getattr(self, name)
            size = len(mine) - (name == "begin")
            room = self.rooms.get(name)
            if room is None or len(room) < size + len(after):
                room = self.rooms[name] = np.empty(size + 2 * len(after), mine.dtype)
                room[:size] = mine[:size]
            room[size : size + len(after)] = after
            setattr(both, name, room[: size + len(after)])
        return both

    def walk(self, which: np.ndarray, seeds: np.ndarray) -> Walks:
        """A path through each of the units, drawn by the probabilities."""
        at, end = self.first[which].copy(), self.last[which]
        live = np.arange(len(which))
        log_p = np.zeros(len(which))
        rows, edges = [], []
        step = 0
        while len(live):
            draw = _uniform(seeds[live] + np.uint64((step * _GOLDEN) & _MASK))
            edge = self.begin[at[live]]
            on = np.flatnonzero(draw >= self.until[edge])
            while len(on):
                edge[on] += 1
                on = on[draw[on] >= self.until[edge[on]]]
            log_p[live] += self.log_p[edge]
            rows.append(live)
            edges.append(edge)
            at[live] = self.target[edge]
            live = live[at[live] < end[live]]
            step += 1
        counts = np.zeros(len(which), np.int64)
        for some in rows:
            counts[some] += 1
        ends = np.cumsum(counts)
        flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for place, (some, edge) in enumerate(zip(rows, edges)):
            flat[ends[some] - counts[some] + place] = edge
        return Walks(flat, ends - counts, ends, log_p)

    def walk_except(
        self, unit: int, taken: list[tuple[int, ...]], draw: Iterator[float]
    ) -> tuple[tuple[int, ...], float]:
        """A path of a unit that is none of ``taken``, by the probabilities of the rest."""
        at, path, log_p, depth = int(self.first[unit]), [], 0.0, 0
        while at < self.last[unit]:
            edges = range(int(self.begin[at]), int(self.begin[at + 1]))
            shares = []
            for edge in edges:
                below = [old for old in taken if old[depth] == edge]
                share = math.exp(self.log_p[edge])
                if below:
                    if self.paths[self.target[edge]] <= len(below):
                        share = 0.0
                    else:
                        gone = sum(math.exp(self.log_p[list(old[depth:])].sum()) for old in below)
                        share = max(share - gone, share * 1e-15)
                shares.append(share)
            rest = next(draw) * sum(shares)
            for edge, share in zip(edges, shares):
                if share > 0.0:
                    chosen = edge
                    rest -= share
                    if rest < 0.0:
                        break
            taken = [old for old in taken if old[depth] == chosen]
            path.append(chosen)
            log_p += float(self.log_p[chosen])
            at, depth = int(self.target[chosen]), depth + 1
        return tuple(path), log_p


class _Numbers(dict):
    """Numbers of units; a new unit gets the next one."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


class Kept:
    """The lattices of units that come up again and again in a task, of bounded number."""

    def __init__(self):
        self.chunks = 0
        self.seen: dict[str, int] = {}
        self.numbers: dict[str, int] = {}
        self.lattices: Lattices | None = None

    def table(self, vocabulary: Vocabulary, numbers: dict[str, int]) -> Lattices:
        """The lattices of ``numbers``, which begins with the kept ones."""
        rare = list(numbers)[len(self.numbers) :]
        found = Lattices(vocabulary, rare)
        if self.lattices is not None:
            found = self.lattices.followed_by(found)
        self._choose(vocabulary, rare)
        return found

    def _choose(self, vocabulary: Vocabulary, rare: list[str]) -> None:
        self.chunks += 1
        if self.chunks > _CHOSEN_AFTER[-1]:
            return
        for unit in rare:
            if len(unit) <= _KEPT_LENGTH:
                self.seen[unit] = self.seen.get(unit, 0) + 1
        if self.chunks in _CHOSEN_AFTER:
            again = sorted((-count, unit) for unit, count in self.seen.items() if count > 1)
            room = _KEPT_UNITS - len(self.numbers)
            units_ = [*self.numbers, *[unit for _, unit in again[:room]]]
            self.numbers = {unit: i for i, unit in enumerate(units_)}
            self.lattices = Lattices(vocabulary, units_) if units_ else None
            self.seen = {}


@dataclass
class Walks:
    """Paths end to end: the edges of row i are ``edges[begin[i]:end[i]]``."""

    edges: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    log_p: np.ndarray


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit keys."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(12)).astype(np.float64) * 2.0**-52 + 2.0**-53


def _seeds(seed: np.ndarray, sample: int, places: np.ndarray, use: int) -> np.ndarray:
    """Keys for the draws of a sample at some units; ``use`` keeps kinds of draws apart."""
    key = seed + np.uint64(((sample * 64 + use) * 0xD1342543DE82EF95) & _MASK)
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return key + places.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)


def _rest(below: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """log of 1 minus the probabilities, minus infinity where one path is all there is."""
    with np.errstate(divide="ignore"):
        found = np.log(-np.expm1(np.minimum(below, -1e-15)))
    return np.where(paths > 1, found, -np.inf)


def _bounded_gumbel(place: np.ndarray, bound: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Gumbel variables at ``place``, given that each is below its ``bound``."""
    return place - np.log(np.exp(np.minimum(place - bound, 700.0)) - np.log(draw))


@dataclass
class _Chain:
    """A sampled segmentation: the parent's up to ``start``, then its own units."""

    value: float
    parent: int
    start: int
    own: tuple[int, ...]  # the edges of the unit it branched at
    walks: Walks | None
    row: int  # in ``walks``, of the unit after ``start``
    log_p: np.ndarray  # of each unit
    taken: list[tuple[int, ...]]  # the paths of unit ``start`` that are used up


class _Search:
    """The search over the segmentations of one text; units are numbers of lattices."""

    def __init__(
        self, lattices: Lattices, which: np.ndarray, seed: int, samples: int, draw: float
    ):
        self.lattices, self.which, self.samples = lattices, which, samples
        self.seed = np.uint64(seed)
        self.chains: list[_Chain] = []
        self.heap: list[tuple[float, int, int]] = []
        self.top = -math.log(-math.log(draw))

    def edges(self, chain: int, unit: int) -> tuple[int, ...]:
        one = self.chains[chain]
        while unit < one.start:
            one = self.chains[one.parent]
        if unit == one.start and one.parent >= 0:
            return one.own
        row = one.row + unit - (one.start + (one.parent >= 0))
        return tuple(one.walks.edges[one.walks.begin[row] : one.walks.end[row]].tolist())

    def all_edges(self, chain: int, until: int | None = None) -> list[np.ndarray]:
        one = self.chains[chain]
        until = len(self.which) if until is None else until
        parts = []
        if one.parent >= 0:
            parts = self.all_edges(one.parent, min(until, one.start))
            if until > one.start:
                parts.append(np.array(one.own, np.int64))
        after = one.start + (one.parent >= 0)
        if until > after and one.walks is not None:
            begin, end = one.walks.begin[one.row], one.walks.end[one.row + until - after - 1]
            parts.append(one.walks.edges[begin:end])
        return parts

    def branch(self) -> tuple[float, int, int] | None:
        """The best open branch: value, chain, unit."""
        if not self.heap:
            return None
        value, chain, unit = heapq.heappop(self.heap)
        return -value, chain, unit

    def sidestep(self, chain: int, unit: int, number: int) -> tuple[tuple[int, ...], float, list]:
        """Another path of the unit than those used up there: path, log p, used up with it."""
        one = self.chains[chain]
        taken = one.taken if unit == one.start and one.parent >= 0 else [self.edges(chain, unit)]

        def draws():
            step = 0
            while True:
                key = _seeds(np.array([self.seed]), number, np.array([unit + (step << 40)]), 3)
                yield float(_uniform(key)[0])
                step += 1

        path, log_p = self.lattices.walk_except(int(self.which[unit]), taken, draws())
        return path, log_p, [*taken, path]

    def bound(self) -> float:
        return -self.heap[0][0] if self.heap else -math.inf


def _walk_all(lattices: Lattices, searches: list, starts: list[int], sample: int) -> list:
    """Paths for the units of each search from its start on, drawn together."""
    which = [s.which[start:] for s, start in zip(searches, starts)]
    counts = [len(part) for part in which]
    if not sum(counts):
        return [(None, 0, np.zeros(0))] * len(searches)
    seed, place, rows = _places(searches, starts, counts)
    walks = lattices.walk(np.concatenate(which), _seeds(seed, sample, place, 0))
    return [
        (walks, row, walks.log_p[row : row + count]) for row, count in zip(rows.tolist(), counts)
    ]


def _places(
    searches: list[_Search], starts: list[int], counts: list[int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seed of each search and its units from a start on, end to end; and where they begin."""
    begin = np.cumsum(counts) - counts
    seed = np.repeat(np.array([s.seed for s in searches], np.uint64), counts)
    place = np.arange(len(seed)) + np.repeat(np.array(starts, np.int64) - begin, counts)
    return seed, place, begin


def _add_all(lattices: Lattices, searches: list[_Search], chains: list[_Chain], sample: int) -> None:
    """Take a leaf of each search, the ``sample``-th, and put the branches beside its path on the
    heap."""
    for s, chain in zip(searches, chains):
        s.chains.append(chain)
    some = [(s, chain) for s, chain in zip(searches, chains) if len(s.which)]
    if not some:
        return
    starts = [chain.start for _, chain in some]
    counts = [len(s.which) - start for (s, _), start in zip(some, starts)]
    seed, at, begin = _places([s for s, _ in some], starts, counts)
    which = np.concatenate([s.which[start:] for (s, _), start in zip(some, starts)])
    paths = lattices.paths[lattices.first[which]]
    used = np.concatenate([chain.log_p[chain.start :] for _, chain in some])
    before = np.concatenate(
        [(np.cumsum(chain.log_p) - chain.log_p)[chain.start :] for _, chain in some]
    )
    for (_, chain), first in zip(some, begin.tolist()):
        if chain.parent >= 0:
            gone = [sum(lattices.log_p[e] for e in path) for path in chain.taken]
            used[first] = np.logaddexp.reduce(gone)
            paths[first] -= len(chain.taken) - 1
    bound = np.repeat(np.array([chain.value for _, chain in some]), counts)
    draw = _uniform(_seeds(seed, sample, at, 2))
    value = _bounded_gumbel(before + _rest(used, paths), bound, draw)
    for (s, _), start, first, count in zip(some, starts, begin.tolist(), counts):
        mine = value[first : first + count]
        most = s.samples + 1
        best = np.argpartition(mine, count - most)[-most:] if count > most else range(count)
        for i in best:
            if math.isfinite(mine[i]):
                heapq.heappush(s.heap, (-float(mine[i]), sample, start + int(i)))


def sample_texts(
    vocabulary: Vocabulary, texts: list[str], seeds: list[int], samples: int
) -> Iterator[tuple[int, int, float, float, float, np.ndarray]]:
    """(text, rank, log probability, perturbed value, log inclusion, ids) of each sample."""
    numbers = _Numbers(vocabulary.kept.numbers)
    parts = [list(map(numbers.__getitem__, units(text))) for text in texts]
    lattices = vocabulary.kept.table(vocabulary, numbers)
    keys = np.array([seed & _MASK for seed in seeds], np.uint64)
    draws = _uniform(_seeds(keys, 0, np.zeros(len(keys), np.int64), 1)).tolist()
    searches = [
        _Search(lattices, np.array(part, np.int64), seed & _MASK, samples, draw)
        for part, seed, draw in zip(parts, seeds, draws)
    ]
    drawn = _walk_all(lattices, searches, [0] * len(searches), 0)
    firsts = [
        _Chain(search.top, -1, 0, (), walks, row, log_p, [])
        for search, (walks, row, log_p) in zip(searches, drawn)
    ]
    _add_all(lattices, searches, firsts, 0)
    for sample in range(1, samples):
        open_ = [(s, s.branch()) for s in searches if len(s.chains) == sample]
        open_ = [(s, found) for s, found in open_ if found]
        steps = [s.sidestep(chain, unit, sample) for s, (_, chain, unit) in open_]
        drawn = _walk_all(
            lattices, [s for s, _ in open_], [unit + 1 for _, (_, _, unit) in open_], sample
        )
        more = []
        for (s, (value, chain, unit)), (path, log_p, taken), (walks, row, rest) in zip(
            open_, steps, drawn
        ):
            old = s.chains[chain].log_p[:unit]
            every = np.concatenate([old, [log_p], rest])
            more.append(_Chain(value, chain, unit, path, walks, row, every, taken))
        _add_all(lattices, [s for s, _ in open_], more, sample)
    for number, search in enumerate(searches):
        bound = search.bound()
        for rank, chain in enumerate(search.chains):
            log_p = float(chain.log_p.sum())
            yield (
                number,
                rank,
                log_p,
                chain.value,
                _log_inclusion(log_p - bound),
                _piece_ids(vocabulary, lattices, search.all_edges(rank)),
            )


def _log_inclusion(excess: float) -> float:
    """log of the chance that a Gumbel variable exceeds the first value left out."""
    if excess > 30.0:
        return 0.0
    rate = math.exp(excess)
    return excess if rate < 1e-12 else math.log(-math.expm1(-rate))


def _piece_ids(vocabulary: Vocabulary, lattices: Lattices, parts: list[np.ndarray]) -> np.ndarray:
    if not parts:
        return np.zeros(0, np.int64)
    ids = lattices.piece[np.concatenate(parts)]
    rare = np.flatnonzero(ids < 0)
    if not len(rare):
        return ids
    out, last = [], 0
    for i in rare.tolist():
        raw = chr(-1 - int(ids[i])).encode("utf-8", "surrogatepass")
        out += [ids[last:i], vocabulary.byte_ids[np.frombuffer(raw, np.uint8)]]
        last = i + 1
    return np.concatenate([*out, ids[last:]])


def encode(
    docs: DataFrame, model: str, samples: int = SAMPLES, sharpness: float = 1.0
) -> DataFrame:
    """Up to ``samples`` distinct segmentations of each whole text, drawn without replacement.

    Returns doc_id, tag (a hash of the text), sample (0 for the first drawn), n_pieces,
    log_prob, perturbed (its Gumbel value; they fall from sample to sample),
    log_inclusion (log of the chance to exceed the first value that was left out: the
    weight of an unbiased estimate is 1 over it) and ids (little-endian 32-bit numbers).
    ``model`` is the path of a SentencePiece file on every executor.

    The draws of a row depend on its doc_id alone, so a lost task draws the same again;
    repeated ids draw with the same seed. A null text counts as empty: one sample without
    pieces. A text with fewer segmentations than ``samples`` gets all it has. An empty
    table gives an empty result.
    """

    def batch(rows: pa.RecordBatch, vocabulary: Vocabulary):
        for columns, pieces, _ in _sampled(rows, vocabulary, samples):
            yield {**columns, "ids": [part.astype("<i4").tobytes() for part in pieces]}

    schema = f"{_SAMPLE}, ids binary"
    return map_batches(
        _seeded(docs), batch, schema, lambda: Vocabulary(model, sharpness), _TRIM_EVERY
    )


_SAMPLE = (
    "doc_id long, tag long, sample int, n_pieces long, log_prob double, perturbed double,"
    " log_inclusion double"
)


def _seeded(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.xxhash64(whole("text")).alias("tag"),
        F.xxhash64("doc_id").alias("seed"),
        whole("text").alias("text"),
    )


def _sampled(
    rows: pa.RecordBatch, vocabulary: Vocabulary, samples: int
) -> Iterator[tuple[dict, list[np.ndarray], list[str]]]:
    """The columns of the samples of some texts, the ids of each, and its text."""
    every = rows.column("text").to_pylist()
    for first, last in chunks(every, _CHUNK):
        texts = every[first:last]
        seeds = rows.column("seed")[first:last].to_pylist()
        found = sample_texts(vocabulary, texts, seeds, samples)
        at, rank, log_p, value, inclusion, pieces = zip(*found)
        row = pa.array(at)
        columns = {
            "doc_id": rows.column("doc_id")[first:last].take(row),
            "tag": rows.column("tag")[first:last].take(row),
            "sample": rank,
            "n_pieces": [len(part) for part in pieces],
            "log_prob": log_p,
            "perturbed": value,
            "log_inclusion": inclusion,
        }
        yield columns, list(pieces), [texts[i] for i in at]


def decoded(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of some ids; the blank that encoding put before it goes."""
    size = vocabulary.size_of[ids]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total) + np.repeat(vocabulary.begin_of[ids] - ends + size, size)
    return vocabulary.all_bytes[place].tobytes()[1:].decode("utf-8", "replace")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with its ``ids`` turned back into ``text``; all other columns are kept.

    Null ids give a null text.
    """
    columns = [name for name in encoded.columns if name not in ("ids", "text")]
    fields = [f"`{name}` {encoded.schema[name].dataType.simpleString()}" for name in columns]

    def batch(rows: pa.RecordBatch, vocabulary: Vocabulary):
        texts = [
            None if ids is None else decoded(vocabulary, np.frombuffer(ids, "<i4"))
            for ids in rows.column("ids").to_pylist()
        ]
        yield {**{name: rows.column(name) for name in columns}, "text": texts}

    schema = ", ".join([*fields, "text string"])
    return map_batches(
        encoded.select(*columns, "ids"), batch, schema, lambda: Vocabulary(model)
    )


def digests(
    docs: DataFrame, model: str, samples: int = SAMPLES, sharpness: float = 1.0
) -> DataFrame:
    """The samples of ``encode``, decoded again where they are drawn, with a digest of the ids.

    Returns doc_id, sample, n_pieces, log_prob, perturbed, log_inclusion, ids (little-endian
    32-bit numbers), ids_sha256 (of these) and round_trip (they decode to the text).
    """

    def batch(rows: pa.RecordBatch, vocabulary: Vocabulary):
        for columns, pieces, texts in _sampled(rows, vocabulary, samples):
            ids = [part.astype("<i4").tobytes() for part in pieces]
            yield {
                **columns,
                "ids": ids,
                "ids_sha256": [hashlib.sha256(part).hexdigest() for part in ids],
                "round_trip": [
                    decoded(vocabulary, part) == text for part, text in zip(pieces, texts)
                ],
            }

    schema = f"{_SAMPLE}, ids binary, ids_sha256 string, round_trip boolean"
    return map_batches(
        _seeded(docs), batch, schema, lambda: Vocabulary(model, sharpness), _TRIM_EVERY
    ).drop("tag")
