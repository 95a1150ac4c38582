"""Documents as token ids, packed into rows of one length."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import chunks, map_arrow, pa_schema, whole
from gridmart.llm.token_counts import units

ROW_TOKENS = 2048

# Tokens packed together. It bounds the memory of a task; with thousands of pieces in
# each window, a larger one would hardly fill the rows better.
WINDOW_TOKENS = 1 << 22

CACHED = 1 << 20
_CHUNK = 1 << 22

SCHEMA = (
    "row_id long, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>,"
    " doc_ids array<long>, tags array<long>, starts array<long>"
)


class Encoder:
    """Token ids by a rank file, with a cache of what the task has seen."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.token_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.token_bytes[rank] = len(token)
        self.dtype = np.dtype("<u2" if len(self.token_bytes) <= 1 << 16 else "<u4")
        self._forget()

    def _forget(self) -> None:
        # The ids of unit number n are ``ids[begin[n] : begin[n] + size[n]]``.
        self.numbers = _Numbers()
        self.ids = np.zeros(0, self.dtype)
        self.begin = self.size = np.zeros(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        # Units that begin with a blank may be encoded as one text, cut by byte lengths.
        alone = [i for i, unit in enumerate(new) if unit[0] != " " or unit[-1].isspace()]
        other = [new[i] for i in alone]
        plain = np.ones(len(new), bool)
        plain[alone] = False
        text = "".join([unit for unit, fits in zip(new, plain.tolist()) if fits])
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new))[plain])
        if not text.isascii():
            raw = np.frombuffer(text.encode(), np.uint8)
            ends = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))[ends]
        ids = np.array(self.encoding.encode_ordinary(text), self.dtype)
        cuts = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1
        each = [np.array(self.encoding.encode_ordinary(unit), self.dtype) for unit in other]
        size = np.zeros(len(new), np.int64)
        size[plain] = np.diff(cuts, prepend=0)
        size[alone] = [len(one) for one in each]
        begin = np.zeros(len(new), np.int64)
        begin[plain] = np.append(0, cuts)[:-1]
        begin[alone] = len(ids) + np.cumsum(size[alone]) - size[alone]
        self.begin = np.append(self.begin, begin + len(self.ids))
        self.size = np.append(self.size, size)
        self.ids = np.concatenate([self.ids, ids, *each])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian numbers end to end."""
        if len(self.numbers) > CACHED:
            self._forget()
        known, found, counts = len(self.numbers), [], []
        for text in texts:
            part = units(text)
            found += map(self.numbers.__getitem__, part)
            counts.append(len(part))
        if len(self.numbers) > known:
            self._learn(list(islice(self.numbers, known, None)))
        number = np.array(found, np.int64)
        size = self.size[number]
        ends = np.append(0, np.cumsum(size))
        place = np.arange(ends[-1]) + np.repeat(self.begin[number] - ends[:-1], size)
        packed, width = self.ids[place].tobytes(), self.dtype.itemsize
        cuts = (ends[np.append(0, np.cumsum(counts, dtype=np.int64))] * width).tolist()
        return [packed[first:last] for first, last in zip(cuts, cuts[1:])]


class _Numbers(dict):
    """Numbers of units; a new unit gets the next one."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


class _Capacities:
    """A segment tree over free capacities: finds the tightest bin that still fits."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, free: int, bin_: int) -> None:
        self.bins[free].append(bin_)
        node = self.leaves + free
        while node:
            self.counts[node] += 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(free, bin) of a bin with the least free capacity of at least ``size``."""
        counts, node = self.counts, self.leaves + size
        while not counts[node]:
            while node & 1:  # a right child: what lies right of it hangs further up
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if counts[2 * node] else 2 * node + 1
        free = node - self.leaves
        bin_ = self.bins[free].pop()
        while node:
            counts[node] -= 1
            node >>= 1
        return free, bin_


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Pieces, none above ``capacity``, into bins: the members of each bin.

    Longest first, equal lengths in the given order, each into the fullest bin that has
    room for it.
    """
    tree, bins = _Capacities(capacity), []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[piece])
        if found is None:
            found = capacity, len(bins)
            bins.append([])
        free, bin_ = found
        bins[bin_].append(piece)
        tree.add(free - sizes[piece], bin_)
    return bins


def _packed(pieces: list[tuple], capacity: int, dtype: np.dtype, pad: int) -> Iterator[dict]:
    """Rows from pieces (doc_id, tag, start, ids)."""
    width = dtype.itemsize
    empty = np.full(capacity, pad, dtype).tobytes()
    sizes = [len(piece[3]) // width for piece in pieces]
    for members in best_fit_decreasing(sizes, capacity):
        ends = np.cumsum([sizes[i] for i in members]).tolist()
        ids = b"".join([pieces[i][3] for i in members])
        yield {
            "n_tokens": ends[-1],
            "ids": ids + empty[len(ids) :],
            "cu_seqlens": [0, *ends],
            "resets": [0, *ends[:-1]],
            "doc_ids": [pieces[i][0] for i in members],
            "tags": [pieces[i][1] for i in members],
            "starts": [pieces[i][2] for i in members],
        }


def pack(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    capacity: int = ROW_TOKENS,
    pad: int = 0,
    window: int = WINDOW_TOKENS,
) -> DataFrame:
    """Rows of ``capacity`` token ids, each filled with whole documents or pieces of one.

    Returns row_id; n_tokens; ids: the row of the id matrix, little-endian (2 bytes an id
    up to 65,536 ids, else 4), padded with ``pad``; cu_seqlens: 0 and the end of each
    segment; resets: where position ids start from 0 again; and per segment doc_ids, tags
    (a hash of the document's text, for ids that repeat) and starts (its first token's
    place in the document). ``ranks`` is the path of a rank file on every executor,
    ``pattern`` the one that splits text before merges.

    A document longer than a row is split into full rows and a rest; nothing is cut off.
    A null or empty text is a segment of no tokens. Repeated rows are packed each for
    itself, null ids stay null, an empty table gives an empty result.

    Every task packs what it reads, in windows of about ``window`` tokens, so no text or
    token is shuffled and the layout of the table decides which documents can share a
    row. ``unpack`` gives the documents back.
    """
    types = pa_schema(docs.sparkSession, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        width = encoder.dtype.itemsize
        step = capacity * width
        number = TaskContext.get().partitionId() << 36
        pieces: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            rows = list(_packed(pieces, capacity, encoder.dtype, pad))
            pieces.clear()
            held = 0
            for row in rows:
                row["row_id"] = number
                number += 1
            return pa.RecordBatch.from_pylist(rows, schema=types)

        for rows in batches:
            ids = rows.column("doc_id").to_pylist()
            tags = rows.column("tag").to_pylist()
            texts = rows.column("text").to_pylist()
            for first, last in chunks(texts, _CHUNK):
                for i, tokens in enumerate(encoder.encode(texts[first:last]), first):
                    for cut in range(0, max(len(tokens), 1), step):
                        part = tokens[cut : cut + step]
                        pieces.append((ids[i], tags[i], cut // width, part))
                        held += len(part) // width
                    if held >= window:
                        yield flush()
        if pieces:
            yield flush()

    kept = docs.select("doc_id", F.xxhash64("text").alias("tag"), whole("text").alias("text"))
    return map_arrow(kept, run, SCHEMA)


def unpack(packed: DataFrame) -> DataFrame:
    """The segments of packed rows: doc_id, tag, start, n_tokens and ids of each."""
    width = F.when(F.size("cu_seqlens") > 0, F.octet_length("ids")) / F.lit(1)
    each = packed.select(
        "ids",
        "n_tokens",
        F.posexplode(F.arrays_zip("doc_ids", "tags", "starts")).alias("i", "s"),
        "cu_seqlens",
        width.alias("bytes"),
    )
    begin, end = F.col("cu_seqlens")[F.col("i")], F.col("cu_seqlens")[F.col("i") + 1]
    return each.select(
        F.col("s.doc_ids").alias("doc_id"),
        F.col("s.tags").alias("tag"),
        F.col("s.starts").alias("start"),
        (end - begin).alias("n_tokens"),
        "ids",
        begin.alias("begin"),
    )
