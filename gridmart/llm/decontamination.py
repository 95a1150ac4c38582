"""Benchmark passages in documents, found by suffix arrays over the documents' words."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridmart.llm.common import chunks, map_arrow, map_batches

WINDOW = 13

# A document is contaminated if a word in this many is hit.
ONE_IN = 20

# Benchmark words in one broadcast block. A larger benchmark takes several blocks, which
# tasks hold one at a time, so the size of a broadcast is bounded.
BLOCK_WORDS = 1 << 20

# Characters of documents in one suffix array.
SHARD_CHARS = 1 << 21

# A-Z folded; what is no letter, digit or code point beyond ASCII ends a word.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Block:
    """Benchmark items as word numbers, with all their suffixes of a window or more.

    ``vocabulary`` numbers the words from 1; ``tokens`` has the items end to end, a zero
    after each; ``starts`` are the places of the suffixes to search, ``sizes`` the words
    that must match for a hit, ``items`` the item of each, as an index into ``item_ids``.
    Equal windows are one group: ``group`` is that of each suffix, ``first`` the first suffix of
    each group, and ``members`` from ``begins`` on are its items, each once.
    """

    def __init__(self, window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.item_ids: list[object] = []
        self.tokens: list[int] = []
        self.starts: list[int] = []
        self.sizes: list[int] = []
        self.items: list[int] = []

    def add(self, item_id: object, item: list[bytes]) -> None:
        number = self.vocabulary
        size = min(self.window, len(item))
        base, index = len(self.tokens), len(self.item_ids)
        self.item_ids.append(item_id)
        self.tokens += [number.setdefault(word, len(number) + 1) for word in item]
        self.tokens.append(0)
        for place in range(len(item) - size + 1):
            self.starts.append(base + place)
            self.sizes.append(size)
            self.items.append(index)

    def packed(self) -> dict:
        numbers: dict[tuple[int, ...], int] = {}
        groups = [
            numbers.setdefault(tuple(self.tokens[start : start + size]), len(numbers))
            for start, size in zip(self.starts, self.sizes)
        ]
        group, item = np.array(groups, np.int64), np.array(self.items, np.int64)
        pairs = np.unique(np.stack([group, item], 1).reshape(-1, 2), axis=0)
        return {
            "window": self.window,
            "group": group,
            "first": np.unique(group, return_index=True)[1],
            "members": pairs[:, 1],
            "begins": np.searchsorted(pairs[:, 0], np.arange(len(numbers) + 1)),
            "vocabulary": self.vocabulary,
            "item_ids": self.item_ids,
            "tokens": np.array(self.tokens + [0] * self.window, np.uint32),
            "starts": np.array(self.starts, np.int64),
            "sizes": np.array(self.sizes, np.int64),
            "items": np.array(self.items, np.int64),
            "shortest": min(self.sizes, default=self.window),
        }


def blocks_of(items: DataFrame, window: int, limit: int = BLOCK_WORDS) -> list:
    """The benchmark as broadcast blocks of about ``limit`` words; it is the query set.

    Items are read one partition at a time. Those without words are left out: they have
    no window. Equal items are kept, each under its own id; a null id is the text "null".
    """
    context = items.sparkSession.sparkContext
    found, block = [], Block(window)
    for row in items.select("item_id", "text").toLocalIterator():
        if item := words(row["text"]):
            block.add("null" if row["item_id"] is None else row["item_id"], item)
            if len(block.tokens) >= limit:
                found.append(context.broadcast(block.packed()))
                block = Block(window)
    if block.item_ids:
        found.append(context.broadcast(block.packed()))
    return found


def _rows_at(tokens: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """The words from each place on, as byte strings that sort like the word numbers."""
    view = np.lib.stride_tricks.sliding_window_view(tokens, width)
    return np.ascontiguousarray(view[places].astype(">u4")).view(f"V{4 * width}").ravel()


def search(
    corpus: list[list[bytes]], block: dict, every: bool = True
) -> dict[str, np.ndarray]:
    """All occurrences of the block's windows in a shard, with the longest match of each.

    Not ``every``: of equal windows the first is searched, and without the longest match, so
    a window that many items hold costs one row for each place it occurs at.

    The shard's suffix array holds every suffix that starts with as many benchmark words
    as the shortest window has: no other suffix can match. It is sorted to the depth of a
    window; each benchmark suffix is looked up by two binary searches, which bound the
    suffixes that start with its window. Returned per occurrence: ``doc`` (row), ``place``
    (word), ``size`` (words of the window), ``length`` (longest verbatim match from
    there on, past the window), ``suffix`` (index of the benchmark suffix).
    """
    window, number = block["window"], block["vocabulary"]
    lengths = np.array([len(doc) for doc in corpus], np.int64)
    flat = np.zeros(int(lengths.sum()) + len(corpus) + window, np.uint32)
    bases = np.cumsum(lengths + 1) - lengths - 1
    get = number.get
    for base, doc in zip(bases.tolist(), corpus):
        flat[base : base + len(doc)] = [get(word, 0) for word in doc]
    known = np.concatenate([[0], np.cumsum(flat != 0)])
    shortest = block["shortest"]
    runs = known[shortest:] - known[:-shortest] == shortest
    places = np.flatnonzero(runs[: len(flat) - window])
    none = np.zeros(0, np.int64)
    if not len(places) or not len(block["starts"]):
        return {name: none for name in ("doc", "place", "size", "length", "suffix")}

    # Sort by the words themselves: void items of big-endian numbers compare as bytes.
    keys = _rows_at(flat, places, window).view(f"S{4 * window}")
    order = np.argsort(keys, kind="stable")
    suffixes, keys = places[order], keys[order]

    found = []
    asked = np.arange(len(block["sizes"])) if every else block["first"]
    for size in np.unique(block["sizes"]).tolist():
        which = asked[block["sizes"][asked] == size]
        prefix = np.zeros((len(which), window), ">u4")
        view = np.lib.stride_tricks.sliding_window_view(block["tokens"], window)
        prefix[:, :size] = view[block["starts"][which], :size]
        low = prefix.copy().view(f"S{4 * window}").ravel()
        prefix[:, size:] = 0xFFFFFFFF
        high = prefix.view(f"S{4 * window}").ravel()
        begin = np.searchsorted(keys, low, "left")
        end = np.searchsorted(keys, high, "right")
        counts = end - begin
        hit = np.repeat(which, counts)
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = suffixes[np.repeat(begin, counts) + inner]
        found.append((hit, at, np.full(len(hit), size)))
    hit, at, size = (np.concatenate(part) for part in zip(*found))

    length = size.copy()
    tokens, starts = block["tokens"], block["starts"]
    live = np.arange(len(hit) if every else 0)
    while len(live):
        mine = tokens[np.minimum(starts[hit[live]] + length[live], len(tokens) - 1)]
        theirs = flat[np.minimum(at[live] + length[live], len(flat) - 1)]
        live = live[(mine == theirs) & (mine != 0)]
        length[live] += 1
    doc = np.searchsorted(bases, at, "right") - 1
    return {"doc": doc, "place": at - bases[doc], "size": size, "length": length, "suffix": hit}


def _search_blocks(corpus: list[list[bytes]], blocks: list, every: bool):
    """(packed block, occurrences) of each block; with several, one is in memory at a time."""
    for block in blocks:
        packed = block.value
        yield packed, search(corpus, packed, every)
        if len(blocks) > 1:
            block._value = None
            del block._value


def _merged(places: np.ndarray, sizes: np.ndarray) -> int:
    """Words covered by the spans."""
    order = np.argsort(places, kind="stable")
    begin, end = places[order], (places + sizes)[order]
    reach = np.maximum.accumulate(end)
    before = np.concatenate([[0], reach[:-1]])
    return int(np.maximum(0, reach - np.maximum(begin, before)).sum())


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every longest verbatim match of benchmark words in documents.

    One row per occurrence that isn't the tail of a longer one: doc_id, doc_place,
    item_id (text), item_place, n_words (places and lengths in words).
    """
    blocks = blocks_of(items, window)

    def batch(rows: pa.RecordBatch):
        ids = rows.column("doc_id").to_pylist()
        texts = [text or "" for text in rows.column("text").to_pylist()]
        for first, last in chunks(texts, SHARD_CHARS):
            corpus = [words(text) for text in texts[first:last]]
            for block, found in _search_blocks(corpus, blocks, True):
                place = block["starts"][found["suffix"]]
                # A tail of a longer match has the same words before it on both sides.
                key = list(zip(found["doc"].tolist(), found["place"].tolist(), place.tolist()))
                inner = {(d, p + 1, s + 1) for d, p, s in key}
                item = block["items"][found["suffix"]]
                base = np.flatnonzero(np.concatenate([[True], block["tokens"][:-1] == 0]))
                keep = [i for i, k in enumerate(key) if k not in inner]
                yield {
                    "doc_id": [ids[first + key[i][0]] for i in keep],
                    "doc_place": [key[i][1] for i in keep],
                    "item_id": [str(block["item_ids"][item[i]]) for i in keep],
                    "item_place": [key[i][2] - int(base[item[i]]) for i in keep],
                    "n_words": [int(found["length"][i]) for i in keep],
                }

    return map_batches(
        docs.select("doc_id", "text"),
        batch,
        "doc_id long, doc_place long, item_id string, item_place long, n_words long",
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """How much of every document occurs in the benchmark.

    One row per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence of a
    window), n_items (items with an occurring window), items_sha256 (of their ids, sorted
    as texts, joined by commas), contaminated (a word in 20 is hit). A null text has no
    words. Repeated rows and null ids are judged like any other; an empty benchmark hits
    nothing, an empty table gives an empty result. Words are matched within one document.

    Documents never move: the benchmark, the query set, goes to them in blocks.
    """
    kept = docs.select("doc_id", "text")
    return map_batches(
        kept,
        _judge(blocks_of(items, window)),
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string,"
        " contaminated boolean",
    )


def _judge(blocks: list):
    def judge(texts: list[str]):
        corpus = [words(text) for text in texts]
        spans: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        items: dict[int, set[str]] = {}
        for block, found in _search_blocks(corpus, blocks, False):
            order = np.argsort(found["doc"], kind="stable")
            hit, place, size = (found[name][order] for name in ("doc", "place", "size"))
            group = block["group"][found["suffix"][order]]
            edges = np.flatnonzero(np.concatenate([[True], hit[1:] != hit[:-1], [True]]))
            edges = edges if len(hit) else edges[:0]
            for low, high in zip(edges.tolist(), edges[1:].tolist()):
                doc = int(hit[low])
                spans.setdefault(doc, []).append((place[low:high], size[low:high]))
                held = [
                    block["members"][block["begins"][g] : block["begins"][g + 1]]
                    for g in np.unique(group[low:high]).tolist()
                ]
                names = [str(block["item_ids"][i]) for i in np.unique(np.concatenate(held))]
                items.setdefault(doc, set()).update(names)
        for doc, parts in enumerate(corpus):
            hit = 0
            if doc in spans:
                hit = _merged(*(np.concatenate(part) for part in zip(*spans[doc])))
            names = sorted(items.get(doc, ()))
            yield (
                len(parts),
                hit,
                len(names),
                hashlib.sha256(",".join(names).encode()).hexdigest(),
                hit > 0 and ONE_IN * hit >= len(parts),
            )

    def batch(rows: pa.RecordBatch):
        texts = [text or "" for text in rows.column("text").to_pylist()]
        for first, last in chunks(texts, SHARD_CHARS):
            columns = list(zip(*judge(texts[first:last])))
            yield {
                "doc_id": rows.column("doc_id")[first:last],
                "n_words": columns[0],
                "n_hit": columns[1],
                "n_items": columns[2],
                "items_sha256": columns[3],
                "contaminated": columns[4],
            }

    return batch


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with all their columns and whole rows."""
    blocks = blocks_of(items, window)
    judge = _judge(blocks)
    types = docs.schema

    def run(batches):
        for rows in batches:
            verdicts = [flag for part in judge(rows) for flag in part["contaminated"]]
            yield rows.filter(pa.array([not flag for flag in verdicts], pa.bool_()))

    return map_arrow(docs, run, types)

