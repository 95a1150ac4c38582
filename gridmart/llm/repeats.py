"""Byte strings that occur more than once in a table of documents, and their removal.

The strings are the windows of a fixed length, one at every byte. A suffix array sorted to
that depth would put equal windows side by side; prefix doubling builds it from names:
equal strings of length h have equal names, and the pair (name at p, name at p + h) names
the string of twice the length.

The first doublings happen where the bytes are, with 64-bit fingerprints of the pairs for
names. Spark then ranks what may still repeat, in rounds that drop what is unique:

1. At sampled positions only: each window points to the position of the least name of a
   quarter of its length inside it, its anchor. Equal windows have equal anchors at equal
   offsets, so windows whose anchor's name is unique are unique. About two positions in
   151 are anchors, so this round moves a hundredth of the bytes.
2. Windows with one anchor lie side by side: a run. Runs of equal content repeat as a
   whole, and one of them stands for the others from here on.
3. Of runs that share an anchor's name but not their content, blocks of neighbouring
   windows are compared: what all windows of a block contain is its core. Windows whose
   core is unique are unique; blocks of equal content repeat as a whole. What is left is
   told apart by the few bytes around the core that each window adds to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import (
    forget,
    map_arrow,
    map_batches,
    once,
    quoted,
    row_key,
    stored,
    whole,
)

WINDOW = 200

# Window starts of a text that are named together; with the rest of their windows these
# stay below 2 ** 20, as positions are kept in the low 20 bits of a name.
_PART = 1 << 18
_LOW = np.uint64((1 << 20) - 1)


def _fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a pair of names."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x += b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


_BYTES = _fold(np.arange(1, 257, dtype=np.uint64), np.full(256, 7, np.uint64))


def block_size(window: int) -> int:
    """Neighbouring windows that are compared as one."""
    return max(1, min(16, window // 8))


class Names:
    """Names at every position: of windows and block cores, two each, and of samples."""

    def __init__(self, data: np.ndarray, window: int):
        self.sample = max(1, window // 4)
        self.core_bytes = window - block_size(window) + 1
        now, length = _BYTES[data], 1
        while True:
            if length <= self.sample < 2 * length:
                self.short = _fold(*self._pair(now, length, self.sample))
            if length <= self.core_bytes < 2 * length:
                self.core = self._pair(now, length, self.core_bytes)
            if 2 * length > window:
                break
            now = _fold(now[:-length], now[length:])
            length *= 2
        self.left, self.right = self._pair(now, length, window)

    @staticmethod
    def _pair(now: np.ndarray, length: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of the first and the last ``length`` bytes of each ``wanted`` bytes."""
        count = len(now) + length - wanted
        return now[:count], now[wanted - length :][:count]

    def anchors(self, window: int) -> np.ndarray:
        """For each window, the position of the least sample name in it; the first if tied."""
        span = window - self.sample + 1
        least = (self.short & ~_LOW) | np.arange(len(self.short), dtype=np.uint64)
        length = 1
        while 2 * length <= span:
            least = np.minimum(least[:-length], least[length:])
            length *= 2
        count = len(self.left)
        least = np.minimum(least[:count], least[span - length :][:count])
        return (least & _LOW).astype(np.int64)


def _parts(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, list[tuple]]]:
    """Bytes of texts end to end, with (text, offset, start, length) of each piece.

    A long text is cut into pieces that overlap by all but one byte of a window, so each
    window is in exactly one piece.
    """
    pieces, size = [], 0

    def joined():
        data = b"".join([texts[t][o : o + n] for t, o, _, n in pieces])
        return np.frombuffer(data, np.uint8), pieces

    for number, text in enumerate(texts):
        for offset in range(0, len(text) - window + 1, _PART):
            length = min(_PART + window - 1, len(text) - offset)
            pieces.append((number, offset, size, length))
            size += length
            if size >= _PART:
                yield joined()
                pieces, size = [], 0
    if pieces:
        yield joined()


def _runs(texts: list[bytes], window: int) -> Iterator[dict[str, np.ndarray]]:
    """Runs of windows with one anchor: text, start, n (windows), gap (from the start
    to the anchor), and the names of anchor and content."""
    for data, pieces in _parts(texts, window):
        names = Names(data, window)
        anchor = names.anchors(window)
        text, offset, begin, length = (np.array(c, np.int64) for c in zip(*pieces))
        last = begin + length - window
        inside = np.zeros(len(anchor) + 1, np.int64)
        inside[begin] += 1
        inside[last + 1] -= 1
        valid = np.cumsum(inside)[:-1] > 0
        fresh = valid.copy()
        fresh[1:] &= anchor[1:] != anchor[:-1]
        fresh[begin] = True
        first = np.flatnonzero(fresh)
        piece = np.searchsorted(begin, first, "right") - 1
        end = np.minimum(np.append(first[1:], len(anchor)) - 1, last[piece])
        left, right = names.left, names.right
        run = _fold(_fold(left[first], right[first]), _fold(left[end], right[end]))
        shape = ((end - first) << 32) | (anchor[first] - first)
        yield {
            "text": text[piece],
            "start": offset[piece] + first - begin[piece],
            "n": end - first + 1,
            "gap": anchor[first] - first,
            "anchor": names.short[anchor[first]].view(np.int64),
            "run": _fold(run, shape.astype(np.uint64)).view(np.int64),
        }


def _utf8(column: pa.Array) -> list[bytes]:
    return [text.encode("utf-8", "surrogatepass") for text in column.to_pylist()]


_KEY = "_id long, _tag long"


def _run_table(docs: DataFrame, window: int) -> DataFrame:
    def batch(rows: pa.RecordBatch):
        ids, tags = rows.column("_id").to_numpy(), rows.column("_tag").to_numpy()
        for found in _runs(_utf8(rows.column("text")), window):
            text = found.pop("text")
            yield {"_id": ids[text], "_tag": tags[text], **found}

    schema = f"{_KEY}, start long, n int, gap int, anchor long, run long"
    return map_batches(docs, batch, schema)


def _block_table(docs: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """The runs asked for, a list for each document, cut into blocks.

    The windows of a block start ``place`` (from 0 up to the block's size) bytes before
    its core, which lies a whole number of block sizes before the anchor: so equal
    windows are in blocks of one number, with equal cores and equal places. A row has the
    n windows from ``low`` bytes before the core on, the largest place starting at
    ``start``, and the bytes they add to the core on its left and right.
    """
    size = block_size(window)

    def batch(rows: pa.RecordBatch):
        ids, tags = rows.column("_id").to_numpy(), rows.column("_tag").to_numpy()
        wanted = rows.column("asked").to_pylist()
        texts = _utf8(rows.column("text"))
        for data, pieces in _parts(texts, window):
            names = Names(data, window)
            one, two = (part.view(np.int64) for part in names.core)
            found: list[tuple] = []
            for text, offset, begin, length in pieces:
                top = offset + length - window
                raw = texts[text]
                for run in wanted[text]:
                    first, last = run["start"], run["start"] + run["n"] - 1
                    anchor = first + run["gap"]
                    first, last = max(first, offset), min(last, top)
                    while first <= last:
                        number = (anchor - first) // size
                        core = anchor - number * size
                        end = min(last, core)
                        low, tail = core - end, core + names.core_bytes
                        found.append(
                            (
                                text,
                                first,
                                end - first + 1,
                                number,
                                low,
                                run["known"],
                                core - offset + begin,
                                raw[first:core],
                                raw[tail : tail + size - 1 - low],
                            )
                        )
                        first = end + 1
            if not found:
                continue
            text, start, n, number, low, known, at, left, right = zip(*found)
            text, at = np.array(text), np.array(at)
            yield {
                "_id": ids[text],
                "_tag": tags[text],
                "start": start,
                "n": n,
                "number": number,
                "low": low,
                "known": known,
                "one": one[at],
                "two": two[at],
                "before": left,
                "after": right,
            }

    joined = docs.join(asked, ["_id", "_tag"])
    schema = (
        f"{_KEY}, start long, n int, number int, low int, known boolean, one long, two long,"
        " before binary, after binary"
    )
    return map_batches(joined, batch, schema)


def _repeated_in_blocks(blocks: DataFrame, window: int) -> DataFrame:
    """Windows of blocks, not known yet to repeat, that do: _id, _tag, start, n."""
    core = ["number", "one", "two"]
    content = [*core, "low", "n", "before", "after"]
    shared = blocks.groupBy(core).agg(F.count("*").alias("c")).filter("c > 1").select(core)
    open_ = blocks.join(shared, core, "left_semi")
    contents = open_.groupBy(content).agg(
        F.count("*").alias("c"), F.min(F.struct("_id", "_tag", "start")).alias("of")
    )
    contents = stored(contents, "contents")
    settled = (
        open_.filter("NOT known")
        .join(contents.filter("c > 1").select(content), content, "left_semi")
        .select("_id", "_tag", "start", F.col("n").cast("long").alias("n"))
    )

    kinds = contents.groupBy(core).agg(F.count("*").alias("kinds")).filter("kinds > 1")
    unlike = contents.join(kinds.select(core), core, "left_semi")
    top = F.col("low") + F.col("n") - 1
    place = F.explode(F.sequence("low", top)).alias("place")
    windows = unlike.select(*core, "before", "after", "of", "c", top.alias("top"), place)
    added = [
        F.substring("before", F.col("top") - F.col("place") + 1, F.col("place")).alias("before"),
        F.substring("after", F.lit(1), F.lit(block_size(window) - 1) - F.col("place")).alias(
            "after"
        ),
    ]
    windows = windows.select(
        *core, "place", *added, "of", "c", (F.col("top") - F.col("place")).alias("shift")
    )
    key = [*core, "place", "before", "after"]
    twice = windows.groupBy(key).agg(F.count("*").alias("t")).filter("t > 1").select(key)
    found = (
        windows.filter("c = 1")
        .join(twice, key, "left_semi")
        .select(
            "of._id",
            "of._tag",
            (F.col("of.start") + F.col("shift")).alias("start"),
            F.lit(1).cast("long").alias("n"),
        )
    )
    return settled.union(found)


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows that also start somewhere else: _id, _tag, spans (start, n windows).

    One row per document that has any (``_id`` and ``_tag`` as of ``row_key``). Windows
    lie within one document and may overlap. Anchors, runs, cores and windows are counted
    by aggregates with a partial sum in each map task, so copies and frequent passages
    reach a shuffle as one row a task; the joins after it are on single counted keys,
    whose hot ones the engine may split, and never pair members of a group. Copies of a
    row are one document, all of whose windows repeat.
    """
    docs, copied = once(docs, F.xxhash64("text"))
    windows = F.octet_length("text").cast("long") - window + 1
    copied = copied.select("_id", "_tag", F.lit(0).cast("long").alias("start"), windows.alias("n"))
    anchors = stored(_run_table(docs, window), "anchors")
    # The keys are stored so that the join has its own shuffle, whose hot keys Spark may split.
    several = anchors.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1")
    several = stored(several.select("anchor"), "several")
    near = stored(anchors.join(several, "anchor", "left_semi"), "near")
    forget(anchors)

    member = F.min(F.struct("_id", "_tag", "start", "n", "gap"))
    runs = stored(
        near.groupBy("anchor", "run").agg(F.count("*").alias("c"), member.alias("of")), "runs"
    )
    known = runs.filter("c > 1").select("anchor", "run")
    settled = near.join(known, ["anchor", "run"], "left_semi").select(
        "_id", "_tag", "start", F.col("n").cast("long").alias("n")
    )

    kinds = runs.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    kinds = stored(kinds.select("anchor"), "kinds")
    unlike = runs.join(kinds, "anchor", "left_semi").select(
        "of.*", (F.col("c") > 1).alias("known")
    )
    asked = unlike.groupBy("_id", "_tag").agg(
        F.collect_list(F.struct("start", "n", "gap", "known")).alias("asked")
    )
    blocks = stored(_block_table(docs, asked, window), "blocks")
    return (
        settled.union(_repeated_in_blocks(blocks, window))
        .union(copied.filter("n > 0"))
        .groupBy("_id", "_tag")
        .agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    )


def _cut(data: bytes, spans: list[dict] | None, window: int) -> tuple[list[bytes], int]:
    """The bytes that stay, in pieces, and how many maximal runs go."""
    if not spans:
        return [data], 0
    kept, at, gone = [], 0, 0
    end = -1
    for start, n in sorted((span["start"], span["n"]) for span in spans):
        if start > end:
            kept.append(data[at:start])
            gone += 1
        end = max(end, start + n - 1 + window)
        at = end
    kept.append(data[at:])
    return kept, gone


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """What removing every repeated window leaves of each document.

    One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_removed (bytes inside a
    window that also starts elsewhere, in this or another document), n_spans (maximal
    removed runs), kept_sha256 (of the remaining bytes). Windows are judged on the input.
    Null counts as empty, and texts shorter than a window lose nothing. Rows that repeat
    repeat each other's text; null ids are told apart by their texts. An empty table
    gives an empty result.
    """
    spans = repeated_windows(docs, window)

    def batch(rows: pa.RecordBatch):
        texts = _utf8(rows.column("text"))
        cuts = [_cut(text, s, window) for text, s in zip(texts, rows.column("spans").to_pylist())]
        kept = [b"".join(parts) for parts, _ in cuts]
        yield {
            "doc_id": rows.column("doc_id"),
            "n_bytes": [len(text) for text in texts],
            "n_removed": [len(text) - len(rest) for text, rest in zip(texts, kept)],
            "n_spans": [gone for _, gone in cuts],
            "kept_sha256": [hashlib.sha256(rest).hexdigest() for rest in kept],
        }

    keyed = docs.select("doc_id", *row_key(F.xxhash64("text")), whole("text").alias("text"))
    joined = keyed.join(spans, ["_id", "_tag"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_batches(joined, batch, schema)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with its repeated windows cut out of ``text``; other columns as they are.

    All rows stay, also those of which nothing is left. Where a cut splits a character,
    its remaining bytes go too. A null text stays null.
    """
    spans = repeated_windows(docs, window)
    columns = docs.columns
    keyed = docs.select(F.struct(*quoted(columns)).alias("_row"), *row_key(F.xxhash64("text")))
    joined = keyed.join(spans, ["_id", "_tag"], "left").select("_row", "spans")
    place = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            row = rows.column("_row")
            fields = [row.field(i) for i in range(len(columns))]
            texts = []
            for text, cut in zip(fields[place].to_pylist(), rows.column("spans").to_pylist()):
                if cut:
                    parts, _ = _cut(text.encode("utf-8", "surrogatepass"), cut, window)
                    text = b"".join(parts).decode("utf-8", "ignore")
                texts.append(text)
            fields[place] = pa.array(texts, fields[place].type)
            yield pa.RecordBatch.from_arrays(fields, names=columns)

    return map_arrow(joined, run, docs.schema)
