"""What text filters remove in every order, with table-wide duplicates found by tries."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import forget, map_arrow, pa_schema, stored, whole

# The filters in the order of the bits of a mask.
FILTERS = "ABCDE"
_DUPLICATE = 1 << FILTERS.index("E")

MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#$%&*|"

# Bytes of text in the trie of a task that collapses copies before any shuffle, and in a
# partition of the shuffled texts; a row counts for so many bytes more.
LOCAL_BYTES = 8 << 20
PART_BYTES = 64 << 20
ROW_BYTES = 512

# Rows of a batch that are Python values at a time.
_ROWS = 256

# Lengths of the prefixes that partitions may be cut by: this one times powers of four.
SHORTEST = 16
_STEP = 4


def mask_of(text: bytes, n_chars: int) -> int:
    """The bits of the filters A to D that a text fails. Blanks are \\x20 and \\x09 to \\x0D."""
    words = text.split()
    upper = len(text) - len(text.translate(None, _UPPER))
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * upper > MAX_UPPER_PERCENT * n_chars,
        len(text.translate(None, _SYMBOLS)) < len(text),
    )
    return sum(1 << bit for bit, fail in enumerate(fails) if fail)


def _shared(one: bytes, other: bytes) -> int:
    """How many first bytes are equal: in doubling steps, then halving, by whole comparisons."""
    most = min(len(one), len(other))
    low, size = 0, 16
    while low < most and one[low : low + size] == other[low : low + size]:
        low += size
        size *= 2
    if low >= most:
        return most
    while size > 1:
        size //= 2
        if one[low : low + size] == other[low : low + size]:
            low += size
    return min(low, most)


class Trie:
    """A compressed trie of texts; a text's node holds the smallest (id, note) inserted for it.

    A node is [edge from its parent, children by first byte, smallest entry or None].
    Loops, not recursion, walk it, so depth is bounded by memory alone.
    """

    def __init__(self):
        self.root = [b"", {}, None]
        self.bytes = 0

    def insert(self, text: bytes, entry: tuple) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = [text[at:], {}, None]
                node[1][text[at]] = child
                self.bytes += len(text) - at + ROW_BYTES
                node, at = child, len(text)
                break
            edge = child[0]
            if text.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            keep = _shared(edge, text[at : at + len(edge)])
            upper = [edge[:keep], {edge[keep]: child}, None]
            child[0] = edge[keep:]
            node[1][text[at]] = upper
            self.bytes += ROW_BYTES
            node, at = upper, at + keep
        if node[2] is None or entry < node[2]:
            node[2] = entry

    def entries(self) -> Iterator[tuple]:
        """The smallest entry of every text."""
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node[2] is not None:
                yield node[2]
            waiting.extend(node[1].values())


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of Arrow batches, some at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield list(zip(*[column.to_pylist() for column in part.columns]))


def marks(text: bytes) -> list[int]:
    """Hashes of the proper prefixes that a partition may be cut by, shortest first."""
    found, size, level = [], SHORTEST, 0
    while size < len(text):
        found.append(xxhash.xxh64_intdigest(text[:size], seed=level))
        size, level = size * _STEP, level + 1
    return np.array(found, np.uint64).view(np.int64).tolist()


_JUDGED = "doc_id long, source string, tag long, mask int, text binary, weight long, marks array<long>"


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, source, tag, mask of A to D, and of one row for each text among those that a
    task holds at a time, the one with the smallest id, its text, weight and marks.

    ``tag`` is a hash of the text. Copies in a task meet in a trie of at most LOCAL_BYTES and
    one batch, so a text with very many copies is shuffled once for each such trie. Rows
    without an id bear no text: they are neither smaller than others nor greater.
    """
    types = pa_schema(docs.sparkSession, _JUDGED)

    def emit(held: list[tuple], trie: Trie) -> Iterator[pa.RecordBatch]:
        first = {entry[1] for entry in trie.entries()}
        for start in range(0, len(held), _ROWS):
            rows = held[start : start + _ROWS]
            texts = [row[4] if start + i in first else None for i, row in enumerate(rows)]
            columns = [
                *[[row[i] for row in rows] for i in range(4)],
                texts,
                [None if text is None else len(text) + ROW_BYTES for text in texts],
                [None if text is None else marks(text) for text in texts],
            ]
            arrays = [pa.array(c, type=t.type) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, trie, size = [], Trie(), 0
        for rows in _values(batches):
            for doc_id, source, tag, text, n_chars in rows:
                if doc_id is not None:
                    trie.insert(text, (doc_id, len(held)))
                held.append((doc_id, source, tag, mask_of(text, n_chars), text))
                size += len(text) + ROW_BYTES
                if size >= LOCAL_BYTES:
                    yield from emit(held, trie)
                    held, trie, size = [], Trie(), 0
        yield from emit(held, trie)

    text = whole("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.xxhash64(text).alias("tag"),
        text.cast("binary").alias("text"),
        F.length(text).alias("n_chars"),
    )
    return map_arrow(rows, run, _JUDGED)


def _parts(spark: SparkSession, total: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))


def _heavy(texts: DataFrame, bound: int) -> np.ndarray:
    """Sorted hashes of the prefixes whose texts weigh more than ``bound``.

    Of each length these are fewer than the total weight over ``bound``: two for each
    partition, whatever the table's size, times some ten lengths.
    """
    weights = texts.select("weight", F.explode("marks").alias("mark"))
    weights = weights.groupBy("mark").agg(F.sum("weight").alias("weight"))
    rows = weights.filter(F.col("weight") > bound).select("mark").collect()
    return np.sort(np.array([row["mark"] for row in rows], np.int64))


def smallest(rows: DataFrame) -> DataFrame:
    """doc_id and tag of the smallest id of every text of ``judged`` rows, table-wide.

    Texts are dealt by ranges of a prefix, which grows until the texts that begin with it
    weigh at most half of a partition's share, or until it is the text. So texts with one
    long beginning are spread, and equal texts meet. The texts of one prefix make a trie.
    """
    spark = rows.sparkSession
    texts = rows.filter(F.col("text").isNotNull()).select("doc_id", "tag", "text", "weight", "marks")
    total = texts.agg(F.sum("weight")).first()[0] or 0
    parts = _parts(spark, total)
    heavy = spark.sparkContext.broadcast(_heavy(texts, max(1, total // (2 * parts))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(heavy.value.tolist())
        for batch in batches:
            cuts = []
            for text, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                size = SHORTEST
                for mark in found:
                    if mark not in known:
                        break
                    size *= _STEP
                cuts.append(text[:size])
            columns = [*batch.columns[:3], pa.array(cuts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tag", "text", "cut"])

    schema = "doc_id long, tag long, text binary, cut binary"
    dealt = map_arrow(texts.select("doc_id", "tag", "text", "marks"), cut, schema)
    dealt = dealt.repartitionByRange(parts, "cut").sortWithinPartitions("cut")

    def flush(trie: Trie) -> pa.RecordBatch:
        entries = list(trie.entries())
        columns = [pa.array([entry[i] for entry in entries], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "tag"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trie = None, Trie()
        for rows in _values(batches):
            for doc_id, tag, text, prefix in rows:
                if prefix != now and trie.bytes > LOCAL_BYTES:
                    yield flush(trie)
                    trie = Trie()
                now = prefix
                trie.insert(text, (doc_id, tag))
        yield flush(trie)

    return map_arrow(dealt, meet, "doc_id long, tag long")


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask of A to E, good and toxic, and the number of documents ``n`` of each.

    A null id fails no E and has no label; of repeated rows with the smallest id none fails E.
    A document is good, or toxic, if any label of its id says so.
    """
    rows = stored(judged(docs), "judged")
    keepers = smallest(rows).withColumn("kept", F.lit(True))
    said = labels.groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    columns = ["doc_id", "source", "tag", "mask"]
    known = rows.filter(F.col("doc_id").isNotNull()).select(columns)
    known = known.join(keepers, ["doc_id", "tag"], "left").join(said, "doc_id", "left")
    known = known.select(
        "source",
        F.when(F.col("kept"), F.col("mask"))
        .otherwise(F.col("mask").bitwiseOR(_DUPLICATE))
        .alias("mask"),
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    unknown = rows.filter(F.col("doc_id").isNull()).select(
        "source", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic")
    )
    counted = known.union(unknown).groupBy(F.col("source").alias("part"), "mask", "good", "toxic")
    result = stored(counted.agg(F.count("*").alias("n")), "masks")
    forget(rows)
    return result


def _orders() -> Column:
    """Every order and step: the filter's bit and those of the filters before it."""
    found = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            found.append(("".join(order), step, bit, before))
            before |= bit
    names = ["filter_order", "step", "bit", "before"]
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in found])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, with counts of documents.

    kept: left after the step; removed: by it; redundant: failing its filter, but removed
    before; unique_fails: failing its filter only; good_lost, toxic_lost: removed by it,
    labelled good or toxic; shapley: removed by its filter, summed over all orders.

    A part is a source, the null source and the empty one being one part. Null texts are
    empty ones. E fails for a document whose whole text a smaller id has too; equal ids tie,
    and none of them fails for the other; null ids fail no E and have no labels. Texts
    of any length are compared whole. Other columns are not read. No documents give no rows.
    """
    every = range(1 << len(FILTERS))
    counts = masks(docs, labels)

    def by_mask(kind: Column, name: str) -> Column:
        one = [F.sum(F.when(kind & (F.col("mask") == m), F.col("n")).otherwise(0)) for m in every]
        return F.array(*one).alias(name)

    parts = counts.groupBy("part").agg(
        by_mask(F.lit(True), "all"),
        by_mask(F.col("good"), "good"),
        by_mask(F.col("toxic"), "toxic"),
    )
    # What a mask counts for, by mask, as constants: all of the sums are over 32 numbers.
    orders = math.factorial(len(FILTERS))
    first = F.array(*[F.lit(orders // max(1, mask.bit_count())) for mask in every])
    steps = parts.select("*", first.alias("first"), F.explode(_orders()).alias("o"))
    bit, before = F.col("o.bit"), F.col("o.before")

    def fails(mask: Column) -> Column:
        return mask.bitwiseAND(bit) != 0

    def earlier(mask: Column) -> Column:
        return mask.bitwiseAND(before) != 0

    def total(of: str, holds: Callable[[Column], Column], by_order: bool = False) -> Column:
        """The sum over the masks for which ``holds(mask)``."""

        def add(so_far: Column, mask: Column) -> Column:
            count = F.col(of)[mask] * F.col("first")[mask] if by_order else F.col(of)[mask]
            return so_far + F.when(holds(mask), count).otherwise(0)

        masks_of_all = F.sequence(F.lit(0), F.lit(len(every) - 1))
        return F.aggregate(masks_of_all, F.lit(0).cast("long"), add)

    def removed(mask: Column) -> Column:
        return fails(mask) & ~earlier(mask)

    return steps.select(
        "part",
        F.col("o.filter_order").alias("filter_order"),
        F.col("o.step").alias("step"),
        total("all", lambda m: ~fails(m) & ~earlier(m)).alias("kept"),
        total("all", removed).alias("removed"),
        total("all", lambda m: fails(m) & earlier(m)).alias("redundant"),
        total("all", lambda m: m == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total("all", fails, by_order=True).alias("shapley"),
    )
