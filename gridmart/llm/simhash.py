"""SimHash fingerprints and groups of documents within a few bits of each other."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import chunks, map_batches, quoted, row_key, stored
from gridmart.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42

# Fingerprints are cut into this many blocks; close pairs share all but MAX_BITS of them.
BLOCKS = 4

# Up to this many fingerprints under one block key are compared in pairs; a larger
# bucket is linked through its one-bit neighbours instead, which is exact as well.
PAIRED = 64

# Lower case for A-Z; the white space of the word pattern becomes a blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b == 32 or 9 <= b <= 13 else b for b in range(256)
)
_CHUNK = 1 << 20


def text_tag() -> Column:
    return F.xxhash64(F.col("text"))


def _shingle_hashes(text: str, size: int) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split(b" ")
    words = [word for word in words if word]
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), SEED)]
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())]


def _bits(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The fingerprint of each document from the hashes of its shingles, end to end."""
    result = np.zeros(len(lengths), np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return result
    starts = (np.cumsum(lengths) - lengths)[full]
    for bit in range(64):
        ones = (hashes >> np.uint64(bit)).astype(np.uint8) & 1
        counts = np.add.reduceat(ones, starts, dtype=np.int64)
        result[full] |= (2 * counts > lengths[full]).astype(np.uint64) << np.uint64(bit)
    return result


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, a hash of the text and its 64-bit fingerprint ``fp``, one row per document.

    Words are runs of other characters than blank and the controls 9 to 13, A-Z folded.
    Fewer words than a shingle make one shingle; a null or blank text has fingerprint 0.
    """

    def batch(rows: pa.RecordBatch):
        texts = [text or "" for text in rows.column("text").to_pylist()]
        for first, last in chunks(texts, _CHUNK):
            hashes = [_shingle_hashes(text, size) for text in texts[first:last]]
            lengths = np.array([len(part) for part in hashes])
            flat = np.array([h for part in hashes for h in part], np.uint64)
            yield {
                "doc_id": rows.column("doc_id")[first:last],
                "tag": rows.column("tag")[first:last],
                "fp": _bits(flat, lengths).view(np.int64),
            }

    tagged = docs.select("doc_id", "text", text_tag().alias("tag"))
    return map_batches(tagged, batch, "doc_id long, tag long, fp long")


def _cuts(blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of each block of 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _masks(blocks: int, bits: int) -> list[int]:
    """The bits that each choice of kept blocks covers; ``bits`` blocks are left out."""
    cuts = _cuts(blocks)
    return [
        sum(((1 << width) - 1) << shift for shift, width in kept)
        for kept in combinations(cuts, blocks - bits)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def close_pairs(
    prints: DataFrame, bits: int = MAX_BITS, blocks: int = BLOCKS, paired: int = PAIRED
) -> DataFrame:
    """Links (a, b) between distinct fingerprints of at most ``bits`` differing bits.

    ``prints`` has one column ``fp`` of distinct longs. Two fingerprints that differ in
    at most ``bits`` bits agree on all but ``bits`` of the blocks (pigeonhole), so they
    meet under one of the block keys. Small buckets are joined in pairs and verified.
    In a larger bucket each fingerprint visits all values one bit from itself. For two
    bits those that meet there hang on the smallest; every close pair meets at a value
    between them. For fewer it is linked to the fingerprints it visits. So no bucket
    yields all its pairs, and the links connect exactly what the pairs would connect.
    Only ``bits`` of 0 to 2 are supported.
    """
    if not 0 <= bits <= 2 or blocks <= bits:
        raise ValueError("0 to 2 bits, and more blocks than bits")
    masks = _masks(blocks, bits)
    keyed = prints.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("part"),
                        F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"),
                    )
                    for i, mask in enumerate(masks)
                ]
            )
        ).alias("k"),
    ).select("fp", "k.part", "k.key")
    sizes = keyed.groupBy("part", "key").agg(F.count("*").alias("n")).filter("n > 1")
    keyed = stored(keyed.join(sizes, ["part", "key"]), "blocks")

    small = keyed.filter(F.col("n") <= paired)
    left = small.select("part", "key", F.col("fp").alias("a"))
    right = small.select("part", "key", F.col("fp").alias("b"))
    pairs = left.join(right, ["part", "key"]).filter("a < b").select("a", "b")

    # Within a bucket only the bits outside the mask differ.
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    large = keyed.filter(F.col("n") > paired).select(
        "fp", F.explode(F.transform(flips, lambda one: F.col("fp").bitwiseXOR(one))).alias("at")
    ).distinct()
    roots = large.groupBy("at").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
    stars = (
        large.join(roots.filter("n > 1"), "at")
        .filter("a <> fp")
        .select("a", F.col("fp").alias("b"))
    )
    if bits < 2:
        there = large.select(F.col("fp").alias("a")).distinct()
        stars = large.join(there, F.col("at") == F.col("a")).select("a", F.col("fp").alias("b"))
        stars = stars.filter("a < b")
    return pairs.union(stars).filter(_distance("a", "b") <= bits).distinct()


def _members(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """doc_id, tag (a hash of the text), fp, root and component_id of every document."""
    marked = stored(fingerprints(docs, size), "fingerprints")
    prints = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    linked = components(close_pairs(prints.select("fp"), bits))
    least = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = least.groupBy("root").agg(F.min("least").alias("component_id"))
    member = least.select("fp", "root").join(named, "root")
    return marked.join(member, "fp")


def groups(docs: DataFrame, size: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links between fingerprints of
    at most ``bits`` differing bits, its own included. Null and blank texts share
    fingerprint 0 and are linked like any other. A null doc_id is greater than any
    other; a component of null ids alone has a null id. Repeated rows are kept and
    share a component. An empty table gives an empty result.

    Documents meet only as distinct fingerprints, each with its smallest doc_id, so a
    group of many copies is one row in every join but the last, which is on the
    fingerprint and which the engine may split.
    """
    return _members(docs, size, bits).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def deduplicate(docs: DataFrame, size: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, null coming last.

    All columns of ``docs`` are kept, whatever their names. Of several texts under that
    doc_id the one with the smaller hash stays, of repeated rows one.
    """
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "tag"))
    kept = (
        _members(docs, size, bits)
        .groupBy("root")
        .agg(first.alias("kept"))
        .select("kept.doc_id", "kept.tag")
        .select(*row_key(F.col("tag")))
    )
    keyed = docs.select(F.struct(*quoted(docs.columns)).alias("_row"), *row_key(text_tag()))
    once = keyed.join(kept, ["_id", "_tag"], "left_semi").dropDuplicates(["_id", "_tag"])
    return once.select("_row.*")
