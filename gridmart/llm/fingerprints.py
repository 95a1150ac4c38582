"""Fingerprints by consistent weighted sampling: they agree as often as texts are alike."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import chunks, map_arrow, map_batches, pa_schema, whole

# Samples of a fingerprint, each of 16 bits: the likeness of two has a standard error of
# at most 1 / (2 * sqrt(SAMPLES)).
SAMPLES = 64

# Characters whose terms share one table of draws.
_CHUNK = 4 << 20
_BLOCK = 4096

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer of 64 bits: near keys give unrelated values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _uniforms(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers in (0, 1) from the halves of each hash."""
    scale, half = np.float32(2.0**-32), np.float32(2.0**-33)
    low = (x & np.uint64(0xFFFFFFFF)).astype(np.float32) * scale + half
    high = (x >> np.uint64(32)).astype(np.float32) * scale + half
    limit = np.float32(1) - np.float32(2.0**-24)
    return np.minimum(low, limit), np.minimum(high, limit)


def _draws(terms: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r and log c, of gamma variables of shape 2, and a uniform b, per term and sample."""
    seeds = (np.arange(1, samples + 1, dtype=np.uint64)) * _GOLDEN
    x = _mix(terms[:, None] + seeds[None, :])
    one, two = _uniforms(x)
    r = -np.log(one * two)
    x = _mix(x + _GOLDEN)
    one, two = _uniforms(x)
    log_c = np.log(-np.log(one * two))
    b, _ = _uniforms(_mix(x + _GOLDEN))
    return r, log_c, b


def signatures(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """One row of 16-bit samples per text; terms are its words, weighted by their counts.

    For each sample, every term draws r, c and b from its hash alone; a weight w counts
    through t = floor(log w / r + b) only, and the term with the smallest
    log a = log c - r (t - b) - r is sampled, as the pair (term, t). Two texts draw the
    same pair with the probability sum of min weights / sum of max weights. The sample
    kept is a hash of log a, which the pair decides. No words: all zero.
    """
    numbers: dict[str, int] = {}
    rows, ids = [], []
    for row, text in enumerate(texts):
        words = text.split()
        ids += [numbers.setdefault(word, len(numbers)) for word in words]
        rows.append(np.full(len(words), row, np.int64))
    result = np.zeros((len(texts), samples), np.uint16)
    if not ids:
        return result
    keys = (np.concatenate(rows) << np.int64(32)) | np.array(ids, np.int64)
    keys, weights = np.unique(keys, return_counts=True)
    doc, term = keys >> np.int64(32), (keys & np.int64(0xFFFFFFFF)).astype(np.int64)
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) for word in numbers),
        np.uint64,
        len(numbers),
    )

    # The smallest log a of each text, over blocks of terms of like weight.
    least = np.full((len(texts), samples), np.inf, np.float32)
    order = np.argsort(term, kind="stable")
    doc, term, weights = doc[order], term[order], weights[order]
    logs = np.log(weights).astype(np.float32)
    begin = 0
    for low in range(0, len(hashes), _BLOCK):
        end = int(np.searchsorted(term, low + _BLOCK, "left"))
        r, log_c, b = _draws(hashes[low : low + _BLOCK], samples)
        once = log_c + r * b - r
        part = slice(begin, end)
        local, single = term[part] - low, weights[part] == 1
        a = once[local]
        many = np.flatnonzero(~single)
        if len(many):
            k = local[many]
            rk = r[k]
            t = np.floor(logs[part][many][:, None] / rk + b[k])
            a[many] = log_c[k] - rk * (t - b[k]) - rk
        by_doc = np.argsort(doc[part], kind="stable")
        docs = doc[part][by_doc]
        starts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
        small = np.minimum.reduceat(a[by_doc], starts, axis=0)
        some = docs[starts]
        least[some] = np.minimum(least[some], small)
        begin = end
    bits = _mix(least.view(np.uint32).astype(np.uint64) + _GOLDEN)
    found = np.maximum((bits >> np.uint64(48)).astype(np.uint16), 1)
    full = np.unique(doc)
    result[full] = found[full]
    return result


def _hex(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and fingerprint (4 hex digits a sample) of every whole text.

    Null counts as empty; a text without words has a fingerprint of zeros, like no other.
    Rows stay where they are; repeated rows, null ids and an empty table need no care.
    """

    def batch(rows: pa.RecordBatch):
        texts = rows.column("text").to_pylist()
        for first, last in chunks(texts, _CHUNK):
            found = signatures(texts[first:last], samples)
            yield {
                "doc_id": rows.column("doc_id")[first:last],
                "fingerprint": [_hex(one) for one in found],
            }

    kept = docs.select("doc_id", whole("text").alias("text"))
    return map_batches(kept, batch, "doc_id long, fingerprint string")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal samples, row by row: an estimate of generalised Jaccard."""
    return (a == b).mean(axis=1)


def with_next(docs: DataFrame) -> DataFrame:
    """Documents in buckets of consecutive ids, in which each finds its successor.

    Returns bucket, doc_id, text, extra; sorted within a partition by bucket, with the
    extra rows (copies of the first document of the bucket after it) last. The document
    after the last is the first. Null ids come first; equal ids are ordered by text.

    The driver sees the quantiles of doc_id that bound the buckets, and the first id of
    each, as many as there are shuffle partitions. Texts are shuffled once.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("place"),
        whole("text").alias("text"),
    )
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(F.col("doc_id").cast("double").alias("id")).approxQuantile(
        "id", [i / count for i in range(1, count)], 0.1 / count
    )
    bounds = F.array(*[F.lit(int(cut)) for cut in sorted(set(cuts))]).cast("array<long>")
    bucket = F.size(F.filter(bounds, lambda cut: cut <= F.col("place")))
    rows = rows.withColumn("bucket", bucket)
    firsts = sorted(
        (row["place"], row["bucket"])
        for row in rows.groupBy("bucket").agg(F.min("place").alias("place")).collect()
    )
    extra = rows.limit(0)
    if firsts:
        before = dict(zip([p for p, _ in firsts], [b for _, b in firsts[-1:] + firsts[:-1]]))
        moved = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
        extra = rows.filter(F.col("place").isin(list(before))).withColumn(
            "bucket", moved[F.col("place")]
        )
    both = rows.withColumn("extra", F.lit(False)).unionByName(
        extra.withColumn("extra", F.lit(True))
    )
    return (
        both.repartition(count, "bucket")
        .sortWithinPartitions("bucket", "extra", "place", "text")
        .drop("place")
    )


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Each document's fingerprint beside that of an edited text and of its successor.

    The edited text has the last quarter of the code points (rounded down) replaced by as
    many first ones of the successor by doc_id (all, if it has fewer). Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one
    row for every row of ``docs``. Null counts as empty; a lone document succeeds itself;
    an empty table gives an empty result.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    types = pa_schema(docs.sparkSession, schema)

    def judged(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, whose successors are the rows after them."""
        texts = [row[1] for row in rows]
        edited, real = [], []
        for i, (text, after) in enumerate(zip(texts, texts[1:])):
            if rows[i][2]:
                quarter = len(text) // 4
                edited.append(text[: len(text) - quarter] + after[:quarter])
                real.append(i)
        found = signatures(texts + edited, samples)
        own, others = found[: len(texts)], found[len(texts) :]
        at = np.array(real, np.int64)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": [rows[i][0] for i in real],
                "n_chars": [len(texts[i]) for i in real],
                "edited_sha256": [
                    hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
                    for text in edited
                ],
                "fingerprint": [_hex(own[i]) for i in real],
                "edited_fingerprint": [_hex(one) for one in others],
                "near_edited": likeness(own[at], others),
                "near_next": likeness(own[at], own[at + 1]),
            },
            schema=types,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, bucket, closed = 0, None, False
        for batch in batches:
            for number, doc_id, text, extra in zip(
                *(batch.column(name).to_pylist() for name in ("bucket", "doc_id", "text", "extra"))
            ):
                if number != bucket:
                    bucket, closed = number, False
                elif closed:
                    continue  # a second extra row: its id repeats
                # An extra row is a successor only, and has none of its own.
                closed = extra
                held.append((doc_id, text, not extra))
                size += len(text)
                if size > _CHUNK // 2 and len(held) > 1:
                    yield judged(held)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield judged(held)

    return map_arrow(with_next(docs), run, schema)
