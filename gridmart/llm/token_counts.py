"""Tokens of every document, without moving a document or a pre-token."""

from __future__ import annotations

import heapq
import os
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import chunks, map_arrow, map_batches, whole

LIMIT = 512

# Entries of the broadcast table, and of what each map task offers for it.
TABLE_SIZE = 1 << 16
OFFERED = 1 << 12

# Worker memory: a count of candidates, and cached lengths, are pruned or emptied here.
COUNTED = 1 << 18
CACHED = 1 << 20
_CHUNK = 1 << 22

# Units of more characters (4 bytes each at most) are neither offered nor cached, which
# bounds the table and both of these in bytes: without blanks a unit is a whole text.
LONGEST = 64

# A run of white space that holds more than one blank before a word needs the whole
# pattern's view, so such a text is cut at other places.
_SPACES = re.compile(r"\s ")


def units(text: str) -> list[str]:
    """The text cut before each blank that follows another character than white space.

    The tokenizer's own pattern always ends a pre-token there and never looks back, so
    counts of the units add up to the count of the text. A unit is a word with its
    blank, or a few pre-tokens that stand together.
    """
    if not text:
        return []
    if text[0] == " " or _SPACES.search(text):
        return re.split(r"(?<=\S)(?= )", text)
    first, *rest = text.split(" ")
    return [first, *[" " + word for word in rest]]


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def special_strings(path: str) -> list[str]:
    added = load_tokenizer(path).get_added_tokens_decoder().values()
    return sorted({token.content for token in added})


def frequent_units(docs: DataFrame, size: int = TABLE_SIZE) -> list[str]:
    """The most frequent short units of all documents: at most ``size``, to be broadcast.

    Each task counts its own and offers its most frequent; only these are summed. The
    choice decides speed alone: a unit that is missed is encoded by the worker.
    """

    def count(batches):
        counts: Counter[str] = Counter()
        for rows in batches:
            for text in rows.column("text").to_pylist():
                counts.update([unit for unit in units(text) if len(unit) <= LONGEST])
                if len(counts) > COUNTED:
                    counts = Counter(dict(counts.most_common(COUNTED // 2)))
        best = heapq.nlargest(OFFERED, counts.items(), key=lambda pair: (pair[1], pair[0]))
        yield pa.RecordBatch.from_pydict(
            {
                "unit": pa.array([unit for unit, _ in best], pa.string()),
                "n": pa.array([n for _, n in best], pa.int64()),
            }
        )

    offered = map_arrow(
        docs.select(whole("text").alias("text")), count, "unit string, n long"
    )
    summed = offered.groupBy("unit").agg(F.sum("n").alias("n"))
    rows = summed.orderBy(F.desc("n"), "unit").limit(size).select("unit").collect()
    return [row["unit"] for row in rows]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of each document.

    ``tokenizer`` is the path of a byte-level BPE file of the ``tokenizers`` library, on
    every executor; counts are those of encoding the whole text without added tokens.
    A null text counts as empty. Null ids and repeated rows are counted like any other;
    an empty table gives an empty result.

    First tier: the lengths of the most frequent units, broadcast. Second tier: a cache
    of the task, filled by encoding what it has not seen, in batches. Long units are kept
    for their batch only. A text that holds one of the tokenizer's special strings is
    encoded whole.
    """
    special = special_strings(tokenizer)
    table = frequent_units(docs)
    lengths = _encode_lengths(load_tokenizer(tokenizer), table)
    frequent = docs.sparkSession.sparkContext.broadcast(dict(zip(table, lengths)))

    def prepare():
        return load_tokenizer(tokenizer), frequent.value, {}

    def batch(rows: pa.RecordBatch, state):
        encoder, first, second = state
        all_texts = rows.column("text").to_pylist()
        for start, end in chunks(all_texts, _CHUNK):
            texts = all_texts[start:end]
            odd = [any(mark in text for mark in special) for text in texts]
            parts = [[] if skip else units(text) for text, skip in zip(texts, odd)]
            missed = {unit for part in parts for unit in part if unit not in first}
            if len(second) > CACHED:
                second.clear()
            new = [unit for unit in missed if unit not in second]
            second.update(zip(new, _encode_lengths(encoder, new)))
            long = [unit for unit in new if len(unit) > LONGEST]
            counts = []
            for text, skip, part in zip(texts, odd, parts):
                if skip:
                    counts.append(len(encoder.encode(text, add_special_tokens=False).ids))
                else:
                    counts.append(
                        sum([first[u] if u in first else second[u] for u in part])
                    )
            for unit in long:
                del second[unit]
            yield {
                "doc_id": rows.column("doc_id")[start:end],
                "n_bytes": rows.column("n_bytes")[start:end],
                "n_tokens": counts,
                "over_limit": [count > limit for count in counts],
            }

    text = whole("text")
    kept = docs.select(
        "doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    return map_batches(
        kept, batch, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", prepare
    )


def _encode_lengths(encoder, parts: list[str]) -> list[int]:
    result = []
    for i in range(0, len(parts), 20_000):
        some = encoder.encode_batch_fast(parts[i : i + 20_000], add_special_tokens=False)
        result += [len(one.ids) for one in some]
    return result
