"""A training corpus from raw documents, stage by stage.

Every stage reads what the one before it stored and keeps the columns of ``documents``,
whatever their names; the last returns sampled segmentations of what is left. Null texts
count as empty, null ids are told apart by their texts, repeated rows are copies, texts of
any length are taken whole, and an empty table gives an empty result in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm import decontamination, language, repeats, segmentation, simhash
from gridmart.llm.common import benchmark, documents, forget, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# No stage but decontamination can be written in SQL; see tests/llm.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or almost as near to a second language, go. Short texts that
    tie in packed size stay if their letters tell."""
    return language.accepted(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; of several rows with
    that id the text with the smaller hash, of equal rows one. A null id comes last."""
    return simhash.deduplicate(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings are cut out of the texts, at every place they stand at; rows stay, also
    those of which nothing is left, a null text stays null, n_chars follows the text."""
    cut = repeats.without_repeats(docs)
    return cut.withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
    )


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a word in 20 lies in benchmark passages go; texts without words stay."""
    return decontamination.decontaminate(docs, benchmark(spark, sf_dir))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct segmentations of every remaining text, one if it has no more."""
    return segmentation.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; a stage's table goes once the next has read it."""
    docs, first = documents(spark, sf_dir), True
    for name, stage in STAGES[:-1]:
        kept = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        if not first:
            forget(docs)
        docs, first = kept, False
    return STAGES[-1][1](spark, docs, sf_dir)
