"""The whole pipeline on odd and empty tables, and stage by stage against plain versions."""

import collections
import os
import random

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` long, spans int"
WORDS = {
    "en": "the and word time one house with over water street reading thing".split(),
    "de": "der und wort zeit ein haus nicht wasser über straße lesen ding".split(),
}


def texts():
    """Clean texts, a copy, a near copy, a benchmark text, a shared passage, mixed and odd ones."""
    rng = random.Random(6)

    def prose(lang, size):
        return " ".join(rng.choice(WORDS[lang]) + str(rng.randrange(50)) * (i % 3 == 0) for i in range(size))

    clean = [prose(lang, 150) for lang in ("en", "de") * 40]
    item, passage = prose("en", 30), prose("en", 60)
    odd = [None, "", "12 !!", "  ", clean[0], clean[1] + " more", clean[2][:300] + " " + item,
           prose("en", 90) + " " + passage, passage + " " + prose("en", 90), "x" * 5000]
    return clean, odd, item


@pytest.fixture
def tables(spark, tmp_path):
    def write(rows, items):
        folder = str(tmp_path / f"t{len(rows)}")
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        return folder

    return write


def test_whole_run_on_odd_tables(spark, tables):
    clean, odd, item = texts()
    rows = [(i, t, ("en", "de")[i % 2] if i < len(clean) else None, None, 1, 5, 6)
            for i, t in enumerate(clean + odd)]
    rows += [(None, odd[-2], None, "s", None, 5, 6), rows[3]]
    found = corpus_pipeline.run(spark, tables(rows, [(1, item), (2, None)])).collect()
    by_id = collections.Counter(r.doc_id for r in found)
    first = len(clean)
    # Without letters, copies and the contaminated one are gone; clean ones stay. The near
    # copy is further than two bits away and only loses what it shares.
    assert not {first + k for k in (0, 1, 2, 3, 4, 6)} & set(by_id)
    assert set(range(3, len(clean))) <= set(by_id) and {0, 1} <= set(by_id)
    assert all(r.round_trip for r in found) and set(by_id.values()) <= {1, 2, 4}


def test_whole_run_on_an_empty_table(spark, tables):
    assert corpus_pipeline.run(spark, tables([], [])).collect() == []


def test_stages_keep_the_columns(spark, tables):
    clean, odd, item = texts()
    folder = tables([(i, t, "en", "s", 1, 5, 6) for i, t in enumerate(clean[:6] + odd)], [(1, item)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    assert not [name for name in os.listdir(folder) if name.startswith("llm")]
