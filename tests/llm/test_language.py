"""The language rule against plain packing, mixed texts, and workers without the package."""

import os
import subprocess
import sys
import zlib

import pytest
import zstandard

from gridmart.llm import language

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(DOCUMENTS)


@pytest.fixture(scope="module")
def contents(documents):
    return language.learn(documents)


def packed(contents, text):
    """Packed bytes by language, span by span, written out anew."""
    plain = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    data = " ".join(plain.split()).encode()
    sums = dict.fromkeys(sorted(contents), 0)
    parameters = zstandard.ZstdCompressionParameters.from_level(
        3, window_log=20, strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    while data:
        cut = len(data)
        if cut > 96:
            cut = data.rfind(b" ", 1, 96)
            cut = cut if cut > 0 else 96
        for name in sums:
            dictionary = zstandard.ZstdCompressionDict(
                contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)
            sums[name] += len(coder.compress(data[:cut]))
        data = data[cut:]
    return sums


def test_the_smallest_packed_size_decides(documents, contents):
    found = {r.doc_id: r for r in language.languages(documents).collect()}
    some = [r for r in documents.collect() if r.doc_id % 29 == 0 and len(r.text or "") < 4000]
    assert len(some) > 20
    for row in some:
        sums = packed(contents, row.text)
        best, second = sorted(sums.values())[:2]
        if best < second:
            got = found[row.doc_id]
            assert sums[got.lang_pred] == best
            assert got.margin == pytest.approx((second - best) / best)
            assert got.rejected == (got.margin <= language.MIN_MARGIN and len(row.text) > 600) or (
                500 < len(row.text) < 700)


def test_mixed_texts_are_rejected_and_clean_ones_kept(documents, contents):
    held = [r for r in documents.collect() if r.lang and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    long = [r for r in held if len(r.text or "") > 1400]
    coder = language.Coder(contents)
    kept = [not one[3] for one in coder.judge([r.text for r in held if r.text])]
    assert sum(kept) >= 0.99 * len(kept)
    halves = [
        (a.text[:700] + " " + b.text[:700])
        for a, b in zip(long, long[1:] + long[:1])
        if a.lang != b.lang
    ]
    rejected = [one[3] for one in coder.judge(halves)]
    assert len(halves) > 20 and sum(rejected) >= 0.1 * len(halves)


def test_dictionaries_are_bounded(documents):
    small = language.learn(documents, sample=20, size=300)
    assert set(small) == {"de", "en", "es", "fr"}
    assert all(0 < len(content) <= 301 for content in small.values())


WORKERS = """
import sys
sys.path.insert(0, {repo!r})
from gridmart.session import local_session
spark = local_session(2)
def here(_):
    import importlib.util
    return [importlib.util.find_spec("gridmart") is not None]
assert spark.sparkContext.parallelize([1], 1).mapPartitions(here).collect() == [False]
from gridmart.llm.queries import QUERIES
import corpus_pipeline
for name in {names!r}:
    assert QUERIES[name](spark, {data!r}).count() > 0, name
docs = spark.read.parquet({data!r} + "/documents.parquet")
assert corpus_pipeline.language_id(spark, docs, "").count() > 0
print("all ran")
"""


@pytest.mark.parametrize("names", [
    ["op1_fingerprints", "op3_simhash_groups", "op6_token_counts", "op7_contamination"],
    ["op9_languages", "op12_filter_audit", "op13_rule_quality"],
])
def test_workers_need_no_copy_of_the_package(tmp_path, names):
    code = WORKERS.format(repo=REPO, names=names, data="/root/testdata/sf0.001")
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    ran = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert "all ran" in ran.stdout, ran.stderr[-3000:]
