"""Lattices kept across chunks, very long words, and inclusion chances against enumeration."""

import collections
import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest

from gridmart.llm import segmentation

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return segmentation.Vocabulary(MODEL)


def samples_of(vocabulary, texts, seeds, samples=2):
    return [
        (at, rank, round(log_p, 9), round(value, 9), tuple(ids.tolist()))
        for at, rank, log_p, value, _, ids in segmentation.sample_texts(
            vocabulary, texts, seeds, samples)
    ]


def test_step_table_is_a_map():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 40, 30_000))
    table = segmentation._Steps(keys, np.arange(len(keys)))
    asked = np.concatenate([keys[::3], rng.integers(0, 1 << 40, 5000)])
    known = {key: i for i, key in enumerate(keys.tolist())}
    match, values = table.find(asked)
    assert match.tolist() == [key in known for key in asked.tolist()]
    assert values.tolist() == [known[key] for key in asked.tolist() if key in known]


def test_kept_lattices_change_no_sample(vocabulary):
    rng = random.Random(8)
    words = ["the", "reading", "Straße", "an", "été", "unbelievable", "x1", "中文", "..", "ing"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    fresh = [samples_of(segmentation.Vocabulary(MODEL), [t], [i]) for i, t in enumerate(texts[:6])]
    warm = segmentation.Vocabulary(MODEL)
    for _ in range(13):
        samples_of(warm, texts, list(range(60)))
    assert warm.kept.numbers and warm.kept.lattices is not None and not warm.kept.seen
    assert [samples_of(warm, [t], [i]) for i, t in enumerate(texts[:6])] == fresh


def test_a_word_of_megabytes(vocabulary):
    word = ("unbelievably" * 200_000)[: 2_000_000] + "é中\U0001f600" * 1000
    start = time.time()
    for text in (word, "a " + word[:5000] + "  b", "x" * segmentation.LONGEST_UNIT):
        found = list(segmentation.sample_texts(vocabulary, [text], [3], 2))
        assert [segmentation.decoded(vocabulary, one[5]) for one in found] == [text] * len(found)
        assert len(found) == 2
    assert time.time() - start < 60
    assert max(map(len, segmentation.units(word))) == segmentation.LONGEST_UNIT
    assert "".join(segmentation.units(word)) == " " + word


def every_path(vocabulary, text):
    """The ids and probability of each segmentation of a short text of one word."""
    lattices = segmentation.Lattices(vocabulary, [" " + text])
    found, open_ = {}, [((), int(lattices.first[0]), 0.0)]
    while open_:
        edges, at, log_p = open_.pop()
        if at == lattices.last[0]:
            ids = segmentation._piece_ids(vocabulary, lattices, [np.array(edges)])
            found[tuple(ids.tolist())] = math.exp(log_p)
            continue
        for edge in range(int(lattices.begin[at]), int(lattices.begin[at + 1])):
            open_.append((
                (*edges, edge), int(lattices.target[edge]), log_p + float(lattices.log_p[edge])))
    return found


def test_inclusion_chances_weigh_samples_without_bias(vocabulary):
    """The sum of p / inclusion over a sample is 1 on average, as is each path's share; and
    the second sample follows the first as draws without replacement do."""
    text, rounds = "reading", 6000
    exact = every_path(vocabulary, text)
    assert abs(sum(exact.values()) - 1) < 1e-9 and len(exact) > 10
    weighed, pairs = collections.Counter(), collections.Counter()
    for seed in range(0, rounds, 500):
        texts = [text] * 500
        seeds = [(seed + i) * 0x9E3779B97F4A7C15 % (1 << 63) for i in range(500)]
        drawn = collections.defaultdict(list)
        for at, _, _, _, inclusion, ids in segmentation.sample_texts(vocabulary, texts, seeds, 2):
            ids = tuple(ids.tolist())
            weighed[ids] += exact[ids] / math.exp(inclusion)
            drawn[at].append(ids)
        pairs.update(tuple(one) for one in drawn.values())
    assert abs(sum(weighed.values()) / rounds - 1) < 0.05
    first, second = sorted(exact, key=exact.get)[-2:][::-1]
    for path in (first, second):
        assert abs(weighed[path] / rounds - exact[path]) < 0.05
    chance = exact[first] * exact[second] / (1 - exact[first])
    assert abs(pairs[first, second] / rounds - chance) < 0.03


def test_kept_lattices_are_copied_once(vocabulary):
    kept = segmentation.Lattices(vocabulary, [" the", " of"])
    seeds = np.arange(4, dtype=np.uint64)
    for words in ([" a", " word"], [" other", " é漢😀"], [" far more words"] * 40):
        after = kept.followed_by(segmentation.Lattices(vocabulary, words))
        every = segmentation.Lattices(vocabulary, [" the", " of", *words])
        which = np.array([0, 1, 2, len(words) + 1])
        one, two = after.walk(which, seeds), every.walk(which, seeds)
        assert after.piece[one.edges].tolist() == every.piece[two.edges].tolist()
        assert np.allclose(one.log_p, two.log_p) and after.last.tolist() == every.last.tolist()
    again = kept.followed_by(segmentation.Lattices(vocabulary, [" short"]))
    for name in ("first", "last", "begin", "target", "piece", "log_p", "until", "paths"):
        assert np.shares_memory(getattr(after, name), getattr(again, name))


def test_units_with_and_without_null_characters():
    for text in ("a bc d", "a\0b c", "ab", "a  b \0", "x" * 1023 + " y", "\ta b"):
        found = segmentation.units(text)
        assert "".join(found) == " " + text and all(found)
        assert found == re.split(r"(?<=\S)(?= )", " " + text)


def test_texts_of_a_chunk_are_sampled_together(vocabulary, monkeypatch):
    """Draws and bounds are made once a round for a chunk, not once a text, and depend on no other."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("the reading of été 中文 x1".split()) for _ in range(n)) for n in range(40)]
    calls, uniform = [], segmentation._uniform
    monkeypatch.setattr(segmentation, "_uniform", lambda x: calls.append(len(x)) or uniform(x))
    monkeypatch.setattr(segmentation._Search, "sidestep", None)
    found = samples_of(vocabulary, texts, list(range(40)), 1)
    assert len(found) == 40 and len(calls) < 3 + 60
    assert found == [
        (i, *one[1:]) for i, text in enumerate(texts) for one in samples_of(vocabulary, [text], [i], 1)
    ]
