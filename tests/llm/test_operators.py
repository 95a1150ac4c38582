"""The training-data operators against brute force, on small tables with odd rows."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from gridmart.llm import (
    decontamination,
    fingerprints,
    language,
    packing,
    passages,
    repeats,
    segmentation,
    sharding,
    simhash,
    token_counts,
)
from gridmart.llm.common import NO_ID

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag long, _id long"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def odd_rows():
    """Nulls, empty and long texts, repeated rows and ids, and columns with names used inside."""
    rng = random.Random(7)
    words = [f"{a}{b}" for a in ("the", "un", "ser", "éta", "wort") for b in ("ly", "ing", "é", "")]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 30, 120]))) for _ in range(30)]
    texts += [texts[3], texts[3] + " end", "", None, "x" * 3000, "  a  b\n\tc ", "<|endoftext|> ok!!"]
    texts += ["1234 !!", "ab " * 700]
    rows = [(i, text) for i, text in enumerate(texts)]
    rows += [(None, "null id"), (None, "null id"), (None, None), (5, "other text"), rows[5]]
    return rows


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, "en" if i and i % 2 else None, "s", len(t or ""), 1, 2) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(frame):
    return [tuple(row) for row in frame.collect()]


def ordered(found):
    return sorted(found, key=repr)


def test_fingerprints_of_documents_and_their_edits(docs, rows, empty):
    found = fingerprints.edited_fingerprints(docs).collect()
    line = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for (doc_id, text), (_, after) in zip(line, line[1:] + line[:1]):
        text, after = text or "", after or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert ordered((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == ordered(expected)
    by_text = dict(zip([i for i, _ in rows], [t for _, t in rows]))
    prints = {r.doc_id: r.fingerprint for r in found}
    assert prints[3] == prints[30] and by_text[3] == by_text[30]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert collected(fingerprints.edited_fingerprints(empty)) == []


def test_likeness_estimates_generalised_jaccard():
    one, two = "a a a b b c d e f g", "a b b b c d x y z a"
    left, right = (collections.Counter(t.split()) for t in (one, two))
    exact = sum((left & right).values()) / sum((left | right).values())
    found = fingerprints.signatures([one, two], 4096)
    assert abs(fingerprints.likeness(found[:1], found[1:])[0] - exact) < 0.03


def test_packing_keeps_every_token(docs, rows, empty):
    import numpy as np

    packed = packing.pack(docs, RANKS, public_tokenizers.PATTERN, capacity=64, pad=9)
    encoding = packing.Encoder(RANKS, public_tokenizers.PATTERN).encoding
    parts = collections.defaultdict(list)
    for row in packed.collect():
        ids = np.frombuffer(row.ids, "<u2").tolist()
        assert len(ids) == 64 and row.resets == row.cu_seqlens[:-1]
        assert set(ids[row.n_tokens :]) <= {9}
        for i, (doc_id, start) in enumerate(zip(row.doc_ids, row.starts)):
            part = ids[row.cu_seqlens[i] : row.cu_seqlens[i + 1]]
            parts[doc_id, row.tags[i]].append((start, part))
    expected = collections.Counter(tuple(encoding.encode_ordinary(t or "")) for _, t in rows)
    found = collections.Counter()
    for pieces in parts.values():
        copies = sum(start == 0 for start, _ in pieces)
        each = [part for _, part in sorted(pieces, key=lambda p: p[0])][::copies]
        found[tuple(itertools.chain(*each))] += copies
    assert found == expected
    assert collected(packing.pack(empty, RANKS, public_tokenizers.PATTERN)) == []


def test_units_are_numbered_until_the_table_is_full(monkeypatch):
    import numpy as np

    monkeypatch.setattr(packing, "CACHED", 100)
    encoder = packing.Encoder(RANKS, public_tokenizers.PATTERN)
    rng, most = random.Random(4), 0
    for _ in range(100):
        size = rng.randrange(6)
        texts = ["".join(rng.choices("ab é漢😀  \n\t.,'s1", k=rng.randrange(40))) for _ in range(size)]
        found = [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode(texts)]
        assert found == [encoder.encoding.encode_ordinary(text) for text in texts]
        assert len(encoder.size) == len(encoder.numbers) and encoder.size.sum() == len(encoder.ids)
        most = max(most, len(encoder.numbers))
    assert 100 < most < 300


def test_best_fit_takes_the_tightest_bin():
    assert packing.best_fit_decreasing([5, 7, 3, 2, 0], 10) == [[1, 2, 4], [0, 3]]


def simple_simhash(text):
    words = [w for w in "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in "\t\n\v\f\r" else c
        for c in text or ""
    ).split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(nodes, close):
    root = {n: n for n in nodes}
    for a, b in itertools.combinations(nodes, 2):
        if close(a, b):
            old, new = root[a], root[b]
            root = {n: new if r == old else r for n, r in root.items()}
    return root


def test_simhash_groups(docs, rows, empty):
    prints = [simple_simhash(text) for _, text in rows]
    root = components_of(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (doc_id, _), fp in zip(rows, prints):
        if doc_id is not None:
            least[root[fp]] = min(least.get(root[fp], doc_id), doc_id)
    expected = [(i, f"{fp:016x}", least.get(root[fp])) for (i, _), fp in zip(rows, prints)]
    assert ordered(collected(simhash.groups(docs))) == ordered(expected)
    assert simhash.deduplicate(docs).count() == len(set(root.values()))
    assert simhash.deduplicate(docs).columns == docs.columns
    assert collected(simhash.groups(empty)) == []


def test_large_buckets_link_like_pairs(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = {base ^ (1 << a) ^ (1 << b) for a in range(0, 40, 3) for b in range(0, 30, 4)}
    prints |= {rng.getrandbits(64) for _ in range(50)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = []
    for paired in (0, 1000):
        links = simhash.close_pairs(frame, paired=paired).collect()
        close = {(r.a, r.b) for r in links} | {(r.b, r.a) for r in links}
        found = components_of(signed, lambda a, b: (a, b) in close)
        roots.append({frozenset(n for n in signed if found[n] == r) for r in found.values()})
    exact = components_of(signed, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2)
    assert roots[0] == roots[1]
    assert roots[0] == {frozenset(n for n in signed if exact[n] == r) for r in exact.values()}


def test_large_buckets_link_one_bit(spark):
    prints = spark.createDataFrame([(13,), (12,), (5,), (8,)], "fp long")
    links = lambda bits: sorted(collected(simhash.close_pairs(prints, bits, paired=1)))
    assert links(1) == [(5, 13), (8, 12), (12, 13)]
    assert links(0) == []


def simple_repeats(rows, window):
    seen = collections.Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i : i + window] for i in range(len(data) - window + 1))
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            if seen[data[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        yield doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("window", [200, 16])
def test_repeated_bytes(docs, rows, empty, window):
    found = collected(repeats.repeats(docs, window))
    assert ordered(found) == ordered(simple_repeats(rows, window))
    if window == 200:
        assert collected(repeats.repeats(empty, window)) == []
        assert repeats.without_repeats(docs, window).columns == docs.columns


def test_null_ids_link_nothing_by_themselves(spark):
    """Two texts that each share a passage with another text of a null id have two classes."""
    rng = random.Random(12)
    one, two, three = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(3))
    rows = [(3, one), (None, one + " a"), (4, two), (None, two + " b"), (None, three), (None, three + " c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = ordered((r.doc_id, r.n_shared, r.class_id) for r in passages.near_passages(frame).collect())
    assert found == ordered([(3, 80, 3), (None, 80, 3), (4, 80, 4), (None, 80, 4), (None, 80, None), (None, 80, None)])


def test_near_passages(spark, empty):
    rng = random.Random(3)
    draw = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    base, rows = draw(70), []
    for i in range(12):
        text = draw(100)
        if i % 3 == 0:
            copy = list(base)
            copy[35] = f"edit{i}"
            text[40:40] = copy
        rows.append((i, " ".join(text)))
    rows += [(20, None), (21, ""), (None, "a b")]
    found = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    shared = {r.doc_id: (r.n_shared >= 50, r.class_id) for r in found.collect()}
    expected = {i: (True, 0) if i in (0, 3, 6, 9) else (False, i) for i, _ in rows}
    assert shared == expected
    assert collected(passages.near_passages(empty)) == []


@pytest.fixture(scope="module")
def short_passages(spark):
    """Pairs of texts that share 51 words but for one in their middle, and nothing else."""
    rng, texts = random.Random(5), {}
    draw = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    for i in range(0, 120, 2):
        base = draw(51)
        for doc_id, middle in ((i, base[25]), (i + 1, "edited")):
            shared = [*base[:25], middle, *base[26:]]
            texts[doc_id] = draw(rng.randrange(80)) + shared + draw(rng.randrange(80))
    rows = [(i, " ".join(text)) for i, text in texts.items()]
    return texts, spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()


def test_passages_are_compared_where_they_align(short_passages):
    texts, frame = short_passages

    def shingles_of(doc_id, start):
        words = texts[doc_id][start : start + 50]
        assert len(words) == 50
        return {tuple(words[i : i + 5]) for i in range(46)}

    found = passages.links(frame).collect()
    for r in found:
        assert r.last - r.start == r.to_last - r.to_start >= 0 and r._id // 2 == r.to_id // 2
        for more in range(r.last - r.start + 1):
            one, to = shingles_of(r._id, r.start + more), shingles_of(r.to_id, r.to_start + more)
            assert len(one & to) / len(one | to) >= 0.8
    assert len({r._id // 2 for r in found}) >= 0.9 * len(texts) / 2


def test_like_passages_at_unlike_distances_from_their_minimum_are_found(spark):
    """Texts of 50 words, the second with a word more at its beginning and one less at its end:
    both have one passage, and these lie on each other under no minimum."""
    rng, texts = random.Random(8), []
    for i in range(40):
        words = [f"w{rng.randrange(10**9)}" for _ in range(50)]
        texts += [words, [f"x{i}", *words[:-1]]]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.n_shared, r.class_id) for r in passages.near_passages(frame).collect()}
    assert found == {(i, 50, i - i % 2) for i in range(80)}


def test_overlapping_passages_of_a_text_are_not_like_each_other(spark):
    """A shingle that stands twice in a text: passages before and after it overlap."""
    rng = random.Random(13)
    draw = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for i in range(30):
        twice = draw(5)
        rows.append((i, " ".join([*draw(20), *twice, *draw(15), *twice, *draw(45)])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.near_passages(frame, hashes=16).collect()
    assert {(r.n_shared, r.n_links) for r in found} == {(0, 0)}


def test_passages_are_found_wherever_they_stand(spark, monkeypatch):
    """Parts of one text that begin at eight places of it, with one of their first 20 words edited:
    every two that have alike passages are linked, in whatever blocks their key is dealt."""
    rng = random.Random(11)
    base, texts = [f"w{rng.randrange(10**9)}" for _ in range(60)], []
    for i in range(24):
        words = base[i % 8 : i % 8 + 50 + i % 3]
        words[rng.randrange(20)] = f"e{i}"
        texts.append(words)
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    sets = [
        [{tuple(words[s : s + 5]) for s in range(i, i + 46)} for i in range(len(words) - 49)]
        for words in texts
    ]
    alike = {
        (a, b) for a, b in itertools.combinations(range(24), 2)
        if any(len(x & y) >= 0.8 * len(x | y) for x in sets[a] for y in sets[b])
    }
    linked = []
    for block in (passages._BLOCK, 4):
        monkeypatch.setattr(passages, "_BLOCK", block)
        found = passages.links(frame, hashes=16).collect()
        linked.append({tuple(sorted((r._id, r.to_id))) for r in found if r._id != r.to_id})
    assert linked[0] == linked[1] and len(alike) > 10
    assert linked[0] <= alike and len(linked[0]) >= 0.95 * len(alike)


def test_like_passages_of_one_key_are_all_compared(spark):
    """Chains of texts, each a word from the next: no text is like all others of its chain."""
    rng, texts = random.Random(1), []
    for chain in range(20):
        words = [f"w{rng.randrange(10**9)}" for _ in range(50)]
        places = [25, *rng.sample([i for i in range(5, 45) if i != 25], 19)]
        for step, place in enumerate(places):
            texts.append(" ".join(words))
            words[place] = f"e{chain}_{step}"
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(46)})
    pairs = [(a, b) for a in range(400) for b in range(a + 1, min(400, a + 20))]
    alike = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    found = {(min(r._id, r.to_id), max(r._id, r.to_id)) for r in passages.links(frame).collect()}
    assert len(alike) >= 380 and found <= alike and len(found) >= 0.99 * len(alike)


def test_blocks_of_a_key_meet_each_other(spark, monkeypatch):
    """A passage in 40 versions of 40 texts: links do not depend on the blocks of a key."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**9)}" for _ in range(49)]
    rows = []
    for i in range(40):
        before = [f"x{rng.randrange(10**9)}" for _ in range(i)]
        rows.append((i, " ".join([*before, f"e{i}", *base])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = ordered(collected(passages.links(frame)))
    assert len({(min(r[0], r[4]), max(r[0], r[4])) for r in expected}) == 40 * 39 // 2
    monkeypatch.setattr(passages, "_BLOCK", 4)
    assert ordered(collected(passages.links(frame))) == expected


def test_alike_passages_share_a_token():
    """Versions of a passage around one minimum, of few or many different shingles."""
    rng, passage = np.random.default_rng(6), 46
    flat = []
    for base in (rng.integers(0, 1 << 32, passage), rng.integers(0, 4, passage) + 7):
        for edits in [0, 1, 3, 5, 6, 9] * 5:
            one = base.copy()
            one[1 + rng.permutation(passage - 1)[:edits]] = rng.integers(0, 1 << 32, edits)
            one[0] = base[0]
            flat.append(one)
    rows = len(flat)
    flat = np.concatenate(flat).astype(np.uint32)
    offsets, lead = np.arange(rows + 1) * passage, np.zeros(rows, np.int64)
    tokens = passages._tokens(flat, offsets, lead, np.ones(rows, bool), passage, 0.8).to_pylist()
    sets = [set(flat[i : i + passage].tolist()) for i in offsets[:-1].tolist()]
    pairs = list(itertools.combinations(range(rows), 2))
    alike = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(alike) > 100 and all(set(tokens[a]) & set(tokens[b]) for a, b in alike)
    alone = passages._tokens(flat, offsets, lead, np.zeros(rows, bool), passage, 0.8)
    assert alone.to_pylist() == [[0]] * rows


def test_unlike_passages_of_a_key_do_not_meet_block_by_block(spark, monkeypatch):
    """A phrase in 200 unlike texts: a digest meets others by its tokens, not in all 50 blocks."""
    rng = random.Random(4)
    draw = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows = [(i, " ".join(["so it is said that", *draw(46)])) for i in range(200)]
    counts, run = [], passages.map_arrow

    def counted(frame, function, schema):
        if "high" in frame.columns:
            counts.append((frame.count(), frame.select("key", "digest").distinct().count()))
        return run(frame, function, schema)

    monkeypatch.setattr(passages, "map_arrow", counted)
    monkeypatch.setattr(passages, "_BLOCK", 4)
    found = passages.links(spark.createDataFrame(rows, "doc_id long, text string"), hashes=16)
    assert found.count() == 0
    dealt, digests = map(sum, zip(*counts))
    assert digests > 100 and dealt < 15 * digests


def test_unlike_passages_with_a_line_in_common_do_not_meet(spark, monkeypatch):
    """A line of 14 words in 100 unlike texts: its shingles bring no two of them together."""
    rng = random.Random(7)
    draw = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    line = draw(14)
    rows = [(i, " ".join([*draw(45), *line, *draw(45)])) for i in range(100)]
    counts, run = [], passages.map_arrow

    def counted(frame, function, schema):
        if "high" in frame.columns:
            groups = frame.groupBy("key", "token", "low", "high").count()
            pairs = groups.selectExpr("coalesce(sum(count * (count - 1) / 2), 0)").first()[0]
            counts.append((pairs, frame.select("key", "digest").distinct().count()))
        return run(frame, function, schema)

    monkeypatch.setattr(passages, "map_arrow", counted)
    monkeypatch.setattr(passages, "_BLOCK", 16)
    monkeypatch.setattr(passages, "_FEW", 4, raising=False)
    found = passages.links(spark.createDataFrame(rows, "doc_id long, text string"), hashes=16)
    assert found.count() == 0
    pairs, digests = map(sum, zip(*counts))
    assert digests > 300 and pairs < 2 * digests


def test_copies_of_a_row_are_one_document(spark, monkeypatch):
    rng = random.Random(9)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))
    rows = [(None, text)] * 200 + [(7, "short")] * 3 + [(8, text[:900]), (9, "other " * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = {r._id: len(r.spans) for r in repeats.repeated_windows(frame).collect()}
    assert spans.keys() == {NO_ID, 8} and max(spans.values()) < 200
    assert ordered(collected(repeats.repeats(frame))) == ordered(simple_repeats(rows, 200))

    most, places = [], passages._places

    def counted(near, passage):
        copies = near.groupBy("_id", "_tag", "hash", "l", "c", "r").count()
        most.append(copies.agg({"count": "max"}).first()[0])
        return places(near, passage)

    monkeypatch.setattr(passages, "_places", counted)
    found = passages.near_passages(frame).collect()
    assert most == [1]
    shared = collections.Counter((r.doc_id, r.n_shared) for r in found)
    (cut,) = [r.n_shared for r in found if r.doc_id == 8]
    assert shared == {(None, 300): 200, (7, 0): 3, (8, cut): 1, (9, 0): 1} and cut > 100
    rows = spark.createDataFrame([(None, text)] * 2, "doc_id long, text string")
    assert [r.n_shared for r in passages.near_passages(rows).collect()] == [300, 300]


def test_texts_without_id_are_told_apart(spark):
    """A long and a short text of one 32-bit hash."""
    words = " ".join(f"v{i}" for i in range(100))
    made = spark.range(800000).selectExpr(
        "id", f"IF(id % 2 = 0, concat('{words} ', id), concat('short ', id)) AS text", "hash(text) AS h"
    )
    both = made.groupBy("h").agg(
        {"text": "max", "id": "count"}
    ).filter("`count(id)` > 1 AND `max(text)` LIKE 'v0 %'")
    pairs = made.join(both, "h").orderBy("h", "text").select("h", "text").collect()
    texts = collections.defaultdict(list)
    for r in pairs:
        texts[r.h].append(r.text)
    short, long = next(t for t in texts.values() if t[0][0] == "s" and t[-1][0] == "v")
    rows = [(None, long), (None, short), (1, words + " end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(collected(repeats.repeats(frame))) == ordered(simple_repeats(rows, 200))
    found = {(r.doc_id, r.n_words): r.n_shared for r in passages.near_passages(frame).collect()}
    assert found == {(None, 101): 101, (None, 2): 0, (1, 101): 101}


def test_token_counts(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    expected = []
    for doc_id, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 512))
    assert ordered(collected(token_counts.token_counts(docs, path))) == ordered(expected)
    assert collected(token_counts.token_counts(empty, path)) == []


def test_long_units_are_not_kept(spark, monkeypatch):
    texts = ["中" * 5000, "a" * 64 + " b", "x" * 65 + " b", "b " * 9 + "中" * 5000]
    rows = [(i, text) for i, text in enumerate(texts * 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    table = token_counts.frequent_units(frame)
    assert {" b", "a" * 64} <= set(table) and max(map(len, table)) <= token_counts.LONGEST
    monkeypatch.setattr(token_counts, "_CHUNK", 6000)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    encoder = Tokenizer.from_file(tokenizer)
    found = token_counts.token_counts(frame, tokenizer).collect()
    assert ordered((r.doc_id, r.n_tokens) for r in found) == ordered(
        (i, len(encoder.encode(t, add_special_tokens=False).ids)) for i, t in rows
    )


def test_repeated_short_items_cost_a_row_a_place():
    """Many equal items of one word in a text that is full of the word."""
    block = decontamination.Block(13)
    for item in range(800):
        block.add(item, [b"hot"])
    block.add(800, [b"hot", b"cold"])
    packed = block.packed()
    text = [b"hot"] * 4000 + [b"cold"]
    found = decontamination.search([text, [b"cold"], text], packed, every=False)
    assert len(found["doc"]) == 2 * 4001
    assert len(decontamination.search([text[:5]], packed)["doc"]) == 5 * 800


def test_contamination_by_repeated_items(spark):
    items = spark.createDataFrame(
        [(i, "Hot") for i in range(300)] + [(300, "hot cold"), (301, "cold hot")],
        "item_id long, text string",
    )
    rows = [(1, "hot " * 3000), (2, "x hot cold y"), (3, "cold"), (4, "hot")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in decontamination.contamination(frame, items).collect()}
    every = ",".join(sorted(str(i) for i in range(300)))
    assert [(found[i].n_hit, found[i].n_items) for i in (1, 2, 3, 4)] == [
        (3000, 300), (2, 301), (0, 0), (1, 300)]
    assert found[1].items_sha256 == hashlib.sha256(every.encode()).hexdigest()


def test_matches_are_the_longest_verbatim_ones(spark):
    item = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    text = "a b " + " ".join(f"w{i}" for i in range(5, 22)) + " c " + " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, text), (2, item), (3, None)], "doc_id long, text string")
    assert ordered(collected(decontamination.matches(docs, items))) == ordered(
        [(1, 2, "7", 5, 17), (2, 0, "7", 0, 30)]
    )


def test_columns_of_any_name_are_kept(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, `a.b` long, `x y` long, _tag int"
    frame = spark.createDataFrame([(i, t, "en", "s", 1, 5, 6, 7) for i, t in rows], schema)
    for kept in (
        simhash.deduplicate(frame),
        repeats.without_repeats(frame),
        language.accepted(frame),
        decontamination.decontaminate(frame, spark.createDataFrame([], "item_id long, text string")),
    ):
        assert kept.columns == frame.columns
        assert {(r["a.b"], r["x y"], r["_tag"]) for r in kept.collect()} <= {(5, 6, 7)}


def test_contamination(spark, docs, empty):
    long_item = " ".join(f"q{i}" for i in range(20))
    items = spark.createDataFrame(
        [(1, long_item), (2, "Short item"), (3, None), (None, "--"), (4, long_item)],
        "item_id long, text string",
    )
    rows = [
        (1, "pad " * 5 + long_item.upper()[6:] + " tail"),
        (2, "a short, ITEM here " + "x " * 90),
        (3, " ".join(long_item.split()[:12])),
        (4, None),
    ]
    found = decontamination.contamination(spark.createDataFrame(rows, "doc_id long, text string"), items)
    by_id = {r.doc_id: r for r in found.collect()}
    assert (by_id[1].n_hit, by_id[1].n_items, by_id[1].contaminated) == (18, 2, True)
    assert by_id[1].items_sha256 == hashlib.sha256(b"1,4").hexdigest()
    assert (by_id[2].n_words, by_id[2].n_hit, by_id[2].contaminated) == (94, 2, False)
    assert (by_id[3].n_hit, by_id[4].n_words, by_id[4].contaminated) == (0, 0, False)
    assert collected(decontamination.contamination(empty, items)) == []
    kept = decontamination.decontaminate(docs, items)
    assert kept.count() == docs.count() and kept.columns == docs.columns


def test_segmentations_are_exact_samples():
    vocabulary = segmentation.Vocabulary(MODEL)
    text, chance = "ab the", collections.Counter()
    lattices = segmentation.Lattices(vocabulary, segmentation.units(text))
    every = []
    for unit in range(2):
        paths = []

        def go(at, log_p, path):
            if at == lattices.last[unit]:
                paths.append((path, log_p))
                return
            for e in range(lattices.begin[at], lattices.begin[at + 1]):
                go(lattices.target[e], log_p + lattices.log_p[e], (*path, int(lattices.piece[e])))

        go(lattices.first[unit], 0.0, ())
        assert math.isclose(sum(math.exp(p) for _, p in paths), 1.0)
        every.append(paths)
    exact = {a + b: x + y for (a, x), (b, y) in itertools.product(*every)}
    rounds = 3000
    samples = segmentation.sample_texts(vocabulary, [text] * rounds, list(range(rounds)), 3)
    drawn = collections.defaultdict(list)
    for row, rank, log_p, _, _, ids in samples:
        assert math.isclose(exact[tuple(ids.tolist())], log_p)
        drawn[row].append(tuple(ids.tolist()))
        chance[rank, tuple(ids.tolist())] += 1
    assert all(len(set(found)) == 3 for found in drawn.values())
    best = max(exact, key=exact.get)
    assert abs(chance[0, best] / rounds - math.exp(exact[best])) < 0.03


def test_segmentations_of_odd_rows(docs, rows, empty):
    found = segmentation.digests(docs, MODEL).collect()
    assert all(row.round_trip for row in found)
    assert collections.Counter(r.doc_id for r in found)[0] in (1, 2)
    assert {r.doc_id for r in found} == {i for i, _ in rows}
    decoded = segmentation.decode(segmentation.encode(docs, MODEL, 1), MODEL)
    assert ordered(r.text for r in decoded.collect()) == ordered(t or "" for _, t in rows)
    assert collected(segmentation.digests(empty, MODEL)) == []


def test_languages(spark, docs, empty):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.lang for r in frame.collect()}
    found = language.languages(frame).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == labels[r.doc_id] for r in held) >= 0.95 * len(held)
    odd = language.languages(docs).collect()
    assert all(r.lang_pred == "und" and r.rejected for r in odd if r.doc_id in (32, 33, 37))
    assert collected(language.languages(empty)) == []
    assert language.accepted(docs).columns == docs.columns


def test_short_texts_get_their_language():
    words = {
        "de": "der und wort zeit ein haus nicht über wasser straße",
        "en": "the and word time one house with over water street",
        "fr": "le et mot temps une maison avec été eau où",
    }
    rng = random.Random(3)
    contents = {
        name: " ".join(rng.choice(text.split()) for _ in range(5000)).encode()
        for name, text in words.items()
    }
    coder = language.Coder(contents)
    for name, text in words.items():
        for size in (1, 2, 3, 5):
            cuts = [" ".join(rng.choice(text.split()) for _ in range(size)) for _ in range(10)]
            sizes = [sorted(coder.sizes(cut.encode())) for cut in cuts]
            assert size > 2 or any(a == b for a, b, *_ in sizes)
            found = coder.judge(cuts)
            assert [(one[0], one[3]) for one in found] == [(name, False)] * len(cuts)
            assert found == [coder.judge([cut])[0] for cut in cuts]
    odd = coder.judge(["中文", None, "12 !", "\ud800"])
    assert [(one[0], one[3]) for one in odd] == [("und", True)] * 4
    assert language.Coder({}).judge(["word"]) == [("und", 0.0, 0.0, True)]
    one = language.Coder({"en": contents["en"]}).judge(["the word", "the word " * 100])
    assert [(found[0], found[3]) for found in one] == [("en", False)] * 2
    same = language.Coder({"a": contents["en"], "b": contents["en"]})
    assert all(found[3] for found in same.judge(["the word", "the word " * 100]))


def test_segmentations_are_returned(spark, docs, rows, empty):
    found = segmentation.digests(docs, MODEL)
    assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 for r in found.collect())
    assert all(len(r.ids) == 4 * r.n_pieces for r in found.collect())
    texts = collections.Counter((r.doc_id, r.text) for r in segmentation.decode(found, MODEL).collect())
    assert texts.keys() == {(i, t or "") for i, t in rows}
    assert "ids" in corpus_pipeline.sentencepiece(spark, empty, "").columns


def test_shards(docs, rows, empty):
    found = sharding.shard(docs, sharding.even_tree(8), sharding.even_tree(9)).collect()
    assert ordered((r.doc_id, r.size, r.text_crc32) for r in found) == ordered(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert all(r.grown_shard in (r.shard, 8) for r in found)
    for shard in {r.shard for r in found}:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert collected(sharding.shard(empty, sharding.even_tree(8))) == []


def test_weights_decide_shares(spark):
    node = sharding.tree([[[1.0, 3.0]], [[4.0], [0.0]]])
    keys = spark.range(20000).selectExpr("id AS doc_id")
    counts = dict(collected(keys.select(sharding.place(keys["doc_id"], node).alias("s")).groupBy("s").count()))
    assert set(counts) == {0, 1, 2}
    assert all(abs(counts[s] / 20000 - share) < 0.02 for s, share in enumerate((1 / 8, 3 / 8, 1 / 2)))
