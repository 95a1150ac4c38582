"""Merkle manifest, filter audit and rule ensemble against brute force, on odd rows."""

import collections
import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gridmart.llm import filter_audit, merkle, rule_quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, `a.b` long"
LABELS = "doc_id long, quality int, toxic int, source string"


def odd_rows():
    """Nulls anywhere, a hot source, a hot text under one null id, repeated ids and rows."""
    rng = random.Random(3)
    start = "the same long beginning of many texts " * 3
    texts = [None, "", "a\nb", "é\n\nü", "UP " * 9, "w " * 60, "a # b", " \t\n", "x" * 70_000]
    texts += [start + str(i) for i in range(40)]
    texts += [" ".join(rng.choice("abcdefgh") * 3 for _ in range(70)) for _ in range(5)]
    sources = ["hot", "hot", "hot", "", None, "é", "z", "hots"]
    rows = [
        (i, rng.choice(texts), rng.choice([None, "en"]), rng.choice(sources), rng.choice([None, i]))
        for i in range(500)
    ]
    rows += [(None, "same", None, "hot", 4)] * 200 + [(None, None, None, None, None)] * 3
    rows += [(7, "other", "de", "z", 1)] * 2 + [(8, rows[3][1], "de", "z", 1)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*row, "h", 1) for row in rows], SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def as_sorted(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = [row[0], row[3], row[2], row[4], text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def climbed(hashes):
    """The root, and of each hash what stands left and right of it at every level."""
    ways = [[] for _ in hashes]
    at = list(range(len(hashes)))
    while len(hashes) > 1:
        for way, i in zip(ways, at):
            run = hashes[i // 3 * 3 : i // 3 * 3 + 3]
            way.append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        at = [i // 3 for i in at]
        hashes = [digest(*hashes[i : i + 3]) for i in range(0, len(hashes), 3)]
    return hashes[0], ways


def brute_manifest(rows):
    by_source = collections.defaultdict(list)
    for row in rows:
        by_source[row[3]].append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(
            by_source[name],
            key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])),
        )
        trees[name] = ordered, *climbed([leaf_of(r, r[1]) for r in ordered])
    root, tops = climbed([trees[name][1] for name in names])
    found = []
    for name, top in zip(names, tops):
        ordered, subroot, ways = trees[name]
        for row, way in zip(ordered, ways):
            way, text = way + top, row[1]
            if row[0] is not None and text and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now = leaf_of(row, text)
            for left, right in way:
                now = digest(left, now, right)
            proof = digest(*[part for step in way for part in step])
            leaf = leaf_of(row, row[1])
            found.append((row[0], leaf, subroot, root, proof, now, now == root))
    return found


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_manifest_matches_brute_force(monkeypatch, docs, rows, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    found = as_sorted(merkle.manifest(docs).collect())
    assert found == as_sorted(brute_manifest(rows))
    assert {row[-1] for row in found} == {True, False}


def test_manifest_of_one_row_and_none(spark, docs, rows, empty):
    one = docs.filter("doc_id = 9")
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == digest("")
    assert merkle.manifest(empty).collect() == []


def test_blocks_are_bounded(docs, rows):
    ranks = merkle.ranked(docs.select("source", "doc_id"), ["source"], ["doc_id"])
    by_source = collections.Counter(row[3] for row in rows)
    seen = collections.defaultdict(list)
    for row in ranks.collect():
        assert row.n == by_source[row.source]
        seen[row.source].append(row["rank"])
    assert all(sorted(found) == list(range(by_source[s])) for s, found in seen.items())


def brute_masks(rows):
    least = {}
    for row in rows:
        if row[0] is not None:
            text = row[1] or ""
            least[text] = min(least.get(text, row[0]), row[0])
    found = []
    for row in rows:
        text = row[1] or ""
        words = text.encode().split()
        fails = [
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            any(c in "#$%&*|" for c in text),
            row[0] is not None and row[0] > least[text],
        ]
        found.append({"ABCDE"[i] for i in range(5) if fails[i]})
    return found


def brute_audit(rows, labels):
    masks = brute_masks(rows)
    parts = sorted({row[3] or "" for row in rows})
    out, total = {}, collections.Counter()
    for part in parts:
        mine = [(row, mask) for row, mask in zip(rows, masks) if (row[3] or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(r, m) for r, m in left if letter in m]
                left = [(r, m) for r, m in left if letter not in m]
                total[part, letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(letter in m for _, m in mine) - len(gone),
                    sum(m == {letter} for _, m in mine),
                    sum(labels.get(r[0], (0, 0))[0] == 1 for r, _ in gone),
                    sum(labels.get(r[0], (0, 0))[1] == 1 for r, _ in gone),
                ]
    return [(*key, *value, total[key[0], key[1][key[2] - 1]]) for key, value in out.items()]


@pytest.mark.parametrize("size", [1, 1 << 24])
def test_audit_matches_brute_force(monkeypatch, spark, docs, rows, size):
    """Also with a trie for every row, so that all copies meet after the shuffle only."""
    monkeypatch.setattr(filter_audit, "LOCAL_BYTES", size)
    said = [(i, i % 2, i % 3 == 0) for i in range(0, 400)]
    labels = spark.createDataFrame(
        [(i, q, int(t), "x") for i, q, t in said] + [(401, None, None, None), (None, 1, 1, "y")],
        LABELS,
    )
    found = as_sorted(filter_audit.audit(docs, labels).collect())
    assert found == as_sorted(brute_audit(rows, {i: (q, int(t)) for i, q, t in said}))


def test_audit_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(empty, none).collect() == []
    row = filter_audit.audit(docs, none).agg(F.max("good_lost"), F.max("toxic_lost")).first()
    assert tuple(row) == (0, 0)


def test_trie_holds_the_smallest_of_every_text():
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"ab", k=rng.randrange(0, 40))) for _ in range(2000)]
    texts += [b"a" * n for n in (1, 15, 16, 17, 31, 32, 33, 5000)]
    trie, least = filter_audit.Trie(), {}
    for i in rng.sample(range(len(texts)), len(texts)):
        trie.insert(texts[i], (i, 0))
        least[texts[i]] = min(least.get(texts[i], i), i)
    assert sorted(entry[0] for entry in trie.entries()) == sorted(least.values())


def test_prefixes_grow_where_texts_share_a_beginning(spark, docs):
    rows = filter_audit.judged(docs).cache()
    texts = rows.filter("text IS NOT NULL")
    total = texts.agg(F.sum("weight")).first()[0]
    assert len(filter_audit._heavy(texts, total // 20)) > 1
    assert len(filter_audit._heavy(texts, total)) == 0


def test_rules_are_the_paths_of_a_tree():
    shown = (
        "tree of depth 2\n"
        "  If (feature 0 <= 1.5)\n"
        "   If (feature 0 <= 0.5)\n"
        "    Predict: 0.0\n"
        "   Else (feature 0 > 0.5)\n"
        "    Predict: 1.0\n"
        "  Else (feature 0 > 1.5)\n"
        "   Predict: 1.0\n"
    )
    inf = float("inf")
    assert [rule.bounds for rule in rule_quality.paths(shown, ["x"])] == [
        (("x", -inf, 1.5),),
        (("x", -inf, 0.5),),
        (("x", 0.5, 1.5),),
        (("x", 1.5, inf),),
    ]


def test_statistics_of_odd_texts(spark):
    texts = [None, "", " \n ", "One one two!!\nÉ 12 #", "a b\na b\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    numbers = rule_quality.statistics(F.coalesce("text", F.lit("")))
    found = rows.select(*[c.alias(n) for n, c in numbers.items()]).collect()
    # A text without characters has no words; one of blanks only has one, the empty word.
    assert found[0] == found[1] and set(found[0].asDict().values()) <= {0.0, 1.0}
    four = found[3]
    assert four.chars == 20 and four.words == 6 and four.distinct_words == 1.0
    assert four.upper == 2 / 20 and four.digits == 2 / 20 and four.points == 2 / 20
    assert four.symbols == 1 / 20 and four.doubled == 2 / 20
    assert found[4].distinct_words == 0.5 and found[4].distinct_lines == 2 / 3


def test_quality_is_learned_and_odd_rows_are_scored(spark, docs, rows, empty):
    rng = random.Random(2)
    words = ["able", "then", "other", "reading", "so", "kind"]
    made = []
    for i in range(900):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) + ("" if good else rng.choice(["##", "$$"])) for _ in range(40))
        made.append((i, text, "en", "s", 1, "h", 1, int(good)))
    table = spark.createDataFrame(made, SCHEMA + ", truth int")
    labels = table.select("doc_id", F.col("truth").alias("quality"), F.lit(0).alias("toxic"))
    scored = rule_quality.quality(table.drop("truth"), labels).join(labels, "doc_id")
    held = scored.filter("held_out")
    assert held.count() > 200
    assert held.filter("predicted = quality").count() / held.count() > 0.97
    assert scored.filter("score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0

    odd = rule_quality.quality(docs, labels).collect()
    assert len(odd) == len(rows) and all(0 <= row.score <= 1 for row in odd)
    assert rule_quality.quality(empty, labels).collect() == []
    nobody = rule_quality.quality(docs, labels.limit(0)).collect()
    assert {row.score for row in nobody} == {0.5}
    alike = rule_quality.quality(docs, labels.withColumn("quality", F.lit(1))).collect()
    assert {row.predicted for row in alike} == {1}


def test_held_out_labels_are_never_learned_from(spark):
    made = [(i, "good words here" if zlib.crc32(str(i).encode()) % 3 == 1 else "#bad# #bad#") for i in range(300)]
    table = spark.createDataFrame([(i, t, "en", "s", 1, "h", 1) for i, t in made], SCHEMA)
    labels = spark.createDataFrame(
        [(i, int(t[0] == "g"), 0, "x") for i, t in made], LABELS
    )
    sample = rule_quality.training_sample(table, labels, 50)
    assert sample.count() == 50 and sample.agg(F.max("label")).first()[0] == 0.0
