"""The operators as registered queries over whole tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridmart.llm import (
    decontamination,
    filter_audit,
    fingerprints,
    language,
    merkle,
    packing,
    passages,
    repeats,
    rule_quality,
    segmentation,
    sharding,
    simhash,
    token_counts,
)
from gridmart.llm.common import benchmark, documents, labels

SHARDS = 8


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op2_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, pad=50256)


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(documents(spark, sf_dir))


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(documents(spark, sf_dir))


def op5_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer)


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op8_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return segmentation.digests(documents(spark, sf_dir), model)


def op9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(documents(spark, sf_dir))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(
        documents(spark, sf_dir), sharding.even_tree(SHARDS), sharding.even_tree(SHARDS + 1)
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), labels(spark, sf_dir))


def op13_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_quality.quality(documents(spark, sf_dir), labels(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: function for name, function in list(globals().items()) if name.startswith("op")
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(_field(value) for value in fields) + ")"


# The checksum of a decimal id, bit by bit: a step of 0 or more takes in a character, -1 shifts.
_CRC32 = (
    "xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(["
    "[CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]"
    " FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),"
    " lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)"
    " ELSE xor(crc >> 1, CASE WHEN crc & 1 = 1 THEN 3988292384 ELSE 0 END) END))"
)


def _tree(name: str, leaves: str) -> str:
    """Nodes of every level over ``leaves`` (key, p, h, n), and the siblings of each."""
    return f"""
{name} AS (
    SELECT key, 0 AS level, p, h, n FROM {leaves}
    UNION ALL
    SELECT key, level + 1, p // 3, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 2) // 3
    FROM {name} WHERE n > 1 GROUP BY key, level, p // 3
),
{name}_steps AS (
    SELECT a.key, a.level, a.p,
           coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l,
           coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS r
    FROM {name} a JOIN {name} b
      ON a.key = b.key AND a.level = b.level AND a.p // 3 = b.p // 3
    WHERE a.n > 1 GROUP BY a.key, a.level, a.p
)"""


# Filters A to E: bit and whether a document fails.
_FAILS = {
    "A": "len(w) < 50",
    "B": "100 * len(list_distinct(w)) < 65 * len(w)",
    "C": "100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t)",
    "D": "regexp_matches(t, '[#$%&*|]')",
    "E": "coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)",
}
_MASK = " + ".join(
    f"CASE WHEN {fails} THEN {1 << bit} ELSE 0 END" for bit, fails in enumerate(_FAILS.values())
)
_BIT = "(1 << (ascii(substr(o, s, 1)) - 65))"
_BEFORE = "list_sum([1 << (ascii(c) - 65) FOR c IN string_split(substr(o, 1, s - 1), '') IF c <> ''])"

ORACLE: dict[str, str] = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE docs AS (
    SELECT *, {_leaf("text")} AS leaf,
           CASE WHEN {_CRC32} % 2 = 0
                THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS changed
    FROM documents
),
sources AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS key
    FROM (SELECT DISTINCT source FROM documents)
),
leaves AS (
    SELECT s.key, d.doc_id, d.leaf, d.changed, d.leaf AS h, count(*) OVER (PARTITION BY s.key) AS n,
           row_number() OVER (PARTITION BY s.key ORDER BY d.doc_id NULLS FIRST, d.leaf) - 1 AS p
    FROM docs d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
),
{_tree("low", "leaves")},
tops AS (
    SELECT 0 AS key, key AS p, h, count(*) OVER () AS n FROM low WHERE n = 1
),
{_tree("high", "tops")},
way AS (
    SELECT key, p, 0 AS up, changed AS cur, CAST('' AS VARCHAR) AS proof FROM leaves
    UNION ALL
    SELECT w.key, w.p, up + 1, sha256(s.l || cur || s.r), proof || s.l || s.r
    FROM way w JOIN low_steps s
      ON s.key = w.key AND s.level = w.up AND s.p = w.p // CAST(pow(3, w.up) AS BIGINT)
),
lower_way AS (
    SELECT key, p, arg_max(cur, up) AS cur, arg_max(proof, up) AS proof FROM way GROUP BY key, p
),
way_up AS (
    SELECT key, p, 0 AS up, cur, proof FROM lower_way
    UNION ALL
    SELECT w.key, w.p, up + 1, sha256(s.l || cur || s.r), proof || s.l || s.r
    FROM way_up w JOIN high_steps s
      ON s.level = w.up AND s.p = w.key // CAST(pow(3, w.up) AS BIGINT)
),
whole_way AS (
    SELECT key, p, arg_max(cur, up) AS cur, arg_max(proof, up) AS proof FROM way_up GROUP BY key, p
)
SELECT l.doc_id, l.leaf, t.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256,
       cur AS folded_root, cur = r.h AS verified
FROM leaves l JOIN whole_way w USING (key, p) JOIN tops t ON t.p = l.key
JOIN (SELECT h FROM high WHERE n = 1) r ON true
""",
    "op12_filter_audit": f"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
m AS (SELECT doc_id, part, {_MASK} AS mask FROM d),
c AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good,
           count(*) FILTER (toxic = 1) AS toxic
    FROM m LEFT JOIN labels USING (doc_id) GROUP BY part, mask
),
letters AS (SELECT unnest(string_split('ABCDE', '')) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS o
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (
    SELECT o, s, {_BIT} AS bit, coalesce({_BEFORE}, 0) AS before
    FROM orders, range(1, 6) AS r(s)
),
counts AS (
    SELECT part, o, CAST(s AS INTEGER) AS step, bit,
           sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM c, steps GROUP BY part, o, s, bit
)
SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counts
""",
    "op7_contamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
i_at AS (
    SELECT item_id, w, least(13, len(w)) AS size,
           unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
    FROM i WHERE len(w) > 0
),
i_win AS (
    SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS win FROM i_at
),
sizes AS (SELECT DISTINCT size FROM i_win),
d_at AS (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
    FROM d JOIN sizes ON len(w) >= size
),
d_win AS (SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS win FROM d_at),
found AS (SELECT doc_id, item_id, p, size FROM d_win JOIN i_win USING (size, win)),
hit_at AS (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS q FROM found),
hits AS (SELECT doc_id, count(*) AS n_hit FROM hit_at GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(ids, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}
