"""Merkle tree over a table: nested structs of ranks to the base three, proofs by unnesting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import forget, on_keys, stored

FAN = 3

# Levels nested in one row: a block holds at most FAN ** DEPTH nodes, some 100 KB.
DEPTH = 6

_ALL = "_all"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return digest(*[_field(value) for value in fields])


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf, changed and a number that tells equal rows apart.

    ``changed`` is the leaf of the text without its line feeds, for rows whose id has an even
    checksum and whose text has any; null for all others, a null id among them.
    """
    text = F.col("text")
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    return docs.select("doc_id", "source", "lang", "n_chars", "text").select(
        "source",
        "doc_id",
        _leaf(text).alias("leaf"),
        F.when(even & text.contains("\n"), _leaf(F.replace(text, F.lit("\n")))).alias("changed"),
        F.monotonically_increasing_id().alias("copy"),
    )


def ranked(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` with a gapless ``rank`` from 0 in the order of each key, and its count ``n``.

    Rows are sorted in ranges, so a key with very many rows lies in several of them. Only
    the counts of keys by range, at most as many as keys and ranges together, are summed.
    The result is a stored table.
    """
    spread = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    spread = stored(spread.withColumn("_at", F.monotonically_increasing_id()), "places")
    spread = spread.withColumn("_range", F.shiftright("_at", 33))
    runs = spread.groupBy(*keys, "_range").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    of_key = Window.partitionBy(*keys)
    before = of_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *keys,
        "_range",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(of_key).alias("n"),
    )
    placed = (
        spread.alias("s")
        .join(runs.alias("r"), on_keys("s", "r", [*keys, "_range"]))
        .select(
            *[f"s.{name}" for name in rows.columns],
            (F.col("s._at") + F.col("r._shift")).alias("rank"),
            "r.n",
        )
    )
    placed = stored(placed, "ranks")
    forget(spread)
    return placed


def _joins(level: int) -> Column:
    """Whether the nodes below ``level`` are several, so that they become parents."""
    return F.col("n") > FAN ** (level - 1)


def _nested(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each block of FAN ** DEPTH ranks: ``keys``, block, n, hash and kids.

    The lowest digit of the rank is grouped away first: nodes that agree in all others
    become the kids of one. Rows are dealt by block once; the groupings need no more
    shuffle, as each is finer than the block.
    """
    digits = [f"_d{level}" for level in range(1, DEPTH + 1)]
    columns = [
        F.expr(f"cast(rank div {FAN**level} % {FAN} as int)").alias(name)
        for level, name in enumerate(digits)
    ]
    block = F.expr(f"rank div {FAN**DEPTH}").alias("block")
    tree = nodes.select(
        *keys, block, "n", *columns, F.struct("hash", "row").alias("node")
    ).repartition(*keys, "block")
    for level, digit in enumerate(digits, 1):
        kid = F.struct(F.col(digit).alias("place"), "node")
        kids = tree.groupBy(*keys, "block", "n", *digits[level:]).agg(
            F.sort_array(F.collect_list(kid)).alias("kids")
        )
        hashes = F.array_join(F.transform("kids", lambda k: k["node"]["hash"]), "")
        alone = F.col("kids")[0]["node"]["hash"]
        parent = F.when(_joins(level), F.sha2(hashes, 256)).otherwise(alone)
        tree = kids.select(
            *keys,
            "block",
            "n",
            *digits[level:],
            F.struct(
                parent.alias("hash"), F.transform("kids", lambda k: k["node"]).alias("kids")
            ).alias("node"),
        )
    return tree.select(*keys, "block", "n", "node.hash", "node.kids")


def _opened(blocks: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes of every block with the ``path`` from each up to the root, lowest step first.

    A step holds what stands left and right of the node among its siblings.
    """
    for level in range(DEPTH, 0, -1):
        kids = F.col("kids")

        def step(kid: Column, at: Column) -> Column:
            left = F.slice(kids, 1, at)
            right = F.slice(kids, at + 2, FAN)
            return F.struct(
                kid.alias("node"),
                F.struct(
                    F.array_join(F.transform(left, lambda k: k["hash"]), "").alias("left"),
                    F.array_join(F.transform(right, lambda k: k["hash"]), "").alias("right"),
                ).alias("step"),
            )

        one = blocks.select(*carried, "n", "path", F.explode(F.transform(kids, step)).alias("k"))
        path = F.when(_joins(level), F.concat(F.array("k.step"), "path")).otherwise(F.col("path"))
        below = F.col("k.node.kids" if level > 1 else "k.node.row")
        blocks = one.select(
            *carried,
            "n",
            path.alias("path"),
            F.col("k.node.hash").alias("hash"),
            below.alias("kids" if level > 1 else "row"),
        )
    return blocks


def climb(nodes: DataFrame, keys: list[str], most: int) -> list[DataFrame]:
    """Nested blocks, blocks of their roots and so on until one is left of each key.

    ``nodes``: keys, rank, n, hash and a struct ``row`` that is handed through; ``most``
    is the largest n. Each table is stored, the lowest first.
    """
    rounds = []
    size = FAN**DEPTH
    while True:
        blocks = stored(_nested(nodes, keys), "blocks")
        rounds.append(blocks)
        if most <= size:
            return rounds
        most = -(-most // size)
        nodes = blocks.select(
            *keys,
            F.col("block").alias("rank"),
            F.expr(f"(n + {size - 1}) div {size}").alias("n"),
            "hash",
            F.struct("block").alias("row"),
        )


def descend(rounds: list[DataFrame], keys: list[str], tops: DataFrame, carried: list[str]):
    """The lowest nodes of ``climb`` with their paths, given ``path`` and ``carried`` of
    each key in ``tops``. Only whole blocks are joined, each with what is above it."""
    above, on = tops, keys
    for blocks in reversed(rounds):
        joined = blocks.alias("b").join(above.alias("a"), on_keys("b", "a", on)).select(
            *[f"b.{key}" for key in keys], "b.n", "b.kids", "a.path", *[f"a.{c}" for c in carried]
        )
        nodes = _opened(joined, [*keys, *carried])
        above, on = nodes.withColumn("block", _block(nodes)), [*keys, "block"]
    return nodes


def _block(nodes: DataFrame) -> Column:
    inner = nodes.schema["row"].dataType.names
    return F.col("row.block") if "block" in inner else F.lit(0)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document.

    A leaf digests doc_id, source, lang, n_chars and text. Of each source every three
    consecutive nodes become one, from the leaves by ascending doc_id up to the subroot, and
    so do the subroots by source up to the root. The proof is the digest of all siblings on
    the way. folded_root is worked out from the leaf as changed (see ``leaves``) and the
    original siblings; verified tells whether it is the root.

    Null sources come first and are a source of their own, unlike the empty text; null ids
    come first in their source and are never changed. Repeated rows and ids, ordered by leaf,
    are leaves of their own. Any null field has a mark of its own. Texts are digested whole;
    only digests are shuffled, whatever their length. Other columns are not read, whatever
    their names. An empty table gives an empty result.

    Ranks come from sorted ranges, so a hot source or key is spread. Nested blocks hold
    at most FAN ** DEPTH nodes; roots of blocks are nested again, and blocks (not documents)
    are joined with the paths above them.
    """
    found = stored(leaves(docs), "leaves")
    rows = ranked(found, ["source"], ["doc_id", "leaf", "copy"])
    forget(found)
    nodes = rows.select(
        "source",
        "rank",
        "n",
        F.col("leaf").alias("hash"),
        F.struct("doc_id", "changed").alias("row"),
    )
    rounds = climb(nodes, ["source"], rows.agg(F.max("n")).first()[0] or 0)
    forget(rows)

    subroots = rounds[-1].select(F.lit(0).alias(_ALL), "source", "hash")
    subroots = ranked(subroots, [_ALL], ["source"])
    sources = subroots.select(
        _ALL, "rank", "n", "hash", F.struct("source", F.col("hash").alias("subroot")).alias("row")
    )
    tops = climb(sources, [_ALL], subroots.agg(F.max("n")).first()[0] or 0)
    forget(subroots)

    no_path = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    root = tops[-1].select(_ALL, no_path.alias("path"), F.col("hash").alias("root"))
    of_source = descend(tops, [_ALL], root, ["root"]).select(
        "row.source", "row.subroot", "root", "path"
    )
    proved = descend(rounds, ["source"], of_source, ["subroot", "root"])

    siblings = F.transform("path", lambda step: F.concat(step["left"], step["right"]))
    folded = F.aggregate(
        "path",
        F.coalesce("row.changed", "hash"),
        lambda node, step: digest(step["left"], node, step["right"]),
    )
    return proved.select(
        "row.doc_id",
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
