"""Quality by a sparse ensemble of rules: tree paths over statistics, weighed by a lasso."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import forget, stored, whole
from gridmart.llm.language import held_out

# The training sample: at most so many labelled documents, spread over the whole table.
SAMPLE = 20_000

TREES = 24
DEPTH = 3
PENALTY = 0.002
_SEED = 42


def statistics(text: Column) -> dict[str, Column]:
    """Numbers of a whole text by name; shares are of its characters, 0 if there are none."""
    chars = F.length(text)
    words = F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " ")
    n_words = F.when(chars > 0, F.size(words)).otherwise(0)
    lines = F.split(text, "\n")

    def share(part: Column | str) -> Column:
        rest = F.length(F.regexp_replace(text, part, ""))
        return F.when(chars > 0, (chars - rest) / chars).otherwise(0.0)

    def over(part: Column, of: Column) -> Column:
        return F.when(of > 0, part / of).otherwise(0.0)

    numbers = {
        "chars": chars,
        "words": n_words,
        "word_length": over(chars, n_words),
        "distinct_words": over(F.size(F.array_distinct(words)), n_words),
        "line_length": over(chars, F.size(lines)),
        "distinct_lines": over(F.size(F.array_distinct(lines)), F.size(lines)),
        "upper": share(r"\p{Lu}+"),
        "digits": share(r"\p{Nd}+"),
        "points": share(r"[.,;:!?]+"),
        "symbols": share(r"[^\p{L}\p{N}\s.,;:!?]+"),
        "doubled": share(r"([^\p{L}\p{N}\s])\1+"),
    }
    return {name: number.cast("double") for name, number in numbers.items()}


@dataclass(frozen=True)
class Rule:
    """All of these hold: a statistic is above ``low`` and not above ``high``."""

    bounds: tuple[tuple[str, float, float], ...]

    def holds(self) -> Column:
        tests = []
        for name, low, high in self.bounds:
            if low > float("-inf"):
                tests.append(F.col(name) > F.lit(low))
            if high < float("inf"):
                tests.append(F.col(name) <= F.lit(high))
        return reduce(lambda one, other: one & other, tests)


_TEST = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(tree: str, names: list[str]) -> list[Rule]:
    """The rules of a printed decision tree: one for every path from the root to a node."""
    rules, path = [], []
    for line in tree.splitlines():
        found = _TEST.match(line)
        if not found:
            continue
        indent, _, feature, side, value = found.groups()
        path = [step for step in path if step[0] < len(indent)]
        path.append((len(indent), names[int(feature)], side, float(value)))
        bounds: dict[str, tuple[float, float]] = {}
        for _, name, side, value in path:
            low, high = bounds.get(name, (float("-inf"), float("inf")))
            bounds[name] = (low, min(high, value)) if side == "<=" else (max(low, value), high)
        rules.append(Rule(tuple((name, *bounds[name]) for name in sorted(bounds))))
    return rules


@dataclass(frozen=True)
class Model:
    """A chance of label 1: weighted rules in a logistic function."""

    base: float
    rules: list[tuple[float, Rule]]

    def score(self) -> Column:
        """The score over columns named as the statistics."""
        total = F.lit(self.base)
        for weight, rule in self.rules:
            total = total + F.when(rule.holds(), F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Statistics and ``label`` of at most ``sample`` labelled documents not held out.

    The ids with the smallest hashes are taken, then the documents with them. The table
    of ids is bounded by ``sample``, so it is broadcast. Of several labels of an id the
    highest counts. Documents that share an id are taken up to the same bound.
    """
    order = F.xxhash64("doc_id")
    ids = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    ids = ids.groupBy("doc_id").agg(F.max("quality").alias("label"))
    ids = ids.orderBy(order, "doc_id").limit(sample)
    some = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(ids), "doc_id")
    numbers = statistics(F.col("text"))
    some = some.select(
        "doc_id", F.col("label").cast("double").alias("label"), *[c.alias(n) for n, c in numbers.items()]
    )
    return some.orderBy(order, *some.columns).limit(sample).drop("doc_id")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn rules and weights from the training sample.

    The rules are the paths of a random forest of shallow trees, equal ones once; those that
    the lasso gives no weight are left out. Without examples of both labels there are no
    rules, and the score is the share of label 1, or one half.
    """
    rows = stored(training_sample(docs, labels, sample).coalesce(1), "sample")
    good, count = rows.agg(F.sum("label"), F.count("*")).first()
    if not count or good in (0, count):
        forget(rows)
        return Model({0: -20.0, count: 20.0}.get(good, 0.0) if count else 0.0, [])
    names = [name for name in rows.columns if name != "label"]
    vectors = rows.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=5, seed=_SEED
    ).fit(vectors)
    found = {rule: None for tree in forest.trees for rule in paths(tree.toDebugString, names)}
    rules = list(found)
    if not rules:
        forget(rows)
        return Model(0.0, [])
    hits = F.array(*[F.when(rule.holds(), 1.0).otherwise(0.0) for rule in rules])
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(
        rows.select("label", array_to_vector(hits).alias("features"))
    )
    forget(rows)
    weights = lasso.coefficients.toArray().tolist()
    return Model(lasso.intercept, [(w, rule) for w, rule in zip(weights, rules) if w])


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted of every document.

    Labels are learned from documents that are not held out; only the text decides a score.
    Null texts are empty ones, whose statistics are 0, and are scored like any other. Texts
    of any length are read whole. Equal texts have equal scores; a score of one half
    predicts 1. Repeated rows and null ids stay rows of their own; a null id has no label.
    Other columns are not read, whatever their names. An empty table gives an empty result.

    Scores are Spark expressions over the statistics: one pass, no shuffle.
    """
    model = fit(docs, labels, sample)
    numbers = statistics(F.col("text"))
    rows = docs.select("doc_id", whole("text").alias("text"))
    rows = rows.select(
        "doc_id",
        held_out().alias("held_out"),
        *[number.alias(name) for name, number in numbers.items()],
    )
    scored = rows.select("doc_id", "held_out", model.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
