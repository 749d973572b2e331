"""Quality classifier as a sparse ensemble of rules (operator 9).

A random forest over statistics of the texts gives the rules: each path from a root to
a node is a conjunction of comparisons.  A logistic regression with lasso penalty weighs
the rules and drops most of them.  What is left is compiled to one Spark column, so
scoring needs no model at run time.  Forest and regression are fitted by Spark on all
labelled rows handed in; only trees and weights come to the driver, whose number does
not depend on the data.

Special cases: a null text is empty, and its statistics are 0; rows without a label or
id do not take part in learning; without labelled rows every score is 0.5, and with one
class only it is that class; rows are scored each by their own text.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry.llm.common import read_table
from offerquarry.llm.text_stats import stats_column
from offerquarry.sources.shared import ship_code, write_and_read

TREES, DEPTH, SEED = 20, 3, 9
LASSO = 0.0005
ACCEPT = 0.7


NAMES = [
    "log_words", "word_length", "symbols", "marks", "upper", "digits", "line_words",
    "dup_lines", "repeated", "distinct", "top_word",
]


def _ratio(count: str, by: str) -> Column:
    return F.coalesce(F.try_divide(F.col(f"stats.{count}").cast("double"), F.col(f"stats.{by}")), F.lit(0.0))


def statistics() -> dict[str, Column]:
    """The statistics rules are made of, from a ``stats`` column."""
    return {
        "log_words": F.log1p(F.col("stats.n_words").cast("double")),
        "word_length": _ratio("word_chars", "n_words"),
        "symbols": _ratio("n_symbols", "n_words"),
        "marks": _ratio("n_marks", "n_words"),
        "upper": _ratio("n_upper", "word_chars"),
        "digits": _ratio("n_digits", "word_chars"),
        "line_words": _ratio("n_words", "n_lines"),
        "dup_lines": _ratio("n_dup_lines", "n_lines"),
        "repeated": _ratio("n_repeat_words", "n_words"),
        "distinct": _ratio("n_distinct_words", "n_words"),
        "top_word": _ratio("n_top_word", "n_words"),
    }


#: One comparison: place of the statistic, is it "at most", limit.
Test = tuple[int, bool, float]
Rule = tuple[Test, ...]


def tree_rules(description: str) -> set[Rule]:
    """All paths of a fitted tree, from its printed form."""
    rules, path = set(), []
    for line in description.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\deE]+)\)", line)
        if found:
            indent, place, sign, limit = found.groups()
            while path and path[-1][0] >= len(indent):
                path.pop()
            path.append((len(indent), (int(place), sign == "<=", float(limit))))
            rules.add(tuple(sorted({test for _, test in path})))
    return rules


def compiled(rule: Rule) -> Column:
    condition = F.lit(True)
    for place, at_most, limit in rule:
        value = F.col(NAMES[place])
        condition = condition & ((value <= limit) if at_most else (value > limit))
    return condition


@dataclass(frozen=True)
class Ensemble:
    constant: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        """Probability of label 1, over columns named like the statistics."""
        total = F.lit(self.constant)
        for rule, weight in self.rules:
            total = total + F.when(compiled(rule), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit(rows: DataFrame) -> Ensemble:
    """``rows``: the statistics and a ``label`` (0 or 1) of each labelled text."""
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Ensemble({0.0: -20.0, 1.0: 20.0}.get(next(iter(counts), None), 0.0), [])
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird"
    ).fit(vectors.select("features", "label"))
    rules = sorted(set().union(*(tree_rules(t.toDebugString) for t in forest.trees)))
    if not rules:
        share = counts[1.0] / (counts[0.0] + counts[1.0])
        return Ensemble(math.log(share / (1 - share)), [])
    hits = rows.select("label", *[compiled(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    inputs = [f"r{i}" for i in range(len(rules))]
    hits = VectorAssembler(inputCols=inputs, outputCol="features").transform(hits)
    hits = write_and_read(hits.select("features", "label"), "rule_hits")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(hits)
    weights = [(r, w) for r, w in zip(rules, lasso.coefficients.toArray().tolist()) if w]
    return Ensemble(float(lasso.intercept), weights)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    ship_code(docs.sparkSession)
    rows = docs.select(*keep, stats_column().alias("stats"))
    return rows.select(*keep, *[c.alias(n) for n, c in statistics().items()])


def learn_and_score(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, score`` of each row of ``docs``.

    ``labels`` holds ``doc_id, label``; rows for which ``held_out`` (of ``doc_id``) is
    true are not learned from.
    """
    stored = write_and_read(measured(docs, ["doc_id"]), "statistics")
    known = labels.where("label IS NOT NULL").select("doc_id", F.col("label").cast("double").alias("label"))
    rows = stored.join(known, "doc_id").where(~held_out).select("label", *NAMES)
    ensemble = fit(write_and_read(rows, "labelled"))
    return stored.select("doc_id", held_out.alias("held_out"), ensemble.score().alias("score"))


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    scored = learn_and_score(docs.select("doc_id", "text"), labels, held_out)
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
