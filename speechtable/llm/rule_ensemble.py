"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of every whole text are Spark expressions, written once as a narrow table. A random forest of shallow trees is grown on the
labelled rows; every path from a root to a node is a conjunctive rule. A logistic model with an L1 penalty weighs the rules, and those
with a weight that is not zero are compiled into one Spark column expression, the score.

Scale: fitting reads the narrow table joined with the labels by id, on all labelled rows, distributed; the driver holds trees and weights
only (at most ``trees`` x 14 rules). Scoring is a projection.

A null text counts as empty and is scored like any other. Rows with a null label or id are not learned from. With fewer than two classes
the score is the share of label 1 (0.5 without labels). Repeated ids are scored each; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechtable import settings
from speechtable.llm import textstats

#: Statistics a rule can test.
STATS = ("chars", "words", "word_length", "short_words", "long_words", "symbols", "marks", "capitals", "digits", "alone_bars",
         "same_as_before", "distinct_words", "distinct_pairs", "repeated_lines", "line_words")


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text but with the statistics as doubles; input columns named like a statistic are replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    w = F.col("_w")
    kept = [c for c in docs.columns if c not in STATS and c != text_col]
    df = docs.select(*kept, text.alias("_t")).withColumns({"_w": textstats.words(F.col("_t")), "_lines": textstats.lines(F.col("_t"))})
    df = df.withColumn("_pairs", F.transform(textstats.tail("_w", 1), lambda a, i: F.xxhash64(a, F.get(w, i + 1))))
    per_char = lambda pattern: (F.length("_t") - textstats.chars_without(F.col("_t"), pattern)) / F.greatest(F.length("_t"), F.lit(1))
    per_word = lambda n: n / F.greatest(F.size("_w"), F.lit(1))
    count = lambda test: F.size(F.filter("_w", test))
    values = {
        "chars": F.length("_t"),
        "words": F.size("_w"),
        "word_length": per_word(textstats.chars_without(F.col("_t"), textstats.SPACES)),
        "short_words": per_word(count(lambda x: F.length(x) <= 3)),
        "long_words": per_word(count(lambda x: F.length(x) >= 8)),
        "symbols": per_char(textstats.SYMBOLS),
        "marks": per_char("[!?]+"),
        "capitals": per_char("\\p{Lu}+"),
        "digits": per_char("[0-9]+"),
        "alone_bars": per_word(count(lambda x: x == "|")),
        "same_as_before": per_word(F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, F.greatest(i - 1, F.lit(0))))))),
        "distinct_words": per_word(F.size(F.array_distinct("_w"))),
        "distinct_pairs": F.size(F.array_distinct("_pairs")) / F.greatest(F.size("_pairs"), F.lit(1)),
        "repeated_lines": textstats.duplicates("_lines") / F.greatest(F.size("_lines"), F.lit(1)),
        "line_words": F.size("_w") / F.greatest(F.size("_lines"), F.lit(1)),
    }
    return df.select(*kept, *(values[name].cast("double").alias(name) for name in STATS))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, "<=" or ">", threshold)."""

    tests: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, sign, value in self.tests:
            out = out & (F.col(name) <= value if sign == "<=" else F.col(name) > value)
        return out


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    terms: tuple[tuple[float, Rule], ...]
    #: Whether rows of both classes were there to learn from.
    fitted: bool = True

    def score(self) -> Column:
        """Probability of label 1 from the statistics columns."""
        z = F.lit(self.intercept)
        for weight, rule in self.terms:
            z = z + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def paths(tree: str) -> list[Rule]:
    """Rules of all paths in the printed form of a forest: an If or Else line for each branch, indented by depth."""
    rules, stack = {}, []
    for line in tree.splitlines():
        if found := re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(found[1])
            stack = [x for x in stack if x[0] < depth] + [(depth, (STATS[int(found[2])], found[3], float(found[4])))]
            rules[Rule(tuple(sorted({test for _, test in stack})))] = None
        elif line.lstrip().startswith("Tree "):
            stack = []
    return list(rules)


def fit(stats: DataFrame, label: str, trees: int = 24, depth: int = 3, penalty: float = 0.002, seed: int = 11) -> Ensemble:
    """Grow trees, take their paths as rules, keep those the lasso needs. ``label`` is 0 or 1."""
    rows = stats.where(F.col(label).isin(0, 1)).select(F.col(label).cast("double").alias("label"), *STATS)
    n, ones = rows.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        share = min(max((ones / n) if n else 0.5, 1e-6), 1 - 1e-6)
        return Ensemble(math.log(share / (1 - share)), (), False)
    # Rows in one order and one place for a given table: the forest draws by place.
    rows = settings.materialize(rows.withColumn("features", array_to_vector(F.array(*STATS))), "labelled")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="0.5", subsamplingRate=0.7, seed=seed).fit(rows)
    rules = paths(forest.toDebugString)
    tested = rows.select("label", array_to_vector(F.array(*(r.column().cast("double") for r in rules))).alias("features"))
    model = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(tested)
    terms = tuple((float(c), r) for c, r in zip(model.coefficients, rules) if abs(c) > 1e-9)
    return Ensemble(float(model.intercept), terms)


def learned(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Ensemble:
    """The ensemble fitted to all labelled rows of a statistics table."""
    known = labels.where(F.col(id_col).isNotNull()).select(id_col, F.col(label_col).alias("_label"))
    return fit(stats.select(id_col, *STATS).join(known, id_col), "_label")


def classify(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", at: float = 0.7) -> DataFrame:
    """``docs`` without the text but with score and predicted. ``learn`` says which rows of ``labels`` may be learned from."""
    stats = settings.materialize(statistics(docs.drop("score", "predicted"), text_col), "statistics")
    model = learned(stats, labels.where(learn), id_col, label_col)
    out = stats.withColumn("score", model.score()).drop(*STATS)
    return out.withColumn("predicted", (F.col("score") >= at).cast("int"))
