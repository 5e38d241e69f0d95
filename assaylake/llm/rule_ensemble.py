"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts are column expressions, computed once per document and stored as a narrow table.
A random forest of shallow trees is grown over the labelled rows; every path from a root is a rule, a conjunction of
comparisons. A logistic model with a lasso penalty weighs the rules and sets most weights to zero, and what is left is
compiled into one column expression, so scoring is a projection of the narrow table.

Nulls: a null text counts as empty; a null label or a label without a document is not learned from; a document without
an id is scored but never learned from. Repeated documents and labels count as often as they occur. Where labels of only
one class (or none) are there, every score is that class (or one half). Further columns of either table are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import SPACES, let, stored

TREES, DEPTH, BINS, LEAST_ROWS = 24, 3, 64, 5
# Lasso penalty on standardised rules.
PENALTY = 0.0005
# Labelled rows learned from; beyond that, a sample by hash of the document's id.
MOST_LABELLED = 2_000_000
# Share of documents kept out of learning: one of so many remainders of a checksum.
FOLDS = 5
SEED = 17

_KINDS = {
    "symbols": r"[#*$%&|<>=_~^@\\+{}\[\]]",
    "marks": r"[.,;:]",
    "calls": r"[!?]",
    "capitals": r"\p{Lu}",
    "digits": r"\p{Nd}",
}


def statistics(text: Column) -> dict[str, Column]:
    """Name -> double, none of them null, for a whole text."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text).cast("double")
    share = lambda part, of: part / F.greatest(of, F.lit(1.0))
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    hashed = lambda parts: F.transform(parts, lambda x: F.xxhash64(x))
    named = lambda parts, fields: let(parts, lambda x: F.struct(*[v.alias(k) for k, v in fields(x).items()]))
    of_words = named(
        hashed(words),
        lambda x: {"n": F.size(x).cast("double"), "distinct": F.size(F.array_distinct(x)).cast("double")},
    )
    of_lines = named(
        hashed(lines),
        lambda x: {"n": F.size(x).cast("double"), "distinct": F.size(F.array_distinct(x)).cast("double")},
    )
    word_chars = F.length(F.replace(spaced, F.lit(" "), F.lit(""))).cast("double")
    found = {
        "words": of_words["n"],
        "chars": chars,
        "mean_word": share(word_chars, of_words["n"]),
        "words_a_line": share(of_words["n"], of_lines["n"]),
        "distinct_words": share(of_words["distinct"], of_words["n"]),
        # Texts reuse words with the square root of their length, roughly: comparable between short and long ones.
        "distinct_by_root": share(of_words["distinct"], F.sqrt(of_words["n"])),
        "distinct_lines": share(of_lines["distinct"], of_lines["n"]),
    }
    return found | {
        name: share(chars - F.length(F.regexp_replace(text, pattern, "")), chars) for name, pattern in _KINDS.items()
    }


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True, order=True)
class Condition:
    name: str
    above: bool  # otherwise: at most the threshold
    threshold: float

    def column(self) -> Column:
        value, bound = F.col(self.name), F.lit(self.threshold)
        return value > bound if self.above else value <= bound


Rule = tuple[Condition, ...]
_SPLIT = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def merged(conditions: Sequence[Condition]) -> Rule:
    """The conjunction with one bound per statistic and side."""
    tight: dict[tuple[str, bool], float] = {}
    for c in conditions:
        at = c.name, c.above
        pick = max if c.above else min
        tight[at] = pick(tight.get(at, c.threshold), c.threshold)
    return tuple(sorted(Condition(name, above, t) for (name, above), t in tight.items()))


def paths(description: str, names: Sequence[str]) -> set[Rule]:
    """All paths from the root, inner ones too, of a tree as its ``toDebugString`` prints it."""
    found, path = set(), []
    for line in description.splitlines():
        if part := _SPLIT.match(line):
            indent, feature, side, threshold = part.groups()
            while path and path[-1][0] >= len(indent):
                path.pop()
            path.append((len(indent), Condition(names[int(feature)], side == ">", float(threshold))))
            found.add(merged([c for _, c in path]))
    return found


def rule_column(rule: Rule) -> Column:
    met = rule[0].column()
    for condition in rule[1:]:
        met = met & condition.column()
    return met


def without_complements(rules: Sequence[Rule]) -> list[Rule]:
    """Of two rules of one condition that are each other's opposite, the first is enough beside an intercept."""
    kept: set[Rule] = set()
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        opposite = (Condition(rule[0].name, not rule[0].above, rule[0].threshold),)
        if len(rule) > 1 or opposite not in kept:
            kept.add(rule)
    return sorted(kept, key=lambda r: (len(r), r))


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1, over columns named as in ``statistics``."""
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(labelled: DataFrame, names: Sequence[str], label: str) -> RuleEnsemble:
    """``labelled``: statistics and a label 0 or 1; it is read several times, so it should be stored."""
    counts = {int(r[0]): r[1] for r in labelled.groupBy(F.col(label).cast("int")).count().collect()}
    if not counts.get(0) or not counts.get(1):
        return RuleEnsemble(0.0 if not counts else 30.0 if counts.get(1) else -30.0, ())
    rows = VectorAssembler(inputCols=list(names), outputCol="_features").transform(
        labelled.withColumn("_label", F.col(label).cast("double"))
    )
    forest = RandomForestClassifier(
        featuresCol="_features",
        labelCol="_label",
        numTrees=TREES,
        maxDepth=DEPTH,
        maxBins=BINS,
        minInstancesPerNode=LEAST_ROWS,
        featureSubsetStrategy="onethird",
        subsamplingRate=0.7,
        seed=SEED,
    ).fit(rows.select("_features", "_label"))
    rules = without_complements(set().union(*(paths(tree.toDebugString, names) for tree in forest.trees)))
    if not rules:  # no statistic tells the classes apart
        share = counts[1] / (counts[0] + counts[1])
        return RuleEnsemble(math.log(share / (1 - share)), ())
    met = F.array(*[rule_column(rule).cast("double") for rule in rules])
    model = LogisticRegression(
        featuresCol="_met", labelCol="_label", elasticNetParam=1.0, regParam=PENALTY, maxIter=100
    ).fit(rows.select(array_to_vector(met).alias("_met"), "_label"))
    weights = zip(rules, (float(w) for w in model.coefficients.toArray()))
    return RuleEnsemble(float(model.intercept), tuple((rule, w) for rule, w in weights if w))


def bounded(labelled: DataFrame, most: int) -> DataFrame:
    """All rows, or about ``most`` of them by a hash of the document's id where there are more."""
    total = labelled.count()
    if total <= most:
        return labelled
    return labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < int(most / total * (1 << 20)))


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics): one narrow row per document, stored."""
    found = docs.select("doc_id", F.struct(*[c.alias(n) for n, c in statistics(F.col("text")).items()]).alias("_s"))
    return stored(found.select("doc_id", "_s.*"), "statistics")


def learned(known: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> RuleEnsemble:
    """The ensemble, from the labelled rows that are not held out."""
    names = [c for c in known.columns if c != "doc_id"]
    marked = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = known.join(marked.select("doc_id", F.col(label).alias("_mark")), "doc_id")
    return fit(stored(bounded(rows, most), "labelled"), names, "_mark")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document."""
    known = text_statistics(docs)
    ensemble = learned(known, labels)
    scored = known.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
