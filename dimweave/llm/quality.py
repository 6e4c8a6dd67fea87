"""Quality scores from a sparse ensemble of rules.

Every text gets a row of statistics. A small forest is grown on labelled rows; each path from a root is a
rule, the conjunction of its comparisons. A logistic model with an L1 penalty weighs the rules and drops
most. What is left is compiled into one column expression, so scoring is a narrow step without
Python. Statistics come from the text alone: labels, lang, source and doc_id are never inputs.

Training uses rows with a known label whose ``crc32(doc_id as text) mod 5`` is not 0, and of these a
sample by hash of about ``TRAIN_ROWS`` rows. The forest and the logistic model are Spark ML's.

Nulls and ties: a null text is empty, and an empty text has statistics of zero and is scored like any
other. A null doc_id has no label, counts as held out and is scored. Repeated rows are scored one by
one. With no usable label every score is 0.5, with labels of one value the score is that value.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import materialize

TRAIN_ROWS = 20_000
TREES, DEPTH, PENALTY = 12, 3, 0.001
THRESHOLD = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a text, each between 0 and 1 or the logarithm of a count."""
    chars = F.length(text)

    def share(pattern: str) -> Column:
        return F.when(chars > 0, F.regexp_count(text, F.lit(pattern)) / chars).otherwise(0.0)

    words = F.filter(F.split(text, "\\s"), lambda w: w != "")
    lines = F.split(text, "\n")
    n, n_lines = F.size(words), F.size(lines)
    return {  # in the order of NAMES
        "symbols": share("[*$%&#@~^<>=_+|\\\\{}\\[\\]]"),
        "marks": share("[!?]"),
        "stops": share("[.,;:]"),
        "capitals": share("\\p{Lu}"),
        "digits": share("[0-9]"),
        "pipes": share("\\|"),
        "other": share("[^\\p{L}\\p{N}\\p{P}\\p{S}\\s]"),
        "distinct_words": F.when(n > 0, F.size(F.array_distinct(words)) / n).otherwise(0.0),
        "word_length": F.when(n > 0, F.log1p((chars - F.size(lines)) / n)).otherwise(0.0),
        "line_length": F.log1p(chars / n_lines),
        "log_chars": F.log1p(chars),
    }


NAMES = ["symbols", "marks", "stops", "capitals", "digits", "pipes", "other", "distinct_words", "word_length", "line_length", "log_chars"]


@dataclass
class RuleModel:
    """Weighted rules; a rule is a tuple of (statistic, "<=" or ">", value)."""

    bias: float
    rules: dict[tuple, float] = field(default_factory=dict)

    def score(self, stats: dict[str, Column]) -> Column:
        """Probability of label 1 as one column expression."""
        terms = [F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules.items()]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(Column.__add__, terms, F.lit(self.bias))))


def holds(rule: tuple, stats: dict[str, Column]) -> Column:
    tests = [stats[name] <= F.lit(value) if sign == "<=" else stats[name] > F.lit(value) for name, sign, value in rule]
    return reduce(Column.__and__, tests)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def tree_rules(description: str) -> list[tuple]:
    """All paths from the root of trees printed by Spark ML, each without repeated or implied comparisons."""
    rules, path = [], []
    top = None
    for line in description.splitlines():
        if re.match(r"\s*Tree \d", line):
            top = None
        found = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dE]+)\)", line)
        if found:
            top = len(found[1]) if top is None else top
            path = [*path[: len(found[1]) - top], (NAMES[int(found[2])], found[3], float(found[4]))]
            tight: dict[tuple, float] = {}
            for name, sign, value in path:
                own = tight.get((name, sign), value)
                tight[name, sign] = min(own, value) if sign == "<=" else max(own, value)
            rules.append(tuple(sorted((*k, v) for k, v in tight.items())))
    return list(dict.fromkeys(rules))


def chosen_labels(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``label`` of the rows to learn from: by hash, about ``TRAIN_ROWS``."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where("label in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.where("doc_id is not null").distinct()
    total = known.count()
    keep = min(1.0, TRAIN_ROWS / max(1, total))
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(keep * 1_000_000))


def fit(stats: DataFrame, labels: DataFrame) -> RuleModel:
    """Fit on ``stats`` (doc_id and the statistics) and ``labels`` (doc_id, quality)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rows = materialize(stats.join(chosen_labels(labels), "doc_id"), "training")
    count, mean = rows.agg(F.count(F.lit(1)), F.avg("label")).first()
    if not count or mean in (0.0, 1.0):
        return RuleModel({None: 0.0, 0.0: -1e3, 1.0: 1e3}[mean])
    inputs = rows.select("label", array_to_vector(F.array(*NAMES)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=7, subsamplingRate=0.7, featureSubsetStrategy="0.6").fit(inputs)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleModel(math.log(mean / (1 - mean)))
    columns = {name: F.col(name) for name in NAMES}
    fired = F.array(*(holds(rule, columns).cast("double") for rule in rules))
    inputs = materialize(rows.select("label", fired.alias("fired")), "rules").select("label", array_to_vector("fired").alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(inputs)
    weights = {rule: float(w) for rule, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w}
    return RuleModel(float(lasso.intercept), weights)


def with_statistics(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", *(c.cast("double").alias(name) for name, c in statistics(text).items()))


def scores(stats: DataFrame, model: RuleModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``stats``."""
    scored = stats.select("doc_id", model.score({n: F.col(n) for n in NAMES}).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, with all their columns."""
    known = F.broadcast(chosen_labels(labels).select("doc_id"))  # at most about TRAIN_ROWS
    model = fit(with_statistics(docs.join(known, "doc_id", "left_semi")), labels)
    whole = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    whole = whole.select("row", F.struct(*(c.cast("double").alias(n) for n, c in statistics(text).items())).alias("stats"))
    score = model.score({n: F.col(f"stats.{n}") for n in NAMES})
    # A generated column: a filter on it stays above, else each rule would compute its statistics anew.
    return whole.select("row", F.explode(F.array(score)).alias("score")).where(F.col("score") >= THRESHOLD).select("row.*")
