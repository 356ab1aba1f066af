"""Quality classifier: a sparse ensemble of rules over text statistics.

1. ``with_statistics``: statistics of a text as native column expressions.
2. ``fit``: shallow random-forest trees are grown on labelled rows; every path
   from a root is a conjunctive rule. A logistic regression with an L1 penalty
   weighs the rules, and most weights become zero.
3. ``RuleModel.score``: the rules left are compiled into one column expression,
   so scoring is a scan without Python or shuffle.

The fit sees about ``FIT_ROWS`` labelled rows, drawn by a hash of the id; scoring
covers all rows. Null text counts as empty. Null labels are left
out; an id labelled more than once counts with its smallest label. With labels
of one kind only (or none) the score is the smoothed share of label 1.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import SPACE_REGEX, fold, saved

#: Expected number of labelled rows that the fit sees, and the tasks it is dealt to.
FIT_ROWS, FIT_TASKS = 20_000, 4
TREES, DEPTH = 20, 3
#: Weight of the L1 penalty.
PENALTY = 2e-3
THRESHOLD = 0.3
HELD_OUT_MOD = 5


def _share(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")) / F.greatest(F.length(text), F.lit(1))


def _over(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(1))


#: Name -> expression of (text, its words, its lines with a word, its distinct words).
STATISTICS: dict[str, Callable[[Column, Column, Column, Column], Column]] = {
    "chars": lambda t, w, li, u: F.log1p(F.length(t)),
    "words": lambda t, w, li, u: F.log1p(F.size(w)),
    "word_length": lambda t, w, li, u: _over(F.length(t), F.size(w)),
    "words_per_line": lambda t, w, li, u: F.log1p(_over(F.size(w), F.size(li))),
    "distinct_words": lambda t, w, li, u: _over(F.size(u), F.size(w)),
    "distinct_lines": lambda t, w, li, u: _over(F.size(F.array_distinct(li)), F.size(li)),
    "symbols": lambda t, w, li, u: _share(t, "#*$%&|<>{}~^\\\\"),
    "exclamations": lambda t, w, li, u: _share(t, "!"),
    "digits": lambda t, w, li, u: _share(t, "0-9"),
    "capitals": lambda t, w, li, u: _share(t, r"\p{Lu}"),
    "stops": lambda t, w, li, u: _over(F.regexp_count(t, F.lit(r"[.?]")), F.size(w)),
    "commas": lambda t, w, li, u: _over(F.regexp_count(t, F.lit(",")), F.size(w)),
}


def with_statistics(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` (its columns must not be named ``__*``) with one ``__<statistic>`` double each."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = (df.withColumn("__t", text)
             .withColumn("__w", F.filter(F.split("__t", SPACE_REGEX), lambda w: w != ""))
             .withColumn("__li", F.filter(F.split("__t", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
             .withColumn("__u", F.array_distinct("__w")))
    cols = [F.col(c) for c in ("__t", "__w", "__li", "__u")]
    return parts.select(*df.columns, *[fn(*cols).cast("double").alias(f"__{k}") for k, fn in STATISTICS.items()])


@dataclass(frozen=True)
class Rule:
    """All of its conditions (statistic, is at most, threshold) hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, at_most, value in self.conditions:
            c = F.col(f"__{name}")
            out = out & ((c <= F.lit(value)) if at_most else (c > F.lit(value)))
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1, over the columns of :func:`with_statistics`."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _paths(node, names: list[str], so_far: tuple = ()) -> set[Rule]:
    """The rules of a fitted tree: the conditions on the way to every node below the root."""
    out = {Rule(_simplified(so_far))} if so_far else set()
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        name, value = names[split.featureIndex()], float(split.threshold())
        out |= _paths(node.leftChild(), names, (*so_far, (name, True, value)))
        out |= _paths(node.rightChild(), names, (*so_far, (name, False, value)))
    return out


def _simplified(conditions: tuple) -> tuple:
    """At most one upper and one lower bound for each statistic."""
    best: dict[tuple[str, bool], float] = {}
    for name, at_most, value in conditions:
        old = best.get((name, at_most))
        best[name, at_most] = value if old is None else (min if at_most else max)(old, value)
    return tuple((n, m, v) for (n, m), v in sorted(best.items()))


def fit(labelled: DataFrame, label_col: str, seed: int = 17) -> RuleModel:
    """Rules and weights from rows with statistics and a 0/1 label; each row weighs one."""
    kinds = {r["label"]: r["n"] for r in labelled.groupBy(F.col(label_col).alias("label")).agg(
        F.count("*").alias("n")).collect()}
    ones, total = kinds.get(1, 0), sum(kinds.values())
    if len(kinds) < 2:
        import math
        share = (ones + 1) / (total + 2)
        return RuleModel(math.log(share / (1 - share)), ())
    names = list(STATISTICS)
    rows = VectorAssembler(inputCols=[f"__{n}" for n in names], outputCol="__x").transform(
        labelled.withColumn("__y", F.col(label_col).cast("double")))
    forest = RandomForestClassifier(featuresCol="__x", labelCol="__y", numTrees=TREES, maxDepth=DEPTH,
                                    featureSubsetStrategy="sqrt", seed=seed).fit(rows)
    rules = sorted({r for tree in forest.trees for r in _paths(tree._call_java("rootNode"), names)},
                   key=lambda r: r.conditions)
    applied = labelled.select(F.col(label_col).cast("double").alias("__y"),
                              *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    lasso = LogisticRegression(featuresCol="__r", labelCol="__y", elasticNetParam=1.0, regParam=PENALTY,
                               standardization=False, maxIter=60)
    model = lasso.fit(VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="__r")
                      .transform(applied).select("__y", "__r"))
    weights = model.coefficients.toArray().tolist()
    return RuleModel(float(model.intercept), tuple((r, w) for r, w in zip(rules, weights) if w != 0.0))


def fitted_model(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality") -> RuleModel:
    """The model from the labels whose id is not held out."""
    labels = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, label_col)
              .where(fold(id_col, HELD_OUT_MOD) != 0).groupBy(id_col).agg(F.min(label_col).alias("__label")))
    labels = saved(labels, "rule-labels")
    share = min(1.0, FIT_ROWS / max(1, labels.count()))
    drawn = labels.where(F.pmod(F.xxhash64(id_col, F.lit(41)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about FIT_ROWS ids and labels, so they may be broadcast
    texts = documents.select(F.col(id_col), F.col(text_col).alias("__text")).join(F.broadcast(drawn), id_col)
    rows = saved(with_statistics(texts.select("__label", "__text"), "__text").drop("__text"), "rule-rows")
    # a few hundred bytes a row: the fit runs dozens of jobs over it, each with few tasks
    return fit(saved(rows.coalesce(FIT_TASKS), "rule-fit"), "__label")


def classify(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with held_out, score and predicted; input columns of these names are replaced."""
    model = fitted_model(documents, labels, id_col, text_col, label_col)
    others = [c for c in documents.columns if c not in ("held_out", "score", "predicted") or c in (id_col, text_col)]
    rows = documents.select(F.struct(*others).alias("row"), F.col(text_col).alias("text"),
                            (fold(id_col, HELD_OUT_MOD) == 0).alias("held_out"))
    return (with_statistics(rows, "text").select("row.*", "held_out", model.score().alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(documents.select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")
