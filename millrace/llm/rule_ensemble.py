"""A quality classifier made of rules over text statistics.

Small random trees are fitted to statistics of labelled texts, every path from a root becomes a conjunctive rule, a
logistic model with a lasso penalty keeps few of the rules, and those are compiled into one Spark column expression, so
that scoring is a projection without Python.

Defined cases: a null text counts as empty, and an empty text is scored by its statistics, all zero; null labels and ids
do not train; a document with several label rows has their majority, and 1 on a tie; without labelled rows every score
is 0.5, and with labels of one kind it is that kind's share with one added to either side. Other columns pass through;
columns of the input that carry the names of the results, in any case, are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import checkpoint, labelled_sample

#: Labelled rows that the model is fitted on, on average at most.
SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 24, 3, 42
#: Strength of the lasso, and the share of the sample that a rule must apply to, and must leave out.
LASSO, SUPPORT = 0.002, 0.005
#: Score from which a text is predicted to be of label 1.
THRESHOLD = 0.3

WORD_BREAK = r"[\x20\x09-\x0D]+"


def _share(text: Column, pattern: str, n: Column) -> Column:
    """Share of the characters that belong to matches of the pattern."""
    return (n - F.length(F.regexp_replace(text, pattern, ""))) / F.greatest(n, F.lit(1))


def statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """The rows with a column for each statistic, and the names of these columns."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, WORD_BREAK), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")
    cut = docs.withColumn("_words", words).withColumn("_lines", lines)
    n, n_words, n_lines = F.length(t), F.size("_words"), F.size("_lines")
    some_words, some_lines = F.greatest(n_words, F.lit(1)), F.greatest(n_lines, F.lit(1))
    following = F.slice("_words", 2, F.greatest(n_words - 1, F.lit(0)))
    made = {
        "_s_chars": n.cast("double"),
        "_s_words": n_words.cast("double"),
        "_s_word_length": F.length(F.regexp_replace(t, WORD_BREAK, "")) / some_words,
        "_s_upper": _share(t, r"\p{Lu}+", n),
        "_s_digits": _share(t, r"\p{N}+", n),
        "_s_symbols": _share(t, r"[#*$%&|<>]+", n),
        "_s_exclaims": _share(t, r"[!?]+", n),
        "_s_bars": _share(t, r"[|]+", n),
        "_s_letters": _share(t, r"\p{L}+", n),
        "_s_distinct_words": F.log1p(F.size(F.array_distinct("_words"))) / F.log1p(some_words),
        "_s_repeats": F.size(F.filter(F.zip_with(F.slice("_words", 1, F.greatest(n_words - 1, F.lit(0))), following, lambda a, b: a == b), lambda x: x)) / some_words,
        "_s_distinct_lines": F.size(F.array_distinct("_lines")) / some_lines,
        "_s_line_words": n_words / some_lines,
        "_s_line_marks": _share(t, r"[.,;:]+", n),
    }
    return cut.withColumns({k: v.cast("double") for k, v in made.items()}).drop("_words", "_lines"), list(made)


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics that must all hold: above < x <= upto."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        out = None
        for name, above, upto in self.bounds:
            for c in ([F.col(name) > above] if above > -math.inf else []) + ([F.col(name) <= upto] if upto < math.inf else []):
                out = c if out is None else out & c
        return out

    def __str__(self) -> str:
        return " and ".join(f"{above:.4g} < {name.removeprefix('_s_')} <= {upto:.4g}" for name, above, upto in self.bounds)


@dataclass
class Model:
    intercept: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def paths(node, names: list[str], bounds: dict[str, tuple[float, float]] | None = None):
    """Every path from a tree's root to a node below it, as a rule."""
    bounds = bounds or {}
    if bounds:
        yield Rule(tuple((k, *v) for k, v in sorted(bounds.items())))
    if node.getClass().getSimpleName() == "InternalNode":
        name, cut = names[node.split().featureIndex()], float(node.split().threshold())
        above, upto = bounds.get(name, (-math.inf, math.inf))
        yield from paths(node.leftChild(), names, bounds | {name: (above, min(upto, cut))})
        yield from paths(node.rightChild(), names, bounds | {name: (max(above, cut), upto)})


def fit(docs: DataFrame, labels: DataFrame, label: str, text: str = "text", key: str = "doc_id", *, rows: int = SAMPLE_ROWS) -> Model:
    measured, names = statistics(labelled_sample(docs, labels, label, rows, key, text), "_text")
    sample = checkpoint(measured.select("_label", *names).repartition(4))
    found = sample.agg(F.count("*").alias("n"), F.sum("_label").alias("ones")).first()
    n, ones = found["n"], found["ones"] or 0.0
    if not n:
        return Model(0.0)
    if ones in (0.0, float(n)):
        return Model(math.log((ones + 1) / (n - ones + 1)))
    assembled = VectorAssembler(inputCols=names, outputCol="_x").transform(sample)
    forest = RandomForestClassifier(labelCol="_label", featuresCol="_x", numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5).fit(assembled)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in paths(tree._java_obj.rootNode(), names)))
    held = sample.agg(*[F.avg(r.column().cast("double")).alias(str(i)) for i, r in enumerate(rules)]).first() if rules else []
    rules = [r for r, s in zip(rules, held, strict=True) if SUPPORT <= s <= 1 - SUPPORT]
    if not rules:
        return Model(math.log(ones / (n - ones)))
    applied = sample.select("_label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    applied = checkpoint(VectorAssembler(inputCols=applied.columns[1:], outputCol="_x").transform(applied).select("_label", "_x"))
    fitted = LogisticRegression(labelCol="_label", featuresCol="_x", elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(applied)
    weights = fitted.coefficients.toArray().tolist()
    return Model(float(fitted.intercept), [(r, w) for r, w in zip(rules, weights, strict=True) if w])


def predict(docs: DataFrame, model: Model, text: str = "text", *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs with ``score`` and ``predicted``."""
    row = F.col("_row")
    measured, _ = statistics(docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text")), "_text")
    scored = measured.select("_row", model.score().alias("_score"))
    kept = [row.getField(c).alias(c) for c in docs.columns if c.lower() not in ("score", "predicted")]
    return scored.select(*kept, F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))
