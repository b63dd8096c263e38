"""Operator 2: a quality classifier as a sparse ensemble of rules.

Statistics of each whole text are gathered once. A random forest is grown over the statistics of labelled rows; every path
from a root to a node is a conjunctive rule. A logistic regression with lasso penalty weighs the rules, and the few with a
weight are compiled into Spark column expressions, so that scoring is a projection over the statistics.

The forest and the weights are fitted by Spark on a bounded sample of the labelled rows, ``rows`` of them in expectation,
taken by a hash of the id; the bound is a parameter. Everything else covers every row.

Defined results: a null text counts as empty, and an empty text has all statistics 0 and is scored as such; texts of any
length are read whole; a row whose label is null is not learned from, one labelled several times counts once, with the least
label; repeated rows are scored each; without labels of both kinds the score is the share of label 1, or 0.5 without any;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliograph.llm.common import forget_worker_state, stored

STATISTICS = ("words", "word_length", "long_words", "upper", "digits", "punctuation", "symbols", "bars", "doubled",
              "doubled_count", "repeated_next", "repeated_next_count", "distinct", "top_word", "top_word_count", "upper_words",
              "upper_word_count", "marked_words", "marked_word_count", "line_words", "repeated_lines", "entropy")


def statistics(text: str) -> tuple[float, ...]:
    """Shares and counts that tell prose from shouting, tables, stutter and strewn symbols."""
    import math
    import operator
    from collections import Counter

    import numpy as np

    raw, words = text.encode(), text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    a = np.frombuffer(raw, np.uint8)
    of = np.bincount(a, minlength=256)
    letters = int(of[65:91].sum() + of[97:123].sum())
    marks = int(of[33:48].sum() + of[58:65].sum() + of[91:97].sum() + of[123:127].sum())
    symbols = int(of[[35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 126]].sum())
    spot = (a[1:] == a[:-1]) & (a[1:] < 127) & (a[1:] > 32)
    spot &= ~(((a[1:] | 32) >= 97) & ((a[1:] | 32) <= 122)) & ~((a[1:] >= 48) & (a[1:] <= 57))
    doubled = int(np.count_nonzero(spot))
    n, size = len(words), len(a)
    counts = Counter(words)
    next_same = sum(map(operator.eq, words, words[1:]))
    top = max(counts.values())
    upper = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    marked = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:?!)\"'")
    lines = [x for x in text.split("\n") if x]
    share = of[of > 0] / size
    return (
        math.log1p(n), (size - int(of[9:14].sum()) - int(of[32])) / n, sum(c for w, c in counts.items() if len(w) > 15) / n,
        int(of[65:91].sum()) / max(1, letters), int(of[48:58].sum()) / size, marks / size, symbols / size, int(of[124]) / n,
        doubled / n, math.log1p(doubled), next_same / n, math.log1p(next_same), len(counts) / n, top / n, math.log1p(top),
        upper / n, math.log1p(upper), marked / n, math.log1p(marked), math.log1p(n / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)), float(-(share * np.log2(share)).sum()),
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, one double for each of STATISTICS) of every row, after the columns to ``keep``."""
    base = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    names = base.columns[:-1]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields[:-1]] + [f"s_{s} double" for s in STATISTICS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()
        for b in batches:
            rows = [statistics(t.as_py()) for t in b.column(len(names))]
            found = list(zip(*rows, strict=True)) if rows else [[]] * len(STATISTICS)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *(pa.array(c, pa.float64()) for c in found)],
                                             names=[*names, *(f"s_{s}" for s in STATISTICS)])

    return base.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def tree_paths(description: str) -> list[tuple[tuple[int, bool, float], ...]]:
    """Every path from a root to an inner or outer node, as (statistic, above, threshold), from a forest's description."""
    paths, at = [], []
    for line in description.splitlines():
        if m := re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(m[1])
            while at and at[-1][0] >= depth:
                at.pop()
            at.append((depth, (int(m[3]), m[4] == ">", float(m[5]))))
            paths.append(tuple(c for _, c in at))
        elif re.match(r" *Tree ", line):
            at = []
    return paths


def simplified(path: tuple[tuple[int, bool, float], ...]) -> tuple[tuple[int, bool, float], ...]:
    """The tightest bound of each statistic on each side."""
    bounds: dict[tuple[int, bool], float] = {}
    for f, above, x in path:
        held = bounds.get((f, above))
        bounds[f, above] = x if held is None else max(held, x) if above else min(held, x)
    return tuple(sorted((f, above, x) for (f, above), x in bounds.items()))


def compiled(rule: tuple[tuple[int, bool, float], ...]) -> Column:
    """A rule as a condition on the statistics."""
    name = lambda f: F.col(f"s_{STATISTICS[f]}")
    return reduce(lambda a, b: a & b, [name(f) > x if above else name(f) <= x for f, above, x in rule])


class RuleEnsemble:
    """Rules with their weights; ``score`` is a column expression over the statistics."""

    def __init__(self, intercept: float, rules: list[tuple[tuple, float]]):
        self.intercept, self.rules = intercept, rules

    def score(self) -> Column:
        total = reduce(lambda a, b: a + b, [F.when(compiled(r), F.lit(w)).otherwise(0.0) for r, w in self.rules], F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, rows: int = 50_000, trees: int = 24, depth: int = 3, lasso: float = 0.001,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> RuleEnsemble:
    """Learns from the labelled rows that are not held out, at most about ``rows`` of them; their ids are broadcast."""
    import math

    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector

    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    known = known.where("label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label")).where(~held_out(F.col("doc_id")))
    parts = 1 << 20
    share = min(1.0, rows / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < math.ceil(parts * share))
    names = [f"s_{s}" for s in STATISTICS]
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    train = stored(measure(texts.join(F.broadcast(sample), "doc_id"), keep=("label",)), "labelled")
    train = train.select(F.col("kept_0").alias("label"), *names).coalesce(8)
    total, ones = train.agg(F.count("*"), F.sum("label")).first()
    if not total or ones in (0, total):
        level = min(max((ones or 0) / total, 1e-6), 1 - 1e-6) if total else 0.5
        return RuleEnsemble(math.log(level / (1 - level)), [])
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(train)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="onethird").fit(vectors)
    rules = sorted({simplified(p) for p in tree_paths(forest.toDebugString)})
    if not rules:
        return RuleEnsemble(math.log(ones / (total - ones)), [])
    flags = train.select("label", F.array(*[compiled(r).cast("double") for r in rules]).alias("flags"))
    held = flags.select("label", array_to_vector("flags").alias("features"))
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=80, standardization=False).fit(held)
    weights = model.coefficients.toArray()
    return RuleEnsemble(float(model.intercept), [(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-9])


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
             **learning) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, with the model of ``labels``, after the columns to ``keep``.

    The kept columns are named kept_0, kept_1 and so on.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **learning)
    scored = measure(docs, id_col, text_col, keep).withColumn("score", model.score())
    return scored.select(*[f"kept_{i}" for i in range(len(keep))], "doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are predicted to be of good quality, with their columns."""
    scored = classify(docs, labels, keep=tuple(docs.columns), **settings).where("predicted = 1")
    return scored.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns)])
