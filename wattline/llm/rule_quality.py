"""Quality classifier as a sparse rule ensemble.

Statistics of each whole text are numbers. Shallow boosted trees on a labelled sample are read as rules: every path from a root to a
node is a conjunction of comparisons. A lasso logistic regression over the rules' truth values keeps few of them, and these are
compiled into one Spark column expression, so scoring is generated code without a model object.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.batches import pieces, text_bytes
from wattline.storage import materialize

#: Labelled rows in the training sample, about; the only sample in this module.
TRAIN_ROWS = 20_000
TREES = 20
DEPTH = 3
LASSO = 2e-3

#: Names of the statistics; shares are of bytes or words, logs are of 1 + count.
STATISTICS = (
    "log_bytes", "log_words", "mean_word", "longest_word", "upper_share", "digit_share", "space_share", "line_share", "stop_share",
    "comma_share", "mark_share", "symbol_share", "pipe_share", "brace_share", "high_share", "bytes_per_word_spread", "repeated_words", "repeated_lines",
)

_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate(
    (bytes(range(65, 91)), b"0123456789", b" \t\v\f\r", b"\n", b".", b",;:", b"!?", b"#$%&*+=@^_~/\\<>", b"|", b"(){}[]\"'`", bytes(range(128, 256))), start=1
):
    _CLASS[list(_chars)] = _k
_CLASSES = 12


def text_statistics(raw: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` per text; a text without bytes has zeros."""
    n = len(borders) - 1
    size = np.diff(borders)
    owner = np.repeat(np.arange(n), size)
    counts = np.bincount(owner * _CLASSES + _CLASS[raw], minlength=n * _CLASSES).reshape(n, _CLASSES).astype(float)
    some = np.maximum(size, 1)
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.zeros(len(raw), bool)
    edge[borders[:-1][size > 0]] = True
    starts = np.flatnonzero(~gap & (edge | np.r_[True, gap[:-1]])) if len(raw) else np.empty(0, np.int64)
    closing = np.zeros(len(raw), bool)
    closing[borders[1:][size > 0] - 1] = True
    ends = np.flatnonzero(~gap & (closing | np.r_[gap[1:], True])) + 1 if len(raw) else np.empty(0, np.int64)
    length = (ends - starts).astype(float)
    of = owner[starts] if len(starts) else np.empty(0, np.int64)
    words = np.bincount(of, minlength=n).astype(float)
    some_words = np.maximum(words, 1)
    mean = np.bincount(of, length, n) / some_words
    spread = np.sqrt(np.maximum(np.bincount(of, length * length, n) / some_words - mean * mean, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, of, length)

    def repeats(begin: np.ndarray, end: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Share of a text's spans that equal an earlier span of it (by a 64-bit hash)."""
        if not len(begin):
            return np.zeros(n)
        power = np.cumprod(np.full(len(raw), 0x100000001B3, np.uint64))
        total = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(7)) * power)]
        # spans are compared at a common place: times the power that is missing up to the end
        value = (total[end] - total[begin]) * power[len(raw) - 1 - begin]
        order = np.lexsort((value, who))
        same = (value[order][1:] == value[order][:-1]) & (who[order][1:] == who[order][:-1])
        spans = np.maximum(np.bincount(who, minlength=n), 1)
        return np.bincount(who[order][1:][same], minlength=n) / spans

    breaks = np.flatnonzero((raw == 10) | closing)
    line_begin = np.r_[0, breaks[:-1] + 1] if len(breaks) else np.empty(0, np.int64)
    line_end = np.where(raw[breaks] == 10, breaks, breaks + 1) if len(breaks) else np.empty(0, np.int64)
    filled = line_end > line_begin
    line_begin, line_end = line_begin[filled], line_end[filled]
    lines = owner[line_begin] if len(line_begin) else np.empty(0, np.int64)
    part = counts / some[:, None]
    return np.column_stack(
        [np.log1p(size), np.log1p(words), mean, np.log1p(longest), part[:, 1], part[:, 2], part[:, 3], part[:, 4], part[:, 5], part[:, 6], part[:, 7],
         part[:, 8], part[:, 9], part[:, 10], part[:, 11], spread, repeats(starts, ends, of), repeats(line_begin, line_end, lines)]
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (struct of all columns of ``docs``) and one double per statistic, over whole texts.

    Null texts count as empty: every statistic 0. No shuffle.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    return _statistics(row, row.schema["row"].dataType.simpleString())


def _statistics(row: DataFrame, row_type: str) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "text"):
                table = text_statistics(*text_bytes(piece.column("text")))
                yield pa.RecordBatch.from_arrays([piece.column("row"), *[pa.array(table[:, k]) for k in range(len(STATISTICS))]], ["row", *STATISTICS])

    return row.mapInArrow(run, f"row {row_type}, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is at most, threshold), and its weight."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        out = F.lit(True)
        for name, at_most, threshold in self.terms:
            out = out & ((F.col(name) <= threshold) if at_most else (F.col(name) > threshold))
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self) -> Column:
        """The probability as one column expression over the statistics."""
        total = F.lit(float(self.intercept))
        for rule in self.rules:
            total = total + F.when(rule.column(), F.lit(float(rule.weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def tree_rules(trees) -> list[Rule]:
    """All distinct paths, to inner nodes and leaves, of fitted Spark trees. A later bound on the same side replaces an earlier one."""
    found: dict[tuple, Rule] = {}

    def walk(node, bounds: dict[tuple[str, bool], float]) -> None:
        if bounds:
            terms = tuple((name, side, value) for (name, side), value in sorted(bounds.items()))
            found.setdefault(terms, Rule(terms))
        if node.getClass().getSimpleName() != "InternalNode":
            return
        name, value = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
        low, high = bounds.get((name, True), np.inf), bounds.get((name, False), -np.inf)
        walk(node.leftChild(), bounds | {(name, True): min(low, value)})
        walk(node.rightChild(), bounds | {(name, False): max(high, value)})

    for tree in trees:
        walk(tree._call_java("rootNode"), {})
    return list(found.values())


def fit_rules(labelled: DataFrame, train_rows: int = TRAIN_ROWS, seed: int = 5, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleEnsemble:
    """Fit on ``labelled`` (key, text, label 0 or 1).

    At most about ``train_rows`` rows are used, chosen by a hash of key and seed; rows without a label are left out, null
    texts count as empty. Without rows of both labels the ensemble has no rule and its score is the smoothed share of
    label 1.
    """
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    known = labelled.where(F.col("label").isin(0, 1)).select("key", "text", F.col("label").cast("double").alias("label"))
    count = known.count()
    share = min(1.0, train_rows / max(count, 1))
    drawn = known.where(F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30)) < int(share * (1 << 30)))
    drawn = drawn.repartition(2 * labelled.sparkSession.sparkContext.defaultParallelism)
    rows = _statistics(drawn.select(F.col("label").alias("row"), "text"), "double").withColumnRenamed("row", "label")
    rows = materialize(rows, "quality-train")
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).first()
    n, good = int(sums["n"]), float(sums["good"] or 0)
    if good in (0, n):
        p = (good + 1) / (n + 2)
        return RuleEnsemble((), float(np.log(p / (1 - p))))
    points = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows).select("label", "features", *STATISTICS)
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, minInstancesPerNode=5).fit(points.select("label", "features"))
    rules = tree_rules(boosted.trees)
    if not rules:
        p = (good + 1) / (n + 2)
        return RuleEnsemble((), float(np.log(p / (1 - p))))
    truth = rows.select("label", F.array(*[r.column().cast("double") for r in rules]).alias("truth"))
    from pyspark.ml.functions import array_to_vector

    vectors = truth.select("label", array_to_vector("truth").alias("features"))
    fitted = LogisticRegression(maxIter=60, regParam=lasso, elasticNetParam=1.0, standardization=False, tol=1e-6).fit(vectors)
    weights = fitted.coefficients.toArray()
    kept = tuple(Rule(r.terms, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6)
    return RuleEnsemble(kept, float(fitted.intercept))


def score_quality(docs: DataFrame, ensemble: RuleEnsemble, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Score every whole text: ``row`` (struct of all columns of ``docs``), ``score``, ``predicted``.

    Null and empty texts have statistics of 0 and are scored by the rules that hold for them. Repeated rows and equal
    texts score alike; an empty table gives an empty result. No shuffle.
    """
    scored = with_statistics(docs, text).select("row", ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
