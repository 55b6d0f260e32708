"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed character n-grams, cut at code points, in lower case by Unicode. Features whose share differs clearly between
toxic and other training texts are kept; each is scaled by the log ratio of its smoothed frequencies in both, and a logistic
regression with an L2 penalty is fitted on the scaled features, with both labels weighing the same in all. Presence, not frequency, counts, so one
insult in a long text weighs as much as in a short one.

The model is fitted on a bounded, documented sample of the labelled rows; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.batches import pieces
from wattline.storage import materialize

#: Sizes of the character windows, in code points.
SIZES = (3, 4, 5, 6)
#: Features are hashed to this many bits, which bounds the counts and the model: 2^20 slots.
BITS = 20
#: Labelled rows in the training sample, about; the only sample in this module.
TRAIN_ROWS = 12_000
#: Features kept: those whose shares differ by so many standard errors. Others are noise of the sample.
LEAST_DEVIATION = 5.0
#: Characters of a text that are taken together.
BLOCK_POINTS = 1 << 17
#: Tasks that count the sample; each sends one row per slot it has seen.
COUNT_TASKS = 8
SMOOTHING = 1.0
PENALTY = 1e-3

_PRIME, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str | None) -> np.ndarray:
    """The characters of a text in lower case, as numbers."""
    return np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_slots(points: np.ndarray, sizes: Sequence[int] = SIZES, bits: int = BITS) -> np.ndarray:
    """Slots of the n-grams of one text, given its code points; with every size in turn. Longer windows go on from the shorter ones."""
    wide = points.astype(np.uint64)
    out = []
    mixed, done = np.full(len(wide), 1, np.uint64), 0
    for n in sorted(sizes):
        if len(wide) < n:
            break
        for k in range(done, n):
            mixed = mixed[: len(wide) - k]
            mixed = (mixed ^ wide[k:]) * _PRIME
            mixed ^= mixed >> np.uint64(29)
        done = n
        out.append((mixed * _SPREAD >> np.uint64(64 - bits)).astype(np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether the checksum of the id, as text, leaves the remainder that is kept for testing; a null id does not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


@dataclass(frozen=True)
class ToxicityModel:
    """Slots of the kept features in ascending order, and their weights."""

    slots: np.ndarray
    weights: np.ndarray
    intercept: float
    sizes: tuple[int, ...] = SIZES
    bits: int = BITS

    def places(self) -> np.ndarray:
        """For each slot its place among the kept features, or -1."""
        out = np.full(1 << self.bits, -1, np.int32)
        out[self.slots] = np.arange(len(self.slots))
        return out

    def score(self, points: np.ndarray, places: np.ndarray) -> float:
        """Probability for one text, given its code points."""
        total = float(self.weights[kept_features(points, places, self.sizes, self.bits)].sum()) + self.intercept
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -30, 30))))


def distinct_slots(points: np.ndarray, sizes: Sequence[int], bits: int, places: np.ndarray | None = None) -> np.ndarray:
    """The distinct slots of a text, or with ``places`` the places of those that have one. A long text is taken in blocks that share their borders."""
    found = []
    for begin in range(0, max(len(points), 1), BLOCK_POINTS):
        met = gram_slots(points[begin : begin + BLOCK_POINTS + max(sizes) - 1], sizes, bits)
        if places is not None:
            met = places[met]
            met = met[met >= 0]
        found.append(np.unique(met))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def kept_features(points: np.ndarray, places: np.ndarray, sizes: Sequence[int], bits: int) -> np.ndarray:
    """Places of the kept features that a text has."""
    return distinct_slots(points, sizes, bits, places)


def _each_text(batches):
    """(label, code points) of the rows of ``label, text`` batches."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            for label, text in zip(piece.column("label").to_pylist(), piece.column("text").to_pylist(), strict=True):
                yield label, code_points(text)


def _count_slots(train: DataFrame, sizes: Sequence[int], bits: int) -> DataFrame:
    """Texts and toxic texts that have each slot; counted in each task before rows are sent."""

    def run(batches):
        import pyarrow as pa

        counts = np.zeros((2, 1 << bits), np.int32)
        for label, points in _each_text(batches):
            counts[label, distinct_slots(points, sizes, bits)] += 1
        slots = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(counts[0, slots]), pa.array(counts[1, slots])], ["slot", "other", "toxic"])

    parts = train.repartition(COUNT_TASKS).mapInArrow(run, "slot int, other int, toxic int")
    return parts.groupBy("slot").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))


def fit_toxicity(labelled: DataFrame, train_rows: int = TRAIN_ROWS, seed: int = 5, sizes: Sequence[int] = SIZES, bits: int = BITS) -> ToxicityModel:
    """Fit on ``labelled`` (key, text, label 0 or 1).

    At most about ``train_rows`` rows are used, chosen by a hash of key and seed; rows without a label are left out, null
    texts count as empty. Without rows of both labels, or without a clear feature, the model is the smoothed share of
    label 1, whatever the text.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector, VectorUDT

    spark = labelled.sparkSession
    known = labelled.where(F.col("label").isin(0, 1)).select("key", "text", F.col("label").cast("int").alias("label"))
    share = min(1.0, train_rows / max(known.count(), 1))
    drawn = known.where(F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30)) < int(share * (1 << 30)))
    train = materialize(drawn.select("label", "text"), "toxicity-train")
    sums = train.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    toxic = int(sums["toxic"] or 0)
    other = int(sums["n"]) - toxic
    prior = ToxicityModel(np.empty(0, np.int64), np.empty(0), float(np.log((toxic + 1) / (other + 1))), tuple(sizes), bits)
    if not toxic or not other:
        return prior
    counted = _count_slots(train, sizes, bits)
    p, q, all_ = F.col("toxic") / toxic, F.col("other") / other, (F.col("toxic") + F.col("other")) / (toxic + other)
    error = F.sqrt(all_ * (1 - all_) * (1 / toxic + 1 / other))
    clear = (
        counted.withColumn("deviation", F.abs(p - q) / F.greatest(error, F.lit(1e-9)))
        .where(F.col("deviation") >= LEAST_DEVIATION)
        .orderBy("slot")
        .select("slot", "other", "toxic")
        .toPandas()  # at most a row for each of the 2^20 slots
    )
    if clear.empty:
        return prior
    slots = clear["slot"].to_numpy().astype(np.int64)
    ratio = np.log((clear["toxic"] + SMOOTHING) / (toxic + 2 * SMOOTHING)) - np.log((clear["other"] + SMOOTHING) / (other + 2 * SMOOTHING))
    ratio = ratio.to_numpy()
    shared = spark.sparkContext.broadcast((slots, ratio))

    def features(batches):
        import pyarrow as pa

        places = ToxicityModel(*shared.value, 0.0, tuple(sizes), bits).places()
        labels, found = [], []
        for label, points in _each_text(batches):
            labels.append(label)
            found.append(kept_features(points, places, sizes, bits).astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(found, pa.list_(pa.int32()))], ["label", "found"])

    width, scale = len(slots), ratio

    @F.udf(VectorUDT())
    def scaled(found):
        return SparseVector(width, found, [float(scale[k]) for k in found])

    found = train.mapInArrow(features, "label int, found array<int>")
    # both labels weigh the same in all, however rare one is
    balance = F.when(F.col("label") == 1, (toxic + other) / (2.0 * toxic)).otherwise((toxic + other) / (2.0 * other))
    points = found.select(F.col("label").cast("double").alias("label"), balance.alias("weight"), scaled("found").alias("features"))
    learner = LogisticRegression(maxIter=60, regParam=PENALTY, elasticNetParam=0.0, standardization=False, tol=1e-6, weightCol="weight")
    fitted = learner.fit(points)
    return ToxicityModel(slots, np.asarray(fitted.coefficients.toArray()) * ratio, float(fitted.intercept), tuple(sizes), bits)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Score every whole text. Returns ``row`` (struct of all columns of ``docs``), ``score`` and ``predicted``.

    Null and empty texts have no features and get the score of the intercept; repeated rows and equal texts score
    alike; an empty table gives an empty result. No shuffle; the model is broadcast, its size is bounded.
    """
    from pyspark.sql.functions import ArrowUDFType, arrow_udf

    # plain values: a broadcast is unpickled before the package can be
    shared = docs.sparkSession.sparkContext.broadcast((model.slots, model.weights, model.intercept, model.sizes, model.bits))

    def score(arrays):
        import pyarrow as pa

        known = ToxicityModel(*shared.value)
        places = known.places()
        for array in arrays:
            scores = [np.empty(0)]
            for piece in pieces(pa.RecordBatch.from_arrays([array], ["text"]), "text"):
                scores.append(np.array([known.score(code_points(t), places) for t in piece.column("text").to_pylist()]))
            yield pa.array(np.concatenate(scores))

    # only the text goes to Python; the row stays where it is. Not deterministic: it is to run once, whatever refers to it
    column = arrow_udf(score, "double", ArrowUDFType.SCALAR_ITER).asNondeterministic()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), column(F.col(text)).alias("score"))
    return row.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
