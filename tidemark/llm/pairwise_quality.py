"""Quality classifier: Bradley-Terry ranking from preference pairs.

A document's score is linear in features of its whole text. Every pair of a good and a bad
labelled document is a preference; the weights minimise the logistic loss of the feature
differences (Bradley and Terry, 1952) over all pairs, with a ridge penalty, by Newton steps.
The threshold is a quantile of the scores: the share of bad labels. The score returned is
the logistic of the distance to the threshold, so 0.5 is the threshold itself.

Every label that may be learned from counts, in the weights and in the threshold. Pairs are
not made: what a pair adds to the sums of a step depends on its two scores, so documents of a
class whose scores lie within 1/``GROUPS`` are added up first, and groups are paired at their
mean scores (a pair's probability is off by about 1e-5 at most). A step is two passes over the
staged features; groups, a few numbers each, go to the driver. ``per_class`` documents of each
class only give the weights from which the steps start. The minimum is one point (the loss
is convex), so they do not decide where it lies.

Features are made in one pass over the texts and staged; no text is shuffled or read again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash60, held_out, packed, small_batches, stage
from .wordhash import pieces, raw_bytes, words_of

PER_CLASS = 6000  # of the start
PAIRS_PER_DOCUMENT = 4  # pairs of the start; all pairs together weigh as many, against the ridge
GROUPS = 64  # groups of scores per unit
_FIXED = float(1 << 20)  # sums of groups are integers, so they do not depend on order

# Character classes of ASCII bytes whose shares are features.
_CLASSES = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "symbols": b"#*$%&<>^~@\\{}[]_=+",
    "bars": b"|",
    "shouts": b"!?",
    "digits": b"0123456789",
    "stops": b".,;:",
    "breaks": b"\n",
}
FEATURES = (*_CLASSES, "distinct", "echo", "length", "word_length", "spread", "beyond")
_CLASS_OF = np.zeros(256, np.uint8)
for _i, _chars in enumerate(_CLASSES.values(), 1):
    _CLASS_OF[list(_chars)] = _i
_CLASS_OF[128:192] = 0


def features(texts: pa.Array) -> np.ndarray:
    """One row of features per text; a text without words has zeros for most."""
    data, bounds = raw_bytes(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    for a, b in pieces(bounds):
        lo = int(bounds[a])
        w = words_of(data, bounds[a:b + 1])
        kind = _CLASS_OF[data[lo:int(bounds[b])]]
        cut = bounds[a:b + 1] - lo
        n = np.maximum(np.diff(w.first), 1).astype(float)
        for j in range(len(_CLASSES)):
            out[a:b, j] = np.diff(np.searchsorted(np.flatnonzero(kind == j + 1), cut)) / n
        j = len(_CLASSES)
        length = (w.end - w.start).astype(float)
        sums = np.concatenate(([0.0], np.cumsum(length)))
        squares = np.concatenate(([0.0], np.cumsum(length * length)))
        same = np.concatenate(([0], np.cumsum(np.concatenate(([False], w.hash[1:] == w.hash[:-1])))))
        mean = np.diff(sums[w.first]) / n
        owner = w.text_of()
        pair = w.hash + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        _, at = np.unique(pair, return_index=True)
        out[a:b, j] = np.bincount(owner[at], minlength=b - a) / np.sqrt(n)
        out[a:b, j + 1] = np.maximum(same[w.first[1:]] - same[np.minimum(w.first[:-1] + 1, w.first[1:])], 0) / n
        out[a:b, j + 2] = np.log1p(np.diff(w.first))
        out[a:b, j + 3] = mean
        out[a:b, j + 4] = np.sqrt(np.maximum(np.diff(squares[w.first]) / n - mean * mean, 0))
        out[a:b, j + 5] = np.diff(np.searchsorted(np.flatnonzero(data[lo:int(bounds[b])] >= 0xC0), cut)) / n
    return out


def feature_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def compute(x: pa.Array) -> pa.Array:
        f = features(x)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1, dtype=np.int32) * f.shape[1]), pa.array(f.ravel()))

    return compute(text)


@dataclass
class Ranking:
    """score(x) = logistic((x - mean) / spread . weights - threshold)"""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float


def expand(x: np.ndarray) -> np.ndarray:
    """Features and their square roots: shares near 0 matter more than large ones."""
    return np.hstack([x, np.sqrt(np.abs(x))])


def fit_bradley_terry(differences: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-w . d)) plus ridge * |w|^2 / (2 n)."""
    n, k = differences.shape
    w = np.zeros(k)
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(differences @ w, -50, 50)))  # probability of the wrong order
        gradient = -differences.T @ p + ridge * w
        curve = (differences * (p * (1 - p))[:, None]).T @ differences + ridge * np.eye(k)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def standard(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return (expand(x) - mean) / spread


def linear(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores row by row: equal rows have equal scores wherever they stand in a batch."""
    return (z * weights).sum(axis=1)


def document_features(docs: DataFrame) -> DataFrame:
    """Staged (doc_id, held_out, text_id, x), one row per row of ``docs``."""
    out = held_out(F.col("doc_id"))
    with small_batches(docs.sparkSession):
        return stage(docs.select("doc_id", out.alias("held_out"),
                                 F.when(~out, F.md5(F.col("text").cast("binary"))).alias("text_id"),
                                 feature_column(F.col("text")).alias("x")))


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a batch of (quality, x)."""
    x = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    return x.reshape(batch.num_rows, -1), batch.column(0).to_numpy(zero_copy_only=False)


def totals(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``part(x, quality)``, a vector, over the batches of all ``rows``: one vector per
    partition goes to the driver and is added there in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [part(*_unpacked(b)) for b in batches if b.num_rows]
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([np.sum(sums, axis=0).tolist()], pa.list_(pa.float64()))], ["place", "sums"])

    got = rows.select("quality", "x").mapInArrow(run, "place int, sums array<double>").collect()
    return np.sum([r["sums"] for r in sorted(got, key=lambda r: r["place"])], axis=0)


@dataclass
class Groups:
    """Documents of one class by score: number of the group, documents, sums of their standard features."""

    place: np.ndarray
    n: np.ndarray
    sums: np.ndarray


def _place(scores: np.ndarray) -> np.ndarray:
    return np.floor(scores * GROUPS).astype(np.int64)


def score_groups(rows: DataFrame, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray) -> dict[int, Groups]:
    names = [f"z{i}" for i in range(len(weights))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = _unpacked(b)
                z = standard(x, mean, spread)
                key, at = np.unique(_place(linear(z, weights)) * 2 + y, return_inverse=True)
                sums = np.zeros((len(key), len(weights)), np.int64)
                np.add.at(sums, at, np.rint(z * _FIXED).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(np.bincount(at)), *map(pa.array, sums.T.copy())], ["key", "n", *names])

    parts = rows.select("quality", "x").mapInArrow(run, ", ".join(f"{c} long" for c in ("key", "n", *names)))
    got = np.array(parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect(), np.int64)
    got = got[np.argsort(got[:, 0])]
    return {y: Groups(g[:, 0] >> 1, g[:, 1].astype(float), g[:, 2:] / _FIXED) for y in (0, 1) for g in [got[got[:, 0] & 1 == y]]}


@dataclass
class PairSums:
    """Sums over all pairs of a good and a bad document, between the groups of two classes.

    ``shares`` has, per class, the sum of p (1 - p) over a document's pairs, p being the
    probability of the wrong order; ``cross`` sums p (1 - p) times good times bad features.
    """

    loss: float
    gradient: np.ndarray
    shares: dict[int, np.ndarray]
    cross: np.ndarray


def pair_sums(groups: dict[int, Groups], weights: np.ndarray, block: int = 256) -> PairSums:
    good, bad = groups[1], groups[0]
    k = len(weights)
    high, low = (g.sums @ weights / g.n for g in (good, bad))
    out = PairSums(0.0, np.zeros(k), {1: np.zeros(len(good.n)), 0: np.zeros(len(bad.n))}, np.zeros((k, k)))
    for a in range(0, len(good.n), block):
        b = slice(a, a + block)
        d = low[None, :] - high[b, None]
        p = 1 / (1 + np.exp(-np.clip(d, -500, 500)))
        q = p * (1 - p)
        out.loss += float(good.n[b] @ np.logaddexp(0, d) @ bad.n)
        out.gradient += (good.n[b] @ p) @ bad.sums - (p @ bad.n) @ good.sums[b]
        out.shares[1][b] = q @ bad.n
        out.shares[0] += good.n[b] @ q
        out.cross += good.sums[b].T @ (q @ bad.sums)
    return out


def fit_all_pairs(rows: DataFrame, mean: np.ndarray, spread: np.ndarray, start: np.ndarray, scale: float,
                  ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights that minimise ``scale`` * the sum over all pairs of log(1 + exp(-w . d)) + ridge * |w|^2 / 2."""
    k = len(start)

    def at(w: np.ndarray) -> tuple[dict[int, Groups], PairSums, float]:
        groups = score_groups(rows, mean, spread, w)
        sums = pair_sums(groups, w)
        return groups, sums, scale * sums.loss + ridge * float(w @ w) / 2

    w, (groups, sums, loss) = start, at(start)
    for _ in range(steps):
        places, shares, now = {y: g.place for y, g in groups.items()}, sums.shares, w

        def spreads(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = standard(x, mean, spread)
            place = _place(linear(z, now))
            share = np.where(y == 1, *(shares[c][np.minimum(np.searchsorted(places[c], place), len(places[c]) - 1)] for c in (1, 0)))
            return ((z * share[:, None]).T @ z).ravel()

        curve = scale * (totals(rows, spreads).reshape(k, k) - sums.cross - sums.cross.T) + ridge * np.eye(k)
        step = np.linalg.solve(curve, scale * sums.gradient + ridge * w)
        for _ in range(20):
            groups, sums, new = at(w - step)
            if new <= loss + 1e-6 * abs(loss):
                break
            step = step / 2
        w, gain, loss = w - step, loss - new, new
        if np.abs(step).max() < 1e-5 or gain <= 1e-7 * abs(loss):  # a document that changes its group moves as much
            break
    return w


def score_quantile(scored: DataFrame, weight: dict[int, float], q: float, parts: int = 1000) -> float:
    """Between the least score of (quality, score) up to which more than ``q`` of all weight lies
    and the next one below it. Exact: each round divides the range that holds it."""
    ends = scored.agg(F.min("score").alias("lo"), F.max("score").alias("hi"),
                      F.count_if(F.col("quality") == 1).alias("good"), F.count("*").alias("n")).first()
    lo, hi = ends["lo"], ends["hi"]
    most = q * (ends["good"] * weight[1] + (ends["n"] - ends["good"]) * weight[0]) * (1 + 1e-9)
    below, under = None, 0.0
    while lo < hi:
        place = F.floor((F.col("score") - F.lit(lo)) / F.lit(hi - lo) * parts)
        ranges = (scored.filter(F.col("score").between(lo, hi)).groupBy(place.alias("place"))
                  .agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.count_if(F.col("quality") == 1).alias("good"),
                       F.count("*").alias("n")).collect())
        for r in sorted(ranges, key=lambda r: r["place"]):
            lo, hi, here = r["lo"], r["hi"], r["good"] * weight[1] + (r["n"] - r["good"]) * weight[0]
            if under + here > most:
                break
            under, below = under + here, hi
    return lo if below is None else (lo + below) / 2


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = 3) -> Ranking | None:
    """Ranking from all labels that are not held out; None unless both classes occur.
    ``per_class`` documents of each class give the start of the fit."""
    return fit(document_features(docs), labels, per_class, seed)


def fit(known: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = 3) -> Ranking | None:
    """``train`` on ``document_features``."""
    labels = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
              .filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct())
    size = {r["quality"]: r["n"] for r in labels.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return None
    own = ["doc_id", "text_id", "quality"]
    rows, _ = packed(known.filter(~F.col("held_out")).join(labels, "doc_id").select(*own, "x")
                     .dropDuplicates(own).sortWithinPartitions(*own))
    n = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None

    def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        e = expand(x)
        return np.concatenate((e.sum(axis=0), (e * e).sum(axis=0)))

    first, second = np.split(totals(rows, moments) / (n[0] + n[1]), 2)
    spread = np.sqrt(np.maximum(second - first * first, 0))
    spread[spread <= 1e-7 * np.abs(first)] = 1.0  # equal values, apart from rounding
    place = hash60(F.lit("text"), F.col("doc_id"), F.col("text_id"))
    least = [rows.filter(F.col("quality") == c).select(place.alias("place"), "x").orderBy("place").limit(per_class).collect()
             for c in (1, 0)]
    z = standard(np.array([r["x"] for part in least for r in part], float), first, spread)
    good, bad = z[:len(least[0])], z[len(least[0]):]
    pick = np.random.default_rng(seed)
    pairs = max(len(good), len(bad)) * PAIRS_PER_DOCUMENT
    start = fit_bradley_terry(good[pick.integers(0, len(good), pairs)] - bad[pick.integers(0, len(bad), pairs)])
    weights = fit_all_pairs(rows, first, spread, start, PAIRS_PER_DOCUMENT / min(n[0], n[1]))
    raw = feature_score(F.col("x"), lambda x: linear(standard(x, first, spread), weights))
    threshold = score_quantile(rows.select("quality", raw.alias("score")), {y: size[y] / n[y] for y in n},
                               size[0] / (size[0] + size[1]))
    return Ranking(first, spread, weights, threshold)


def feature_score(x: Column, score: Callable[[np.ndarray], np.ndarray]) -> Column:
    """``score`` of the features ``x``, row by row."""
    @F.arrow_udf("double")
    def rate(x: pa.Array) -> pa.Array:
        return pa.array(score(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(FEATURES))), pa.float64())

    return rate(x)


def quality_score(text: Column, model: Ranking | None, spark=None) -> Column:
    """Score 0 to 1 of a text; 0.5 without a model. A NULL text counts as an empty one."""
    return ranking_score(feature_column(text), model)


def ranking_score(x: Column, model: Ranking | None) -> Column:
    """Score 0 to 1 of a text's features; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    def chance(x: np.ndarray) -> np.ndarray:
        s = linear(standard(x, model.mean, model.spread), model.weights) - model.threshold
        return 1 / (1 + np.exp(np.clip(-s, -500, 500)))

    return feature_score(x, chance)


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    NULL ids are held out; labels that are NULL or neither 0 nor 1 are not used; repeated labels
    and repeated documents are learned once. Repeated rows score alike; without documents the
    result is empty, without labels of both classes every score is 0.5; other columns are ignored.
    """
    known = document_features(docs)
    model = fit(known, labels, per_class)
    out = known.select("doc_id", "held_out", ranking_score(F.col("x"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
