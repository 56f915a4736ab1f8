"""Operator 8, quality classifier: Bradley-Terry pairwise ranking.

Features of the text are compared in preference pairs (a labelled good document beside a
labelled bad one); the logistic loss on feature differences gives a linear score, the
Bradley-Terry strength. The threshold is the quantile of the training rows' scores at the
share of bad rows; scores are mapped so that it lies at ``threshold`` (0.7).

Features are computed once for every document (whole texts) and written. The fit learns from
every labelled row that it may see: rows are dealt to blocks of some hundred, each with rows
of either label (those of a rare label lie in several), and all pairs of a good and a bad row
of a block are compared, so pairs grow with the rows. A block adds up gradient and Hessian; only
such sums pass through the driver, which takes the Newton steps. The quantiles are those of
all learnt rows, by ranks. Scoring is a column expression over all documents.

Defined results: null and empty texts have all features zero and are scored; repeated rows
and null ids are scored one by one; an id labelled twice with both labels is not learnt
from. Without a labelled row of either label every score is the threshold, so nothing is
rejected. Extra columns are not read by ``scores``. Empty in, empty out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.operators.sampling import group_rank
from corpuslab.session import checkpoint_dir

from .common import bounded, saved, unused

FEATURES = ("long", "repeats", "signs", "bars", "capitals", "shouts", "squeeze", "squeeze_more", "word_length", "digits",
            "dup_lines", "title_words", "odd_ends", "stops", "spread")
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
SIGNS = b"#*$%&<>\\^~@{}[]=+_/"


def measure(text: str | None, squeeze) -> tuple[float, ...]:
    """FEATURES of one text, each between 0 and about 3."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0.0,) * len(FEATURES)
    n, size = len(words), len(raw)
    count = lambda chars: size - len(raw.translate(None, chars))
    letters = max(1, count(LETTERS))
    ratio = math.log(size / len(squeeze(raw)))
    usual = 0.35 + 0.065 * math.log(max(size, 64) / 64) ** 1.0  # prose of this length, roughly
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct = len(set(words))
    capital = sum(w[:1].isupper() for w in words)
    ends = count(b".!?")
    odd = sum(not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,") for w in words)
    return (min(3.0, math.log1p(n) / 3), 1 - distinct / n, min(2.0, count(SIGNS) / n), min(1.0, 2 * count(b"|") / n),
            count(UPPER) / letters, min(1.0, count(b"!?") / n), ratio - usual, max(0.0, ratio - usual - 0.5),
            min(3.0, size / n / 6), min(1.0, 4 * count(DIGITS) / size), 1 - len(set(lines)) / max(1, len(lines)),
            capital / n, odd / n, min(1.0, ends / n), min(3.0, math.log1p(n / distinct)))


def features(text: Column, level: int = 1) -> Column:
    """FEATURES of a text column as an array of doubles."""

    def of_batch(texts: pa.Array) -> pa.Array:
        squeeze = zstandard.ZstdCompressor(level=level).compress
        return pa.array([measure(t.as_py(), squeeze) for t in texts], pa.list_(pa.float64()))

    of_batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(of_batch, "array<double>")(text)


def held_out(doc_id: Column) -> Column:
    """Rows that the fit never sees: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def newton(sums, width: int, l2: float = 1e-4, steps: int = 25) -> np.ndarray:
    """The weights at the least loss; ``sums(w)``: mean gradient and Hessian over the pairs."""
    w = np.zeros(width)
    for _ in range(steps):
        grad, hess = sums(w)
        step = np.linalg.solve(hess + (l2 + 1e-6) * np.eye(width), grad + l2 * w)
        w = w - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(good: np.ndarray, bad: np.ndarray, pairs: int = 200_000, l2: float = 1e-4, steps: int = 25, seed: int = 7):
    """Weights of the Bradley-Terry model by Newton steps on the logistic loss of good - bad
    differences, of pairs drawn from two arrays: a plain form that the queries don't use."""
    rng = np.random.default_rng(seed)
    n = min(pairs, len(good) * len(bad) * 4)
    x = good[rng.integers(0, len(good), n)] - bad[rng.integers(0, len(bad), n)]
    scale = x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    x = x / scale

    def sums(w):
        p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))  # chance that the model gives the pair the other way
        return -(x * p[:, None]).mean(axis=0), (x * (p * (1 - p))[:, None]).T @ x / len(x)

    return newton(sums, x.shape[1], l2, steps) / scale


BLOCK = 512  # rows of the more frequent label in a block
PARTNERS = 16  # rows of the other label in each block, at least (all of them, if there are fewer)


def blocks(rows: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """good, bad: the features of a block's rows, one after the other. ``rows``: doc_id, good, features."""
    most, least = max(n_good, n_bad), min(n_good, n_bad)
    n_blocks = math.ceil(most / BLOCK)
    each = max(math.ceil(least / n_blocks), min(PARTNERS, least))  # a run of the rarer rows, round and round
    checkpoint_dir(rows.sparkSession)
    at = F.col("_rank") - 1
    ranked = group_rank(rows, ["good"], [F.xxhash64("doc_id"), F.col("doc_id")], "_rank")
    frequent = F.col("good") == int(n_good >= n_bad)
    places = F.when(frequent, F.array(at % n_blocks)).otherwise(
        F.transform(F.sequence(at, F.lit(n_blocks * each - 1), F.lit(least)), lambda u: F.floor(u / each)))
    of = lambda label: F.flatten(F.sort_array(F.collect_list(F.when(F.col("good") == label, F.col("features"))))).alias(("bad", "good")[label])
    return saved(ranked.select("good", "features", F.explode(places).alias("block")).groupBy("block").agg(of(1), of(0)), "blocks")


def _added(of_block, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            for g, x in zip(b.column("good"), b.column("bad")):
                total += of_block(*(v.values.to_numpy().reshape(-1, len(FEATURES)) for v in (g, x)))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])
    return run


def added(pairs: DataFrame, of_block, width: int) -> np.ndarray:
    """The sum over all blocks; each task adds up its own."""
    return sum((np.array(r["sums"]) for r in pairs.mapInArrow(_added(of_block, width), "sums array<double>").collect()), np.zeros(width))


def fit_blocks(pairs: DataFrame) -> np.ndarray:
    """Weights of the Bradley-Terry model by Newton steps on the logistic loss of all good - bad
    differences in the blocks."""
    k = len(FEATURES)

    def squares(g, b):
        first = len(b) * g.sum(axis=0) - len(g) * b.sum(axis=0)
        second = len(b) * (g * g).sum(axis=0) - 2 * g.sum(axis=0) * b.sum(axis=0) + len(g) * (b * b).sum(axis=0)
        return np.concatenate([[len(g) * len(b)], first, second])

    totals = added(pairs, squares, 1 + 2 * k)
    n = totals[0]
    scale = np.sqrt(np.maximum(0.0, totals[k + 1:] / n - (totals[1:k + 1] / n) ** 2))
    scale[scale < 1e-6] = 1.0

    def sums(w):
        def slopes(g, b):
            g, b = g / scale, b / scale
            p = 1 / (1 + np.exp(np.clip((g @ w)[:, None] - (b @ w)[None, :], -30, 30)))
            grad = b.T @ p.sum(axis=0) - g.T @ p.sum(axis=1)
            p *= 1 - p
            mixed = g.T @ p @ b
            hess = (g.T * p.sum(axis=1)) @ g + (b.T * p.sum(axis=0)) @ b - mixed - mixed.T
            return np.concatenate([grad, hess.reshape(-1)])

        out = added(pairs, slopes, k + k * k) / n
        return out[:k], out[k:].reshape(k, k)

    return newton(sums, k) / scale


def quantile(rows: DataFrame, value: Column, q: float, n: int) -> float:
    """As ``numpy.quantile`` of all ``n`` values, which are ranked in range pieces."""
    at = q * (n - 1)
    low = math.floor(at)
    checkpoint_dir(rows.sparkSession)
    ranked = group_rank(rows.select(F.lit(0).alias("_g"), value.alias("_v")), ["_g"], ["_v"], "_rank")
    x = sorted((r["_rank"], r["_v"]) for r in ranked.filter(F.col("_rank").between(low + 1, low + 2)).collect())
    return float(x[0][1] + (x[-1][1] - x[0][1]) * (at - low))


def strength(weights: np.ndarray, features: Column) -> Column:
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + F.lit(float(w)) * features[i]
    return total


class Model:
    def __init__(self, weights: np.ndarray, cut: float, slope: float, threshold: float = 0.7):
        self.weights, self.cut, self.slope, self.threshold = weights, cut, slope, threshold

    @classmethod
    def train(cls, measured: DataFrame, labels: DataFrame, threshold: float = 0.7) -> Model:
        """``measured``: doc_id, features; ``labels``: doc_id, quality."""
        rows = saved(measured.join(chosen(labels), "doc_id").groupBy("doc_id")
                     .agg(F.first("good").cast("int").alias("good"), F.min("features").alias("features")), "learnt")
        sizes = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}
        n_good, n_bad = sizes.get(1, 0), sizes.get(0, 0)
        if not n_good or not n_bad:
            return cls(np.zeros(len(FEATURES)), 0.0, 1.0, threshold)
        weights = fit_blocks(blocks(rows, n_good, n_bad))
        strengths = saved(rows.select(strength(weights, F.col("features")).alias("strength")), "strengths")
        cut = quantile(strengths, F.col("strength"), n_bad / (n_good + n_bad), n_good + n_bad)
        spread = max(1e-6, quantile(strengths, F.abs(F.col("strength") - cut), 0.5, n_good + n_bad))
        return cls(weights, cut, 2.0 / spread, threshold)

    def score(self, features: Column) -> Column:
        total = strength(self.weights, features) - F.lit(self.cut)
        shift = math.log(self.threshold / (1 - self.threshold))
        z = F.greatest(F.lit(-60.0), F.least(F.lit(60.0), F.lit(self.slope) * total)) + F.lit(shift)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def chosen(labels: DataFrame) -> DataFrame:
    """doc_id, good: all labelled rows that the fit may see."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high")).filter("low = high")
            .select("doc_id", F.col("high").alias("good")))


def measured(docs: DataFrame) -> DataFrame:
    return saved(bounded(docs).select("doc_id", features(F.col("text")).alias("features")), "features")


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = measured(docs)
    model = Model.train(rows, labels, threshold=threshold)
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("features")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents predicted good, with all their columns. Documents are measured for the fit
    and once more where they are judged, so that no text is written or shuffled for it."""
    model = Model.train(measured(docs), labels, threshold=threshold)
    name = unused(docs, "quality_score")
    return bounded(docs).withColumn(name, model.score(features(F.col("text")))).filter(F.col(name) >= threshold).drop(name)
