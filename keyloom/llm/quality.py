"""Document quality by kernel ridge regression on random Fourier features.

A text becomes some statistics: shares of letters, capitals, marks and digits, repeated words
and lines, over the whole text and in its worst line.  Cosines of random projections of the
standardised statistics approximate a Gaussian kernel, so a linear ridge fit on them is a fit
with that kernel.  Its normal equations are sums over rows: tasks add up their own, Spark adds up
the tasks', and what is solved on the driver has the size of the features and not of the data.

Equations are kept by fold of the identifier.  Each fold's labelled rows are scored by the fit
without them, and isotonic regression makes a probability of those scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keyloom.llm.common import fold, in_batches, texts_of
from keyloom.plans.lineage import scratch_path

#: Random features, their kernel's width per statistic, the ridge per labelled row, and the seed.
FEATURES = 256
WIDTH = 1.5
RIDGE = 1e-3
SEED = 20_013
FOLDS = 5
#: Scores are calibrated on a grid of so many steps between these ends.
GRID = 4096
LOW, HIGH = -0.5, 1.5
GOOD = 0.3
#: Score where nothing could be learned.
UNKNOWN = 0.5
#: Sums of normal equations that are brought to the driver at most, and that one task adds up.
_SUMS, _FAN_IN = 8, 32
_LIMIT = 6.0  # standard deviations

STATISTICS = (
    "characters", "words", "word_length", "distinct", "repeated", "top_word", "capitals", "digits", "marks", "spaces", "line_length",
    "repeated_lines", "short_words", "bare_marks", "marked_words", "worst_capitals", "worst_marks", "worst_repeated", "other",
)

# classes of bytes: space, newline, lower, capital, digit, mark, beyond ASCII
_CLASS = np.full(256, 5, dtype=np.uint8)
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[10] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[128:] = 6


def _share(part: float, whole: float) -> float:
    """Shares are spread by the root, as a small part of a text may be what is wrong with it."""
    return math.sqrt(part / whole) if whole else 0.0


def statistics(text: str) -> list[float]:
    """The ``STATISTICS`` of a text; all zero for an empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(STATISTICS)
    kinds = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
    n = np.bincount(kinds, minlength=7).tolist()
    size, words = len(raw), raw.split()
    count = len(words)
    often = Counter(words)
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    capitals = marks = again = 0.0
    starts = np.flatnonzero(np.concatenate(([True], kinds[:-1] == 1)))
    upper, marked = np.add.reduceat(kinds == 3, starts, dtype=np.int64), np.add.reduceat(kinds == 5, starts, dtype=np.int64)
    long = np.diff(np.append(starts, size))
    wide = long >= 40
    if wide.any():
        capitals, marks = float((upper / long)[wide].max()), float((marked / long)[wide].max())
    for line in lines:
        own = line.split()
        if len(own) >= 8:
            again = max(again, 1 - len(set(own)) / len(own))
    ends = b"\n".join(words)
    tails = _CLASS[np.frombuffer(ends, dtype=np.uint8)[np.append(np.flatnonzero(np.frombuffer(ends, dtype=np.uint8) == 10) - 1, len(ends) - 1)]] if count else np.zeros(0, np.uint8)
    return [
        math.log1p(len(text)), math.log1p(count), math.log1p(sum(map(len, words)) / max(1, count)), _share(len(often), count), _share(repeated, count),
        _share(often.most_common(1)[0][1] if often else 0, count), _share(n[3], size), _share(n[4], size), _share(n[5], size), _share(n[0], size),
        math.log1p(size / max(1, len(lines))), _share(len(lines) - len(set(lines)), len(lines)), _share(sum(len(w) <= 2 for w in words), count),
        _share(sum(len(w) == 1 and _CLASS[w[0]] == 5 for w in words), count), _share(int((tails == 5).sum()), count), math.sqrt(capitals), math.sqrt(marks),
        math.sqrt(again), _share(n[6], size),
    ]


def text_statistics(df: DataFrame) -> DataFrame:
    """``doc_id, stats`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return in_batches(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, stats array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


@dataclass(frozen=True)
class Features:
    """Standardised statistics to random Fourier features; drawn from the seed, so the same everywhere."""

    mean: np.ndarray
    spread: np.ndarray
    features: int = FEATURES
    seed: int = SEED

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        drawn = np.random.default_rng(self.seed)
        width = WIDTH * math.sqrt(len(self.mean))
        directions = drawn.normal(0.0, 1.0 / width, (len(self.mean), self.features))
        phases = drawn.uniform(0.0, 2 * math.pi, self.features)
        at = np.clip((stats - self.mean) / self.spread, -_LIMIT, _LIMIT)
        waves = math.sqrt(2.0 / self.features) * np.cos(at @ directions + phases)
        return np.concatenate((waves, np.ones((len(stats), 1))), axis=1)


def learn_features(train: DataFrame) -> Features | None:
    """Mean and spread of the statistics of all labelled rows, rounded so that reruns agree; None without rows."""
    cols = [F.col("stats")[i] for i in range(len(STATISTICS))]
    found = train.agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
    if found[0] is None:
        return None
    values = np.array([float(f"{v:.6g}") for v in found])
    mean, spread = values[: len(cols)], values[len(cols) :]
    return Features(mean, np.where(spread > 1e-6, spread, 1.0))


def normal_equations(train: DataFrame, features: Features) -> dict[int, np.ndarray]:
    """Per fold the sums over ``train(fold, stats, label)`` of features by features and by label.

    A task leaves one sum per fold; they are added up ``_FAN_IN`` at a time until few are left.
    """
    width = features.features + 1
    types = {"fold": pa.int32(), "total": pa.binary()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            folds, labels = batch.column("fold").to_numpy(), batch.column("label").to_numpy().astype(np.float64)
            known = features(_matrix(batch))
            both = np.concatenate((known, labels[:, None]), axis=1)
            for k in np.unique(folds).tolist():
                mine = folds == k
                held[k] = held.get(k, 0.0) + known[mine].T @ both[mine]
        yield _sums(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, total in zip(batch.column("fold").to_pylist(), batch.column("total").to_pylist()):
                held[k] = held.get(k, 0.0) + np.frombuffer(total)
        yield _sums(held)

    def _sums(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        out = [list(held), [np.ascontiguousarray(v).tobytes() for v in held.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types.values())], names=list(types))

    spark = train.sparkSession
    sums, parts = in_batches(train.select("fold", "stats", "label"), add, "fold int, total binary"), None
    while True:
        path = scratch_path(spark, "quality-sums")
        sums.write.parquet(path)
        sums = spark.read.parquet(path)
        parts = sums.count()
        if parts <= _SUMS * FOLDS:
            break
        groups = max(1, math.ceil(parts / FOLDS / _FAN_IN))
        sums = in_batches(sums.repartition(groups, F.xxhash64("total") % groups), merge, "fold int, total binary")
    out: dict[int, np.ndarray] = {}
    for k, total in sorted((k, bytes(total)) for k, total in sums.collect()):
        out[k] = out.get(k, 0.0) + np.frombuffer(total).reshape(width, width + 1)
    return out


def ridge(equations: np.ndarray) -> np.ndarray:
    """Weights of the fit; the constant feature, which is last, is not shrunk."""
    gram, right = equations[:, :-1], equations[:, -1]
    shrink = np.full(len(gram), RIDGE * max(1.0, gram[-1, -1]))
    shrink[-1] = 1e-9
    return np.linalg.solve(gram + np.diag(shrink), right)


def isotonic(totals: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, probabilities) of the non-decreasing fit to shares on a grid, by pooling adjacent violators.

    Between the middles of neighbouring pools the fit goes straight, so scores in one pool keep
    their order.
    """
    pools: list[list[float]] = []  # rows, good rows, sum of places
    for at in np.flatnonzero(totals).tolist():
        pools.append([float(totals[at]), float(good[at]), float(totals[at]) * at])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    if not pools:
        return np.array([0.0]), np.array([UNKNOWN])
    return np.array([p[2] / p[0] for p in pools]), np.array([p[1] / p[0] for p in pools])


@dataclass(frozen=True)
class QualityModel:
    """Features, weights of the fit, and the calibration's places on the grid; small and sent to the tasks."""

    features: Features
    weights: np.ndarray
    places: np.ndarray
    shares: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        raw = self.features(stats) @ self.weights
        known = np.interp(_grid(raw), self.places, self.shares)
        # within a flat piece of the calibration the raw score still counts a little
        return np.clip(known * (1 - 1e-3) + 1e-3 * _grid(raw) / GRID, 0.0, 1.0)


def _grid(raw: np.ndarray) -> np.ndarray:
    return (np.clip(raw, LOW, HIGH) - LOW) / (HIGH - LOW) * (GRID - 1)


def train_model(train: DataFrame) -> QualityModel | None:
    """A model of all rows of ``train(fold, stats, label)``; None if there are none."""
    features = learn_features(train)
    if features is None:
        return None
    equations = normal_equations(train, features)
    whole = sum(equations.values())
    # a fold that is all there is has nothing else to learn from
    without = {k: ridge(whole - e if len(equations) > 1 else whole) for k, e in equations.items()}
    types = {"place": pa.int32(), "label": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds, known = batch.column("fold").to_numpy(), features(_matrix(batch))
            raw = np.zeros(len(folds))
            for k, weights in without.items():
                raw[folds == k] = known[folds == k] @ weights
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(_grid(raw)).astype(np.int32)), batch.column("label").cast(pa.int32())], names=list(types))

    graded = in_batches(train.select("fold", "stats", "label"), run, "place int, label int")
    totals, good = np.zeros(GRID), np.zeros(GRID)
    for place, n, g in graded.groupBy("place").agg(F.count(F.lit(1)), F.sum("label")).collect():  # GRID rows at most
        totals[place], good[place] = n, g
    return QualityModel(features, ridge(whole), *isotonic(totals, good))


def assess_quality(df: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``df``.

    Learns from the label rows (``quality`` 0 or 1) of all documents but those whose crc32 of the
    doc_id leaves ``part`` of ``parts``; every label row counts, and nothing but the text is read to
    make a score.  ``predicted`` is 1 from a score of ``GOOD`` on.

    Null text counts as empty and gets the score of an empty text.  A row without doc_id is not
    held out and has no label; repeated rows, and labels that repeat, count as often as they
    are.  Where no label can be learned from, all scores are 0.5.  An empty table gives no rows.
    Other columns, whatever their names, are not read.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "quality-statistics")
    text_statistics(df.select("doc_id", "text")).write.parquet(path)
    known = spark.read.parquet(path)
    held = F.coalesce(fold("doc_id", parts) == part, F.lit(False))
    marks = labels.where("quality IN (0, 1)").select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label"))
    path = scratch_path(spark, "quality-labelled")
    # folds by another hash than the one that holds rows out
    chosen = known.where(~held).join(marks, F.col("doc_id") == F.col("id")).select((F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS))).cast("int").alias("fold"), "stats", "label")
    chosen.write.parquet(path)
    model = train_model(spark.read.parquet(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.full(batch.num_rows, UNKNOWN) if model is None else model.scores(_matrix(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = in_batches(known, run, "doc_id long, score double")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
