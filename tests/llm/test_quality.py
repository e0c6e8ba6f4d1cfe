"""The quality classifier: its sums, its fit, its calibration, and held-out accuracy."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from keyloom.llm import quality
from tests.llm.test_operators import HARD, SCHEMA

DATA = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def area(good, scores):
    """Share of (good, bad) pairs that the scores put in order."""
    a, b = scores[good == 1], scores[good == 0]
    return float(np.mean((a[:, None] > b[None]) + 0.5 * (a[:, None] == b[None])))


def test_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    found = quality.assess_quality(docs, labels).cache()
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == docs.count()
    rows = found.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [(known[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in known]
    good, scores, predicted = map(np.array, zip(*held))
    assert area(good, scores) > 0.98 and predicted[good == 1].mean() > 0.97


def test_labels_of_the_fold_are_not_read(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet").limit(400), spark.read.parquet(f"{DATA}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.assess_quality(docs, x).select("doc_id", F.round("score", 9)).collect() for x in (labels, turned))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_sums_are_those_of_all_rows(spark):
    rng = np.random.default_rng(3)
    stats = rng.normal(size=(500, len(quality.STATISTICS)))
    rows = [(int(k) % 5, s.tolist(), int(s[0] + s[1] > 0)) for k, s in enumerate(stats)]
    train = spark.createDataFrame(rows, "fold int, stats array<double>, label int").repartition(120)
    features = quality.learn_features(train)
    found = quality.normal_equations(train, features)
    known, good = features(stats), np.array([r[2] for r in rows], dtype=float)
    for k in range(5):
        mine = np.arange(500) % 5 == k
        want = known[mine].T @ np.concatenate((known[mine], good[mine, None]), axis=1)
        np.testing.assert_allclose(found[k], want, atol=1e-8)
    # the fit is that of ridge regression solved on all rows at once
    whole = sum(found.values())
    shrink = np.sqrt(np.diag(np.full(known.shape[1], quality.RIDGE * 500)))
    shrink[-1, -1] = np.sqrt(1e-9)
    want = np.linalg.lstsq(np.concatenate((known, shrink)), np.concatenate((good, np.zeros(len(shrink)))), rcond=None)[0]
    np.testing.assert_allclose(quality.ridge(whole), want, atol=1e-6)
    model = quality.train_model(train)
    assert area(good, model.scores(stats)) > 0.97


def test_features_approximate_the_kernel():
    features = quality.Features(np.zeros(4), np.ones(4), features=20_000)
    x = np.random.default_rng(1).normal(size=(30, 4))
    waves = features(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.testing.assert_allclose(waves @ waves.T, np.exp(-distance / (2 * (quality.WIDTH * 2) ** 2)), atol=0.05)


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(5)
    for _ in range(20):
        totals = rng.integers(0, 5, 12).astype(float)
        good = rng.binomial(totals.astype(int), 0.5).astype(float)
        places, shares = quality.isotonic(totals, good)
        assert (np.diff(shares) > 0).all() and (np.diff(places) > 0).all()
        used = np.flatnonzero(totals)
        # the minimax formula of isotonic regression
        mean = lambda a, b: good[a : b + 1].sum() / totals[a : b + 1].sum()
        fit = [max(min(mean(a, b) for b in used[used >= i]) for a in used[used <= i]) for i in used]
        pools = sorted(set(np.round(fit, 12)))
        np.testing.assert_allclose(shares, pools)
    assert quality.isotonic(np.zeros(4), np.zeros(4))[1].tolist() == [quality.UNKNOWN]


def test_hard_rows(spark):
    clashing = [F.lit(7).alias(c) for c in ("stats", "fold", "label", "id", "score", "quality", "place")]
    docs = spark.createDataFrame(HARD, SCHEMA).select("*", *clashing)
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 1, 0), (8, None, 0), (9, 1, 1), (9, 1, 1), (12, 7, 0), (None, 1, 1)], LABELS)
    found = quality.assess_quality(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in HARD) and all(0 <= r.score <= 1 for r in found)
    by_text = {}
    for r in found:
        by_text.setdefault(next(t or "" for d, t, *_ in HARD if d == r.doc_id), set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    none = quality.assess_quality(docs, spark.createDataFrame([], LABELS)).collect()
    assert {r.score for r in none} == {quality.UNKNOWN}
    one = quality.assess_quality(docs, spark.createDataFrame([(2, 1, 0), (3, 1, 0)], LABELS)).collect()
    assert all(r.predicted == 1 for r in one)
    assert quality.assess_quality(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_long_text():
    found = quality.statistics("Word word, " * 400_000)
    assert len(found) == len(quality.STATISTICS) and all(np.isfinite(found))
