"""Poisson replicates against brute force, with ties across slices."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.functions.hashing import uniform60
from tallyfold.operators import bootstrap, poisson


def test_replicates_equal_weighted_pairs(spark, monkeypatch):
    monkeypatch.setattr(poisson, "CHUNK_ROWS", 7)
    rnd = random.Random(5)
    rows = [(f"u{i}", t, float(rnd.random() < .4), .5 if rnd.random() < .5 else round(rnd.random(), 1)) for i in range(150) for t in "ab"]
    df = spark.createDataFrame(rows, "uid string, target string, y double, p double").repartition(4)
    got = {(r.target, r.b): r for r in poisson.replicate_auc(df, ["target"], 20, 3).collect()}
    h = {r.uid: r.h for r in df.select("uid", uniform60(3, F.col("uid")).alias("h")).distinct().collect()}
    w = {u: poisson.weights(np.array([v]), 20)[0] for u, v in h.items()}
    assert len(got) == 40
    for t in "ab":
        pos = [(p, w[u]) for u, k, y, p in rows if k == t and y == 1]
        neg = [(p, w[u]) for u, k, y, p in rows if k == t and y == 0]
        for b in range(20):
            num = sum(a[b] * c[b] * ((p > q) + .5 * (p == q)) for p, a in pos for q, c in neg)
            den = sum(a[b] for _, a in pos) * sum(c[b] for _, c in neg)
            assert got[(t, b)].auc == pytest.approx(num / den, abs=1e-12)


def test_weights_are_poisson():
    w = poisson.weights(np.arange(4000, dtype=np.int64) * 7919, 50)
    assert abs(w.mean() - 1) < .02 and abs(w.var() - 1) < .03 and (w == 0).mean() == pytest.approx(np.exp(-1), abs=.01)


def test_poisson_interval_is_close_to_multinomial(spark):
    rnd = random.Random(1)
    rows = [(f"u{i}", "t", float(i % 2), m, min(1.0, max(0.0, .5 * (i % 2) * k + .5 * rnd.random()))) for i in range(200) for m, k in (("new", .6), ("old", .3))]
    df = spark.createDataFrame(rows, "uid string, target string, y double, model string, p double")
    a = bootstrap.paired_delta(df, "new", "old", 200, 1).first()
    b = bootstrap.paired_delta(df, "new", "old", 200, 1, method="poisson").first()
    assert a.delta == pytest.approx(b.delta) and b.n_boot == 200
    assert abs(a.ci_low - b.ci_low) < .03 and abs(a.ci_high - b.ci_high) < .03
