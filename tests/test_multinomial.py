"""Exact replicate weights: every replicate draws n units, each unit as often as by n draws, and AUCs equal those of plain weighted pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import bootstrap, multinomial, poisson
from tallyfold.plans import review


def weights(spark, n, n_boot, seed=1, strata=None):
    rows = [(s, f"u{i:04d}") for s, k in (strata or {"a": n}).items() for i in range(k)]
    units = spark.createDataFrame(rows, "s string, uid string")
    drawn, rounds = multinomial.drawn_units(bootstrap.index_units(units, "uid", ["s"]), ["s", "uid"], ["s"], n_boot, seed)
    out = {}
    for r in drawn.collect():
        w = poisson.weights(np.array([r.h]), n_boot, r.mean, np.array(rounds))[0]
        np.add.at(w, np.array(r.extra, int), 1)
        out[(r.s, r.uid)] = w
    return out, rounds


def test_each_replicate_has_n_draws_in_each_stratum(spark):
    out, rounds = weights(spark, 0, 60, strata={"a": 400, "b": 3, "c": 1, "d": 90})
    assert len(out) == 494 and set(rounds) == {0}
    for s, n in {"a": 400, "b": 3, "c": 1, "d": 90}.items():
        assert (sum(w for (k, _), w in out.items() if k == s) == n).all()


def test_counts_are_distributed_as_n_draws(spark):
    n, n_boot = 300, 400
    out, _ = weights(spark, n, n_boot, seed=4)
    w = np.array([out[k] for k in sorted(out)])
    assert w.shape == (n, n_boot)
    # binomial(n, 1 / n) for each unit, and covariance -1 / n between two of them
    assert abs(w.var() - (1 - 1 / n)) < 0.02
    assert [np.mean(w == k) for k in range(4)] == pytest.approx([0.3673, 0.3685, 0.1842, 0.0612], abs=0.005)
    pairs = np.cov(w)[np.triu_indices(n, 1)]
    assert pairs.mean() == pytest.approx(-1 / n, abs=0.0015)


def test_a_replicate_above_n_takes_another_round(spark, monkeypatch):
    monkeypatch.setattr(multinomial, "MARGIN", 0.5)
    out, rounds = weights(spark, 200, 50)
    assert max(rounds) > 0 and (sum(out.values()) == 200).all()


def test_replicate_aucs_equal_weighted_pairs(spark, monkeypatch):
    monkeypatch.setattr(poisson, "CHUNK_ROWS", 7)
    rnd = random.Random(5)
    rows = [(f"u{i:04d}", t, float(rnd.random() < 0.4), 0.5 if rnd.random() < 0.5 else round(rnd.random(), 1)) for i in range(150) for t in "ab"]
    df = spark.createDataFrame(rows, "uid string, target string, y double, p double").repartition(4)
    got = {(r.target, r.b): r.auc for r in bootstrap.replicates(df, ["target"], 20, 3, ["uid"], df, [], "multinomial").collect()}
    drawn, rounds = multinomial.drawn_units(bootstrap.index_units(df, "uid"), ["uid"], [], 20, 3)
    w = {}
    for r in drawn.collect():
        w[r.uid] = poisson.weights(np.array([r.h]), 20, r.mean, np.array(rounds))[0]
        np.add.at(w[r.uid], np.array(r.extra, int), 1)
    assert (sum(w.values()) == 150).all() and len(got) == 40
    for t in "ab":
        pos, neg = ([(p, w[u]) for u, k, y, p in rows if k == t and y == c] for c in (1, 0))
        for b in range(20):
            num = sum(a[b] * c[b] * ((p > q) + 0.5 * (p == q)) for p, a in pos for q, c in neg)
            assert got[(t, b)] == pytest.approx(num / (sum(a[b] for _, a in pos) * sum(c[b] for _, c in neg)), abs=1e-12)


def test_strata_without_pairs_have_a_null_result(spark):
    rows = [("gold", f"u{i}", "t", float(i % 2), m, i / 40) for i in range(40) for m in ("new", "old")]
    df = spark.createDataFrame(rows, "split string, uid string, target string, y double, model string, p double")
    expected = spark.createDataFrame([("gold",), ("weak",)], "split string")
    out = {r.split: r for r in bootstrap.paired_delta(df, "new", "old", 50, 1, ["split"], expected=expected).collect()}
    assert (out["gold"].delta, out["gold"].ci_low, out["gold"].n_boot, out["gold"].n_paired) == (0.0, 0.0, 50, 40)
    assert (out["weak"].delta, out["weak"].ci_low, out["weak"].n_boot, out["weak"].n_paired) == (None, None, 0, 0)


def test_two_folds_need_valid_replicates_and_the_secondary_rule(spark):
    rows = [(f, f"g{i}", f"{f}{i}", "t", float(i % 2), m, (i % 2) * k + i / 100) for f in "01" for i in range(30) for m, k in (("new", 1.0), ("old", 0.1))]
    df = spark.createDataFrame(rows, "fold string, group_id string, uid string, target string, y double, model string, p double")
    ok = review.two_fold_review(df, "new", "old", 100, 1)["decision"].first()
    assert ok.passed and ok.n_boot == 100 and ok.ci_low > 0
    worse = df.withColumn("p", F.when(F.col("group_id").isin("g0", "g1") & (F.col("model") == "new"), -F.col("p")).otherwise(F.col("p")))
    out = review.two_fold_review(worse, "new", "old", 100, 1, secondary=F.col("group_id").isin("g0", "g1"), strict=False)["decision"].first()
    assert out.all_positive and not out.secondary_ok and not out.passed
    with pytest.raises(Exception, match="bootstrap"):
        review.two_fold_review(df.where("group_id IN ('g1', 'g2')"), "new", "old", 100, 1)
    assert not review.two_fold_review(df.where("group_id IN ('g1', 'g2')"), "new", "old", 100, 1, strict=False)["decision"].first().passed
