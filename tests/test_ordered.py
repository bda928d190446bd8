"""Ordered primitives: against brute force, with a hot group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.functions.hashing import id_list_fingerprint, table_fingerprint
from tallyfold.operators import auc, calibration, dominance, ranks
from tallyfold.scale import exact_quantiles, ordinal_rank, prefix_sums


def _scored(n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        target = "a" if rnd.random() < 0.7 else "b"  # a is the hot group
        p = 0.5 if rnd.random() < 0.35 else round(rnd.random(), 2)  # a third of the scores tie
        rows.append((f"u{i:04d}", target, float(rnd.random() < 0.3), p))
    return rows


def _brute_auc(rows):
    pos = [p for *_, y, p in rows if y == 1]
    neg = [p for *_, y, p in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_equals_pair_count(spark):
    rows = _scored()
    df = spark.createDataFrame(rows, "uid string, target string, y double, p double")
    got = {r.target: r.auc for r in auc.target_auc(df).collect()}
    for t in "ab":
        assert got[t] == pytest.approx(_brute_auc([r for r in rows if r[1] == t]), abs=1e-12)


def test_tie_fixture_and_burden(spark):
    df = spark.createDataFrame(
        [("a", "t", 1.0, .5), ("b", "t", 0.0, .5), ("c", "t", 1.0, .2), ("d", "t", 0.0, .7), ("e", "t", 0.0, .1)],
        "uid string, target string, y double, p double")
    row = auc.target_auc(df).first()
    assert row.auc == pytest.approx(2.5 / 6) and (row.n_pos, row.n_neg, row.n) == (2, 3, 5)
    pair = auc.pair_summary(df).first()
    assert pair.n_pairs == 6 and pair.misordered == pytest.approx(3.5) and pair.identity_auc == pytest.approx(row.auc)
    burden = {r.uid: r.burden for r in auc.case_burden(df).collect()}
    assert burden == pytest.approx({"a": 0.5, "c": 2 / 3, "b": 0.75, "d": 1.0, "e": 0.0})


def test_undefined_auc_is_null(spark):
    df = spark.createDataFrame([("u", "t", 1.0, .3), ("v", "t", 1.0, .4), ("w", "s", float("nan"), .4)],
                               "uid string, target string, y double, p double")
    got = {r.target: r for r in auc.target_auc(df).collect()}
    assert got["t"].auc is None and got["t"].undefined and got["t"].n_pos == 2
    assert got["s"].n == 0 and got["s"].auc is None
    macro = auc.macro_auc(auc.target_auc(df)).first()
    assert macro.macro_auc is None and macro.n_defined == 0 and macro.n_targets == 2


def test_weighted_auc(spark):
    rows = [(*r, i % 4) for i, r in enumerate(_scored(120))]
    df = spark.createDataFrame(rows, "uid string, target string, y double, p double, w long")
    got = {r.target: r.auc for r in auc.target_auc(df, weight="w").collect()}
    for t in "ab":
        repeated = [r[:4] for r in rows if r[1] == t for _ in range(r[4])]
        assert got[t] == pytest.approx(_brute_auc(repeated), abs=1e-12)


def test_prefix_and_rank(spark):
    rows = _scored(300)
    df = spark.createDataFrame(rows, "uid string, target string, y double, p double").withColumn("v", F.lit(2))
    out = prefix_sums(df, ["target"], [F.col("p"), F.col("uid")], ["v"])
    out = ordinal_rank(out, ["target"], [F.col("p").desc(), F.col("uid")]).collect()
    for t in "ab":
        ordered = sorted([r for r in rows if r[1] == t], key=lambda r: (r[3], r[0]))
        want = {r[0]: 2 * i for i, r in enumerate(ordered)}
        down = sorted([r for r in rows if r[1] == t], key=lambda r: (-r[3], r[0]))
        wrank = {r[0]: i + 1 for i, r in enumerate(down)}
        for r in out:
            if r.target == t:
                assert r.v_before == want[r.uid] and r["rank"] == wrank[r.uid]


def test_mid_ranks(spark):
    rows = _scored(200)
    df = spark.createDataFrame(rows, "uid string, target string, y double, p double")
    got = {(r.target, r.uid): r.nrank for r in ranks.normalized_ranks(df, ["target"], "p").collect()}
    for t in "ab":
        vals = [r for r in rows if r[1] == t]
        for r in vals:
            below = sum(o[3] < r[3] for o in vals)
            same = sum(o[3] == r[3] for o in vals)
            assert got[(t, r[0])] == pytest.approx((below + (same + 1) / 2) / len(vals))


def test_quantiles_match_numpy(spark):
    rows = _scored(150)
    df = spark.createDataFrame(rows, "uid string, target string, y double, p double")
    got = {r.target: r for r in exact_quantiles(df, ["target"], "p", {"q5": .05, "q50": .5, "q95": .95}).collect()}
    for t in "ab":
        v = [r[3] for r in rows if r[1] == t]
        assert [got[t].q5, got[t].q50, got[t].q95] == pytest.approx(list(np.percentile(v, [5, 50, 95])))


def test_component_comparison_equals_pairs(spark):
    rnd = random.Random(3)
    rows = [(t, float(rnd.random() < .4), *[round(rnd.random(), 1) for _ in range(4)]) for t in "ab" for _ in range(40)]
    df = spark.createDataFrame(rows, "target string, y double, ref double, c1 double, c2 double, c3 double")
    got = {(r.target, r.component): r for r in dominance.component_comparison(
        df, ["target"], "ref", ["c1", "c2", "c3"]).collect()}
    for t in "ab":
        pos = [r[2:] for r in rows if r[0] == t and r[1] == 1]
        neg = [r[2:] for r in rows if r[0] == t and r[1] == 0]
        pairs = [[a <= b for a, b in zip(x, z)] for x in pos for z in neg]
        for k in (1, 2, 3):
            r = got[(t, f"c{k}")]
            assert r.corrected == sum(p[0] and not p[k] for p in pairs)
            assert r.broken == sum(not p[0] and p[k] for p in pairs)
        assert got[(t, "*")].all_wrong == sum(all(p[1:]) for p in pairs)


def test_null_scores_and_null_groups_stay(spark):
    rows = [("a", "u1", 0.5), ("a", "u2", None), ("a", "u3", 0.7), (None, "u4", 0.1), (None, "u5", 0.1), ("b", "u6", None)]
    df = spark.createDataFrame(rows, "target string, uid string, p double")
    got = {r.uid: (r["rank"], r.ties, r.n) for r in ranks.mid_ranks(df, ["target"], "p").collect()}
    assert got == {"u1": (2.0, 1, 3), "u2": (1.0, 1, 3), "u3": (3.0, 1, 3), "u4": (1.5, 2, 2), "u5": (1.5, 2, 2), "u6": (1.0, 1, 1)}
    order = {r.uid: r["rank"] for r in ordinal_rank(df, ["target"], [F.col("p"), F.col("uid")]).collect()}
    assert order == {"u2": 1, "u1": 2, "u3": 3, "u4": 1, "u5": 2, "u6": 1}
    from tallyfold.operators.manifest import size_profile

    profile = {r.target: (r["mean"], r.p50, r["max"]) for r in size_profile(df, "p", ["target"]).collect()}
    assert profile["b"] == (None, None, None) and profile[None] == (0.1, 0.1, 0.1) and profile["a"][1] == pytest.approx(0.6)


def test_missing_component_score_costs_only_its_own_questions(spark):
    rows = [("a", "t", 1.0, .2, .9, None), ("b", "t", 0.0, .5, .1, .3), ("c", "t", 1.0, .9, .05, .6), ("d", None, 1.0, .2, .9, .9), ("e", None, 0.0, .5, .1, .1)]
    df = spark.createDataFrame(rows, "uid string, target string, y double, ref double, c1 double, c2 double")
    got = {(r.target, r.component): r for r in dominance.component_comparison(df, ["target"], "ref", ["c1", "c2"]).collect()}
    assert (got["t", "c1"].corrected, got["t", "c1"].broken) == (1, 1)
    assert (got["t", "c2"].corrected, got["t", "c2"].broken) == (0, 0)
    assert got["t", "*"].all_wrong == 0
    assert (got[None, "c1"].corrected, got[None, "c2"].corrected) == (1, 1)


def test_totals_need_no_second_pass(spark):
    df = spark.createDataFrame([(g, i, 1) for g in ("a", None) for i in range(50)], "g string, i int, v int")
    out = prefix_sums(df, ["g"], [F.col("i")], ["v"], totals=True).collect()
    assert {(r.v_before - r.i, r.v_total) for r in out} == {(0, 50)} and len(out) == 100
    assert prefix_sums(df.where("i < 0"), [], [F.col("i")], ["v"], totals=True).count() == 0


def test_lag_crosses_slices_and_keeps_nulls(spark):
    df = spark.createDataFrame([(g, i, None if i % 7 == 0 else float(i)) for g in ("a", None) for i in range(60)], "g string, i int, x double")
    out = prefix_sums(df.repartition(5), ["g"], [F.col("i")], [], lags=["x"]).collect()
    assert len(out) == 120
    for r in out:
        assert r.x_prev == (None if r.i == 0 or (r.i - 1) % 7 == 0 else float(r.i - 1))


def test_fingerprints_ignore_order_and_count_repeats(spark):
    rows = [(i % 3, f"u{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "g int, uid string")
    one = table_fingerprint(df, ["g", "uid"]).first()
    assert one == table_fingerprint(df.repartition(4, "uid"), ["g", "uid"]).first() and one.n_rows == 40
    assert one.fingerprint != table_fingerprint(df.union(df.limit(1)), ["g", "uid"]).first().fingerprint
    parts = {r.g: (r.n_ids, r.ids_sha256) for r in id_list_fingerprint(df, "uid", ["g"]).collect()}
    assert {g: n for g, (n, _) in parts.items()} == {0: 14, 1: 13, 2: 13} and len({h for _, h in parts.values()}) == 3
    assert table_fingerprint(df.where("g > 9"), ["g", "uid"]).first().n_rows == 0


def test_cells_do_not_run_together_and_ranges_show_what_differs(spark):
    from tallyfold.functions.hashing import differing_ranges

    rows = [[("a", "b")], [("ab", "")], [("", "ab")], [("a\x1fb", "")], [("a", None)], [(None, "a")], [("a", "\x00")], [("-", "")], [(None, "")], [("1:a", None)]]
    found = {table_fingerprint(spark.createDataFrame(r, "x string, y string"), ["x", "y"]).first().fingerprint for r in rows}
    assert len(found) == len(rows)
    df = spark.range(3000).selectExpr("id", "id % 7 AS v")
    assert differing_ranges(df, df.repartition(3), ["id", "v"]).count() == 0
    out = differing_ranges(df, df.where("id <> 17").union(spark.createDataFrame([(17, 99), (5, 5)], "id long, v long")), ["id", "v"]).collect()
    assert 1 <= len(out) <= 3 and sum(r.n_right - r.n_left for r in out) == 1


def test_linear_head_of_many_targets(spark):
    pooled = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [0.0, -1.0])], "uid string, pooled array<double>")
    head = spark.createDataFrame([(f"t{i}", [i / 50, 0.5], -0.1) for i in range(60)], "target string, weights array<double>, bias double")
    got = {(r.uid, r.target): r.p for r in calibration.linear_scores(pooled, head, block=8).collect()}
    assert len(got) == 120
    assert got["a", "t7"] == pytest.approx(1 / (1 + np.exp(-(7 / 50 + 1.0 - 0.1)))) and got["b", "t59"] == pytest.approx(1 / (1 + np.exp(0.6)))
    assert calibration.linear_scores(pooled, head.where("false")).count() == 0
