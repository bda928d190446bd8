"""Known answers for reviews, contracts, slots, slices and arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.functions import arrays, geometry
from tallyfold.operators import bootstrap, configdiff, contracts, manifest, ranks, series
from tallyfold.plans import review

SLOTS = [("Sagittal", "fluid"), ("Coronal", "fluid"), ("Axial", "fluid"), ("Sagittal", "structural"), ("Coronal", "structural")]


def test_paired_bootstrap_extremes(spark):
    rows = [(f"u{i:02d}", "t", float(i % 2), m, float(i % 2) if m == "new" else 1.0 - i % 2) for i in range(40) for m in ("new", "old")]
    df = spark.createDataFrame(rows, "uid string, target string, y double, model string, p double")
    r = bootstrap.paired_delta(df, "new", "old", 25).first()
    assert (r.delta, r.ci_low, r.ci_high, r.n_boot, r.n_paired) == (1.0, 1.0, 1.0, 25, 40)


def preds(spark, rows):
    return spark.createDataFrame(rows, "uid string, split string, a double, b double")


def test_prediction_gates(spark):
    good = [("g", "gold", .5, .5), ("w", "weak", .5, .5)]
    assert contracts.prediction_violations(preds(spark, good), ["a", "b"]).count() == 0
    cases = {"invalid_prediction_probability": [("g", "gold", float("nan"), .5)], "duplicate_prediction_uid": good + good[:1],
             "invalid_prediction_split": [("g", "train", .5, .5)], "prediction_split_overlap": good + [("g", "weak", .5, .5)], "empty_predictions": []}
    for check, rows in cases.items():
        assert check in {r.check for r in contracts.prediction_violations(preds(spark, rows), ["a", "b"]).collect()}
    for v in (float("inf"), -.01, 1.01):
        assert contracts.prediction_violations(preds(spark, [("g", "gold", v, .5)]), ["a", "b"]).count() == 1


def test_submission_contract(spark):
    req = spark.createDataFrame([(i, u) for i, u in enumerate("abcd")], "row_ix long, uid string")
    ok = spark.createDataFrame([(i, u, ".25", ".25") for i, u in enumerate("abcd")], "row_ix long, uid string, x string, y string")
    assert contracts.submission_violations(ok, req, ["x", "y"]).count() == 0
    nan = ok.withColumn("x", F.when(F.col("uid") == "b", "NaN").otherwise(F.col("x")))
    assert [(r.check, r.key) for r in contracts.submission_violations(nan, req, ["x", "y"]).collect()] == [("not_prob", "b:x")]
    swapped = ok.withColumn("row_ix", F.when(F.col("uid") == "a", 1).when(F.col("uid") == "b", 0).otherwise(F.col("row_ix")))
    assert {r.check for r in contracts.submission_violations(swapped, req, ["x", "y"]).collect()} == {"uid_order_differs"}
    assert "columns" in {r.check for r in contracts.submission_violations(ok.select("row_ix", "uid", "y", "x"), req, ["x", "y"]).collect()}


def test_review_rejects_uncovered_gold(spark):
    folds = spark.createDataFrame([("g", 0, True, "eval", "g"), ("w", 1, False, "weak", "w")], "uid string, fold int, is_gold boolean, gold_split string, group_id string")
    long = spark.createDataFrame([("m", "weak", "w", "t", .5)], "model string, split string, uid string, target string, p double")
    cells = spark.createDataFrame([("w", "t", 1.0, 1.0, "weak")], "uid string, target string, y double, mask double, source string")
    with pytest.raises(contracts.ContractError, match="coverage"):
        review.review_model(long, cells, folds, "1", ["t"], new="m", old="n", rule={"split": "weak", "min_delta": 0, "ci95_lower_gt": 0})


def test_final_submission_fallback(spark):
    p = spark.createDataFrame([(m, u, "t", v) for m in ("a", "b") for u, v in (("x", .2), ("y", .6))], "model string, uid string, target string, p double")
    req = spark.createDataFrame([(f"{c}",) for c in "xyz"], "uid string")
    with pytest.raises(contracts.ContractError):
        review.final_submission(p, req, ["t"], ["a", "b"])
    got = {r.uid: r.t for r in review.final_submission(p, req, ["t"], ["a", "b"], limit=0.5).collect()}
    assert got == pytest.approx({"x": .2, "y": .6, "z": .4})


def test_scaled_ranks_lone_row(spark):
    df = spark.createDataFrame([("m", "t", "u", .5)], "model string, target string, uid string, p double")
    assert ranks.rank_mean(df).first().p == 0.0


def test_slot_selection(spark):
    cols = "study string, series string, plane string, fluid string, fat string, n int"
    rows = [("s", "sag-fs", "Sagittal", "1", "1", 7), ("s", "sag-t1", "Sagittal", "0", "0", 5), ("s", "cor-fs", "Coronal", "1", "1", 6), ("s", "ax-fs", "Axial", "1", "1", 4)]
    got = [r.series for r in series.select_slots(spark.createDataFrame(rows, cols), SLOTS).orderBy("slot").collect()]
    assert got == ["sag-fs", "cor-fs", "ax-fs", "sag-t1", None]
    t1 = spark.createDataFrame([("s", "t1", "Coronal", "0", None, 3)], cols)
    assert [r.series for r in series.select_slots(t1, SLOTS[:3]).orderBy("slot").collect()] == [None, "t1", None]
    assert [r.series for r in series.select_slots(t1, SLOTS).orderBy("slot").collect()] == [None, None, None, None, "t1"]
    two = spark.createDataFrame(rows + [("s", "sag-2", "Sagittal", "1", "0", 9)], cols)
    twice = [("Sagittal", "fluid"), ("Sagittal", "fluid"), ("Sagittal", "fluid")]
    assert [r.series for r in series.select_slots(two, twice).orderBy("slot").collect()] == ["sag-fs", "sag-2", "sag-t1"]


def _headers(spark, rows):
    return spark.createDataFrame(rows, "study string, series string, path string, iop array<double>, ipp array<double>, instance int, sop string")


AX = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]


def test_slice_order_modes(spark):
    rows = [("s", "iop", f"f{9 - i}", AX, [0.0, 0.0, 3.0 * i], i, f"u{i}") for i in range(5)]
    rows += [("s", "inst", f"f{i}", None, None, 10 - i, f"u{i}") for i in range(4)]
    rows += [("s", "path", f"f{i}", None, None, None if i == 1 else i, f"u{i}") for i in range(3)]
    out = series.order_slices(_headers(spark, rows))
    got = {}
    for r in out.orderBy("position").collect():
        got.setdefault((r.series, r.mode), []).append(r.path)
    assert got == {("iop", "iop_ipp"): ["f9", "f8", "f7", "f6", "f5"], ("inst", "instance_number_fallback"): ["f3", "f2", "f1", "f0"],
                   ("path", "path_fallback_not_sop_lex"): ["f0", "f1", "f2"]}
    geo = {r.series: r for r in series.through_plane_geometry(out).collect()}
    assert (geo["iop"].spacing_median, geo["iop"].spacing_max, geo["iop"].extent) == (3.0, 3.0, 12.0)
    assert geo["inst"].spacing_median is None
    planes = spark.createDataFrame([("s", "iop", "Axial"), ("s", "inst", "Axial"), ("s", "path", "Axial")], "study string, series string, plane string")
    qc = {r.series: r.reason for r in series.series_qc(_headers(spark, rows), planes).collect()}
    assert qc == {"iop": None, "inst": "missing_iop", "path": "missing_iop"}


def test_centers_match_numpy(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 7, 24, 61)], "n int")
    for k in (1, 3, 12):
        got = {r.n: r.c for r in df.select("n", arrays.series_centers(F.col("n"), k).alias("c")).collect()}
        for n, c in got.items():
            if k == 1:
                want = [n // 2]
            else:
                pos = np.linspace(.15, .85, k) * (n - 1)
                want = np.rint(np.clip(pos, 1, n - 2) if n >= 3 else pos).astype(int).tolist()
            assert c == want
    t = df.where("n = 3").select(arrays.neighbour_triplets(F.array(F.lit(0), F.lit(2)), F.col("n")).alias("t")).first().t
    assert t == [[0, 0, 1], [1, 2, 2]]


def test_slice_values_match_numpy(spark):
    rng = np.random.default_rng(0)
    data = [(i, rng.normal(100, 30, 50).tolist()) for i in range(4)] + [(9, [5.0] * 6)]
    df = spark.createDataFrame(data, "i int, v array<double>")
    got = {r.i: r for r in df.select("i", arrays.to_unit(arrays.percentile_clip(F.col("v"))).alias("u"), arrays.invert_monochrome(F.col("v"), F.lit("MONOCHROME1")).alias("m")).collect()}
    for i, v in data:
        a = np.array(v)
        lo, hi = np.percentile(a, [.5, 99.5])
        if hi <= lo:
            lo, hi = a.min(), a.max() + 1e-6
        c = np.clip(a, lo, hi)
        want = np.zeros_like(c) if c.max() <= c.min() else (c - c.min()) / (c.max() - c.min())
        assert np.allclose(got[i].u, want) and np.allclose(got[i].m, a.max() - a)


def test_crop_box(spark):
    df = spark.createDataFrame([(400, 500, [0.5, 0.5]), (400, 500, None), (400, 500, [0.0, 1.0]), (100, 90, [0.5, 1.0])], "r int, c int, s array<double>")
    got = [tuple(r.b) for r in df.select(geometry.crop_box(F.col("r"), F.col("c"), F.col("s")).alias("b")).collect()]
    assert got == [(40, 360, 90, 410, "pixel_spacing_mm"), (0, 400, 50, 450, "missing_spacing_square_fallback"),
                   (0, 400, 50, 450, "missing_spacing_square_fallback"), (0, 100, 0, 90, "pixel_spacing_mm")]


def test_budget_stops_at_first_overflow(spark):
    req = spark.createDataFrame([(1, "a", 40), (2, "b", 50), (3, "c", 30), (4, "d", 1)], "seq int, uid string, bytes long")
    have = spark.createDataFrame([("b", 45)], "uid string, bytes long")
    got = [r.status for r in manifest.admit_under_budget(req, have, 100, "seq").orderBy("seq").collect()]
    assert got == ["admitted", "admitted", "cache_budget_exceeded", "not_attempted"]


def test_config_diff(spark):
    entries = spark.createDataFrame([("c", "train.lr", "1"), ("c", "cache", "x"), ("a", "train.lr", "2"), ("a", "cache", "x"), ("a", "train.new", "9")], "arm string, key string, value string")
    pairs = spark.createDataFrame([("a", "c")], "arm string, control string")
    changed = configdiff.controlled_changes(entries, pairs)
    assert {r.key for r in changed.collect()} == {"train.lr", "train.new"}
    declared = spark.createDataFrame([("a", "train.lr"), ("a", "cache")], "arm string, key string")
    assert {(r.key, r.side) for r in configdiff.undeclared_changes(changed, declared).collect()} == {("train.new", "undeclared"), ("cache", "declared_but_equal")}


def test_slices_are_shuffled_once(spark, tmp_path):
    """Series with gaps, ties, tilted slices, null keys and null paths against a plain version, from one exchange by series."""
    import random

    rng = random.Random(4)
    rows = []
    for s in range(40):
        for i in range(rng.randint(1, 9)):
            iop = None if s % 7 == 3 and i == 1 else [1.0, 0.0, 0.0, 0.0, 0.6, 0.8] if s % 5 == 4 and i == 2 else AX
            rows.append((f"s{s}", "a", f"f{rng.randint(100, 999)}{i}", iop, [0.0, 0.0, float(rng.randint(0, 20))], None if s % 3 else i, f"u{i // (1 + (s % 11 == 0))}"))
    rows += [(None, "a", f"x{i}", AX, [0.0, 0.0, 1.0], i, "u") for i in range(5)]
    headers = _headers(spark, rows).repartition(3)
    out = series.order_slices(headers)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan
    got = {}
    for r in out.orderBy("position").collect():
        got.setdefault(r.study, []).append(r)
    assert None not in got and sum(map(len, got.values())) == len(rows) - 5
    geo = {r.study: r for r in series.through_plane_geometry(out).collect()}
    for study, found in got.items():
        assert [r.position for r in found] == list(range(len(found)))
        proj = [r.proj for r in found]
        assert [r.proj_prev for r in found] == [None, *proj[:-1]]
        if found[0].mode == "iop_ipp":
            assert [(r.proj, r.path) for r in found] == sorted((r.proj, r.path) for r in found)
        if len(proj) < 2 or None in proj:
            assert geo[study].spacing_median is None and geo[study].extent is None
        else:
            gaps = np.diff(proj)
            assert geo[study].spacing_median == pytest.approx(np.median(gaps), abs=1e-4) and geo[study].spacing_max == pytest.approx(max(gaps), abs=1e-4)
            assert geo[study].extent == pytest.approx(proj[-1] - proj[0], abs=1e-3)
    ser = headers.where("study IS NOT NULL").select("study", "series").distinct().selectExpr("study", "series", "'Axial' plane", "'1' fluid", "'1' fat", "0 n")
    plan = {r.study: r for r in series.series_plan(ser, headers, SLOTS, 3).where("present").collect()}
    assert {s: (r.n, r.mode, r.spacing_median) for s, r in plan.items()} == {s: (len(f), f[0].mode, geo[s].spacing_median) for s, f in got.items()}
