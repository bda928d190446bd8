"""Quantiles over arrays by radix selection, and the composed slice job."""

import numpy as np
from pyspark.sql import functions as F

from tallyfold.operators import radix, series


def test_bits_order_like_doubles():
    x = np.array([-np.inf, -1e300, -2.0, -1e-310, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300])
    bits = radix.ordered_bits(x)
    assert (np.diff(bits.astype(object)) >= 0).all() and bits[4] == bits[5]
    assert (radix.doubles(bits) == x).all()


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(5)
    groups = {
        ("a", "x"): [rng.normal(0, 100, n) for n in (3, 500, 0, 1)], ("a", None): [rng.integers(-3, 4, 400).astype(float)], ("b", "x"): [np.array([7.25])],
        ("b", "y"): [np.full(90, -0.0), np.full(10, 1e-300)], ("c", "x"): [rng.normal(0, 1e-9, 300) + 1.0]}
    rows = [(*k, [float(v) for v in a]) for k, arrays in groups.items() for a in arrays] + [("a", "x", None), ("a", "x", [None, float("nan"), float("inf")]), ("none", "z", [])]
    df = spark.createDataFrame(rows, "study string, series string, values array<double>").repartition(5)
    shares = {"lo": 0.005, "mid": 0.5, "hi": 0.995, "top": 1.0}
    got = {(r.study, r.series): r for r in radix.array_quantiles(df, ["study", "series"], "values", shares).collect()}
    assert set(got) == set(groups)
    for k, arrays in groups.items():
        whole = np.concatenate(arrays)
        assert got[k].n == len(whole)
        for name, q in shares.items():
            a, b = np.quantile(whole, q, method="lower"), np.quantile(whole, q, method="higher")
            assert abs(got[k][name] - np.quantile(whole, q)) <= 1e-12 * max(1, abs(a), abs(b))


def test_center_slices(spark):
    rng = np.random.default_rng(2)
    headers = [("s", "m", f"p{i:02d}", 50 - i, None, None) for i in range(9)] + [("s", "one", "q", 1, None, None)]
    pixels = {h[:3]: rng.integers(0, 900, 20).astype(float) for h in headers}
    slices = [(*k, 4, 5, [2.0, 1.0] if k[1] == "m" else None, 1.0, 0.0, "MONOCHROME2", v.tolist()) for k, v in pixels.items()]
    h = spark.createDataFrame(headers, "study string, series string, path string, instance int, iop array<double>, ipp array<double>")
    s = spark.createDataFrame(slices, "study string, series string, path string, rows int, cols int, spacing array<double>, slope double, intercept double, photometric string, values array<double>")
    out = {(r.series, r.position): r for r in series.center_slices(h, s, 2, crop_mm=4.0, intensity="series").collect()}
    # centers of nine slices are 1 and 7, in the order of instances, which runs against the paths
    assert sorted(out) == [("m", i) for i in (0, 1, 2, 6, 7, 8)] + [("one", 0)]
    assert [(p.center, p.neighbour) for p in out[("m", 1)].places] == [(0, 1)] and len(out[("one", 0)].places) == 6
    used = {i: pixels[("s", "m", f"p{8 - i:02d}")].reshape(4, 5)[1:3, 0:4].ravel() for i in (0, 1, 2, 6, 7, 8)}
    lo, hi = np.quantile(np.concatenate(list(used.values())), [0.005, 0.995])
    for i, v in used.items():
        r = out[("m", i)]
        assert r.path == f"p{8 - i:02d}" and r.n_slices == 9 and (r.crop.r0, r.crop.r1, r.crop.c0, r.crop.c1, r.crop.mode) == (1, 3, 0, 4, "pixel_spacing_mm")
        assert np.abs(np.array(r.q) - np.floor((np.clip(v, lo, hi) - lo) / (hi - lo) * 255)).max() <= 1
    assert out[("one", 0)].crop.mode == "missing_spacing_square_fallback" and len(out[("one", 0)].q) == 16
    own = series.center_slices(h, s.where(F.col("path") != "p08"), 2, crop_mm=4.0).collect()
    assert [r.q is None for r in own].count(True) == 1 and len(own) == 7
