"""Array-valued column functions: window centers, value scaling, linear scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.functions.hashing import uniform60
from tallyfold.functions.predicates import clip, sigmoid


def let(bindings: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """Evaluate the bindings once per row and hand them to ``body`` as struct fields.

    A lambda over an array evaluates whatever it captures once per element; a sorted copy or
    a maximum of the whole array must not be recomputed for each of its elements.
    """
    packed = F.array(F.struct(*[v.alias(k) for k, v in bindings.items()]))
    return F.get(F.transform(packed, body), F.lit(0))


def _steps(lo: Column, hi: Column, k: int) -> Column:
    """k evenly spaced doubles from lo to hi inclusive."""
    if k == 1:
        return F.array(lo)
    return F.array(*[lo + (hi - lo) * F.lit(i / (k - 1)) for i in range(k)])


def series_centers(n: Column, k: int, *, strategy: str = "interior", lower: float = 0.15,
                   upper: float = 0.85) -> Column:
    """Slice positions sampled from a series of n slices."""
    if k < 1 or strategy not in {"interior", "legacy"} or not 0 <= lower < upper <= 1:
        raise ValueError("invalid center count, strategy or fractions")
    n = n.cast("long")
    if k == 1:
        return F.array(F.floor(n / 2).cast("int"))
    if strategy == "legacy":
        return F.transform(_steps(F.lit(0.0), (n - 1).cast("double"), k), lambda x: F.floor(x).cast("int"))
    pos = F.array(*[F.lit(lower + (upper - lower) * i / (k - 1)) * (n - 1) for i in range(k)])
    inner = F.transform(pos, lambda x: F.greatest(F.lit(1.0), F.least((n - 2).cast("double"), x)))
    return F.transform(F.when(n >= 3, inner).otherwise(pos), lambda x: F.rint(x).cast("int"))


def evaluation_centers(n: Column, k: int) -> Column:
    """Evenly spaced centers over the inner 4 to 96 percent, kept off both ends."""
    d = n.cast("double")
    a = F.greatest(F.lit(1.0), F.lit(0.04) * (d - 1))
    b = F.least(d - 2, F.lit(0.96) * (d - 1))
    mid = (d - 1) / 2
    lo, hi = F.when(b < a, mid).otherwise(a), F.when(b < a, mid).otherwise(b)
    return F.transform(_steps(lo, hi, k), lambda x: clip_int(F.rint(x), F.lit(1), n - 2))


def clip_int(x: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(lo.cast("int"), F.least(hi.cast("int"), x.cast("int")))


def neighbour_triplets(centers: Column, n: Column) -> Column:
    """(center-1, center, center+1) clamped to the series ends."""
    return F.transform(centers, lambda c: F.array(
        *[clip_int(c + d, F.lit(0), n - 1) for d in (-1, 0, 1)]))


def duplicate_count(values: Column) -> Column:
    return F.size(values) - F.size(F.array_distinct(values))


def rescale(values: Column, slope: Column, intercept: Column) -> Column:
    return F.transform(values, lambda v: v.cast("double") * slope + intercept)


def invert_monochrome(values: Column, photometric: Column) -> Column:
    """Flip values around their maximum for the MONOCHROME1 interpretation."""
    flip = F.coalesce(F.upper(photometric) == "MONOCHROME1", F.lit(False))
    return let({"v": values, "flip": flip}, lambda s: F.when(s["flip"], let(
        {"v": s["v"], "top": F.array_max(s["v"])}, lambda t: F.transform(t["v"], lambda x: t["top"] - x))).otherwise(s["v"]))


def _at(ordered: Column, q: float) -> Column:
    """Linear interpolation at quantile q of a sorted array."""
    pos = (F.size(ordered) - 1) * F.lit(float(q))
    lo, hi = F.floor(pos).cast("int"), F.ceil(pos).cast("int")
    a, b = F.get(ordered, lo), F.get(ordered, hi)
    return a + (b - a) * (pos - lo)


def array_quantile(values: Column, q: float) -> Column:
    """Linear-interpolation quantile of one array cell."""
    return let({"o": F.sort_array(values)}, lambda s: _at(s["o"], q))


def percentile_clip(values: Column, low: float = 0.5, high: float = 99.5) -> Column:
    """Clip to two percentiles; to the full range when they coincide."""
    def ends(s: Column) -> Column:
        return let({"v": s["v"], "lo": _at(s["o"], low / 100), "hi": _at(s["o"], high / 100),
                    "mn": F.get(s["o"], F.lit(0)), "mx": F.get(s["o"], F.size(s["o"]) - 1)}, window)

    def window(s: Column) -> Column:
        flat = F.coalesce(s["hi"] <= s["lo"], F.lit(True))
        return let({"v": s["v"], "lo": F.when(flat, s["mn"]).otherwise(s["lo"]),
                    "hi": F.when(flat, s["mx"] + F.lit(1e-6)).otherwise(s["hi"])},
                   lambda t: F.transform(t["v"], lambda x: F.least(t["hi"], F.greatest(t["lo"], x))))

    return let({"v": values, "o": F.sort_array(values)}, ends)


def to_unit(values: Column) -> Column:
    """Scale an array to [0, 1]; a constant array becomes zeros."""
    return let({"v": values}, lambda s: let(
        {"v": s["v"], "lo": F.array_min(s["v"]), "hi": F.array_max(s["v"])},
        lambda t: F.transform(t["v"], lambda x: F.when(t["hi"] <= t["lo"], F.lit(0.0)).otherwise(
            F.try_divide(x - t["lo"], t["hi"] - t["lo"])))))


def with_window(values: Column, lo: Column, hi: Column) -> Column:
    """Clip to a shared intensity window and scale to [0, 1]."""
    return F.transform(values, lambda v: (F.least(hi, F.greatest(lo, v)) - lo) / (hi - lo))


def encode_uint8(values: Column) -> Column:
    return F.transform(values, lambda v: F.floor(clip(v * 255.0, 0, 255)).cast("int"))


def decode_uint8(values: Column) -> Column:
    return F.transform(values, lambda v: v.cast("double") / 255.0)


def seeded_subset(valid: Column, size: Column, k: int, *key: Column | str | int) -> Column:
    """k window positions of one row in physical order, chosen by a seeded hash.

    ``valid`` holds the usable positions and ``size`` the number of positions. With
    fewer than k usable positions all are kept and unusable ones fill up in order.
    """
    everything = F.sequence(F.lit(0), size.cast("int") - 1)
    unusable = F.array_except(everything, valid)
    drawn = F.transform(
        F.slice(F.sort_array(F.transform(valid, lambda i: F.struct(
            uniform60(*key, i.cast("string")).alias("h"), i.cast("int").alias("i")))), 1, k),
        lambda s: s["i"])
    padded = F.slice(F.concat(valid, unusable), 1, k)
    return F.sort_array(F.when(F.size(valid) >= k, drawn).otherwise(padded))


def dot(x: Column, w: Column) -> Column:
    products = F.zip_with(x, w, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def linear_probability(x: Column, weight: Column, bias: Column) -> Column:
    return clip(sigmoid(dot(x, weight) + bias), 0.0, 1.0)
