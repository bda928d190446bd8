"""Bootstrap intervals as replicate weights.

A replicate that draws n units with replacement is the vector of how often each unit was drawn. ``multinomial`` makes these vectors
exactly, ``poisson`` approximately; either way the scored rows are range partitioned by score once and no replicate is a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import multinomial, poisson
from tallyfold.operators.auc import target_auc
from tallyfold.scale import attach, col, cols, join_on, ordinal_rank, pin


def index_units(units: DataFrame, unit: str, strata: Sequence[str] = ()) -> DataFrame:
    """(strata, unit, idx, n): distinct units numbered 0..n-1 in unit order."""
    strata = list(strata)
    distinct = units.select(*cols([*strata, unit])).distinct()
    return ordinal_rank(distinct, strata, [col(unit)], "idx", size="n").withColumn("idx", F.col("idx") - 1)


def replicates(scored: DataFrame, keys: Sequence[str], n_boot: int, seed: int, unit: Sequence[str], universe: DataFrame,
               strata: Sequence[str], method: str) -> DataFrame:
    """(keys, b, n_pos, n_neg, auc) of every replicate; units are drawn from those of ``universe``, in each of ``strata`` for itself.

    ``unit`` names what is drawn within the strata. Exact draws are the same for all keys of a stratum."""
    own = [*strata, *unit]
    if method == "poisson":
        return poisson.replicate_auc(scored, keys, n_boot, seed, [*unit] if unit == ["uid"] else own)
    if method != "multinomial":
        raise ValueError(f"unknown method {method!r}")
    drawn = multinomial.drawn_units(index_units(universe, unit[0], strata), own, strata, n_boot, seed)
    return poisson.replicate_auc(scored, keys, n_boot, seed, own, drawn)


def interval(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean, 2.5 and 97.5 percentile over replicates; at most n_boot values per key."""
    return values.where(col(value).isNotNull()).groupBy(*cols(keys)).agg(
        F.avg(col(value)).alias("mean"),
        F.percentile(col(value), F.lit(0.025)).alias("low"),
        F.percentile(col(value), F.lit(0.975)).alias("high"),
        F.count(F.lit(1)).alias("n_boot"))


def bootstrap_macro(scored: DataFrame, n_boot: int = 200, seed: int = 0, *, by: Sequence[str] = (), method: str = "multinomial") -> DataFrame:
    """Study bootstrap of the macro AUC: (by, uid, target, y, p) -> by, mean, low, high, n_boot. All of ``by`` share their draws.

    ``method="poisson"`` draws independent weights instead of exact counts.
    """
    by = list(by)
    scored = pin(scored.select(*cols(by), "uid", "target", "y", "p"))
    per = replicates(scored, [*by, "target"], n_boot, seed, ["uid"], scored, [], method)
    return interval(per.groupBy(*cols(by), "b").agg(F.avg("auc").alias("macro")), by, "macro")


def paired_delta(scored: DataFrame, new: str, old: str, n_boot: int = 2000, seed: int = 2026,
                 strata: Sequence[str] = (), *, method: str = "multinomial", expected: DataFrame | None = None) -> DataFrame:
    """Macro AUC difference of two models on the same draws, per stratum.

    ``method="poisson"`` draws independent weights instead of exact counts.

    ``scored`` is (strata, uid, target, y, model, p) with a row for both models.
    Returns delta, ci_low, ci_high, the three rounded to 5 digits, n_boot and n_paired.
    A stratum of ``expected`` without a pair has a null delta and interval, and n_boot and n_paired of 0.
    """
    strata = list(strata)
    both = pin(scored.where(col("model").isin(new, old)).select(*cols(strata), "uid", "target", "y", "model", "p"))
    point = _macro_delta(target_auc(both, [*strata, "model", "target"]), strata, new, old)
    per = replicates(both, [*strata, "model", "target"], n_boot, seed, ["uid"], both, strata, method)
    deltas = _macro_delta(per, [*strata, "b"], new, old)
    ci = interval(deltas, strata, "delta").drop("mean")
    sizes = both.groupBy(*cols(strata)).agg(F.countDistinct("uid").alias("n_paired"))
    out = point
    for side in (ci, sizes):
        out = join_on(out, side, strata, "left") if strata else attach(out, side)
    if expected is not None:
        out = join_on(expected.select(*cols(strata)).distinct(), out, strata, "left")
    return out.select(
        *cols(strata), "delta", F.col("low").alias("ci_low"), F.col("high").alias("ci_high"),
        F.round("delta", 5).alias("delta_5"), F.round("low", 5).alias("ci_low_5"), F.round("high", 5).alias("ci_high_5"),
        F.coalesce("n_boot", F.lit(0)).alias("n_boot"), F.coalesce("n_paired", F.lit(0)).alias("n_paired"))


def _macro_delta(per: DataFrame, keys: Sequence[str], new: str, old: str) -> DataFrame:
    macro = per.groupBy(*cols(keys)).agg(
        F.avg(F.when(col("model") == new, F.col("auc"))).alias("__new"),
        F.avg(F.when(col("model") == old, F.col("auc"))).alias("__old"))
    return macro.select(*cols(keys), (F.col("__new") - F.col("__old")).alias("delta"))


def group_bootstrap_delta(scored: DataFrame, new: str, old: str, n_boot: int = 2000, seed: int = 2026, *,
                          groups: DataFrame | None = None, method: str = "multinomial") -> DataFrame:
    """Resample whole groups inside each fold and average the per (fold, target) deltas.

    ``method="poisson"`` draws independent weights instead of exact counts.

    ``scored`` is (fold, group_id, uid, target, y, model, p). A replicate counts only
    when every (fold, target) keeps both classes. ``groups`` is the (fold, group_id)
    universe to draw from, by default the groups of the scored rows.
    """
    both = pin(scored.where(col("model").isin(new, old) & col("y").isin(0.0, 1.0)).select(
        "fold", "group_id", "target", "y", "model", "p"))
    universe = both if groups is None else groups
    per = replicates(both, ["fold", "target", "model"], n_boot, seed, ["group_id"], universe, ["fold"], method)
    strata = both.select("fold", "target").distinct().agg(F.count(F.lit(1)).alias("n_strata"))
    pairs = per.groupBy("b", "fold", "target").agg(
        F.max(F.when(col("model") == new, F.col("auc"))).alias("__new"),
        F.max(F.when(col("model") == old, F.col("auc"))).alias("__old"))
    deltas = pairs.groupBy("b").agg(
        F.avg(F.col("__new") - F.col("__old")).alias("delta"),
        F.count(F.col("__new") - F.col("__old")).alias("defined"))
    kept = attach(deltas, strata).where(F.col("defined") == F.col("n_strata"))
    return interval(kept, [], "delta")


def group_bootstrap_auc(scored: DataFrame, n_boot: int = 2000, seed: int = 2026, *, by: Sequence[str] = (),
                        method: str = "multinomial") -> DataFrame:
    """Per (by, target): interval of the AUC when whole groups of a target are resampled, the same ones for all of ``by``."""
    by = list(by)
    rows = pin(scored.where(col("y").isin(0.0, 1.0)).select(*cols(by), "target", "group_id", "y", "p"))
    per = replicates(rows, [*by, "target"], n_boot, seed, ["group_id"], rows, ["target"], method)
    return interval(per, [*by, "target"], "auc")
