"""Rank-based scores and model blends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.scale import attach, col, cols, join_on, ordinal_rank, prefix_sums


def mid_ranks(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Add ``rank`` (ties share their average rank), ``ties`` and ``n`` (group size)."""
    group = list(group)
    hist = df.groupBy(*cols(group), col(value)).agg(F.count(F.lit(1)).alias("ties"))
    table = prefix_sums(hist, group, [col(value)], ["ties"], totals=True)
    table = table.select(*cols([*group, value]), "ties", F.col("ties_total").alias("n"),
                         (F.col("ties_before") + (F.col("ties") + 1) / F.lit(2.0)).alias("rank"))
    # one rank row per (group, value): a heavily tied value is a skewed row side that AQE may split
    return join_on(df, table, [*group, value])


def normalized_ranks(df: DataFrame, group: Sequence[str], value: str, name: str = "nrank") -> DataFrame:
    """Average rank divided by the group size, in (0, 1]."""
    return mid_ranks(df, group, value).withColumn(name, F.col("rank") / F.col("n")).drop("rank", "ties", "n")


def scaled_ordinal_ranks(df: DataFrame, group: Sequence[str], value: str, tiebreak: str, name: str = "srank") -> DataFrame:
    """Ordinal rank scaled to 0..1; ties are ordered by ``tiebreak``; a lone row gets 0."""
    group = list(group)
    joined = ordinal_rank(df, group, [col(value), col(tiebreak)], "__k", size="__n")
    scaled = F.coalesce(F.try_divide(F.col("__k") - 1, F.col("__n") - 1), F.lit(0.0))
    return joined.withColumn(name, scaled).drop("__k", "__n")


def rank_mean(preds: DataFrame) -> DataFrame:
    """Mean over models of the scaled ordinal rank: (model, uid, target, p) -> (uid, target, p)."""
    ranked = scaled_ordinal_ranks(preds, ["model", "target"], "p", "uid")
    return ranked.groupBy("uid", "target").agg(F.avg("srank").alias("p"))


def rank_blend(a: DataFrame, b: DataFrame, weight: float = 0.5) -> DataFrame:
    """(1-weight) * rank(a) + weight * rank(b) per (uid, target)."""
    ra = normalized_ranks(a.select("uid", "target", "p"), ["target"], "p", "ra").drop("p")
    rb = normalized_ranks(b.select("uid", "target", "p"), ["target"], "p", "rb").drop("p")
    return ra.join(rb, ["uid", "target"]).select(
        "uid", "target", ((1.0 - weight) * F.col("ra") + weight * F.col("rb")).alias("p"))


def equal_mean(preds: DataFrame, n_models: int | None = None) -> DataFrame:
    """Mean probability per (uid, target); ``complete`` tells whether every member covers the cell."""
    out = preds.groupBy("uid", "target").agg(F.avg("p").alias("p"), F.count(F.lit(1)).alias("members"))
    if n_models is None:
        n = preds.agg(F.count_distinct("model").alias("__m"))
        return attach(out, n).withColumn("complete", F.col("members") == F.col("__m")).drop("__m")
    return out.withColumn("complete", F.col("members") == F.lit(n_models))


def route(a: DataFrame, b: DataFrame, from_a: Sequence[str]) -> DataFrame:
    """Each target whole from one model: listed targets from ``a``, the rest from ``b``."""
    mine = col("target").isin(*from_a) if from_a else F.lit(False)
    pick = ["uid", "target", "p"]
    return a.where(mine).select(*pick).unionByName(b.where(~mine).select(*pick))


def fill_missing(preds: DataFrame, required: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Required ids without a prediction get the target mean over predicted ids, 0.5 when there is none."""
    grid = required.select("uid").withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))
    means = preds.where(col("target").isin(*targets)).groupBy("target").agg(F.avg("p").alias("__mean"))
    return (
        grid.join(preds.select("uid", "target", "p"), ["uid", "target"], "left")
        .join(F.broadcast(means), "target", "left")  # one row per target
        .select("uid", "target", F.coalesce("p", "__mean", F.lit(0.5)).alias("p"), F.col("p").isNull().alias("filled"))
    )


def missing_share(preds: DataFrame, required: DataFrame, limit: float = 0.1) -> DataFrame:
    """One row: how many required ids lack a prediction and whether that is within the limit."""
    have = preds.select("uid").distinct().withColumn("__have", F.lit(1))
    return required.select("uid").join(have, "uid", "left").agg(
        F.count(F.lit(1)).alias("n_required"),
        F.count_if(F.col("__have").isNull()).alias("n_missing"),
    ).withColumn("ok", F.col("n_missing") <= F.lit(limit) * F.col("n_required"))


def mirrored_mean(passes: DataFrame) -> DataFrame:
    """(uid, target, pass, p) with a plain and mirrored passes -> plain probability and the mean of all passes."""
    return passes.groupBy("uid", "target").agg(
        F.max(F.when(F.col("pass") == "plain", F.col("p"))).alias("p_plain"), F.avg("p").alias("p"))
