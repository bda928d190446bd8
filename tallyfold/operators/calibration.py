"""Calibration, loss and sampling weights as grouped sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.arrays import linear_probability
from tallyfold.functions.predicates import sigmoid
from tallyfold.scale import attach, col, cols


def shrink(p: Column, n: Column, prior: Column | float = 0.5, k: float = 8.0) -> Column:
    prior = prior if isinstance(prior, Column) else F.lit(float(prior))
    w = n / (n + F.lit(k))
    return w * p + (1 - w) * prior


def calibrate_from_gold(scored: DataFrame, keys: Sequence[str] = ("target",), minimum: int = 8) -> DataFrame:
    """Per key: prevalence, mean score, the mean shrunk toward prevalence, spread and collapse flag."""
    agg = scored.groupBy(*cols(keys)).agg(
        F.count("y").alias("n"), F.count("p").alias("__np"), F.avg("y").alias("prev"), F.avg("p").alias("pm"),
        F.stddev_pop("p").alias("sd"))
    ok = (F.col("n") >= minimum) & (F.col("__np") == F.col("n"))
    return agg.select(
        *cols(keys), F.when(ok, F.lit("ok")).otherwise(F.lit("insufficient_gold")).alias("status"), "n",
        F.when(ok, F.col("prev")).alias("gold_prevalence"), F.when(ok, F.col("pm")).alias("pred_mean"),
        F.when(ok, shrink(F.col("pm"), F.col("n"), F.col("prev"))).alias("shrunk_mean"),
        F.when(ok, F.col("sd")).alias("spread"), F.when(ok, F.col("sd") < 1e-4).alias("collapsed"))


def masked_bce(cells: DataFrame, keys: Sequence[str] = (), logit: str = "logit", eps: float = 1e-8) -> DataFrame:
    """Weighted loss over unmasked cells; 0 when nothing is weighted. A -1 target is counted as an error."""
    t = F.when(F.isnan(F.coalesce("y", F.lit(float("nan")))), F.lit(0.0)).otherwise(F.col("y"))
    p = sigmoid(col(logit))
    w = F.col("mask").cast("double") * F.coalesce(F.col("weight"), F.lit(1.0))
    loss = -(t * F.ln(p + eps) + (1 - t) * F.ln(1 - p + eps))
    return cells.groupBy(*cols(keys)).agg(
        F.coalesce(F.try_divide(F.sum(loss * w), F.nullif(F.sum(w), F.lit(0.0))), F.lit(0.0)).alias("loss"),
        F.sum(w).alias("weight"), F.count_if(t == -1.0).alias("sentinel_errors"))


def masked_mean(vectors: DataFrame, ids: Sequence[str], vector: str = "vector", mask: str = "mask",
                eps: float = 1e-6) -> DataFrame:
    """Element-wise masked mean of equally long vectors per id, combined map-side per dimension."""
    flat = vectors.select(*cols(ids), col(mask).cast("double").alias("__m"), F.posexplode(col(vector)).alias("__d", "__v"))
    per = flat.groupBy(*cols(ids), "__d").agg(
        (F.sum(F.col("__v") * F.col("__m")) / F.greatest(F.sum("__m"), F.lit(eps))).alias("__x"))
    packed = F.sort_array(F.collect_list(F.struct("__d", "__x")))  # one entry per dimension
    return per.groupBy(*cols(ids)).agg(F.transform(packed, lambda s: s["__x"]).alias("pooled"))


def joint_counts(pairs: DataFrame) -> DataFrame:
    """One row (n00, n01, n10, n11) over rows where both labels are observed."""
    both = (F.col("m0") > 0) & (F.col("m1") > 0)
    code = F.when(both, 2 * F.col("y0") + F.col("y1"))
    return pairs.agg(*[F.count_if(code == i).alias(f"n{i // 2}{i % 2}") for i in range(4)])


def conditional_weights(pairs: DataFrame, cap: float = 3.0) -> DataFrame:
    """Sampling weight 1/sqrt(joint count), scaled to mean 1 over rows with both labels, then capped.

    The mean of 1/sqrt(count of own cell) is sum(sqrt(count)) / total, so it comes from
    the four counts. Rows with one label unknown weigh 1.
    """
    c = joint_counts(pairs)
    names = ["n00", "n01", "n10", "n11"]
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    mean = F.try_divide(sum((F.sqrt(F.col(n)) for n in names[1:]), F.sqrt(F.col(names[0]))), F.nullif(total, F.lit(0)))
    both = (F.col("m0") > 0) & (F.col("m1") > 0)
    own = F.when((F.col("y0") == 0) & (F.col("y1") == 0), F.col("n00")).when(
        (F.col("y0") == 0) & (F.col("y1") == 1), F.col("n01")).when(
        (F.col("y0") == 1) & (F.col("y1") == 0), F.col("n10")).otherwise(F.col("n11"))
    w = F.least(F.try_divide(F.lit(1.0), F.sqrt(own)) / F.col("__mean"), F.lit(float(cap)))
    out = attach(pairs, c.withColumn("__mean", mean))
    return out.withColumn("weight", F.when(both, w).otherwise(F.lit(1.0))).drop(*names, "__mean")


def conditional_weight_violations(pairs: DataFrame) -> DataFrame:
    """Rows without any observed label or with an observed value that is not 0/1."""
    seen0, seen1 = F.col("m0") > 0, F.col("m1") > 0
    bad = (seen0 & F.coalesce(~F.col("y0").isin(0.0, 1.0), F.lit(True))) | (
        seen1 & F.coalesce(~F.col("y1").isin(0.0, 1.0), F.lit(True)))
    check = F.when(~seen0 & ~seen1, F.lit("no_observed_target")).when(bad, F.lit("not_binary"))
    return pairs.withColumn("check", check).where(F.col("check").isNotNull()).select("check", "uid")


def linear_scores(pooled: DataFrame, head: DataFrame, ids: Sequence[str] = ("uid",), block: int = 256) -> DataFrame:
    """Probability per (id, target) from pooled vectors and a (target, weights, bias) head.

    Targets are dealt by hash to blocks of about ``block`` and every vector meets every block by an
    equi-join, whose plan Spark picks by the size of the head; no head is too large.
    """
    n = head.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block)).cast("int").alias("__blocks"))
    dealt = attach(head, n).groupBy(F.pmod(F.xxhash64("target"), "__blocks").cast("int").alias("__block")).agg(
        F.collect_list(F.struct("target", "weights", "bias")).alias("__head"))
    rows = attach(pooled, n).withColumn("__block", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))).join(dealt, "__block")
    return rows.select(*cols(ids), "pooled", F.explode("__head").alias("h")).select(
        *cols(ids), "h.target", linear_probability(F.col("pooled"), F.col("h.weights"), F.col("h.bias")).alias("p"))
