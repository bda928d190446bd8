"""Agreement between label sources, between a source and gold, and between scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.auc import rounded_macro, target_auc
from tallyfold.operators.labels import policy_scores
from tallyfold.operators.ranks import mid_ranks
from tallyfold.scale import col, cols


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over the given columns; null stays a value of its own."""
    cells = df.select(*[col(c).cast("string").alias(c) for c in columns]).unpivot([], cols(columns), "column", "value")
    return cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def pearson(x: Column, y: Column) -> Column:
    """Correlation from moments over rows where both sides are present; null when a side does not vary."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0)))


def source_pairs(sources: DataFrame, keys: Sequence[str] = ("uid", "target")) -> DataFrame:
    """Every unordered pair of sources on a shared cell. A cell holds one row per source, so pairs stay few."""
    a = sources.select(*cols(keys), F.col("source").alias("source_a"), F.col("p").alias("pa"))
    b = sources.select(*cols(keys), F.col("source").alias("source_b"), F.col("p").alias("pb"))
    return a.join(b, list(keys)).where(F.col("source_a") < F.col("source_b"))


def pairwise_pearson(sources: DataFrame, digits: int = 3) -> DataFrame:
    return source_pairs(sources.where(F.col("p").isNotNull())).groupBy("target", "source_a", "source_b").agg(
        F.round(pearson(F.col("pa"), F.col("pb")), digits).alias("r"), F.count(F.lit(1)).alias("n"))


def spearman_with(preds: DataFrame, reference: str) -> DataFrame:
    """(model, target, rho): rank correlation of every model with the reference model on shared ids."""
    ref = preds.where(col("model") == reference).select("uid", "target", F.col("p").alias("__pr"))
    both = preds.join(ref, ["uid", "target"])
    ranked = mid_ranks(both, ["model", "target"], "p").withColumnRenamed("rank", "__ra").drop("ties", "n")
    ranked = mid_ranks(ranked, ["model", "target"], "__pr")
    return ranked.groupBy("model", "target").agg(pearson(F.col("__ra"), F.col("rank")).alias("rho"))


def source_vs_gold(sources: DataFrame, gold: DataFrame) -> DataFrame:
    """(source, target, n, missing, auc rounded to 4): each source against trusted cells (uid, target, y)."""
    labelled = gold.select("uid", "target", "y")
    per = target_auc(sources.join(labelled, ["uid", "target"]), ["source", "target"])
    wanted = labelled.groupBy("target").agg(F.count(F.lit(1)).alias("__want"))
    offered = sources.select("source", "target").distinct().join(wanted, "target")
    n = F.coalesce(F.col("n"), F.lit(0).cast("long"))
    return offered.join(per, ["source", "target"], "left").select(
        "source", "target", n.alias("n"), (F.col("__want") - n).alias("missing"), F.round("auc", 4).alias("auc"))


def policy_vs_gold(states: DataFrame, gold: DataFrame, policies: dict[str, dict[str, float]]) -> DataFrame:
    """(policy, target, n_scored, auc rounded to 4): report states scored under each policy against gold."""
    scored = policy_scores(states, policies).join(gold.where(F.col("y").isin(0.0, 1.0)), ["uid", "target"])
    return target_auc(scored, ["policy", "target"]).select(
        "policy", "target", F.col("n").alias("n_scored"), F.round("auc", 4).alias("auc"))


def policy_macro(per: DataFrame) -> DataFrame:
    return rounded_macro(per, ["policy"], "auc")


def state_positive_rate(states: DataFrame, gold: DataFrame) -> DataFrame:
    """(target, state, n, rate): gold positive rate by report state, an absent state reads ``missing``."""
    return states.join(gold, ["uid", "target"]).groupBy(
        "target", F.coalesce("state", F.lit("missing")).alias("state")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 2).alias("rate"))


def state_score_profile(states: DataFrame, sources: DataFrame, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """(source, target, state, n, mean, share high, share low) of public scores by our state."""
    joined = states.join(sources, ["uid", "target"])
    return joined.groupBy("source", "target", F.coalesce("state", F.lit("missing")).alias("state")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 3).alias("mean"),
        F.round(F.avg((F.col("p") >= high).cast("double")), 3).alias("frac_high"),
        F.round(F.avg((F.col("p") <= low).cast("double")), 3).alias("frac_low"))


def explicit_state_auc(states: DataFrame, sources: DataFrame) -> DataFrame:
    """AUC of public scores against our explicit positive / negative states."""
    y = F.when(F.col("state") == "criterion_positive", 1.0).when(F.col("state") == "explicit_negative", 0.0)
    joined = states.withColumn("y", y).where(F.col("y").isNotNull()).join(sources, ["uid", "target"])
    return target_auc(joined, ["source", "target"]).select(
        "source", "target", "n", F.round("auc", 4).alias("auc"))


def disagreements(states: DataFrame, scores: DataFrame, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """(target, kind, uid): we say positive and the source is low, or the other way round."""
    kind = (
        F.when((F.col("state") == "criterion_positive") & (F.col("p") <= low), F.lit("ours_positive_public_low"))
        .when((F.col("state") == "explicit_negative") & (F.col("p") >= high), F.lit("ours_negative_public_high")))
    return states.join(scores, ["uid", "target"]).withColumn("kind", kind).where(F.col("kind").isNotNull()).select(
        "target", "kind", "uid")


def disagreement_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("target", "kind").agg(F.count(F.lit(1)).alias("n"))


def parity(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("uid", "target"), member: Sequence[str] = ("model",),
           max_abs: float = 0.02, mean_abs: float = 0.002) -> DataFrame:
    """Largest and mean absolute difference of two prediction tables per member, with the accept flag."""
    on = [*member, *keys]
    joined = a.select(*cols(on), F.col("p").alias("pa")).join(b.select(*cols(on), F.col("p").alias("pb")), on)
    d = F.abs(F.col("pa") - F.col("pb"))
    return joined.groupBy(*cols(member)).agg(F.max(d).alias("max_abs"), F.avg(d).alias("mean_abs")).withColumn(
        "ok", (F.col("max_abs") <= max_abs) & (F.col("mean_abs") <= mean_abs))
