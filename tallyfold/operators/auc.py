"""Exact ROC-AUC from the distinct-score histogram.

AUC = sum(pos * (neg_below + neg / 2)) / (P * N) over distinct scores. A run of
consecutive scores is summarised by (pos, neg, wins); two neighbouring runs merge
into (pos1 + pos2, neg1 + neg2, wins1 + wins2 + pos2 * neg1). So the histogram can
be range partitioned, summarised slice by slice and merged in slice order: one
pass, no sort of a whole target in one task, no pair of rows ever built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.predicates import finite
from tallyfold.scale import PART, col, cols, join_on, prefix_sums, slices

BEFORE = (Window.unboundedPreceding, -1)


def usable(y: str = "y", p: str = "p", mask: str | None = None) -> Column:
    """Cells that enter a score: unmasked, finite label, finite score."""
    ok = finite(col(y)) & finite(col(p))
    return ok if mask is None else ok & F.coalesce(col(mask).cast("double") > 0, F.lit(False))


def score_histogram(scored: DataFrame, keys: Sequence[str], y: str = "y", p: str = "p", *,
                    mask: str | None = None, weight: str | None = None) -> DataFrame:
    """(keys, score, pos, neg, n): class totals per distinct score.

    Unusable cells fall into the null score with empty totals, so a key whose cells
    are all masked still shows up with n = 0.
    """
    ok = usable(y, p, mask)
    w = F.lit(1).cast("long") if weight is None else col(weight).cast("double")
    zero = F.lit(0).cast("long") if weight is None else F.lit(0.0)
    return scored.groupBy(*cols(keys), F.when(ok, col(p).cast("double")).alias("score")).agg(
        F.sum(F.when(ok & (col(y) == 1), w).otherwise(zero)).alias("pos"),
        F.sum(F.when(ok & (col(y) == 0), w).otherwise(zero)).alias("neg"),
        F.count_if(ok).alias("n"),
    )


def _wins(below: Column) -> Column:
    return F.col("pos") * (below + F.col("neg") / F.lit(2.0))


def histogram_auc(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, n_pos, n_neg, wins, auc) from a score histogram."""
    keys = list(keys)
    cut = slices(hist, keys, [F.col("score")])
    local = Window.partitionBy(*cols([*keys, PART])).orderBy("score").rowsBetween(*BEFORE)
    runs = (
        cut.withColumn("wins", _wins(F.coalesce(F.sum("neg").over(local), F.lit(0))))
        .groupBy(*cols([*keys, PART]))
        .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("wins").alias("wins"))
    )
    along = Window.partitionBy(*cols(keys)).orderBy(PART).rowsBetween(*BEFORE)
    steps = runs.withColumn(
        "wins", F.col("wins") + F.col("pos") * F.coalesce(F.sum("neg").over(along), F.lit(0)).cast("double"))
    total = steps.groupBy(*cols(keys)).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("wins").alias("wins"))
    defined = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    auc = F.when(defined, F.col("wins") / (F.col("n_pos").cast("double") * F.col("n_neg").cast("double")))
    return total.withColumn("auc", auc)


def target_auc(scored: DataFrame, keys: Sequence[str] = ("target",), y: str = "y", p: str = "p", *,
               mask: str | None = None, weight: str | None = None) -> DataFrame:
    """Masked AUC per key; null, never 0.5, when a class is missing."""
    hist = score_histogram(scored, keys, y, p, mask=mask, weight=weight)
    return histogram_auc(hist, keys).drop("wins").withColumn(
        "undefined", F.col("auc").isNull())


def macro_auc(per_target: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over defined targets."""
    return per_target.groupBy(*cols(keys)).agg(
        F.avg("auc").alias("macro_auc"), F.count("auc").alias("n_defined"), F.count(F.lit(1)).alias("n_targets"))


def rounded_macro(values: DataFrame, keys: Sequence[str], value: str, digits: int = 4) -> DataFrame:
    return values.groupBy(*cols(keys)).agg(F.round(F.avg(col(value)), digits).alias("macro"))


def diagnostics(scored: DataFrame, keys: Sequence[str] = ("target",), y: str = "y", p: str = "p") -> DataFrame:
    """Log-loss with clipped scores, population spread and mean of the finite scores."""
    ok_p, ok = finite(col(p)), usable(y, p)
    q = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), col(p)))
    loss = -(col(y) * F.ln(q) + (1 - col(y)) * F.ln(1 - q))
    return scored.groupBy(*cols(keys)).agg(
        F.avg(F.when(ok, loss)).alias("log_loss"),
        F.stddev_pop(F.when(ok_p, col(p))).alias("pred_std"),
        F.avg(F.when(ok_p, col(p))).alias("pred_mean"),
    )


def auc_delta(scored: DataFrame, new: str, old: str, keys: Sequence[str] = ("target",), **kw) -> DataFrame:
    """AUC of two models side by side and their difference, null when either is undefined."""
    both = scored.where(col("model").isin(new, old))
    per = target_auc(both, [*keys, "model"], **kw)
    return per.groupBy(*cols(keys)).agg(
        F.max(F.when(col("model") == new, F.col("auc"))).alias("auc_new"),
        F.max(F.when(col("model") == old, F.col("auc"))).alias("auc_old"),
    ).withColumn("delta", F.col("auc_new") - F.col("auc_old"))


def subgroup_auc(scored: DataFrame, stratum: str, keys: Sequence[str] = ("target",), **kw) -> DataFrame:
    """AUC inside each stratum value; a missing stratum value is its own stratum."""
    named = scored.withColumn(stratum, F.coalesce(col(stratum).cast("string"), F.lit("none")))
    return target_auc(named, [*keys, stratum], **kw)


def with_companion(scored: DataFrame, labels: DataFrame, companion: dict[str, str], name: str = "companion") -> DataFrame:
    """Attach the observed value of each target's companion target."""
    pairs = [F.lit(x) for kv in companion.items() for x in kv]
    wanted = scored.withColumn("__companion", F.try_element_at(F.create_map(*pairs), F.col("target")))
    observed = labels.where((F.col("mask") > 0) & F.col("y").isin(0.0, 1.0)).select(
        "uid", F.col("target").alias("__companion"), F.col("y").cast("int").alias(name))
    return wanted.join(observed, ["uid", "__companion"], "left").drop("__companion")


def pair_summary(scored: DataFrame, keys: Sequence[str] = ("target",), **kw) -> DataFrame:
    """Positive-negative pairs and misordered equivalents (a tie counts one half)."""
    hist = score_histogram(scored, keys)
    out = histogram_auc(hist, keys, **kw)
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return out.select(
        *cols(keys), "n_pos", "n_neg", pairs.cast("long").alias("n_pairs"),
        (pairs - F.col("wins")).alias("misordered"),
        F.when(pairs > 0, F.lit(1.0) - (pairs - F.col("wins")) / pairs).alias("identity_auc"))


def case_burden(scored: DataFrame, keys: Sequence[str] = ("target",)) -> DataFrame:
    """Share of opposite-class cases each case is misordered with (ties one half)."""
    keys = list(keys)
    rows = scored.where(usable() & col("y").isin(0.0, 1.0)).withColumn("score", F.col("p").cast("double"))
    hist = score_histogram(rows, keys)
    table = prefix_sums(hist, keys, [F.col("score")], ["pos", "neg"], totals=True)
    lost_pos = F.col("neg_total") - F.col("neg_before") - F.col("neg") / F.lit(2.0)
    lost_neg = F.col("pos_before") + F.col("pos") / F.lit(2.0)
    table = table.select(
        *cols(keys), "score",
        F.try_divide(lost_pos, F.col("neg_total")).alias("__bp"), F.try_divide(lost_neg, F.col("pos_total")).alias("__bn"))
    return join_on(rows, table, [*keys, "score"]).withColumn(
        "burden", F.when(F.col("y") == 1, F.col("__bp")).otherwise(F.col("__bn"))).drop("__bp", "__bn", "score")


def hardest_cases(burden: DataFrame, k: int | None = None) -> DataFrame:
    """Report order: target, then heaviest burden first; uid breaks ties."""
    ordered = burden.orderBy(F.col("target").asc(), F.col("burden").desc(), F.col("uid").asc())
    return ordered if k is None else ordered.limit(k)
