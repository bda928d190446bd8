"""Model review jobs: scoring, paired comparison, blends and the final submission."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import agreement, auc, bootstrap, contracts, dominance, ranks
from tallyfold.operators.reshape import to_long, to_wide
from tallyfold.scale import attach, col


def score_long(preds: DataFrame, cells: DataFrame) -> DataFrame:
    """Inner join of predictions and unmasked label cells on (uid, target)."""
    labelled = cells.where(F.col("mask") > 0).select("uid", "target", "y")
    return preds.join(labelled, ["uid", "target"])


def unlabelled(preds: DataFrame, cells: DataFrame) -> DataFrame:
    """One row: predicted ids and those that have no label row at all."""
    ids = preds.select("uid").distinct()
    have = cells.select("uid").distinct().withColumn("__l", F.lit(1))
    return ids.join(have, "uid", "left").agg(
        F.count(F.lit(1)).alias("n_predicted"), F.count_if(F.col("__l").isNull()).alias("skipped"))


def split_scores(preds: DataFrame, cells: DataFrame, keys: Sequence[str] = ("model", "split")) -> dict[str, DataFrame]:
    """Per-target and macro AUC per model and split."""
    scored = score_long(preds, cells)
    per = auc.target_auc(scored, [*keys, "target"])
    return {"per_target": per, "macro": auc.macro_auc(per, keys)}


def review_model(preds: DataFrame, cells: DataFrame, folds: DataFrame, outer: str, targets: Sequence[str], *, new: str, old: str,
                 rule: dict, n_boot: int = 2000, seed: int = 2026, strict: bool = True, method: str = "multinomial") -> dict[str, DataFrame]:
    """Contract checks, split scores, paired deltas with intervals and the declared rule.

    ``preds`` is long (model, split, uid, target, p). Gold pairs must be complete; weak pairs use the
    intersection unless the rule asks for complete ones. A split without a pair has a null delta and is not supported.
    """
    mine = to_wide(preds.where(col("model") == new), ["uid", "split"], targets)
    if strict:
        contracts.require(contracts.prediction_violations(mine, targets), "predictions")
        contracts.require(contracts.prediction_coverage(mine, folds, outer), "prediction coverage")
    keys = ["split", "uid", "target"]
    a, b = preds.where(col("model") == new), preds.where(col("model") == old)
    if strict:
        splits = ["gold", "weak"] if rule.get("require_complete_pairs") else ["gold"]
        contracts.require(contracts.incomplete_pairs(a, b, keys, splits), "paired predictions")
    paired = a.join(b.select(*keys), keys, "left_semi").unionByName(b.join(a.select(*keys), keys, "left_semi"))
    scored = score_long(paired, cells)
    delta = bootstrap.paired_delta(scored, new, old, n_boot, seed, ["split"], method=method, expected=a.select("split"))
    status = contracts.rule_status(F.col("n_paired"), F.col("delta"), F.col("ci_low"), rule["min_delta"], rule["ci95_lower_gt"])
    return {
        **split_scores(preds, cells),
        "per_target_delta": auc.auc_delta(scored, new, old, ["split", "target"]),
        "delta": delta,
        "decision": delta.where(F.col("split") == rule["split"]).select(
            "split", "delta", "ci_low", "ci_high", "n_boot", "n_paired", status.alias("status")),
    }


def second_fold_review(preds: DataFrame, cells: DataFrame, pairs: dict[str, tuple[str, str]], n_boot: int = 2000,
                       seed: int = 2026, strict: bool = True, method: str = "multinomial") -> dict[str, DataFrame]:
    """Pool the weak folds of several (new, old) pairs after checking that no id repeats across folds."""
    parts = []
    for fold, (new, old) in pairs.items():
        rows = preds.where(col("model").isin(new, old) & (F.col("split") == "weak"))
        parts.append(rows.select(F.lit(fold).alias("fold"), F.when(col("model") == new, F.lit("new")).otherwise(F.lit("old")).alias("model"),
                                 "uid", "target", "p"))
    pooled = parts[0]
    for p in parts[1:]:
        pooled = pooled.unionByName(p)
    overlap = pooled.groupBy("uid").agg(F.min("fold").alias("a"), F.max("fold").alias("b")).where("a <> b").select(
        F.lit("weak_folds_overlap").alias("check"), F.col("uid").alias("key"))
    if strict:
        contracts.require(overlap, "pooled folds")
    scored = score_long(pooled, cells)
    return {"overlap": overlap, "delta": bootstrap.paired_delta(scored, "new", "old", n_boot, seed, method=method)}


def two_fold_review(scored: DataFrame, new: str, old: str, n_boot: int = 2000, seed: int = 2026, groups: DataFrame | None = None,
                    method: str = "multinomial", secondary: Column | None = None, min_valid: float = 0.95, strict: bool = True) -> dict[str, DataFrame]:
    """Per-fold deltas, group bootstrap inside folds and the all-folds rule: (fold, group_id, uid, target, y, model, p).

    ``secondary`` marks the rows of a subgroup whose delta must not be negative in any fold. Fewer valid replicates than the share
    ``min_valid`` of ``n_boot`` are an error if ``strict``, and never pass.
    """
    per = auc.auc_delta(scored, new, old, ["fold", "target"])
    fold_delta = per.groupBy("fold").agg(F.avg("delta").alias("delta"))
    if secondary is not None:
        inside = auc.auc_delta(scored.where(secondary), new, old, ["fold", "target"]).groupBy("fold").agg(F.avg("delta").alias("secondary"))
        fold_delta = fold_delta.join(inside, "fold", "left")
    ci = bootstrap.group_bootstrap_delta(scored, new, old, n_boot, seed, groups=groups, method=method)
    few = ci.where(F.col("n_boot") < min_valid * n_boot).select(F.lit("too_few_valid_replicates").alias("check"), F.col("n_boot").cast("string").alias("key"))
    if strict:
        contracts.require(few, "bootstrap")
    decision = contracts.all_folds_positive(fold_delta, ci, secondary=None if secondary is None else "secondary")
    decision = attach(decision, ci.select(F.col("high").alias("ci_high"), "n_boot"))
    decision = decision.withColumn("passed", F.col("passed") & (F.col("n_boot") >= min_valid * n_boot))
    return {"per_target": per, "per_fold": fold_delta, "ci": ci, "decision": decision}


def ranking_diagnostic(preds: DataFrame, cells: DataFrame, reference: str, components: Sequence[str], companion: dict[str, str],
                       quality: DataFrame | None = None, n_boot: int = 2000, groups: DataFrame | None = None) -> dict[str, DataFrame]:
    """Where the reference misorders positives and negatives and which components would not."""
    scored = score_long(preds, cells).where(F.col("y").isin(0.0, 1.0))
    ref = scored.where(col("model") == reference)
    with_c = auc.with_companion(ref, cells, companion)
    wide = scored.where(col("model").isin(reference, *components)).groupBy("uid", "target", "y").pivot(
        "model", [reference, *components]).agg(F.first("p"))
    burden = auc.case_burden(ref)
    ranked = ranks.normalized_ranks(burden, ["target"], "p", "reference_rank")
    strata = None
    if quality is not None:
        ranked = ranked.join(quality, "uid", "left")
        flags = [c for c in quality.columns if c != "uid"]
        flagged = ref.join(quality, "uid", "left").select(*ref.columns, F.explode(F.array(*[F.struct(F.lit(c).alias("flag"), col(c).cast("string").alias("value")) for c in flags])).alias("f"))
        strata = auc.subgroup_auc(flagged.select(*ref.columns, "f.*"), "value", ["target", "flag"])
    out = {
        "pairs": auc.pair_summary(ref),
        "components": dominance.component_comparison(wide, ["target"], reference, components),
        "spearman": agreement.spearman_with(scored, reference),
        "strata": auc.subgroup_auc(with_c, "companion"),
        "cases": ranked,
    }
    if strata is not None:
        out["quality_strata"] = strata
    if groups is not None:
        out["group_ci"] = bootstrap.group_bootstrap_auc(ref.join(groups.select("uid", "group_id"), "uid"), n_boot)
    return out


def blend_screen(preds: DataFrame, cells: DataFrame, reader: str, members: Sequence[str]) -> DataFrame:
    """(candidate, macro_auc, n_defined, vs_reader): reader, members, member mean and fixed half-half rank blend.

    Every candidate is scored on the ids all of them cover.
    """
    base = preds.where(col("model").isin(reader, *members)).select("model", "uid", "target", "p")
    labelled = cells.where(F.col("mask") > 0).select("uid", "target", "y")
    mine = base.where(col("model") != reader)
    mean = ranks.equal_mean(mine, len(members)).where("complete").select("uid", "target", "p")
    read = base.where(col("model") == reader).select("uid", "target", "p")
    blend = ranks.rank_blend(read, mean, 0.5)
    every = base.unionByName(mean.withColumn("model", F.lit("member_mean"))).unionByName(blend.withColumn("model", F.lit("rank_blend")))
    scored = every.join(labelled, ["uid", "target"])
    macro = auc.macro_auc(auc.target_auc(scored, ["model", "target"]), ["model"])
    own = macro.where(col("model") == reader).agg(F.max("macro_auc").alias("__reader"))
    return attach(macro, own).select(
        F.col("model").alias("candidate"), "macro_auc", "n_defined", (F.col("macro_auc") - F.col("__reader")).alias("vs_reader"))


def final_submission(preds: DataFrame, required: DataFrame, targets: Sequence[str], members: Sequence[str], *, reader: str | None = None,
                     mode: str = "blend", from_members: Sequence[str] = (), weight: float = 0.5, limit: float = 0.1,
                     strict: bool = True) -> DataFrame:
    """Wide submission rows for the required ids: member mean, fallback for missing ids, then routing or rank blend."""
    base = preds.select("model", "uid", "target", "p").join(required.select("uid"), "uid", "left_semi")
    mine = ranks.equal_mean(base.where(col("model").isin(*members)), len(members))
    if strict:
        contracts.require(mine.where(~F.col("complete")), "members predicted different studies or targets")
        contracts.require(ranks.missing_share(mine, required, limit).where(~F.col("ok")), "too many missing studies")
    filled = ranks.fill_missing(mine.select("uid", "target", "p"), required, targets).select("uid", "target", "p")
    if reader is not None:
        theirs = base.where(col("model") == reader).select("uid", "target", "p")
        if mode == "reader_only":
            filled = theirs
        elif mode == "route":
            filled = ranks.route(filled, theirs, from_members)
        elif mode == "blend":
            filled = ranks.rank_blend(filled, theirs, weight)
        else:
            raise ValueError(f"unknown mode {mode!r}")
    return to_wide(filled, ["uid"], targets)


def long_predictions(wide: DataFrame, targets: Sequence[str], ids: Sequence[str] = ("model", "split", "uid")) -> DataFrame:
    return to_long(wide, ids, targets)
