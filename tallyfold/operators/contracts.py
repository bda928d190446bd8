"""Contracts as violation tables; ``require`` turns a non-empty one into an error."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.predicates import finite, is_probability, parse_number, synthetic_id
from tallyfold.operators.folds import trainable
from tallyfold.operators.selection import set_difference
from tallyfold.scale import col, cols


class ContractError(ValueError):
    """A table breaks a stated rule."""


def require(violations: DataFrame, what: str, sample: int = 5) -> None:
    """Raise when there is any violation; only a few rows are looked at."""
    rows = violations.limit(sample).collect()
    if rows:
        raise ContractError(f"{what}: {[r.asDict() for r in rows]}")


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    return df


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def synthetic_ids(ids: DataFrame) -> DataFrame:
    return ids.where(synthetic_id(F.col("uid"))).select(F.lit("synthetic_uid").alias("check"), F.col("uid").alias("key"))


def group_integrity(folds: DataFrame) -> DataFrame:
    """Ids and groups that sit in more than one fold. Min and max tell, so no distinct set is kept."""
    def spread(key: str, check: str) -> DataFrame:
        return folds.groupBy(key).agg(F.min("fold").alias("a"), F.max("fold").alias("b")).where("a <> b").select(
            F.lit(check).alias("check"), F.col(key).alias("key"))

    return spread("uid", "study_in_multiple_folds").unionByName(spread("group_id", "group_split_across_folds"))


def eval_in_training(train: DataFrame, folds: DataFrame) -> DataFrame:
    return train.join(folds.where(F.col("gold_split") == "eval").select("uid"), "uid", "left_semi").select(
        F.lit("gold_eval_in_training").alias("check"), F.col("uid").alias("key"))


def outside_trainable(train: DataFrame, folds: DataFrame) -> DataFrame:
    return train.join(trainable(folds).select("uid"), "uid", "left_anti").select(
        F.lit("outside_trainable").alias("check"), F.col("uid").alias("key"))


def split_overlap(roles: DataFrame, folds: DataFrame) -> DataFrame:
    """Ids with two roles and groups whose members have different roles: ``roles`` is (uid, role)."""
    def mixed(df: DataFrame, key: str, check: str) -> DataFrame:
        return df.groupBy(key).agg(F.min("role").alias("a"), F.max("role").alias("b")).where("a <> b").select(
            F.lit(check).alias("check"), F.col(key).alias("key"))

    grouped = folds.select("uid", F.coalesce("group_id", "uid").alias("group_id")).join(roles, "uid")
    return mixed(roles, "uid", "split_overlap").unionByName(mixed(grouped, "group_id", "group_crosses_splits"))


def prediction_violations(preds: DataFrame, targets: Sequence[str], splits: Sequence[str] = ("gold", "weak")) -> DataFrame:
    """Wide prediction table (uid, split, targets…): repeated ids, ids in two splits, unknown splits, bad probabilities."""
    per = preds.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.min("split").alias("a"), F.max("split").alias("b"))
    twice = preds.groupBy("split", "uid").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bad = reduce(lambda a, b: a | b, [~is_probability(col(t)) for t in targets])
    empty = preds.agg(F.count(F.lit(1)).alias("n")).where("n = 0")

    def rows(df: DataFrame, check: str, key: Column) -> DataFrame:
        return df.select(F.lit(check).alias("check"), key.cast("string").alias("key"))

    return _union([
        rows(twice, "duplicate_prediction_uid", F.col("uid")),
        rows(per.where("a <> b"), "prediction_split_overlap", F.col("uid")),
        rows(preds.where(F.coalesce(~F.col("split").isin(*splits), F.lit(True))), "invalid_prediction_split", F.col("uid")),
        rows(preds.where(bad), "invalid_prediction_probability", F.col("uid")),
        rows(empty, "empty_predictions", F.lit("")),
    ])


def prediction_coverage(preds: DataFrame, folds: DataFrame, outer: str) -> DataFrame:
    """Gold ids without a prediction and weak ids that differ from the outer fold minus gold."""
    gold = folds.where(F.col("gold_split") == "eval").select("uid")
    lost = gold.join(preds.select("uid"), "uid", "left_anti").select(F.lit("gold_not_predicted").alias("check"), F.col("uid").alias("key"))
    expected = folds.where((F.col("fold").cast("string") == outer) & (F.col("gold_split") != "eval")).select("uid")
    diff = set_difference(preds.where(F.col("split") == "weak").select("uid"), expected, ["uid"])
    return lost.unionByName(diff.select(
        F.when(F.col("side") == "left_only", F.lit("weak_outside_outer_fold")).otherwise(F.lit("weak_not_predicted")).alias("check"),
        F.col("uid").alias("key")))


def submission_violations(sub: DataFrame, required: DataFrame, targets: Sequence[str], uid: str = "uid",
                          index: str = "row_ix") -> DataFrame:
    """Text submission against the required ids: column order, cells, id multiset and row order.

    Both sides carry an explicit 0-based row index because a table has no order of its own.
    """
    columns = [c for c in sub.columns if c != index]
    expected = [uid, *targets]
    parts = []
    spark = sub.sparkSession
    if columns != expected:
        parts.append(spark.range(1).select(F.lit("columns").alias("check"), F.lit(",".join(columns)).alias("key")))
    present = [t for t in targets if t in columns]
    cells = sub.select(col(uid).alias("uid"), F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), col(t).cast("string").alias("v")) for t in present])).alias("c"))
    # NaN and infinity parse as numbers but are not probabilities
    number = F.col("c.v").try_cast("double")
    key = F.concat_ws(":", "uid", "c.t")
    parts.append(cells.where(number.isNull()).select(F.lit("nonfloat").alias("check"), key.alias("key")))
    parts.append(cells.where(number.isNotNull() & ~is_probability(number)).select(F.lit("not_prob").alias("check"), key.alias("key")))
    have = sub.groupBy(col(uid).alias("uid")).agg(F.count(F.lit(1)).alias("a"))
    want = required.groupBy(col(uid).alias("uid")).agg(F.count(F.lit(1)).alias("b"))
    parts.append(have.join(want, "uid", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(
        F.lit("uid_set_mismatch").alias("check"), F.col("uid").alias("key")))
    placed = sub.select(col(index).alias("i"), col(uid).alias("u")).join(
        required.select(col(index).alias("i"), col(uid).alias("v")), "i", "full_outer")
    parts.append(placed.where(~F.col("u").eqNullSafe(F.col("v"))).select(
        F.lit("uid_order_differs").alias("check"), F.coalesce("u", "v").alias("key")))
    return _union(parts)


def metric_mismatch(recomputed: DataFrame, reported: DataFrame, keys: Sequence[str], tolerance: float = 1e-8) -> DataFrame:
    """Keys whose recomputed metric is undefined, absent or differs from the reported one."""
    a = recomputed.select(*cols(keys), F.col("metric").alias("__a"))
    b = reported.select(*cols(keys), F.col("metric").alias("__b"))
    both = a.join(b, list(keys), "full_outer")
    check = (
        F.when(F.col("__a").isNull(), F.lit("undefined_validation_target"))
        .when(F.col("__b").isNull() | (F.abs(F.col("__a") - F.col("__b")) > tolerance), F.lit("reported_metrics_mismatch")))
    return both.withColumn("check", check).where(F.col("check").isNotNull()).select("check", *cols(keys))


def incomplete_pairs(new: DataFrame, old: DataFrame, keys: Sequence[str], complete_splits: Sequence[str]) -> DataFrame:
    """Rows of the new model without a control row in the splits that must be complete."""
    return new.where(F.col("split").isin(*complete_splits)).join(
        old.select(*cols(keys)), list(keys), "left_anti").select(F.lit("incomplete_pairs").alias("check"), *cols(keys))


def promote_candidate(gold_delta: Column, weak_delta: Column, ci_low: Column) -> Column:
    """Candidate rule: no gold loss, a weak gain of at least .002 and a bounded gold interval."""
    return F.coalesce((gold_delta >= 0) & (weak_delta >= 0.002) & (ci_low >= -0.03), F.lit(False))


def rule_status(n_paired: Column, delta: Column, ci_low: Column, min_delta: float, ci_lower_gt: float) -> Column:
    """Single-fold rule of an arm with a declared minimum gain and interval bound."""
    ok = (n_paired > 0) & (delta >= min_delta) & (ci_low > ci_lower_gt)
    return F.when(F.coalesce(ok, F.lit(False)), F.lit("passes_this_fold_only")).otherwise(F.lit("not_supported"))


def all_folds_positive(deltas: DataFrame, ci: DataFrame, delta: str = "delta", secondary: str | None = None) -> DataFrame:
    """One row: every fold gains, the interval lies above zero and, if named, no secondary delta is negative."""
    from tallyfold.scale import attach

    folds = deltas.agg(
        F.bool_and(F.coalesce(col(delta) > 0, F.lit(False))).alias("all_positive"),
        (F.bool_and(F.coalesce(col(secondary) >= 0, F.lit(False))) if secondary else F.lit(True)).alias("secondary_ok"))
    out = attach(folds, ci.select(F.col("low").alias("ci_low")))
    return out.withColumn("passed", F.coalesce(
        F.col("all_positive") & F.col("secondary_ok") & (F.col("ci_low") > 0), F.lit(False)))


def gate_rollup(gates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any FAIL* fails the run, else any BLOCKED blocks it, else it passes: (keys, gate, status) -> (keys, overall)."""
    severity = F.when(F.col("status").startswith("FAIL"), 2).when(F.col("status") == "BLOCKED", 1).otherwise(0)
    worst = gates.groupBy(*cols(keys)).agg(F.max(severity).alias("s"))
    return worst.select(*cols(keys), F.when(F.col("s") == 2, F.lit("FAIL")).when(F.col("s") == 1, F.lit("BLOCKED"))
                        .otherwise(F.lit("PASS")).alias("overall"))


def review_blockers(runs: DataFrame) -> DataFrame:
    """(run, kind, macro_auc, audit, source_ok, outputs_finite) -> sorted blockers and the champion flag."""
    blockers = F.array_compact(F.array(
        F.when(~F.col("kind").eqNullSafe("real"), F.lit("metrics_not_real")),
        F.when(F.col("macro_auc").isNull(), F.lit("macro_auc_undefined")),
        F.when(~F.col("audit").eqNullSafe("PASS"), F.concat(F.lit("audit_"), F.coalesce("audit", F.lit("FAIL")))),
        F.when(~F.coalesce("source_ok", F.lit(False)), F.lit("source_not_legitimate")),
        F.when(~F.coalesce("outputs_finite", F.lit(False)), F.lit("outputs_not_finite"))))
    return runs.withColumn("blockers", blockers).withColumn("champion", F.size("blockers") == 0)


def metric_kind_violations(metrics: DataFrame, production: bool = True) -> DataFrame:
    """Metrics a production gate must refuse: (run, kind, macro_auc, n_defined)."""
    check = (
        F.when(F.col("kind").isin("synthetic", "simulated", "fake"), F.lit("synthetic_metrics"))
        .when(F.col("macro_auc").isNotNull() & (F.coalesce("n_defined", F.lit(1)) == 0), F.lit("macro_without_defined_class"))
        .when(~F.col("kind").eqNullSafe("real"), F.lit("kind_not_real")))
    out = metrics.withColumn("check", check).where(F.col("check").isNotNull()).select("check", "run")
    return out if production else out.where(F.lit(False))


def numeric_export(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Allow-list projection for leaving the trusted side; refuses free-text columns that are not ids or categories."""
    out = df.select(*cols(allowed))
    ids = {"uid", "target", "source", "split", "group_id", "gold_split", "gold_set", "model", "ontology_version"}
    text = [f.name for f in out.schema.fields if f.dataType.simpleString() == "string" and f.name not in ids]
    if text:
        raise ContractError(f"free-text columns must not be exported: {text}")
    return out


def receipt_status(receipts: DataFrame, remote: DataFrame) -> DataFrame:
    """Reconcile receipts with remote rows: exactly one match decides, none or several stay PENDING.

    ``receipts`` is (run, receipt), ``remote`` (ref, status, score text, error text).
    """
    from tallyfold.functions.predicates import remote_score, remote_status

    rows = remote.groupBy("ref").agg(
        F.count(F.lit(1)).alias("n"), F.first(F.struct("status", "score", "error")).alias("r"))
    both = receipts.join(rows, F.col("receipt") == F.col("ref"), "left")
    status, score = remote_status(F.col("r.status")), remote_score(F.col("r.score"))
    failed = (status == "ERROR") | (F.coalesce(F.col("r.error"), F.lit("")) != "")
    scored = (status == "COMPLETE") & score.isNotNull() & ~failed
    one = F.coalesce(F.col("n") == 1, F.lit(False))
    state = (
        F.when(F.col("receipt").isNull(), F.lit("BLOCKED")).when(~one, F.lit("PENDING")).when(scored, F.lit("SCORED"))
        .when(failed, F.lit("ERROR")).otherwise(F.lit("PENDING")))
    reason = F.when(F.col("receipt").isNull(), F.lit("server_receipt_missing")).when(~one, F.lit("receipt_not_in_history"))
    return both.select("run", "receipt", state.alias("status"), reason.alias("reason"),
                       F.when(one & scored, score).alias("score"))


def non_finite_scores(df: DataFrame, value: str) -> DataFrame:
    return df.where(~finite(parse_number(col(value))))
