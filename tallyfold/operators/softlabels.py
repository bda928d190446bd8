"""Combining soft and pseudo label sources. Sources are long: (source, uid, target, p)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.predicates import clip, finite, soft_target, soft_target_error
from tallyfold.operators.reshape import target_grid
from tallyfold.operators.selection import common_ids


def soft_rows_violations(rows: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Problems of a soft-label table (uid, soft_targets map, target_weights map)."""
    known = F.array(*[F.lit(t) for t in targets])
    no_keys = F.array().cast("array<string>")
    names = F.array_union(F.coalesce(F.map_keys("soft_targets"), no_keys), F.coalesce(F.map_keys("target_weights"), no_keys))
    bad_p = F.exists(F.coalesce(F.map_values("soft_targets"), F.array().cast("array<double>")), soft_target_error)
    # in the versioned table a present value must be a probability; -1 is not a way to say masked
    minus = F.exists(F.coalesce(F.map_values("soft_targets"), F.array().cast("array<double>")),
                     lambda v: F.coalesce(v < 0, F.lit(False)))
    bad_w = F.exists(F.coalesce(F.map_values("target_weights"), F.array().cast("array<double>")),
                     lambda w: ~finite(w) | (w < 0))
    checks = F.array_compact(F.array(
        F.when(F.coalesce(F.col("uid") == "", F.lit(True)) | F.col("soft_targets").isNull(), F.lit("malformed_row")),
        F.when(F.size(F.array_except(names, known)) > 0, F.lit("unknown_target")),
        F.when(bad_p | minus, F.lit("not_a_probability")),
        F.when(bad_w, F.lit("bad_weight"))))
    bad = rows.select(F.coalesce("uid", F.lit("")).alias("uid"), F.explode(checks).alias("check"))
    dup = rows.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.coalesce("uid", F.lit("")).alias("uid"), F.lit("duplicate_uid").alias("check"))
    return bad.unionByName(dup)


def soft_cells(rows: DataFrame, targets: Sequence[str]) -> DataFrame:
    """(uid, target, y, mask, weight): null probabilities are masked, weights default to 1."""
    packed = F.array(*[
        F.struct(F.lit(t).alias("target"), soft_target(F.try_element_at("soft_targets", F.lit(t))).alias("p"),
                 F.coalesce(F.try_element_at("target_weights", F.lit(t)), F.lit(1.0)).alias("weight")) for t in targets])
    return rows.select("uid", F.explode(packed).alias("c")).select(
        "uid", "c.target", F.coalesce("c.p", F.lit(0.0)).alias("y"),
        F.col("c.p").isNotNull().cast("double").alias("mask"), "c.weight")


def without_gold(rows: DataFrame, gold: DataFrame) -> DataFrame:
    return rows.join(gold.select("uid").distinct(), "uid", "left_anti")


def equal_source_mean(sources: DataFrame, folds: DataFrame, digits: int = 6) -> DataFrame:
    """Mean over sources for ids every source and the fold table cover, gold excluded; null p means out of range."""
    ids = common_ids(sources).join(folds.where(~F.col("is_gold")).select("uid"), "uid", "left_semi")
    mean = sources.join(ids, "uid", "left_semi").groupBy("uid", "target").agg(F.avg("p").alias("m"))
    return mean.select("uid", "target", F.when(F.col("m").between(0.0, 1.0), F.round("m", digits)).alias("p"))


def available_source_mean(sources: DataFrame, gold: DataFrame, targets: Sequence[str], lo: float = 0.01,
                          hi: float = 0.99, digits: int = 6) -> DataFrame:
    """Mean of whatever sources have a finite value per cell, clipped; cells without one stay null."""
    rows = without_gold(sources, gold)
    value = F.when(finite(F.col("p")), F.col("p"))
    mean = rows.where(F.col("target").isin(*targets)).groupBy("uid", "target").agg(F.avg(value).alias("m"))
    grid = target_grid(rows, "uid", targets)
    return grid.join(mean, ["uid", "target"], "left").select(
        "uid", "target", F.when(F.col("m").isNotNull(), F.round(clip(F.col("m"), lo, hi), digits)).alias("p"))


def masked_cells(cells: DataFrame) -> DataFrame:
    return cells.agg(F.count_distinct("uid").alias("n_rows"), F.count_if(F.col("p").isNull()).alias("masked_cells"))


def teacher_base_mix(teacher: DataFrame, base: DataFrame, alpha: float, digits: int = 6) -> DataFrame:
    """alpha * base + (1 - alpha) * teacher where the base has a value, else the teacher."""
    joined = teacher.select("uid", "target", "p").join(
        base.select("uid", "target", F.col("p").alias("q")), ["uid", "target"], "left")
    mixed = F.when(F.col("q").isNull(), F.col("p")).otherwise(F.lit(alpha) * F.col("q") + F.lit(1 - alpha) * F.col("p"))
    return joined.select("uid", "target", F.round(mixed, digits).alias("p"))


def pseudo_label_violations(teachers: DataFrame, predictions: DataFrame, training: DataFrame, folds: DataFrame,
                            blind_to: str | None = None) -> DataFrame:
    """Leakage checks for teacher predictions used as labels.

    ``teachers`` is (teacher, fold, excluded array), ``predictions`` (teacher, uid), ``training`` (teacher, uid).
    """
    out = []
    held = teachers.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    out.append(held.where((F.col("n") > 1) | (F.col("fold") == "none")).select(
        F.lit("teachers_share_fold").alias("check"), F.col("fold").alias("key")))
    fold_of = folds.select("uid", F.col("fold").cast("string").alias("__f"), "is_gold")
    rows = (predictions.select("teacher", "uid").distinct().join(fold_of, "uid", "left")
            .join(teachers.select("teacher", "fold"), "teacher"))
    out.append(rows.where(F.col("is_gold")).select(F.lit("labels_gold").alias("check"), F.col("uid").alias("key")))
    out.append(rows.where(~F.col("__f").eqNullSafe(F.col("fold"))).select(
        F.lit("outside_held_out_fold").alias("check"), F.col("uid").alias("key")))
    out.append(rows.select("teacher", "uid").join(training.select("teacher", "uid").distinct(), ["teacher", "uid"], "left_semi")
               .select(F.lit("labels_own_training_row").alias("check"), F.col("uid").alias("key")))
    out.append(rows.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.lit("labelled_twice").alias("check"), F.col("uid").alias("key")))
    if blind_to is not None:
        out.append(teachers.where(~F.array_contains("excluded", blind_to)).select(
            F.lit("teacher_not_blind").alias("check"), F.col("teacher").alias("key")))
        seen = training.select("teacher", "uid").join(fold_of.where(F.col("__f") == blind_to).select("uid"), "uid", "left_semi")
        out.append(seen.groupBy("teacher").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("trained_on_blind_fold").alias("check"), F.col("teacher").alias("key")))
        out.append(rows.where(F.col("__f") == blind_to).select(
            F.lit("labels_blind_fold").alias("check"), F.col("uid").alias("key")))
    total = out[0]
    for o in out[1:]:
        total = total.unionByName(o)
    return total.distinct()
