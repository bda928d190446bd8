"""Fold jobs: leakage-safe folds and the all-gold holdout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.predicates import all_nonempty
from tallyfold.operators import contracts, folds, labels


def make_folds(train: DataFrame, targets: Sequence[str], *, n_folds: int = 5, seed: int = 2026, gold_eval_fraction: float = 0.5,
               report: str = "report") -> dict[str, DataFrame]:
    """(uid, fold, is_gold, gold_split, group_id) plus gold class counts per target."""
    units = folds.leakage_groups(train, "uid", report).join(
        train.select("uid", all_nonempty(targets).alias("is_gold")), "uid")
    dealt = folds.deal_folds(units, n_folds, seed)
    gold = folds.split_gold(units, gold_eval_fraction, seed)
    table = units.join(dealt, "group_id").join(gold, "uid", "left").select(
        "uid", "fold", "is_gold", F.coalesce("gold_split", F.lit("weak")).alias("gold_split"), "group_id")
    return {"folds": table, "gold_counts": labels.gold_class_counts(train, targets)}


def all_gold_holdout(table: DataFrame, *, strict: bool = True) -> dict[str, DataFrame]:
    """Keep folds and groups, hold all gold out of training, and count what that costs per fold."""
    if strict:
        contracts.require(contracts.group_integrity(table), "fold table")
    held = folds.all_gold_holdout(table)
    return {"folds": held, "trainable": folds.trainable(held), "per_fold": folds.holdout_report(held),
            "groups": folds.group_size_report(held)}
