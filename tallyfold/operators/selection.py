"""Cohorts, deterministic samples and id shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.hashing import uniform60
from tallyfold.operators.folds import trainable
from tallyfold.scale import attach, cols, ordinal_rank


def development_cohort(rows: DataFrame, folds: DataFrame) -> DataFrame:
    """Trainable and not gold."""
    return rows.join(trainable(folds).where(~F.col("is_gold")).select("uid"), "uid", "left_semi")


def gold_cohort(rows: DataFrame, folds: DataFrame) -> DataFrame:
    return rows.join(folds.where(F.col("is_gold")).select("uid"), "uid", "left_semi")


def new_attempts(cohort: DataFrame, done: DataFrame, limit: int, order: Sequence[Column] = ()) -> DataFrame:
    """At most ``limit`` cohort rows that have no finished result yet, in a fixed order."""
    todo = cohort.join(done.select("uid").distinct(), "uid", "left_anti")
    return todo.orderBy(*(order or [F.col("uid")])).limit(limit)


def hash_sample(rows: DataFrame, n: int, priority: Sequence[Column] = (), seed: int | None = None) -> DataFrame:
    """First n ids by (priority, hash of the id); a top-k, so every task forwards at most n rows."""
    key = F.sha2(F.col("uid"), 256) if seed is None else uniform60(seed, F.col("uid"))
    return rows.orderBy(*priority, key, F.col("uid")).limit(n)


def id_shards(rows: DataFrame, n_shards: int) -> DataFrame:
    """(uid, shard): the sorted ids dealt out one by one."""
    ids = rows.select("uid").distinct()
    ranked = ordinal_rank(ids, [], [F.col("uid")], "__k")
    return ranked.select("uid", F.pmod(F.col("__k") - 1, F.lit(n_shards)).cast("int").alias("shard"))


def gold_first(rows: DataFrame, n: int = 50) -> DataFrame:
    """Gold rows, then the rest, by id."""
    return rows.orderBy(F.when(F.col("is_gold"), 0).otherwise(1), F.col("uid")).limit(n)


def observed_rows(cells: DataFrame, targets: Sequence[str] | None = None) -> DataFrame:
    """Cells that can be scored: masked in with a 0/1 value."""
    ok = (F.col("mask") > 0) & F.col("y").isin(0.0, 1.0)
    return cells.where(ok if targets is None else ok & F.col("target").isin(*targets))


def where_companion(cells: DataFrame, target: str, companion: str, value: float) -> DataFrame:
    """Observed cells of ``target`` whose companion target is observed with the given value."""
    other = observed_rows(cells, [companion]).where(F.col("y") == value).select("uid")
    return observed_rows(cells, [target]).join(other, "uid", "left_semi")


def with_verified_candidate(manifest: DataFrame, ids: DataFrame, min_slices: int = 3) -> DataFrame:
    """Ids whose nested candidate list holds a verified series with enough slices."""
    usable = F.exists(F.flatten("candidates"), lambda c: c["anatomical_order_verified"] & (c["n"] >= min_slices))
    return ids.join(manifest.where(usable).select("uid"), "uid", "left_semi")


def shared_groups(left: DataFrame, right: DataFrame, folds: DataFrame) -> DataFrame:
    """Groups that have members among both id lists; empty means the lists are disjoint by group."""
    g = folds.select("uid", "group_id")
    a = g.join(left.select("uid").distinct(), "uid", "left_semi").select("group_id").distinct()
    b = g.join(right.select("uid").distinct(), "uid", "left_semi").select("group_id").distinct()
    return a.join(b, "group_id", "left_semi")


def common_ids(sources: DataFrame) -> DataFrame:
    """Ids present in every source of a (source, uid, …) table."""
    n = sources.agg(F.count_distinct("source").alias("__n"))
    per = sources.select("source", "uid").distinct().groupBy("uid").agg(F.count(F.lit(1)).alias("__k"))
    return attach(per, n).where(F.col("__k") == F.col("__n")).select("uid")


def set_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both-side difference of two key sets: (keys, side)."""
    la = a.select(*cols(keys)).distinct().withColumn("__a", F.lit(True))
    lb = b.select(*cols(keys)).distinct().withColumn("__b", F.lit(True))
    both = la.join(lb, list(keys), "full_outer")
    return both.where(F.col("__a").isNull() | F.col("__b").isNull()).select(
        *cols(keys), F.when(F.col("__b").isNull(), F.lit("left_only")).otherwise(F.lit("right_only")).alias("side"))


def exact_alignment(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: duplicate keys on each side and keys on one side only; all zero means aligned."""
    da = a.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("__ca"))
    db = b.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("__cb"))
    return da.join(db, list(keys), "full_outer").agg(
        F.count_if(F.col("__ca") > 1).alias("left_duplicates"), F.count_if(F.col("__cb") > 1).alias("right_duplicates"),
        F.count_if(F.col("__cb").isNull()).alias("left_only"), F.count_if(F.col("__ca").isNull()).alias("right_only"))
