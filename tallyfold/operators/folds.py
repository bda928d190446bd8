"""Duplicate groups, leakage-safe folds and training pools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.hashing import sha256_text, uniform60
from tallyfold.functions.predicates import strip
from tallyfold.operators.extraction import first_rows
from tallyfold.scale import attach, col, cols, join_on, ordinal_rank, pin, prefix_sums

HISTORIC_EVAL = "A_historic_eval"
FORMER_TRAIN = "B_former_train"


def duplicate_text_groups(df: DataFrame, uid: str, text: str) -> DataFrame:
    """(text_hash, n): texts held by more than one row; an absent text hashes like an empty one."""
    return df.groupBy(sha256_text(col(text)).alias("text_hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def duplicate_text_members(df: DataFrame, uid: str, text: str, max_groups: int = 20, max_ids: int = 8) -> DataFrame:
    """The report's sample: first ids of the first duplicate groups, in hash and id order."""
    rows = df.select(col(uid).alias("uid"), sha256_text(col(text)).alias("text_hash"))
    groups = rows.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("text_hash").limit(max_groups)
    members = first_rows(rows.join(F.broadcast(groups), "text_hash"), ["text_hash"], [F.col("uid")], max_ids)
    return members.groupBy("text_hash", "n").agg(F.sort_array(F.collect_list("uid")).alias("uids"))  # <= max_ids


def leakage_groups(df: DataFrame, uid: str, text: str) -> DataFrame:
    """(uid, group_id): shared stripped text -> its hash, otherwise the id itself.

    Only hashes are shuffled. Repeat counts combine map-side, so a text held by a
    third of all rows is one count row, not one collected group.
    """
    body = strip(F.coalesce(col(text), F.lit("")))
    keyed = df.select(col(uid).alias("uid"), F.when(body != "", F.sha2(body, 256)).alias("__key"))
    shared = keyed.where(F.col("__key").isNotNull()).groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    # an id stands in for the key of an empty text: rows without a text must not meet at one null key
    spread = keyed.select("uid", F.coalesce("__key", F.concat(F.lit("\x00"), F.col("uid").cast("string"))).alias("__key"))
    return spread.join(shared, "__key", "left").select(
        "uid", F.when(F.col("__n").isNotNull(), F.col("__key")).otherwise(F.col("uid")).alias("group_id"))


def _greedy(loads: list[int], weights: Sequence[int]) -> list[int]:
    """Fold of each weight, in turn the least loaded one; ``loads`` grows along."""
    out = []
    for w in weights:
        fold = loads.index(min(loads))
        loads[fold] += w
        out.append(fold)
    return out


def _poured(loads: Sequence[int], amount: int) -> list[tuple[int, int]]:
    """Bounds (numerator, denominator) up to which a stream of ``amount`` goes to each fold so that loads become level."""
    by_load = sorted(loads)
    _, j, top = min(((amount + sum(by_load[:j])) / j, j, amount + sum(by_load[:j])) for j in range(1, len(loads) + 1))
    bounds, total = [], 0
    for x in loads:
        total += max(0, top - j * x)
        bounds.append((total, j))
    return bounds


def deal_folds(units: DataFrame, n_folds: int, seed: int, heavy: int = 4) -> DataFrame:
    """(group_id, fold): whole groups, so that gold rows, then all rows, are as even over the folds as the largest groups allow.

    ``units`` is (uid, group_id, is_gold). Groups with gold are placed first, by their gold rows, the others by their rows on top of what
    lies in each fold. In either part a group above the ``heavy * n_folds``-th part is heavy, so there are fewer than that many; they go
    to the least loaded fold, largest first. The others stand in a row by a seeded hash that is cut where prefix sums level the folds.
    The same seed gives the same folds whatever the row order.
    """
    spark = units.sparkSession
    gold = F.col("is_gold").cast("int")
    groups = units.groupBy("group_id").agg(F.count(F.lit(1)).alias("size"), F.coalesce(F.sum(gold), F.lit(0)).alias("gold"))
    groups = pin(groups.withColumns({"h": uniform60(seed, F.col("group_id")), "weight": F.when(F.col("gold") > 0, F.col("gold")).otherwise(F.col("size"))}))
    parts, loads = [], [0] * n_folds
    for with_gold in (True, False):
        own = groups.where((F.col("gold") > 0) == F.lit(with_gold))
        total = own.agg(F.sum("weight")).first()[0] or 0
        large = F.col("weight") * heavy * n_folds > total
        first = own.where(large).orderBy(F.col("weight").desc(), "h", "group_id").select("group_id", "weight").collect()  # < heavy * n_folds
        here = list(loads)
        placed = spark.createDataFrame(list(zip([r.group_id for r in first], _greedy(here, [r.weight for r in first]), strict=True)), groups.select("group_id", F.lit(0).alias("fold")).schema)
        rest = prefix_sums(own.where(~large), [], [F.col("h"), F.col("group_id")], ["weight"])
        fold = sum([(F.col("weight_before") * F.lit(j) >= F.lit(bound)).cast("int") for bound, j in _poured(here, total - sum(r.weight for r in first))], F.lit(0))
        dealt = pin(placed.unionByName(rest.select("group_id", F.least(fold, F.lit(n_folds - 1)).cast("int").alias("fold"))))
        parts.append(dealt)
        if with_gold:
            rows = {r.fold: r.rows for r in join_on(dealt, own.select("group_id", "size"), ["group_id"]).groupBy("fold").agg(F.sum("size").alias("rows")).collect()}
            loads = [rows.get(f, 0) for f in range(n_folds)]
    return parts[0].unionByName(parts[1])


def split_gold(units: DataFrame, fraction: float, seed: int) -> DataFrame:
    """(uid, gold_split) for gold ids: the first max(1, round(n * fraction)) by seeded hash are eval."""
    gold = units.where(F.col("is_gold")).select("uid", uniform60(seed, F.lit("gold"), F.col("uid")).alias("__h"))
    ranked = ordinal_rank(gold, [], [F.col("__h"), F.col("uid")], "__k")
    n = gold.agg(F.greatest(F.lit(1), F.rint(F.count(F.lit(1)) * F.lit(fraction))).alias("__n"))
    return attach(ranked, n).select(
        "uid", F.when(F.col("__k") <= F.col("__n"), F.lit("eval")).otherwise(F.lit("train_image_ok")).alias("gold_split"))


def all_gold_holdout(folds: DataFrame) -> DataFrame:
    """Hold every gold row out: remember its former role in ``gold_set`` and mark it eval."""
    former = (F.when(F.col("gold_split") == "eval", F.lit(HISTORIC_EVAL))
              .when(F.col("gold_split") == "train_image_ok", F.lit(FORMER_TRAIN)).otherwise(F.lit("")))
    out = folds.withColumn("gold_set", former)
    return out.withColumn("gold_split", F.when(F.col("gold_set") != "", F.lit("eval")).otherwise(F.col("gold_split")))


def trainable(folds: DataFrame) -> DataFrame:
    """Rows whose duplicate group holds no eval row; an eval row is in its own group, so one anti join does both."""
    held = folds.where(F.col("gold_split") == "eval").select("group_id").distinct()
    return folds.join(held, "group_id", "left_anti").select(*cols(folds.columns))


def holdout_report(held: DataFrame) -> DataFrame:
    """Per fold: trainable rows, gold rows and rows dropped because their group holds gold."""
    groups = held.where(F.col("gold_set") != "").select("group_id").distinct().withColumn("__hit", F.lit(True))
    gold = F.col("gold_set") != ""
    return held.join(groups, "group_id", "left").groupBy("fold").agg(
        F.count_if(~gold & F.col("__hit").isNull()).alias("trainable"), F.count_if(gold).alias("gold"),
        F.count_if(~gold & F.col("__hit").isNotNull()).alias("dropped_group_member"))


def group_size_report(folds: DataFrame) -> DataFrame:
    """One row: duplicate groups, rows inside them and gold groups that have other members."""
    sizes = folds.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("gold_split") != "weak").alias("gold"))
    big = F.col("n") > 1
    return sizes.agg(
        F.count_if(big).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(big, F.col("n"))), F.lit(0)).alias("rows_in_duplicate_groups"),
        F.count_if(big & F.col("gold")).alias("gold_groups_with_other_members"))


def _outside(outer: str, exclude: Sequence[str]) -> Column:
    return ~F.col("fold").cast("string").isin(str(outer), *[str(x) for x in exclude])


def training_pool(folds: DataFrame, cells: DataFrame, outer: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Trainable ids outside the held folds with at least one observed target that is not from the gold source."""
    observed = cells.where((F.col("source") != "gold") & (F.col("mask") > 0)).select("uid").distinct()
    return trainable(folds).where(_outside(outer, exclude)).join(observed, "uid", "left_semi").select("uid")


def soft_training_pool(folds: DataFrame, soft: DataFrame, outer: str, exclude: Sequence[str] = (), *, strict: bool = False) -> DataFrame:
    """Same over a soft-label table (uid, target, p): at least one non-null soft target.

    ``strict`` makes an empty pool, a group with rows in several folds and a soft target outside [0, 1] or given twice an error."""
    from tallyfold.operators import contracts

    if strict:
        repeated = soft.groupBy("uid", "target").agg(F.count(F.lit(1)).alias("n"), F.max(~F.coalesce(F.col("p").between(0, 1), F.lit(True))).alias("off")).where("n > 1 OR off")
        contracts.require(contracts.group_integrity(folds), "fold table")
        contracts.require(repeated, "repeated or invalid soft label")
    filled = soft.where(F.col("p").isNotNull()).select("uid").distinct()
    pool = trainable(folds).where(_outside(outer, exclude)).join(filled, "uid", "left_semi").select("uid")
    if strict:
        pool = pin(pool)
        if pool.isEmpty():
            raise contracts.ContractError("empty soft-label training pool")
    return pool


def outer_roles(folds: DataFrame, outer: str) -> DataFrame:
    """(uid, role): train outside the outer fold, weak inside it, gold = eval rows.

    When nothing would be left to train on, every trainable row trains and weak is empty.
    """
    pool = trainable(folds).select("uid", (F.col("fold").cast("string") != outer).alias("__out"))
    any_train = pool.agg(F.coalesce(F.bool_or("__out"), F.lit(False)).alias("__any"))
    roles = attach(pool, any_train).select(
        "uid", F.when(F.col("__out") | ~F.col("__any"), F.lit("train")).otherwise(F.lit("weak")).alias("role"))
    gold = folds.where(F.col("gold_split") == "eval").select("uid", F.lit("gold").alias("role"))
    return roles.unionByName(gold)


def pool_gain(base: DataFrame, wider: DataFrame) -> DataFrame:
    """One row: sizes of two pools and ids only the wider one has."""
    a = base.select("uid", F.lit(1).alias("__a"), F.lit(None).cast("int").alias("__b"))
    b = wider.select("uid", F.lit(None).cast("int").alias("__a"), F.lit(1).alias("__b"))
    per = a.unionByName(b).groupBy("uid").agg(F.max("__a").alias("__a"), F.max("__b").alias("__b"))
    return per.agg(
        F.count("__a").alias("n_base"), F.count("__b").alias("n_wider"),
        F.count_if(F.col("__a").isNull()).alias("n_added"))
