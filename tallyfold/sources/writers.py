"""Sinks. Spark's commit protocol makes each write all-or-nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.hashing import table_fingerprint
from tallyfold.scale import attach, col, cols


def sorted_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """JSON object text with keys in alphabetical order."""
    return F.to_json(F.struct(*[col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def json_line_table(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return df.select(col(key).alias("key"), sorted_json(df, columns).alias("line"))


def write_json_lines(df: DataFrame, path: str, key: str, columns: Sequence[str]) -> None:
    """Lines ordered by key: range partitions in file order, sorted inside."""
    lines = df.select(col(key).alias("__k"), sorted_json(df, columns).alias("value"))
    lines.repartitionByRange("__k").sortWithinPartitions("__k").select("value").write.mode("overwrite").text(path)


def submission_columns(df: DataFrame, uid: str, targets: Sequence[str]) -> DataFrame:
    return df.select(col(uid), *cols(targets))


def write_submission(df: DataFrame, path: str, uid: str, targets: Sequence[str]) -> None:
    """A header CSV whose files, read in name order, hold the rows in id order."""
    rows = submission_columns(df, uid, targets)
    rows.repartitionByRange(col(uid)).sortWithinPartitions(col(uid)).write.mode("overwrite").option("header", True).csv(path)


def fold_summary(folds: DataFrame, n_folds: int, seed: int) -> DataFrame:
    """One row describing a fold table, with its order-independent fingerprint."""
    base = folds.agg(
        F.count(F.lit(1)).alias("n_studies"), F.count_if("is_gold").alias("n_gold"),
        F.count_if(F.col("gold_split") == "eval").alias("n_gold_eval"),
        F.count_if(F.col("gold_split") == "train_image_ok").alias("n_gold_train"))
    mark = table_fingerprint(folds, ["uid", "fold", "is_gold", "gold_split", "group_id"]).select("fingerprint")
    return attach(base, mark).withColumn("n_folds", F.lit(n_folds)).withColumn("seed", F.lit(seed))


def write_folds(folds: DataFrame, path: str, n_folds: int, seed: int) -> None:
    folds.write.mode("overwrite").parquet(f"{path}/folds")
    fold_summary(folds.sparkSession.read.parquet(f"{path}/folds"), n_folds, seed).write.mode("overwrite").json(f"{path}/summary")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def provenance(output: DataFrame, columns: Sequence[str], inputs: dict[str, tuple[DataFrame, Sequence[str]]], name: str,
               rule: str) -> DataFrame:
    """(role, name, n_rows, fingerprint, rule) for an output table and everything it was made from."""
    def line(role: str, label: str, df: DataFrame, cs: Sequence[str]) -> DataFrame:
        return table_fingerprint(df, cs).select(
            F.lit(role).alias("role"), F.lit(label).alias("name"), "n_rows", "fingerprint",
            F.lit(rule if role == "output" else None).cast("string").alias("rule"))

    out = line("output", name, output, columns)
    for label, (df, cs) in inputs.items():
        out = out.unionByName(line("input", label, df, cs))
    return out


def publish_labels(tagged: DataFrame, cells: DataFrame, path: str) -> None:
    """Kept cells to one sink and rejected envelopes with their reason to another."""
    cells.write.mode("overwrite").parquet(f"{path}/labels")
    tagged.where(F.col("reason").isNotNull()).select("uid", "reason").write.mode("overwrite").parquet(f"{path}/rejected")
