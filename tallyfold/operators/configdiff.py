"""Differences between configurations and between pinned records, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.scale import col, cols


def flatten_config(configs: DataFrame, sections: Sequence[str], nested: str = "train") -> DataFrame:
    """(arm, key, value): chosen top-level sections and every ``nested.*`` entry of a JSON config column."""
    parsed = configs.select("arm", F.from_json("config", "map<string,string>").alias("m"))
    top = parsed.select("arm", F.explode("m").alias("key", "value")).where(F.col("key").isin(*sections))
    inner = parsed.select("arm", F.explode(F.from_json(F.try_element_at("m", F.lit(nested)), "map<string,string>")).alias("k", "value"))
    return top.unionByName(inner.select("arm", F.concat(F.lit(f"{nested}."), "k").alias("key"), "value"))


def melt(df: DataFrame, id_col: str, attributes: Sequence[str]) -> DataFrame:
    """(arm, key, value) from an attribute table."""
    text = df.select(col(id_col).cast("string").alias("arm"), *[col(a).cast("string").alias(a) for a in attributes])
    return text.unpivot(["arm"], cols(attributes), "key", "value")


def controlled_changes(entries: DataFrame, controls: DataFrame) -> DataFrame:
    """(arm, key): keys whose value differs between an arm and its control; (arm, control) pairs are given."""
    mine = controls.join(entries, "arm").select("arm", "key", F.col("value").alias("__a"), F.lit(True).alias("__in_a"))
    base = controls.join(entries.withColumnRenamed("arm", "control"), "control").select(
        "arm", "key", F.col("value").alias("__b"), F.lit(True).alias("__in_b"))
    both = mine.join(base, ["arm", "key"], "full_outer")
    return both.where(~F.col("__a").eqNullSafe(F.col("__b"))).select("arm", "key")


def undeclared_changes(actual: DataFrame, declared: DataFrame) -> DataFrame:
    """(arm, key, side): symmetric difference of actual and declared changes."""
    a = actual.select("arm", "key").distinct().withColumn("__a", F.lit(True))
    d = declared.select("arm", "key").distinct().withColumn("__d", F.lit(True))
    return a.join(d, ["arm", "key"], "full_outer").where(F.col("__a").isNull() | F.col("__d").isNull()).select(
        "arm", "key", F.when(F.col("__d").isNull(), F.lit("undeclared")).otherwise(F.lit("declared_but_equal")).alias("side"))


def pin_mismatches(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """(record, field): pinned fields whose observed value is absent or different; both are (record, field, value)."""
    e = expected.select("record", "field", F.col("value").alias("__e"))
    o = observed.select("record", "field", F.col("value").alias("__o"))
    return e.join(o, ["record", "field"], "left").where(~F.col("__e").eqNullSafe(F.col("__o"))).select("record", "field")
