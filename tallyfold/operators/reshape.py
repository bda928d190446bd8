"""Wide target columns to long rows and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.scale import col, cols


def to_long(df: DataFrame, ids: Sequence[str], targets: Sequence[str], value: str = "p") -> DataFrame:
    return df.select(*cols(ids), *cols(targets)).unpivot(
        cols(ids), cols(targets), "target", value)


def to_wide(df: DataFrame, ids: Sequence[str], targets: Sequence[str], value: str = "p") -> DataFrame:
    """One column per target in the given order; the target list is fixed, so no extra pass finds it."""
    return df.groupBy(*cols(ids)).pivot("target", list(targets)).agg(F.first(col(value))).select(
        *cols(ids), *cols(targets))


def map_to_long(df: DataFrame, ids: Sequence[str], map_col: str, value: str) -> DataFrame:
    return df.select(*cols(ids), F.explode(col(map_col)).alias("target", value))


def to_map(df: DataFrame, ids: Sequence[str], value: str, name: str) -> DataFrame:
    """One map per id; bounded by the number of targets."""
    return df.groupBy(*cols(ids)).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(col("target"), col(value))))).alias(name))


def target_grid(df: DataFrame, id_col: str, targets: Sequence[str]) -> DataFrame:
    """Every (id, target) cell: each id row is exploded over the short target list."""
    return df.select(col(id_col)).distinct().withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))
