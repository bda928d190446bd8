"""Scans with explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold import schemas
from tallyfold.functions.predicates import parse_number, safe_id
from tallyfold.operators.contracts import ContractError, require, require_columns
from tallyfold.scale import col, cols
from tallyfold.sources.records import csv_records


def csv_strings(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header CSV as text columns by name; cells may hold line breaks in quotes, and one file is read in many tasks.

    Every file must have the header of the first. Carriage returns in quotes stay. An empty cell without quotes and one that a short
    record lacks are null; lines without anything are no records."""
    names = csv_header(spark, path)
    missing = [c for c in columns if c not in names]
    if missing:
        raise ContractError(f"missing columns: {missing}")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = csv_records(spark, path).where("text <> ''").withColumn("r", F.from_csv("text", schema, {"escape": '"', "multiLine": "true"}))
    header = F.array(*[F.coalesce(F.regexp_replace(f"r.c{i}", "^\ufeff", ""), F.lit("")) for i in range(len(names))])
    same = F.when(header == F.array(*[F.lit(n) for n in names]), F.lit(False)).otherwise(F.raise_error(F.concat(F.lit("another header in "), "file")))
    rows = parsed.where(F.when((F.col("block") == 0) & (F.col("record") == 1), same.cast("boolean")).otherwise(F.lit(True)))
    return rows.select(*[F.col(f"r.c{names.index(c)}").alias(c) for c in columns])


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file: one line is read, no data."""
    return spark.read.option("header", True).option("escape", '"').csv(path, enforceSchema=False).columns


def unsafe_ids(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    bad = F.array_compact(F.array(*[F.when(~safe_id(col(i)), F.struct(F.lit(i).alias("column"), col(i).alias("value"))) for i in ids]))
    return df.select(F.explode(bad).alias("b")).select("b.column", "b.value")


def series_table(df: DataFrame, required: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Check required columns and id safety; an unsafe id is an error, never a silent null."""
    require_columns(df, required)
    require(unsafe_ids(df, ids), "unsafe or empty identifier")
    return df


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line; blank lines are skipped, unreadable lines keep their text in ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(full).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def json_text(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Same for a text column of an existing table."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = df.where(F.trim(col(text)) != "")
    parsed = F.from_json(col(text), full, {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"})
    return rows.withColumn("__j", parsed).select(*cols([c for c in df.columns if c != text]), "__j.*")


def score_table(df: DataFrame, uid: str, targets: Sequence[str], suffix: str = "") -> DataFrame:
    """Text score columns (named target + suffix) to doubles; unparsable and non-finite cells become null."""
    require_columns(df, [uid, *[t + suffix for t in targets]])
    return df.select(col(uid).alias("uid"), *[parse_number(col(t + suffix)).alias(t) for t in targets])


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, size, sha256) of stored files; each task hashes the files it reads."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
