"""Records of CSV files whose quoted cells hold line breaks, read in as many tasks as the files have blocks.

A line break ends a record only outside of quotes, and whether a place is inside is a matter of all quotes before it. Quotes are counted
per block of a file, running sums over the blocks (a row each) say in which state a block is entered, and each block is then cut into
records on its own. What a block holds of a record that began before it is put behind that record's part, over as many blocks as it
takes. Quotes come in pairs, as RFC 4180 has it: a single one in a cell without quotes is not supported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BEFORE = (Window.unboundedPreceding, -1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (its first byte), at (grows along the block), value, quotes."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    return lines.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, record (from 1 per block), text: the records of all files below ``path``, carriage returns inside of quotes kept."""
    lines = _lines(spark, path)
    along = Window.partitionBy("file").orderBy("block").rowsBetween(*BEFORE)
    quotes = lines.groupBy("file", "block").agg(F.sum("quotes").alias("q"))
    entered = quotes.select("file", "block", (F.coalesce(F.sum("q").over(along), F.lit(0)) % 2).alias("inside"))
    step = Window.partitionBy("file", "block").orderBy("at")
    open_before = (F.col("inside") + F.coalesce(F.sum("quotes").over(step.rowsBetween(*BEFORE)), F.lit(0))) % 2
    starts = lines.join(entered, ["file", "block"]).withColumn("starts", (open_before == 0).cast("int"))
    numbered = starts.withColumn("record", F.sum("starts").over(step.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("at", "value")))  # the lines of one record
    pieces = numbered.groupBy("file", "block", "record").agg(F.array_join(F.transform(parts, lambda x: x.value), "\n").alias("text"))
    counts = numbered.groupBy("file", "block").agg(F.max("record").alias("n"))
    owner = F.last(F.when(F.col("n") > 0, F.struct("block", "n")), ignorenulls=True).over(along)
    owners = counts.select("file", "block", owner.alias("owner")).where("owner IS NOT NULL")
    rest = pieces.where("record = 0").join(owners, ["file", "block"]).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("rest"))
    rest = rest.select("file", F.col("owner.block").alias("block"), F.col("owner.n").alias("record"), F.array_join(F.transform("rest", lambda x: x.text), "\n").alias("rest"))
    whole = pieces.where("record > 0").join(rest, ["file", "block", "record"], "left")
    return whole.select("file", "block", "record", F.regexp_replace(F.concat_ws("\n", "text", "rest"), "\r$", "").alias("text"))
