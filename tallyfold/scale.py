"""Building blocks shared by every ordered operator.

A plain ``Window.partitionBy(target).orderBy(score)`` puts all rows of one target
into one task. Everything here that needs an order works the same way at every
size: rows are range partitioned on (group, order), each slice is handled on its
own and the slices are stitched together by their totals, so one hot group is
spread over as many tasks as it needs. Nulls in a group or an order are values.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "__part"


def col(name: str) -> Column:
    """Column reference that survives spaces, dots and apostrophes in names."""
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: Sequence[str]) -> list[Column]:
    return [col(n) for n in names]


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row, as a scalar subquery."""
    packed = one_row.select(F.struct(*cols(one_row.columns)).alias("s")).scalar()
    return df.withColumn("__one", packed).select(
        *cols(df.columns), *[F.col("__one").getField(c).alias(c) for c in one_row.columns])


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same name in which nulls are equal; the result has the left key columns once."""
    names = {k: f"__on_{i}" for i, k in enumerate(keys)}
    other = right.select(*[col(c).alias(names.get(c, c)) for c in right.columns])
    on = [col(k).eqNullSafe(col(n)) for k, n in names.items()]
    return left.join(other, on, how).drop(*names.values())


def checkpoint_root(spark) -> str:
    """The folder named in spark.checkpoint.dir; one is made only in local mode, where the setting may be absent."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = "file://" + tempfile.mkdtemp(prefix="tallyfold-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark, name: str) -> str:
    """A new path in the shared folder; it is removed when the driver's JVM ends."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def pin(df: DataFrame) -> DataFrame:
    """The rows of df written as Parquet to the shared folder: every reader sees the same rows and slices."""
    path = fresh_path(df.sparkSession, "pin")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Range partition on (group, order) and tag every row with its slice number."""
    return df.repartitionByRange(*cols(group), *order).withColumn(PART, F.spark_partition_id())


def prefix_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    values: Sequence[str],
    *,
    totals: bool = False,
    lags: Sequence[str] = (),
) -> DataFrame:
    """Add ``<value>_before``: the sum over the rows ordered before this one, and on demand ``<value>_total``.

    ``order`` must be unique inside a group; a null group is a group. A total is the sum of
    the group's slice totals, so it costs no further pass over the rows. ``<lag>_prev`` is the
    column's value in the row before this one, for orders that are ascending.
    """
    group, order = list(group), list(order)
    before = Window.unboundedPreceding, -1
    laid = pin(slices(df, group, order))
    keys = [*group, PART]
    local = Window.partitionBy(*cols(keys)).orderBy(*order).rowsBetween(*before)
    step = Window.partitionBy(*cols(keys)).orderBy(*order)
    along = Window.partitionBy(*cols(group)).orderBy(col(PART)).rowsBetween(*before)
    offsets = laid.groupBy(*cols(keys)).agg(
        *[F.sum(col(v)).alias(f"__t_{v}") for v in values],
        *[F.max_by(F.struct(col(c)), F.struct(*order)).alias(f"__e_{c}") for c in lags])
    edge = Window.partitionBy(*cols(group)).orderBy(col(PART))
    offsets = offsets.select(
        *cols(keys), *[F.coalesce(F.sum(col(f"__t_{v}")).over(along), F.lit(0)).alias(f"__o_{v}") for v in values],
        *[F.sum(col(f"__t_{v}")).over(Window.partitionBy(*cols(group))).alias(f"{v}_total") for v in values if totals],
        *[F.lag(f"__e_{c}").over(edge)[c].alias(f"__b_{c}") for c in lags],
    )
    inside = laid.select(
        "*", *[F.coalesce(F.sum(col(v)).over(local), F.lit(0)).alias(f"__l_{v}") for v in values],
        *[F.lag(F.struct(col(c))).over(step).alias(f"__p_{c}") for c in lags],
    )
    return join_on(inside, offsets, keys).select(
        *cols(df.columns), *[(col(f"__l_{v}") + col(f"__o_{v}")).alias(f"{v}_before") for v in values],
        *[col(f"{v}_total") for v in values if totals],
        *[F.when(col(f"__p_{c}").isNotNull(), col(f"__p_{c}")[c]).otherwise(col(f"__b_{c}")).alias(f"{c}_prev") for c in lags],
    )


def ordinal_rank(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str = "rank",
    *,
    size: str | None = None,
    lags: Sequence[str] = (),
) -> DataFrame:
    """1-based position of every row, and in ``size`` the rows of its group; ``order`` must be unique inside a group.

    ``lags`` as in ``prefix_sums``.
    """
    one = f"__one_{name}"
    out = prefix_sums(df.withColumn(one, F.lit(1).cast("long")), group, order, [one], totals=size is not None, lags=lags)
    out = out.withColumn(name, col(f"{one}_before") + 1)
    if size is not None:
        out = out.withColumn(size, col(f"{one}_total"))
    return out.drop(one, f"{one}_before", f"{one}_total")


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probs: dict[str, float],
) -> DataFrame:
    """Linear-interpolation quantiles per group from the distinct-value histogram.

    The built-in exact ``percentile`` keeps every distinct value of a group in one
    buffer; here a group is a set of (value, count) rows that may span many tasks.
    """
    group = list(group)
    hist = df.where(col(value).isNotNull()).groupBy(*cols(group), col(value)).agg(F.count(F.lit(1)).alias("__c"))
    joined = prefix_sums(hist, group, [col(value)], ["__c"], totals=True)
    aggs = []
    for name, q in probs.items():
        pos = (F.col("__c_total") - 1) * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)

        def at(k: Column) -> Column:
            hit = (F.col("__c_before") <= k) & (k < F.col("__c_before") + F.col("__c"))
            return F.max(F.when(hit, col(value).cast("double")))

        frac = F.max(pos - lo)
        aggs.append((at(lo) + (at(hi) - at(lo)) * frac).alias(name))
    return joined.groupBy(*cols(group)).agg(*aggs)
