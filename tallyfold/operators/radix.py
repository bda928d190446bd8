"""Exact quantiles over the arrays of a group, without a row per element.

A double's bits, with the sign turned, order like the double itself. They are settled 16 bits at a time: each array gives, for the ranks
that are looked for, a histogram of the next 16 bits of those elements whose higher bits are settled already; histograms of a group are
added up, the bin that holds a rank settles 16 more bits, and after four passes the element is known. Rows are occupied bins, of which an
array has a few hundred at first and a handful later; elements never become rows and a group is never gathered.

The arrays are read once per pass. Null arrays, and null and non-finite elements, take no part.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.scale import cols, join_on, pin

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

BITS, PASSES = 16, 4


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers that order like the doubles."""
    raw = (values + 0.0).view(np.uint64)  # -0.0 becomes 0.0
    sign = raw >> np.uint64(63)
    return raw ^ np.where(sign == 1, np.uint64(0xFFFF_FFFF_FFFF_FFFF), np.uint64(1 << 63))


def doubles(bits: np.ndarray) -> np.ndarray:
    positive = bits >> np.uint64(63) == 1
    return (bits ^ np.where(positive, np.uint64(1 << 63), np.uint64(0xFFFF_FFFF_FFFF_FFFF))).view(np.float64)


def _histograms(rows: DataFrame, group: Sequence[str], values: str, done: int) -> DataFrame:
    """(group, prefix, bin, n): next bits of the elements that have one of the row's ``prefixes`` (an array of longs) in front."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*cols(group)).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, prefix, bins, ns = [], [], [], []
            for i, (array, wanted) in enumerate(zip(batch.column(values), batch.column("prefixes").to_pylist(), strict=True)):
                if not array.is_valid:
                    continue
                found = array.values.to_numpy(zero_copy_only=False).astype(np.float64)
                bits = ordered_bits(found[np.isfinite(found)])
                below = np.uint64(64 - BITS * (done + 1))
                front = bits >> np.uint64(64 - BITS * done) if done else None
                for p in wanted:
                    inside = bits if front is None else bits[front == np.uint64(p)]
                    b, n = np.unique((inside >> below) & np.uint64((1 << BITS) - 1), return_counts=True)
                    at.append(np.full(len(b), i))
                    prefix.append(np.full(len(b), p, np.int64))
                    bins.append(b.astype(np.int32))
                    ns.append(n)
            at, prefix, bins, ns = (np.concatenate([np.zeros(0, t), *x]).astype(t) for x, t in ((at, np.int64), (prefix, np.int64), (bins, np.int32), (ns, np.int64)))
            yield pa.record_batch([*[batch.column(g).take(pa.array(at)) for g in group], pa.array(prefix), pa.array(bins), pa.array(ns)], [*group, "prefix", "bin", "n"])

    counted = rows.select(*cols(group), values, "prefixes").mapInArrow(run, ", ".join([*fields, "prefix long", "bin int", "n long"]))
    return counted.groupBy(*cols(group), "prefix", "bin").agg(F.sum("n").alias("n"))


def array_quantiles(rows: DataFrame, group: Sequence[str], values: str, shares: dict[str, float]) -> DataFrame:
    """(group, one column per share, n): linearly interpolated quantiles of all elements of a group's arrays."""
    group = list(group)
    hist = pin(_histograms(rows.withColumn("prefixes", F.array(F.lit(0).cast("long"))), group, values, 0))
    sizes = hist.groupBy(*cols(group)).agg(F.sum("n").alias("size"))
    ends = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(side).alias("side"), (f((F.col("size") - 1) * F.lit(float(q)))).cast("long").alias("rank"))
                     for k, q in shares.items() for side, f in (("lo", F.floor), ("hi", F.ceil))])
    wanted = sizes.select(*cols(group), "size", F.explode(ends).alias("e")).select(*cols(group), "size", "e.*", F.lit(0).cast("long").alias("prefix"))
    for done in range(PASSES):
        if done:
            each = wanted.groupBy(*cols(group)).agg(F.collect_set("prefix").alias("prefixes"))  # two for each share at most
            hist = _histograms(join_on(rows, each, group), group, values, done)
        before = Window.partitionBy(*cols(group), "prefix").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        placed = hist.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        met = join_on(wanted, placed, [*group, "prefix"]).where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        settled = F.shiftleft(F.col("prefix"), BITS).bitwiseOR(F.col("bin").cast("long"))
        wanted = pin(met.select(*cols(group), "size", "name", "side", (F.col("rank") - F.col("before")).alias("rank"), settled.alias("prefix")))
    value = wanted.mapInArrow(_as_doubles(group), ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.select(*cols(group)).schema], "size long, name string, side string, value double"]))
    out = value.groupBy(*cols(group), "size").agg(*[F.max(F.when((F.col("name") == k) & (F.col("side") == s), F.col("value"))).alias(f"{k}__{s}") for k in shares for s in ("lo", "hi")])
    part = {k: (F.col("size") - 1) * F.lit(float(q)) - F.floor((F.col("size") - 1) * F.lit(float(q))) for k, q in shares.items()}
    return out.select(*cols(group), *[(F.col(f"{k}__lo") + (F.col(f"{k}__hi") - F.col(f"{k}__lo")) * part[k]).alias(k) for k in shares], F.col("size").alias("n"))


def _as_doubles(group: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = doubles(batch.column("prefix").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            yield pa.record_batch([*[batch.column(g) for g in group], batch.column("size"), batch.column("name"), batch.column("side"), pa.array(found)], [*group, "size", "name", "side", "value"])

    return run
