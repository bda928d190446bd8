"""Exact multinomial replicate weights without a row per draw.

A replicate draws n times from n units with replacement. If every unit first gets an independent Poisson count of a mean a little below
one, then, whatever their sum S, the counts are a multinomial sample of S draws; ``n - S`` further draws that each pick a unit make it
one of n. The Poisson counts are a function of (seed, unit, replicate) and are made where they are used, so the rows that are shuffled
are the further draws alone: about ``MARGIN * sqrt(n)`` a replicate, where drawing all would shuffle n.

S is above n with a chance of about 1e-12 a replicate. Such a replicate takes its Poisson counts from the next round of the hash, until S
is not above n; the further draws make its counts multinomial whichever round is taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.hashing import uniform60
from tallyfold.operators import poisson
from tallyfold.scale import col, cols, join_on, pin

#: Standard deviations of S by which the mean of the Poisson counts is lowered.
MARGIN = 7.0


def poisson_mean(n: Column) -> Column:
    """Mean of the Poisson counts of n units; zero for few units, all of whose draws are then made one by one."""
    return F.greatest(F.lit(0.0), 1 - F.lit(MARGIN) / F.sqrt(n.cast("double")))


def unit_hash(seed: int, unit: Sequence[str]) -> Column:
    return uniform60(seed, *[col(u).cast("string") for u in unit])


def poisson_sums(units: DataFrame, strata: Sequence[str], n_boot: int, offsets: Sequence[int]) -> DataFrame:
    """(strata, b, __s): sums of the Poisson counts of each stratum's units, added up in the tasks first. units: strata, h, mean."""
    strata, at = list(strata), np.asarray(offsets, np.int64)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in units.select(*cols(strata)).schema] if strata else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            keys = [tuple(None if pd.isna(x) else x for x in k) for k in zip(*[pdf[s] for s in strata], strict=True)] if strata else [()] * len(pdf)
            places: dict[tuple, list[int]] = {}
            for i, k in enumerate(keys):
                places.setdefault(k, []).append(i)
            for k, rows in places.items():
                h, mean = pdf["h"].to_numpy()[rows], float(pdf["mean"].iloc[rows[0]])
                for i in range(0, len(rows), poisson.CHUNK_ROWS):
                    w = poisson.weights(h[i : i + poisson.CHUNK_ROWS], n_boot, mean, at).sum(axis=0).astype(np.int64)
                    sums[k] = sums[k] + w if k in sums else w
        for k, s in sums.items():
            yield pd.DataFrame({**dict(zip(strata, k, strict=True)), "b": np.arange(n_boot, dtype=np.int32), "__s": s})

    parts = units.select(*cols(strata), "h", "mean").mapInPandas(run, ", ".join([*fields, "b int", "__s long"]))
    return parts.groupBy(*cols(strata), "b").agg(F.sum("__s").alias("__s"))


def drawn_units(indexed: DataFrame, unit: Sequence[str], strata: Sequence[str], n_boot: int, seed: int) -> tuple[DataFrame, list[int]]:
    """(unit, mean, h, extra): each unit's Poisson mean and hash, and the replicates of its further draws; and the hash round of each
    replicate. indexed: (strata, unit's columns, idx, n), one row per unit. The table is saved."""
    strata, unit = list(strata), list(unit)
    units = pin(indexed.select("*", unit_hash(seed, unit).alias("h"), poisson_mean(F.col("n")).alias("mean")))
    offsets = [0] * n_boot
    sizes = units.groupBy(*cols(strata)).agg(F.first("n").alias("n")) if strata else None
    for tries in range(1, 100):
        sums = poisson_sums(units, strata, n_boot, offsets)
        if strata:
            left = pin(join_on(sums, sizes, strata).withColumn("left", F.col("n") - F.col("__s")))
        else:
            left = pin(sums.withColumn("left", units.agg(F.max("n").alias("n")).scalar() - F.col("__s")).withColumn("n", units.agg(F.max("n").alias("n")).scalar()))
        over = [r.b for r in left.where("left < 0").select("b").distinct().collect()]  # almost always none, n_boot at most
        if not over:
            break
        for b in over:
            offsets[b] = tries
    draws = left.where("left > 0").select(*cols(strata), "n", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("left") - 1)).alias("k"))
    label = [col(s).cast("string") for s in strata]
    pick = F.pmod(uniform60(seed, *label, F.lit("draw"), F.col("b").cast("string"), F.col("k").cast("string")), F.col("n"))
    extra = draws.select(*cols(strata), pick.alias("idx"), "b").groupBy(*cols(strata), "idx").agg(F.collect_list("b").alias("extra"))
    keep = list(dict.fromkeys([*strata, *unit]))
    joined = join_on(units, extra, [*strata, "idx"], "left")
    return pin(joined.select(*cols(keep), "mean", "h", F.coalesce("extra", F.array().cast("array<int>")).alias("extra"))), offsets
