"""Bootstrap replicates for inputs too large to draw n units n_boot times.

Multinomial draws need n_boot * n shuffled rows. Here every unit gets an independent
Poisson weight per replicate, a function of (seed, unit, replicate) alone, so no draw
is shuffled: the scored rows are range partitioned by score once and each slice turns
its rows into per-replicate class totals. Poisson(1) weights approximate the multinomial ones
(their sum is n only on average); with the few further draws of ``multinomial`` they are exact.

A slice sends back, per key and replicate, its first and last distinct score as they
are and everything between as one summed run. Equal scores cut by a slice border meet
again when the border scores are added up, so the AUC of a replicate is exact for its
weights however rows are spread and however many of them tie.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.hashing import uniform60
from tallyfold.operators.auc import usable
from tallyfold.scale import col, cols, join_on

CHUNK_ROWS = 2048
# Cumulative Poisson(1) probabilities of 0..11 events
CDF = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 12)])])


def steps(mean: float) -> np.ndarray:
    """Cumulative Poisson probabilities of 0..11 events."""
    return CDF if mean == 1.0 else np.cumsum([np.exp(-mean) * mean**k / f for k, f in enumerate(np.cumprod([1.0, *range(1, 12)]))])


def weights(unit_hash: np.ndarray, n_boot: int, mean: float = 1.0, rounds: np.ndarray | None = None) -> np.ndarray:
    """(units, n_boot) Poisson weights by inverse distribution of a mixed 64-bit hash; integer steps that SQL can repeat.

    ``rounds``: of each replicate, which of the hash's rounds it takes, the first by default."""
    with np.errstate(over="ignore"):
        at = np.arange(1, n_boot + 1, dtype=np.uint64)
        if rounds is not None:
            at = at + np.asarray(rounds, np.uint64) * np.uint64(n_boot)
        step = (at * np.uint64(0x9E3779B97F4A7C15))[None, :]
        z = unit_hash.astype(np.int64).view(np.uint64)[:, None] + step
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return np.searchsorted(steps(mean), (z >> np.uint64(11)) * 2.0 ** -53, side="right").astype(np.float64)


class _Run:
    """Per-replicate totals of one key inside one slice, fed in score order."""

    def __init__(self, n_boot: int):
        self.n_boot = n_boot
        self.first = self.last = self.start = None
        self.pos, self.neg, self.wins = (np.zeros(n_boot) for _ in range(3))

    def add(self, score: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
        starts = np.r_[0, np.flatnonzero(score[1:] != score[:-1]) + 1]
        pos = np.add.reduceat(w * y[:, None], starts, axis=0)
        neg = np.add.reduceat(w * (1 - y)[:, None], starts, axis=0)
        values = score[starts]
        if self.last is not None:
            at, lp, ln = self.last
            if at == values[0]:
                pos[0] += lp
                neg[0] += ln
            else:
                values, pos, neg = np.r_[at, values], np.vstack([lp, pos]), np.vstack([ln, neg])
        self.last = (values[-1], pos[-1], neg[-1])
        self._close(values[:-1], pos[:-1], neg[:-1])

    def _close(self, values: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> None:
        if len(values) and self.first is None:
            self.first = (values[0], pos[0], neg[0])
            values, pos, neg = values[1:], pos[1:], neg[1:]
        if not len(values):
            return
        if self.start is None:
            self.start = values[0]
        below = np.cumsum(neg, axis=0) - neg + self.neg
        self.wins += (pos * (below + neg / 2)).sum(axis=0)
        self.pos += pos.sum(axis=0)
        self.neg += neg.sum(axis=0)

    def frames(self) -> Iterator[tuple[float, bool, np.ndarray, np.ndarray, np.ndarray]]:
        zero = np.zeros(self.n_boot)
        for border in (self.first, self.last):
            if border is not None:
                yield border[0], True, border[1], border[2], zero
        if self.start is not None:
            yield self.start, False, self.pos, self.neg, self.wins


def replicate_auc(scored: DataFrame, keys: Sequence[str], n_boot: int, seed: int, unit: Sequence[str] = ("uid",),
                  drawn: tuple[DataFrame, list[int]] | None = None) -> DataFrame:
    """(keys, b, n_pos, n_neg, auc): weighted AUC of every replicate, by Poisson weights or by those of ``drawn``.

    A unit has the same weight under every key, so models and targets stay paired. ``drawn`` is what ``multinomial.drawn_units`` gives
    for the unit's columns; the mean of its Poisson counts has to be one for all rows of a key.
    """
    keys = list(keys)
    own = scored.where(usable() & col("y").isin(0.0, 1.0))
    if drawn is None:
        own = own.withColumns({"__h": uniform60(seed, *[col(u).cast("string") for u in unit]), "__mean": F.lit(1.0), "__extra": F.array().cast("array<int>")})
    else:
        own = join_on(own, drawn[0].select(*cols(unit), F.col("h").alias("__h"), F.col("mean").alias("__mean"), F.col("extra").alias("__extra")), unit)
    rounds = None if drawn is None else np.asarray(drawn[1], np.int64)
    rows = own.select(
        *cols(keys), col("p").cast("double").alias("score"), col("y").cast("double").alias("y"),
        F.col("__h").alias("h"), F.col("__mean").alias("mean"), F.col("__extra").alias("extra"))
    laid = rows.repartitionByRange(*cols(keys), F.col("score"), F.col("h")).sortWithinPartitions(*cols(keys), F.col("score"))
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*cols(keys)).schema.fields)
    schema = f"{key_schema}, b int, score double, border boolean, pos double, neg double, wins double"

    def emit(key: tuple, run: _Run) -> Iterator[pd.DataFrame]:
        for score, border, pos, neg, wins in run.frames():
            yield pd.DataFrame({**dict(zip(keys, key, strict=True)), "b": np.arange(n_boot, dtype=np.int32), "score": score,
                                "border": border, "pos": pos, "neg": neg, "wins": wins})

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, run = None, None
        for pdf in batches:
            for key, part in pdf.groupby(keys, sort=False):
                if key != current:
                    if run is not None:
                        yield from emit(current, run)
                    current, run = key, _Run(n_boot)
                score, y, h, extra = (part[c].to_numpy() for c in ("score", "y", "h", "extra"))
                mean = float(part["mean"].iloc[0])
                for i in range(0, len(part), CHUNK_ROWS):
                    w = weights(h[i:i + CHUNK_ROWS], n_boot, mean, rounds)
                    more = extra[i:i + CHUNK_ROWS]
                    np.add.at(w, (np.repeat(np.arange(len(more)), [len(x) for x in more]), np.concatenate([*more, np.zeros(0, np.int32)]).astype(np.int64)), 1.0)
                    run.add(score[i:i + CHUNK_ROWS], y[i:i + CHUNK_ROWS], w)
        if run is not None:
            yield from emit(current, run)

    runs = laid.mapInPandas(summarise, schema).groupBy(*cols(keys), "b", "score", "border").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("wins").alias("wins"))
    own = F.when(F.col("border"), F.col("pos") * F.col("neg") / 2).otherwise(F.col("wins"))
    along = Window.partitionBy(*cols(keys), "b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    steps = runs.withColumn("wins", own + F.col("pos") * F.coalesce(F.sum("neg").over(along), F.lit(0.0)))
    total = steps.groupBy(*cols(keys), "b").agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("wins").alias("wins"))
    defined = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return total.select(*cols(keys), "b", "n_pos", "n_neg", F.when(
        defined, F.col("wins") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"))
