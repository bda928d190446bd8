"""Job monitoring: heartbeats, results, progress, terminal states and failure rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.extraction import failure_breaker, latest_per_key
from tallyfold.scale import cols
from tallyfold.streaming.keyed import breaker, first_per_key, last_writes

TERMINAL = ("COMPLETE", "ERROR")


def stale_heartbeats(beats: DataFrame, keys: Sequence[str], ts: str = "ts", max_age: str = "120 seconds",
                     lateness: str = "0 seconds") -> DataFrame:
    """Silences longer than ``max_age``, one row each, once the watermark has passed them.

    A session with that gap is exactly a run of beats without a stale pause, so its end is
    the moment the job went stale. State is one open session per key, kept by the JVM.
    """
    live = beats.withWatermark(ts, lateness)
    s = F.session_window(ts, max_age)
    return live.groupBy(*cols(keys), s.alias("s")).agg(F.max(ts).alias("last_beat"), F.count(F.lit(1)).alias("beats")).select(
        *cols(keys), "last_beat", F.col("s.end").alias("stale_at"), "beats")


def heartbeat_state(jobs: DataFrame, beats: DataFrame, keys: Sequence[str], now: Column, max_age_seconds: float = 120.0,
                    ts: str = "ts") -> DataFrame:
    """Batch form: every known job, stale when it never beat or its last beat is too old."""
    last = beats.groupBy(*cols(keys)).agg(F.max(ts).alias("last_beat"))
    age = now.cast("double") - F.col("last_beat").cast("double")
    return jobs.select(*cols(keys)).distinct().join(last, list(keys), "left").withColumn(
        "stale", F.coalesce(age > max_age_seconds, F.lit(True)))


def fenced_results(results: DataFrame, jobs: DataFrame) -> DataFrame:
    """Verdict per result: ``jobs`` is the static side (job, expected_token, stale).

    A result whose token no longer matches is refused whatever its time; a stale
    heartbeat does not void a finished result.
    """
    joined = results.join(jobs, "job", "left")
    token_ok = F.col("token").eqNullSafe(F.col("expected_token"))
    status = (F.when(~token_ok, F.lit("token_mismatch")).when(~F.col("exit_reason").eqNullSafe("ok"), F.lit("rejected_exit"))
              .otherwise(F.lit("ingested")))
    return joined.withColumn("status", status).withColumn("accepted", F.col("status") == "ingested")


def missing_results(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Jobs without any result: ``heartbeat_stale`` or ``missing_result``."""
    return jobs.join(results.select("job").distinct(), "job", "left_anti").select(
        "job", F.when(F.col("stale"), F.lit("heartbeat_stale")).otherwise(F.lit("missing_result")).alias("status"))


def first_write_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str], lateness: str | None = None) -> DataFrame:
    """The first write of each key by ``order`` (event time first), for ever; see ``first_per_key``."""
    return first_per_key(rows, keys, order, lateness)


def last_write_wins(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table that a log of ``last_writes`` stands for: the newest row per key."""
    return latest_per_key(changes, keys, order)


def throughput(events: DataFrame, ts: str = "ts", window: str = "1 hour", slide: str | None = None,
               lateness: str = "10 minutes", keys: Sequence[str] = (), quarantined: Column | None = None) -> DataFrame:
    """Events per minute and quarantined events per time window."""
    minutes = F.col("w.end").cast("double") / 60 - F.col("w.start").cast("double") / 60
    bad = quarantined if quarantined is not None else F.lit(False)
    out = events.withWatermark(ts, lateness).groupBy(*cols(keys), F.window(ts, window, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("quarantined"))
    return out.select(*cols(keys), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n",
                      "quarantined", F.round(F.col("n") / minutes, 2).alias("per_minute"))


def terminal_states(updates: DataFrame, key: str, order: Sequence[str], lateness: str | None = None) -> DataFrame:
    """Each key's first terminal status by ``order``, once and for ever: a later one is refused in whatever batch it comes."""
    return first_per_key(updates.where(F.col("status").isin(*TERMINAL)), [key], order, lateness)


__all__ = ["breaker", "failure_breaker", "fenced_results", "first_write_wins", "heartbeat_state", "last_write_wins", "last_writes",
           "missing_results", "stale_heartbeats", "terminal_states", "throughput"]
