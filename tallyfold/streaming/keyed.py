"""Keyed state that Spark keeps: first and last row per key, and a breaker that counts attempts in their order.

Each operator is a ``transformWithStateInPandas`` with typed state and event-time timers. State lives in the state store (RocksDB, set
by ``use_state_store``) and is checkpointed by changes, so no table is rewritten and a batch that is replayed finds its predecessor's
state. Rows of a key that come in the wrong order, in one batch or over several, are put in order: they wait until the watermark has
passed them. Rows behind the watermark are refused, as by every watermark; without one (``lateness`` None) an operator decides at once,
by the rows it has seen, and refuses nothing.

A null key is a key. Null times and nulls in the order come last. Rows that agree in the whole order are repeats of one write, of which
any is taken. All rows of a key in a batch meet in one task; the size of a batch is set at the source. First and last rows keep the state
of ``BUCKETS`` groups of keys, since a call into Python and its few calls back cost more than the rows of a small key.
"""

from __future__ import annotations

import datetime as dt
import sys
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallyfold.scale import cols

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

EPOCH = dt.datetime(1970, 1, 1)
INTEGERS = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)
#: Groups of keys whose state is read and written together; a checkpoint holds for the number it was made with.
BUCKETS = 4096
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """State with timers needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def passed(ts) -> int:
    """The first watermark, in milliseconds, behind which no row of this time or an earlier one can come."""
    return int((ts - EPOCH) // dt.timedelta(milliseconds=1)) + 1


def plain(value):
    """A pandas cell as the Python value that typed state takes."""
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        value = value.to_pydatetime()
        return value.replace(tzinfo=None) if value.tzinfo else value
    return value.item() if hasattr(value, "item") else value


def tuples(rows: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for frame in rows:
        for row in zip(*[frame[c].array for c in frame.columns], strict=True):
            yield tuple(plain(v) for v in row)


def last_null(values: Sequence) -> tuple:
    """Sort key in which nulls come last."""
    return tuple((v is None, 0 if v is None else v) for v in values)


def frame(rows: list[tuple], schema: T.StructType) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=schema.names)
    for f in schema:  # a column of integers with a null must not become one of floats
        if isinstance(f.dataType, INTEGERS):
            out[f.name] = out[f.name].astype("Int64")
    return out


class Bucketed(StatefulProcessor):
    """Keyed state for the keys of a bucket. Python is called once per bucket and batch, not per key: the number of calls has a bound
    that does not grow with the keys, and the rows of a bucket are read and written by one call each."""

    def __init__(self, schema: T.StructType, keys: Sequence[str], order: Sequence[str]):
        self.schema = schema
        self.own, self.at = [schema.names.index(c) for c in keys], [schema.names.index(c) for c in order]
        self.whole = [i for i, f in enumerate(schema) if isinstance(f.dataType, INTEGERS)]

    def key_type(self) -> list[T.StructField]:
        return [T.StructField(f"key_{n}", self.schema[i].dataType) for n, i in enumerate(self.own)]

    def rows(self, frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """The rows without their bucket, which is the last column; integers that a null beside them made floats are integers again."""
        for row in tuples(frames):
            values = list(row[: len(self.schema)])
            for i in self.whole:
                if isinstance(values[i], float):
                    values[i] = int(values[i])
            yield tuple(values)

    def key(self, row: tuple) -> tuple:
        return tuple(row[i] for i in self.own)

    def close(self) -> None:
        pass


class FirstRow(Bucketed):
    """The least row per key, once and for ever."""

    def __init__(self, schema: T.StructType, keys: Sequence[str], order: Sequence[str], ts: str | None):
        super().__init__(schema, keys, order)
        self.ts = None if ts is None else schema.names.index(ts)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getListState("done", T.StructType(self.key_type()))
        self.least = handle.getListState("least", self.schema)

    def rank(self, row: tuple) -> tuple:
        return last_null([row[i] for i in self.at])

    def finish(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        self.done.appendList([self.key(r) for r in rows])
        yield frame(rows, self.schema)

    def wait(self, held: list[tuple]) -> None:
        """A timer for the first row that the watermark passes; one waits at a time."""
        times = [passed(r[self.ts]) for r in held if r[self.ts] is not None]
        set_before = list(self.handle.listTimers())
        if times and min(times) not in set_before:
            for t in set_before:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(min(times))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        done = {tuple(k) for k in self.done.get()}
        found: dict[tuple, tuple[tuple, tuple]] = {}
        for row in self.rows(rows):
            k = self.key(row)
            if k in done:
                continue
            rank = self.rank(row)
            if k not in found or rank < found[k][0]:
                found[k] = rank, row
        if not found:
            return
        if self.ts is None:
            yield from self.finish([row for _, row in found.values()])
            return
        held = {self.key(r): r for r in map(tuple, self.least.get())}
        better = {k: row for k, (rank, row) in found.items() if k not in held or rank < self.rank(held[k])}
        if better:
            held |= better
            self.least.put(list(held.values()))
            self.wait(list(held.values()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        ready, rest = [], []
        for row in map(tuple, self.least.get()):
            (ready if row[self.ts] is not None and passed(row[self.ts]) <= now else rest).append(row)
        if rest:
            self.least.put(rest)
            self.wait(rest)
        else:
            self.least.clear()
        if ready:
            yield from self.finish(ready)


class LastRow(Bucketed):
    """The greatest row per key so far, whenever there is a new one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        places = [T.StructField(f"order_{n}", self.schema[i].dataType) for n, i in enumerate(self.at)]
        self.last = handle.getListState("last", T.StructType([*self.key_type(), *places]))

    def rank(self, values: Sequence) -> tuple:
        return tuple((v is not None, 0 if v is None else v) for v in values)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = len(self.own)
        last = {v[:n]: v[n:] for v in map(tuple, self.last.get())}
        ranks = {k: self.rank(v) for k, v in last.items()}
        changed: dict[tuple, tuple] = {}
        for row in self.rows(rows):
            k, own = self.key(row), tuple(row[i] for i in self.at)
            rank = self.rank(own)
            if k not in ranks or rank > ranks[k]:
                last[k], ranks[k], changed[k] = own, rank, row
        if changed:
            self.last.put([k + v for k, v in last.items()])
            yield frame(list(changed.values()), self.schema)


class Breaker(StatefulProcessor):
    """Trips a run at the first attempt where too many were rejected; attempts that come early wait for those before them."""

    def __init__(self, rows: T.StructType, out: T.StructType, ts: str, attempt: str, rejected: str, minimum: int, limit: float):
        self.out, self.minimum, self.limit, self.attempt_type = out, minimum, limit, rows[attempt].dataType
        self.at = [rows.names.index(c) for c in (ts, attempt, rejected)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        long = T.LongType()
        self.counts = handle.getValueState("counts", T.StructType([T.StructField("attempted", long), T.StructField("rejected", long), T.StructField("tripped", T.BooleanType())]))
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("micros", long), T.StructField("attempt", self.attempt_type), T.StructField("rejected", long)]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        attempted, bad, tripped = tuple(self.counts.get()) if self.counts.exists() else (0, 0, False)
        found = list(tuples(rows))
        if tripped:
            return
        rows = [[row[i] for i in self.at] for row in found]
        more = [(int((ts - EPOCH) // dt.timedelta(microseconds=1)), attempt, int(bool(rejected))) for ts, attempt, rejected in rows if ts is not None and attempt is not None]
        if more:
            self.waiting.appendList(more)  # one call a batch
            earliest = min(more)[0] // 1000 + 1
            if not any(t <= earliest for t in self.handle.listTimers()):
                self.handle.registerTimer(earliest)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempted, bad, tripped = tuple(self.counts.get()) if self.counts.exists() else (0, 0, False)
        if tripped:
            return
        now = timerValues.getCurrentWatermarkInMs()
        held = sorted(tuple(x) for x in self.waiting.get())
        ready = bisect_left(held, now * 1000, key=lambda x: x[0])
        last = None
        for micros, attempt, rejected in held[:ready]:
            if (micros, attempt) == last:  # a repeat of the attempt before
                continue
            last = micros, attempt
            attempted, bad = attempted + 1, bad + rejected
            if attempted >= self.minimum and bad / attempted > self.limit:
                tripped = True
                yield frame([(*key, attempt, attempted, bad)], self.out)
                break
        self.waiting.clear()
        if not tripped and held[ready:]:
            self.waiting.put(held[ready:])
            self.handle.registerTimer(held[ready][0] // 1000 + 1)
        self.counts.update((attempted, bad, tripped))

    def close(self) -> None:
        pass


def _keyed(rows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, out: T.StructType, mode: str) -> DataFrame:
    use_state_store(rows.sparkSession)
    return rows.groupBy(*cols(keys)).transformWithStateInPandas(processor, out, "Append", mode)


def _by_bucket(rows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, out: T.StructType, mode: str) -> DataFrame:
    name = "bucket"
    while name in {c.lower() for c in rows.columns}:
        name += "_"
    return _keyed(rows.withColumn(name, F.pmod(F.xxhash64(*cols(keys)), F.lit(BUCKETS)).cast("int")), [name], processor, out, mode)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], lateness: str | None = None) -> DataFrame:
    """The first row of each key by ``order``, whose first column is the event time; one row per key for ever.

    With ``lateness`` the least row waits until the watermark has passed its time, so an earlier one of a later batch still wins. Without,
    the least row of the first batch that has the key is it."""
    if lateness is None:
        return _by_bucket(rows, keys, FirstRow(rows.schema, keys, order, None), rows.schema, "None")
    return _by_bucket(rows.withWatermark(order[0], lateness), keys, FirstRow(rows.schema, keys, order, order[0]), rows.schema, "EventTime")


def last_writes(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Changes of the last row per key: a row whenever one comes that is later in ``order`` than all before it."""
    return _by_bucket(rows, keys, LastRow(rows.schema, keys, order), rows.schema, "None")


def breaker(rows: DataFrame, run: Sequence[str], ts: str, attempt: str, rejected: str = "rejected", minimum: int = 10, limit: float = 0.2,
            lateness: str = "10 minutes") -> DataFrame:
    """run, stopped_at, attempted, rejected: once per run, at the first attempt, in the order of (ts, attempt), where at least ``minimum``
    were made and more than the share ``limit`` was rejected. An attempt counts when the watermark has passed it; an attempt that comes
    twice counts once."""
    fields = [rows.schema[k] for k in run] + [T.StructField("stopped_at", rows.schema[attempt].dataType)]
    out = T.StructType([*fields, T.StructField("attempted", T.LongType()), T.StructField("rejected", T.LongType())])
    live = rows.withWatermark(ts, lateness)
    return _keyed(live, run, Breaker(rows.schema, out, ts, attempt, rejected, minimum, limit), out, "EventTime")
