"""Best-fit packing of token sequences: bounded-space online best-fit.

Texts become ids plus an end id. Texts longer than a sequence are cut into full pieces; the first piece takes the remainder. Each
task packs a stream of pieces with a fixed number of open bins. A bitset holds the free spaces at which a bin is open, so the best
fit is the lowest set bit at or above the piece's length; when all bins are open, the fullest closes. Streams are large, dealt out
evenly and sorted longest first, and the number of open bins exceeds what such a stream opens, so little space is lost.

Null texts are empty (their sequence is the end id alone). Repeated rows and repeated or null doc_ids are packed like any others; an
empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyfold.llm.common import only, saved
from tallyfold.llm.tokens import encoder

END_ID = 2
CAPACITY = 1024
OPEN_BINS = 65_536
#: Pieces that one task packs.
STREAM_PIECES = 200_000
#: Pieces that wait in a task when texts are packed as they are encoded.
WAITING = 30_000


def piece_bounds(length: int, capacity: int) -> list[int]:
    """Starts of the pieces of a sequence, and its length; only the first piece may be shorter than capacity when it is cut."""
    first = length if length <= capacity else length % capacity or capacity
    return [0, *range(first, length + 1, capacity)]


def pieces(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, as_bytes: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, on request, ids: an array, or 16-bit little-endian numbers as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, pattern)
        for batch in batches:
            rows, taken = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(text or ""), np.uint16(end_id)).astype("<u4")
                bounds = piece_bounds(len(ids), capacity)
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append((k, a, b - a, zlib.crc32(ids[a:b].tobytes()), (ids[a:b].astype("<u2").tobytes() if as_bytes else ids[a:b].tolist()) if with_ids else None))
                    taken.append(i)
            piece, start, length, crc, kept = zip(*rows, strict=True) if rows else [()] * 5
            columns = [batch.column("doc_id").take(pa.array(taken, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch([*columns, pa.array(kept, pa.binary() if as_bytes else pa.list_(pa.int32()))] if with_ids else columns, [*names, "ids"] if with_ids else names)

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long" + f", ids {'binary' if as_bytes else 'array<int>'}" * with_ids
    return only(docs, "doc_id", "text").mapInArrow(run, schema)


class OpenBins:
    """Open bins by free space; ``levels`` has bit f set if a bin with f free places is open."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.levels, self.n, self.next = capacity, most, 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.at[free]
        name = bins.pop()
        if not bins:
            self.levels &= ~(1 << free)
        self.n -= 1
        return name

    def put(self, length: int) -> tuple[int, int]:
        """The bin that takes a piece, and the offset in it."""
        fits = self.levels >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            name = self._take(free)
        else:
            free, name = self.capacity, self.next
            self.next += 1
        offset, left = self.capacity - free, free - length
        if left:
            if self.n == self.most:
                self._take((self.levels & -self.levels).bit_length() - 1)  # the fullest closes
            self.at[left].append(name)
            self.levels |= 1 << left
            self.n += 1
        return name, offset


def pack(rows: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, stream_pieces: int = STREAM_PIECES) -> DataFrame:
    """The rows (column length, at most capacity) with sequence_id and offset. Sequences of different tasks have different ids."""
    rows = saved(rows, "pieces")
    tasks = -(-rows.count() // stream_pieces) or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, own = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            put = [bins.put(n) for n in batch.column("length").to_pylist()]
            extra = [pa.array([own + name for name, _ in put], pa.int64()), pa.array([offset for _, offset in put], pa.int64())]
            yield pa.record_batch([*batch.columns, *extra], [*batch.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long"
    streams = rows.repartition(tasks).sortWithinPartitions(rows.length.desc(), *[c for c in ("doc_id", "piece") if c in rows.columns])
    return streams.mapInArrow(run, schema)


def packed(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID, open_bins: int = OPEN_BINS, waiting: int = WAITING) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (16-bit little-endian numbers), sequence_id, offset: pieces packed where they are made.

    Ids are neither saved nor shuffled. A task takes up to ``waiting`` pieces, puts them longest first into the bins that are open, and
    goes on; bins stay open from one lot to the next. Against ``pack`` this costs the bins that are open at the end of each task."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins, own = encoder(tokenizer, pattern), OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        rows, id_type = [], None

        def placed() -> Iterator[pa.RecordBatch]:
            out = []
            for row in sorted(rows, key=lambda r: -r[3]):
                name, offset = bins.put(row[3])
                out.append((*row, own + name, offset))
            for i in range(0, len(out), 5_000):
                ids, *rest = zip(*out[i : i + 5_000], strict=True)
                yield pa.record_batch([pa.array(ids, id_type), *[pa.array(x, k) for x, k in zip(rest, kinds, strict=True)]], names)
            rows.clear()

        for batch in batches:
            id_type = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.uint16(end_id)).astype("<u2")
                bounds = piece_bounds(len(ids), capacity)
                rows += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes()), ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
                if len(rows) >= waiting:
                    yield from placed()
        if rows:
            yield from placed()

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"
    return only(docs, "doc_id", "text").mapInArrow(run, schema)
