"""Token counts of flat token files by separator scan.

A token file is a run of little-endian unsigned 16-bit ids without an index; an end id closes each document. Files are cut into
blocks. A task searches a block for end ids with one vectorised comparison: every end id closes a document and opens the next. What
a block can't know, where the document that is open at its end closes, comes from a prefix scan over the blocks of the file (one
small row per block): the first end id of any later block.

A document may begin with its id: ``HEADER`` ids of 15 bits each; the end id has more, so none of them is one. Blocks read a
few ids beyond their end for a header that is cut by it.

Files may be empty; ids after the last end id are a document of their own, ``closed`` false. ``flat_files`` writes null texts as
empty documents and null doc_ids as null; repeated rows are counted as often as they occur; an empty table gives no documents. Texts
that encode to the end id itself would be cut there: the end id has to be one that texts don't use, and ``flat_files`` refuses others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.llm.common import new_path, only
from tallyfold.llm.tokens import encoder

#: Ids of a document's header: 64 bits of its doc_id and a flag for null.
HEADER = 5
#: Ids of a block.
BLOCK = 2 << 20
#: The end-of-text id of the 50k byte vocabulary is one that ordinary text never encodes to.
END_ID = 50_256


def header(doc_id: int | None) -> np.ndarray:
    value = 1 << 64 if doc_id is None else doc_id & (1 << 64) - 1
    return np.array([(value >> 15 * k) & 0x7FFF for k in range(HEADER)], "<u2")


def flat_files(docs: DataFrame, tokenizer: str, pattern: str, end_id: int = END_ID) -> tuple[str, DataFrame]:
    """Writes the documents' ids to flat files in the shared folder, and returns the folder and the table of files: name, bytes.
    A task writes one file."""
    if end_id >> 15 == 0:
        raise ValueError("the end id has to be above the 15 bits of a header's ids")
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, pattern), np.array([end_id], "<u2").tobytes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(text or "")
                if (ids == end_id).any():
                    raise ValueError(f"a text holds the end id {end_id}")
                out.append(header(doc_id).tobytes() + ids.tobytes() + end)
            yield pa.record_batch([pa.array(out, pa.binary())], ["ids"])

    path, listed = new_path(spark, "tokens"), new_path(spark, "token-files")
    ids = only(docs, "doc_id", "text").mapInArrow(run, "ids binary")
    store = _Store(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        # a name for each attempt: one that is lost halfway, or runs twice, never mixes with another
        name = f"{task.partitionId():07d}-{task.taskAttemptId()}"
        size = 0
        with store.writer(name) as file:
            for batch in batches:
                for data in batch.column("ids").to_pylist():
                    size += file.write(data)
        yield pa.record_batch([pa.array([name]), pa.array([size], pa.int64())], ["name", "bytes"])

    # only the attempts that Spark reports back count
    ids.mapInArrow(write, "name string, bytes long").write.parquet(listed)
    return path, spark.read.schema("name string, bytes long").parquet(listed)


class _Store:
    """Block reads and file writes in a folder that pyarrow can open; tasks get their own copy."""

    def __init__(self, path: str):
        self.path = "/" + path[5:].lstrip("/") if path.startswith("file:") else path

    def opened(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def writer(self, name: str) -> pa.NativeFile:
        system, root = self.opened()
        system.create_dir(root, recursive=True)
        return system.open_output_stream(f"{root}/{name}")

    def block(self, name: str, start: int, size: int) -> bytes:
        system, root = self.opened()
        with system.open_input_file(f"{root}/{name}") as file:
            file.seek(start)
            return file.read(size)


def block_documents(ids: np.ndarray, first: int, size: int, end_id: int) -> tuple[int | None, np.ndarray, np.ndarray]:
    """Of a block that starts at id number ``first`` of its file and has ``size`` ids (ids may go on for a header): where its first
    end id is (or None), the starts of the documents it opens, and their ends, -1 for one that it doesn't close."""
    ends = np.flatnonzero(ids[:size] == end_id) + first
    starts = np.append(0, ends + 1) if first == 0 else ends + 1
    stops = np.append(ends if first == 0 else ends[1:], -1)[: len(starts)]
    return (int(ends[0]) if len(ends) else None), starts, stops


def doc_ids(ids: np.ndarray, starts: np.ndarray, first: int) -> list[int | None]:
    """The doc_ids in the headers at starts; None for a null one or where no whole header is left."""
    out: list[int | None] = []
    for at in (starts - first).tolist():
        digits = ids[at : at + HEADER]
        value = sum(int(x) << 15 * k for k, x in enumerate(digits)) if len(digits) == HEADER else 1 << 64
        out.append(None if value >> 64 else value - (1 << 64) if value >> 63 else value)
    return out


def documents_of(path: str, files: DataFrame, end_id: int = END_ID, with_header: bool = True, block: int = BLOCK) -> DataFrame:
    """doc_id (null without headers), file, start, n_tokens (without header), closed: a row per document of the
    files (name, bytes) in path."""
    store = _Store(path)
    extra = HEADER if with_header else 0
    blocks = files.select(
        "name", (F.col("bytes") / 2).cast("long").alias("total"), F.explode(F.expr(f"sequence(0L, greatest(bytes div 2 - 1, 0L), {block}L)")).alias("first")).where("total > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            rows: list[tuple] = []
            for name, total, first in zip(*[batch.column(c).to_pylist() for c in ("name", "total", "first")], strict=True):
                size = min(block, total - first)
                ids = np.frombuffer(store.block(name, 2 * first, 2 * (size + extra)), "<u2")
                end, starts, stops = block_documents(ids, first, size, end_id)
                ids_of = doc_ids(ids, starts, first) if with_header else [None] * len(starts)
                rows.append((name, total, first, end, [{"doc_id": d, "start": a, "stop": b} for d, a, b in zip(ids_of, starts.tolist(), stops.tolist(), strict=True)]))
            name, total, first, end, docs = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.record_batch([pa.array(name, pa.string()), *[pa.array(x, pa.int64()) for x in (total, first, end)], pa.array(docs, found)], ["name", "total", "first", "first_end", "docs"])

    # a block's bytes are read by the task that its row is dealt to
    dealt = blocks.repartition(F.col("name"), F.col("first"))
    scanned = dealt.mapInArrow(run, "name string, total long, first long, first_end long, docs array<struct<doc_id: long, start: long, stop: long>>")
    later = W.partitionBy("name").orderBy("first").rowsBetween(1, W.unboundedFollowing)
    stitched = scanned.withColumn("next_end", F.min("first_end").over(later)).select("name", "total", "next_end", F.explode("docs").alias("d"))
    stop = F.when(F.col("d.stop") >= 0, F.col("d.stop")).otherwise(F.col("next_end"))
    out = stitched.select("d.doc_id", F.col("name").alias("file"), "d.start", (F.coalesce(stop, "total") - F.col("d.start") - extra).alias("n_tokens"), stop.isNotNull().alias("closed"), "total")
    return out.where("closed or start < total").drop("total")
