"""Helpers shared by the operators: tables in the shared folder, row keys, batches of texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Without the setting a temporary one is made in local mode; elsewhere it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tallyfold-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it goes when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


#: Folders that ``saved`` wrote, by the scopes that are open; what a finished stage left, until the next one begins.
_SCOPES: list[list[str]] = [[]]
_LEFT: list[str] = []


def saved(df: DataFrame, name: str, outer: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """The rows of df, written as Parquet to the shared folder: it cuts the lineage, and the planner knows the table's real size. options
    are those of the writer.

    The table goes with the scope in which it is made (outer: with the one around it), or when the driver's JVM ends."""
    path = new_path(df.sparkSession, name)
    _SCOPES[-2 if outer and len(_SCOPES) > 1 else -1].append(path)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """A scope: the tables saved in it are removed at its end. What it hands on has to be saved with ``outer`` before."""
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield own
    finally:
        _SCOPES.pop()
        removed(spark, own)


@contextmanager
def stage_scratch(spark: SparkSession, docs: DataFrame) -> Iterator[None]:
    """The scope of a stage whose result is written before the next one begins: its tables are removed when that begins, but for those
    that docs, the next one's input, still reads."""
    read = " ".join(docs.inputFiles())
    gone = [path for path in _LEFT if path.rpartition("/")[2] not in read]
    removed(spark, gone)
    _LEFT[:] = [path for path in _LEFT if path not in gone]
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield
    finally:
        _SCOPES.pop()
        _LEFT.extend(own)


def text_key(text: Column) -> Column:
    """A hash that tells rows of one doc_id with different texts apart; null and empty texts differ."""
    return F.xxhash64(F.coalesce(text, F.lit("\x00null")))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, whatever else the table has."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def unused(df: DataFrame, name: str) -> str:
    """name, or a longer one if df has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
