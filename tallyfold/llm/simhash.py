"""SimHash near-duplicates: a byte-position inverted index with count filtering, and components of the links.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most ``MAX_BITS`` = 2 bits share at least six of them
(the guaranteed minimum of matches). The index is therefore keyed by six (position, byte) pairs at a time: a pair of fingerprints
meets under C(m, 6) of the 28 keys when it shares m positional bytes, so whoever meets has reached the minimum, and lists stay short
where lists of single bytes would hold 1/256 of the corpus. A list has at most 2**16 different fingerprints, because only two bytes
are free; long lists are searched by flipping bits of the two free bytes, never by comparing all pairs.

Null texts are empty; texts without words have fingerprint 0 and are linked like any other. Repeated rows share a fingerprint. Rows
with a null doc_id are linked too, but a component is named by its smallest non-null doc_id (null if it has none). An empty table
gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import byte_texts, only, removed, saved, text_key, unused

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: The positions of the two bytes that a key leaves free.
FREE = list(combinations(range(8), 2))
#: Lists up to this length are compared pairwise; 1 + 16 + 120 flips are cheaper beyond.
SHORT_LIST = 64


def fingerprint(data: bytes) -> int:
    """Bit i is set if it is set in more than half of the hashes of the word shingles."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[SHINGLE_WORDS:], strict=False)), "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i : i + 4096].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (long), fp (the 64 bits as a signed long); one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(map(fingerprint, byte_texts(batch.column("text"))), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))], ["doc_id", "text_key", "fp"])

    source = only(docs, "doc_id", "text").withColumn("text_key", text_key(F.col("text")))
    id_type = dict(docs.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {id_type}, text_key long, fp long")


def list_links(fps: np.ndarray, free: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of one list: pairs of different fingerprints that differ in at most MAX_BITS bits. Each pair is reported from
    one key only: the first one that leaves all of its differing bytes free."""
    fps = np.unique(fps)
    if len(fps) <= SHORT_LIST:
        a, b = np.triu_indices(len(fps), 1)
        left, right = fps[a], fps[b]
    else:
        x, y = (np.uint64(8 * i) for i in free)
        bits = [np.uint64(1) << (s + np.uint64(j)) for s in (x, y) for j in range(8)]
        lefts, rights = [], []
        for flip in bits + [p | q for p, q in combinations(bits, 2)]:
            other = fps ^ flip
            at = np.searchsorted(fps, other)
            found = (at < len(fps)) & (fps[np.minimum(at, len(fps) - 1)] == other) & (fps < other)
            lefts.append(fps[found])
            rights.append(other[found])
        left, right = np.concatenate(lefts), np.concatenate(rights)
    diff = left ^ right
    near = np.bitwise_count(diff) <= MAX_BITS
    left, right, diff = left[near], right[near], diff[near]
    changed = (diff[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8))) & np.uint64(255) != 0
    first = changed.argmax(axis=1)
    one = changed.sum(axis=1) == 1
    alone = (first == free[1]) | ((first == 0) & (free[1] == 1)) if free[0] == 0 else np.zeros(len(first), bool)
    own = np.where(one, alone, changed[:, free[0]] & changed[:, free[1]])
    return left[own], right[own]


def links(fps: DataFrame) -> DataFrame:
    """a < b (as unsigned): different fingerprints within MAX_BITS bits. fps: column fp, each value once."""
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("free"), F.col("fp").bitwiseAND(F.lit(_mask(free))).alias("key")) for i, free in enumerate(FREE)]))
    lists = (
        fps.select("fp", keys.alias("k")).groupBy("k.free", "k.key").agg(F.collect_list("fp").alias("fps"))  # at most 2**16 values
        .where(F.size("fps") > 1).select("free", "fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for free, values in zip(batch.column("free").to_pylist(), batch.column("fps"), strict=True):
                left, right = list_links(values.values.to_numpy().view(np.uint64), FREE[free])
                a.append(left)
                b.append(right)
            yield pa.record_batch([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    return lists.mapInArrow(run, "a long, b long")


def _mask(free: tuple[int, int]) -> int:
    mask = (1 << 64) - 1
    for i in free:
        mask &= ~(255 << (8 * i))
    return mask - (1 << 64) if mask >> 63 else mask


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for every node of edges (a, b). Large-star and small-star steps in turn; each round
    is written to the shared folder. Rounds grow with the logarithm of the longest path."""
    spark = edges.sparkSession
    edges = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        before = edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.withColumnRenamed("m", "v"))
        edges = saved(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        removed(spark, sorted({f.rpartition("/")[0] for f in before.inputFiles()}))
        if now == state or now[0] == 0:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fp, component_id (smallest doc_id of the component), component (a long that names it): a row per row of docs."""
    prints = saved(fingerprints(docs), "fingerprints")
    by_fp = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = saved(components(links(by_fp.select("fp"))), "roots")
    named = by_fp.join(roots, by_fp.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("component"))
    named = saved(named, "named")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return prints.join(named.join(smallest, "component").select("fp", "component", "component_id"), "fp")


def keep_one(docs: DataFrame, groups: Callable[[DataFrame], DataFrame] = near_duplicates) -> DataFrame:
    """The rows of docs with one row of each component of groups(docs): that of the smallest doc_id (null last), then of the smallest text hash; of
    rows that repeat it in both, one. Columns as in docs."""
    members = saved(groups(docs).select("doc_id", "text_key", "component"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    first = members.groupBy("component").agg(F.min(order).alias("k")).select("component", "k.doc_id", "k.text_key")
    own = [F.col("m.doc_id").eqNullSafe(F.col("f.doc_id")), F.col("m.text_key") == F.col("f.text_key"), F.col("m.component") == F.col("f.component")]
    chosen = members.alias("m").join(first.alias("f"), own, "left_semi").groupBy("doc_id", "text_key").count()
    chosen = saved(chosen, "chosen")
    gone = members.join(chosen, [members.doc_id.eqNullSafe(chosen.doc_id), members.text_key == chosen.text_key], "left_anti").select("doc_id", "text_key").distinct()
    repeated = saved(chosen.where("count > 1").select("doc_id", "text_key"), "repeated")
    out = saved(gone.unionByName(repeated), "gone")
    kept = _with_keys(docs, out, "left_anti")
    if not repeated.isEmpty():
        kept = kept.unionByName(_with_keys(docs, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))
    return kept


def _with_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    name = unused(docs, "__text_key")
    left = docs.withColumn(name, text_key(F.col("text")))
    return left.join(keys, [left.doc_id.eqNullSafe(keys.doc_id), left[name] == keys.text_key], how).drop(name)
